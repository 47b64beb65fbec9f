"""Benchmark items inside documents: MinHash containment search, partitioned by the items' size, then exact containment.

An item's sketch is the ``SKETCH`` smallest hashes of its distinct shingles under one hash function. Items are parted by
size into powers of two; a partition's bound is the largest hash in any of its sketches, so of a long document only the
hashes up to the bound (about SKETCH / size of them) can matter, and a short item is found in a document of any length:
the sketch is taken from the item alone, and the share of it that a document has estimates the containment whatever the
document's size. Pairs with the estimate at 4 of 16 at least (at 80 percent, 1 pair in 10 million falls below) are
verified: shared shingles of the two whole sets against the item's.

Defined results: words are split at white space and A-Z folded; an item of fewer words than a shingle has one shingle,
its whole sequence, which is sought as that sequence; null texts and items without words match nothing; items that share an
item_id or a text are each reported; a null doc_id or item_id is reported as null; repeated documents are reported
each; other columns are ignored, in ``drop_leaks`` passed through whatever their names.

Scale: items are sketched by tasks and packed into block files of at most ``BLOCK_ITEMS`` items or ``BLOCK_BYTES`` of hashes
in the shared folder; the driver sees one manifest row for each. Documents are read once and never shuffled: a worker holds
its batch against one block after another and keeps the blocks it read last, up to ``HELD_BYTES``.
"""

from __future__ import annotations

import pickle
import uuid
from collections import OrderedDict, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import scratch, stage, text_of
from pagemill.llm.textvec import U64, Block, blocks, shingles, word_hashes, words

SKETCH, LEAST = 16, 4
#: Most items and bytes of hashes in a block file, and bytes of blocks that a worker keeps.
BLOCK_ITEMS, BLOCK_BYTES, HELD_BYTES = 20_000, 32 << 20, 256 << 20


def _sets(b: Block, width: int) -> Iterator[np.ndarray]:
    w = words(b)
    g, _, lo, hi = shingles(word_hashes(b, w, fold=True), w, width)
    for s, e in zip(lo.tolist(), hi.tolist(), strict=True):
        yield np.unique(g[s:e])


class Items:
    """A block of items ready to be searched for."""

    def __init__(self, rows: list[tuple[int | None, str | None]], width: int):
        self.ids, self.sets, self.parts = [r[0] for r in rows], [], {}
        by_width: dict[tuple[int, int], list[int]] = defaultdict(list)
        for k, (_, text) in enumerate(rows):
            column = pa.array([text or ""])
            b = next(blocks(column))
            w = words(b)
            n = int(w.last[0] - w.first[0])
            own = min(n, width)  # a shorter item is sought with shingles of its own length
            s = next(_sets(b, own)) if n else np.zeros(0, U64)
            self.sets.append(s)
            if n:
                by_width[own, int(len(s)).bit_length()].append(k)
        for key, members in by_width.items():
            values = np.concatenate([self.sets[k][:SKETCH] for k in members])
            owner = np.repeat(members, [min(SKETCH, len(self.sets[k])) for k in members])
            o = np.argsort(values, kind="stable")
            distinct, first = np.unique(values[o], return_index=True)
            self.parts[key] = distinct, np.append(first, len(o)), owner[o], distinct[-1]

    def widths(self) -> list[int]:
        return sorted({w for w, _ in self.parts})

    def search(self, b: Block, width: int, threshold: float) -> Iterator[tuple[int, int, int, float]]:
        """(row, item, shared, containment) of the block's documents and the items of this width."""
        w = words(b)
        h = word_hashes(b, w, fold=True)
        g, _, lo, hi = shingles(h, w, width)
        inside = np.repeat(w.last - w.first >= width, hi - lo)
        doc = np.repeat(np.arange(len(lo)), hi - lo)
        for (own, _), (values, first, owner, bound) in self.parts.items():
            if own != width:
                continue
            low = np.flatnonzero((g <= bound) & inside)
            at = np.searchsorted(values, g[low])
            hit = values[np.minimum(at, len(values) - 1)] == g[low]
            if not hit.any():
                continue
            # a hash counts once a document
            pair = np.unique(np.column_stack((doc[low[hit]], at[hit])), axis=0)
            seen: dict[tuple[int, int], int] = defaultdict(int)
            for d, v in pair.tolist():
                for k in owner[first[v] : first[v + 1]].tolist():
                    seen[d, k] += 1
            own_set: dict[int, np.ndarray] = {}
            for (d, k), n in seen.items():
                if n * SKETCH >= LEAST * min(SKETCH, len(self.sets[k])):
                    if d not in own_set:
                        own_set[d] = np.unique(g[lo[d] : hi[d]])
                    shared = len(np.intersect1d(self.sets[k], own_set[d], assume_unique=True))
                    if shared >= threshold * len(self.sets[k]) - 1e-9:
                        yield b.row + d, k, shared, shared / len(self.sets[k])


def item_blocks(benchmark: DataFrame, width: int) -> list[str]:
    """Files of packed ``Items``, written by the tasks that read the items."""
    spark = benchmark.sparkSession
    items = stage(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text"), "items")
    size = items.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    parts = max(1, -(-size["n"] // BLOCK_ITEMS), -(-(size["bytes"] or 0) // BLOCK_BYTES))
    folder = scratch(spark, "item-blocks")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        held: list[tuple[int | None, str | None]] = []

        def out() -> pa.RecordBatch:
            items = Items(held, width)
            where, path = fs.FileSystem.from_uri(f"{folder}/{uuid.uuid4().hex}")
            where.create_dir(path.rpartition("/")[0], recursive=True)
            with where.open_output_stream(path) as f:
                f.write(pickle.dumps(items))
            held.clear()
            return pa.RecordBatch.from_pylist([{"name": path.rpartition("/")[2]}])

        room = 0
        for batch in batches:
            for row in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if held and (len(held) >= BLOCK_ITEMS or room + len(row[1] or "") > BLOCK_BYTES):
                    yield out()
                    room = 0
                held.append(row)
                room += len(row[1] or "")
        if held:
            yield out()

    # a block has items from anywhere, so that equal ones do not crowd in one
    names = stage(items.repartition(parts).mapInArrow(pack, "name string"), "item-manifest").collect()
    return [f"{folder}/{r['name']}" for r in names]


_held: OrderedDict[str, tuple[Items, int]] = OrderedDict()


def _block(uri: str) -> Items:
    """A block file, from this worker's memory where it is held."""
    if uri not in _held:
        from pyarrow import fs

        where, path = fs.FileSystem.from_uri(uri)
        with where.open_input_stream(path) as f:
            raw = f.read()
        while _held and sum(n for _, n in _held.values()) + len(raw) > HELD_BYTES:
            _held.popitem(last=False)
        _held[uri] = pickle.loads(raw), len(raw)
    _held.move_to_end(uri)
    return _held[uri][0]


def _search(column: pa.Array, blocks_of_items: list[str], threshold: float) -> Iterator[tuple[int, Items, int, int, float]]:
    for uri in blocks_of_items:
        items = _block(uri)
        for b in blocks(column):
            for width in items.widths():
                for r, *found in items.search(b, width, threshold):
                    yield r, items, *found


def find_items(docs: DataFrame, benchmark: DataFrame, *, threshold: float = 0.8, width: int = 5) -> DataFrame:
    """doc_id, item_id, n_item (shingles), n_shared, containment of each pair at the threshold."""
    files = item_blocks(benchmark, width)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            out = [(ids[r], items.ids[k], len(items.sets[k]), n, c) for r, items, k, n, c in _search(batch.column("text"), files, threshold)]
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64()] * 4 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(columns, kinds, strict=True)], ["doc_id", "item_id", "n_item", "n_shared", "containment"])

    return text_of(docs).mapInArrow(search, "doc_id long, item_id long, n_item long, n_shared long, containment double")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, *, threshold: float = 0.8, width: int = 5) -> DataFrame:
    """The rows of ``docs`` in which no item was found; a row is judged by its own text, also where ids repeat."""
    text, files = docs.columns.index("text"), item_blocks(benchmark, width)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.ones(batch.num_rows, bool)
            for r, *_ in _search(batch.column(text), files, threshold):
                ok[r] = False
            yield batch.filter(pa.array(ok))

    return docs.mapInArrow(clean, docs.schema)
