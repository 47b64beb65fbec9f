"""Exact removal of repeated substrings of ``length`` bytes, by suffix arrays over the places where repeats compete.

Whatever of a document is covered by ``length`` bytes that also start earlier (smaller doc_id, or the same document
further left) goes; strings are judged on the input.

1. Every window of ``length`` bytes has an anchor, its smallest hash of ``gram`` bytes (the leftmost of equals). Windows
   in a row with one anchor, and the bytes they cover, are a context. Equal windows have equal anchors at equal places.
2. Rows (anchor hash, context hash, document, place) go to the context's task; before that, a task keeps of equal
   contexts only the first, so that a passage that everybody quotes arrives once a block of input. There, sorted, a
   context that occurred before is repeated as a whole. At most one row for each such task then goes to the anchor's
   task and tells whether it has contexts elsewhere. Where it has one context nothing is left to decide.
3. Anchors whose first occurrences differ in context need a comparison of windows: the contexts' bytes meet in a task, a
   suffix array is built over them in blocks of eight counted from the anchor (``suffix_array``: linear grouping by
   Lyndon prefixes), neighbours in it tell which windows have equal cores, and windows with equal cores and edges are
   equal; all but the earliest are repeated. Of an anchor with more than
   ``SPLIT_BYTES`` of contexts the windows are dealt out one by one, by a hash of their bytes and one of ``SALTS`` parts
   of the documents: suffix arrays of at most ``ARRAY_BYTES`` leave the first of each part, then the first of all.
4. The spans of a document are joined to its text and merged.

Defined results: a null text is the empty text (nothing removed, the hash of no bytes); matches never cross documents; rows
that share a doc_id, or have none, are documents of their own, ordered by doc_id (nulls first), then a hash of the
text, then the text; of equal texts the first keeps its bytes; other columns are ignored; an empty table gives no rows.

Scale: the text is read three times and shuffled twice (by doc_id, for steps 3 and 4); a row of about 40 bytes for each 35
bytes of text is shuffled twice. Contexts, not documents, are compared, so no cluster of copies meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import stage, text_of
from pagemill.llm.suffixes import suffix_array
from pagemill.llm.textvec import U64, Block, blocks, gram_hash, mix, span_hash

#: Bytes under one suffix array, where groups are small; the most of one group; tasks that may share one window's rows.
ARRAY_BYTES, SPLIT_BYTES, SALTS = 1 << 19, 8_000_000, 1024
FIRST, WHOLE, COMPETE, LONE, OTHERS = 0, 1, 2, 3, 4


def keyed(docs: DataFrame) -> DataFrame:
    """key, doc_id, text: key is unique and ascends with the documents' order; it is doc_id wherever that will do."""
    t = text_of(docs)
    again = t.select("doc_id").groupBy("doc_id").agg(F.count("*").alias("n")).filter((F.col("n") > 1) | F.col("doc_id").isNull())
    if not again.limit(1).count():
        return t.select(F.col("doc_id").alias("key"), "doc_id", "text")
    # rows that are equal altogether are told apart by their place, so that no range has to hold them all
    order = t.withColumns({"_tie": F.xxhash64("text"), "_row": F.monotonically_increasing_id()}).repartitionByRange("doc_id", "_tie", "_row").sortWithinPartitions("doc_id", "_tie", "text", "_row")
    return stage(order.select(F.monotonically_increasing_id().alias("key"), "doc_id", "text"), "document-keys")


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if width > done else x


def contexts(b: Block, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, context hash, row in the block, first window (place in the document), number of windows, anchor's distance."""
    n = len(b.buf)
    none = np.zeros(0, np.int64)
    if n < length:
        return none.astype(U64), none.astype(U64), none, none, none, none
    at = np.arange(n - gram + 1)
    h = gram_hash(b.buf, gram)
    low = _sliding_min((h & U64(0xFFFFFFFF00000000)) | at.astype(U64), length - gram + 1)
    valid = np.zeros(n - length + 2, bool)  # the last is a fence
    last = b.ends - length
    full = last >= b.starts
    edge = np.zeros(n + 2, np.int32)
    np.add.at(edge, b.starts[full], 1)
    np.add.at(edge, last[full] + 1, -1)
    valid[:-1] = np.cumsum(edge)[: n - length + 1] > 0
    anchor = (low & U64(0xFFFFFFFF)).astype(np.int64)
    new = valid[:-1].copy()
    new[1:] &= ~valid[:-2] | (anchor[1:] != anchor[:-1])
    lo = np.flatnonzero(new)
    stop = np.flatnonzero(valid[:-1] & np.append(new[1:] | ~valid[1:-1], True)) + 1
    count = stop - lo
    ctx = span_hash(b.buf, lo, lo + count + length - 1)
    row = np.searchsorted(b.starts, lo, "right") - 1
    # of documents that start at one place (empty ones before it), the last has the bytes
    return h[anchor[lo]], ctx, row, lo - b.starts[row], count, anchor[lo] - lo


def merged(key: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans by key, those that touch or overlap joined."""
    if not len(key):
        return key, lo, hi
    o = np.lexsort((lo, key))
    key, lo, hi = key[o], lo[o], hi[o]
    reach = hi.copy()
    # running maximum of the ends within a key: shifted so that keys don't mix
    step = np.cumsum(np.concatenate(([0], key[1:] != key[:-1]))) * (int(hi.max()) + 1)
    reach = np.maximum.accumulate(reach + step) - step
    new = np.concatenate(([True], (key[1:] != key[:-1]) | (lo[1:] > reach[:-1])))
    at = np.flatnonzero(new)
    return key[at], lo[at], reach[np.append(at[1:], len(key)) - 1]


_ROWS = "kind int, anchor long, ctx long, key long, lo long, n long, off long"
_NAMES = ["kind", "anchor", "ctx", "key", "lo", "n", "off"]


def _row_batch(kind: int, anchor: np.ndarray, ctx: np.ndarray, key: np.ndarray, lo: np.ndarray, n: np.ndarray, off: np.ndarray) -> pa.RecordBatch:
    columns = [np.full(len(key), kind, np.int32), anchor.view(np.int64), ctx.view(np.int64), key, lo, n, off]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], _NAMES)


def _places(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            for b in blocks(batch.column("text")):
                anchor, ctx, row, lo, n, off = contexts(b, length, gram)
                key = keys[b.row + row]
                o = np.lexsort((lo, key, anchor, ctx))
                anchor, ctx, key, lo, n, off = anchor[o], ctx[o], key[o], lo[o], n[o], off[o]
                again = np.zeros(len(o), bool)
                again[1:] = (ctx[1:] == ctx[:-1]) & (anchor[1:] == anchor[:-1])
                yield _row_batch(FIRST, *(x[~again] for x in (anchor, ctx, key, lo, n, off)))
                if again.any():
                    k, s, e = merged(key[again], lo[again], lo[again] + n[again])
                    yield _row_batch(WHOLE, mix(k.astype(U64)), np.zeros(len(k), U64), k, s, e - s, np.zeros(len(k), np.int64))

    return docs.select("key", "text").mapInArrow(find, _ROWS)


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows, all of a context in one task -> WHOLE rows and first occurrences of contexts.

    Those are COMPETE where their anchor has several contexts in the task, with one row OTHERS that says so, else LONE.
    """
    last, held, held_before = None, None, False
    for batch in batches:
        kind, anchor, ctx, key, lo, n, off = (batch.column(c).to_numpy() for c in _NAMES)
        done = kind == WHOLE
        if done.any():
            yield _row_batch(WHOLE, *(x[done] for x in (anchor, ctx, key, lo, n, off)))
            anchor, ctx, key, lo, n, off = (x[~done] for x in (anchor, ctx, key, lo, n, off))
        if not len(key):
            continue
        again = np.zeros(len(key), bool)
        again[1:] = (anchor[1:] == anchor[:-1]) & (ctx[1:] == ctx[:-1])
        again[0] = last == (anchor[0], ctx[0])
        last = anchor[-1], ctx[-1]
        if again.any():
            yield _row_batch(WHOLE, *(x[again] for x in (anchor, ctx, key, lo, n, off)))
        first = [x[~again] for x in (anchor, ctx, key, lo, n, off)]
        if held is not None:
            first = [np.append(h, x) for h, x in zip(held, first, strict=True)]
        if not len(first[0]):
            continue
        same = first[0][1:] == first[0][:-1]
        before, after = np.append(held_before, same), np.append(same, False)
        several = (before | after)[:-1]
        if several.any():
            yield _row_batch(COMPETE, *(x[:-1][several] for x in first))
        opens = (~before & after)[:-1]
        if opens.any():
            yield _row_batch(OTHERS, *(x[:-1][opens] for x in first))
        lone = ~several
        if lone.any():
            yield _row_batch(LONE, *(x[:-1][lone] for x in first))
        held, held_before = [x[-1:] for x in first], bool(before[-1])
    if held is not None:
        yield _row_batch(COMPETE if held_before else LONE, *held)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """LONE and OTHERS rows sorted by anchor, at most one a task of ``_decide`` -> COMPETE, where an anchor has several."""
    held, held_before = None, False
    for batch in batches:
        rows = [batch.column(c).to_numpy() for c in _NAMES]
        if held is not None:
            rows = [np.append(h, x) for h, x in zip(held, rows, strict=True)]
        if not len(rows[0]):
            continue
        same = rows[1][1:] == rows[1][:-1]
        before = np.append(held_before, same)
        wanted = (before[:-1] | same) & (rows[0][:-1] == LONE)
        if wanted.any():
            yield _row_batch(COMPETE, *(x[:-1][wanted] for x in rows[1:]))
        held, held_before = [x[-1:] for x in rows], bool(before[-1])
    if held is not None and held_before and held[0][0] == LONE:
        yield _row_batch(COMPETE, *held[1:])


#: key, place in the document, distance of the anchor, bytes
Part = tuple[int, int, int, bytes]


def _windows(size: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Part and offset of every window."""
    count = size - length + 1
    part = np.repeat(np.arange(len(size)), count)
    return part, np.arange(len(part)) - np.repeat(np.cumsum(count) - count, count)


def _repeats(parts: list[Part], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the windows of parts sorted by key and place: key and place of those that also start earlier.

    Equal windows lie alike around their anchor, so the suffix array is built over blocks of ``wide`` bytes counted from
    it, an eighth of the bytes. Neighbours in it give each block the class of the ``core`` blocks from there on; a
    window is told by the class of the first block in it and by its own few bytes around that core.
    """
    wide = 8 if length >= 32 else 1
    core = (length - wide + 1) // wide
    data = np.frombuffer(b"".join(x for *_, x in parts), np.uint8)
    size = np.array([len(x) for *_, x in parts], np.int64)
    phase = np.array([off for _, _, off, _ in parts], np.int64) % wide
    head = np.cumsum(size) - size
    blocks_in = (size - phase) // wide
    first = np.cumsum(blocks_in + 1) - blocks_in - 1  # each part's blocks are followed by a separator
    part = np.repeat(np.arange(len(parts)), blocks_in)
    nth = np.arange(len(part)) - np.repeat(np.cumsum(blocks_in) - blocks_in, blocks_in)
    raw = data[(head[part] + phase[part] + nth * wide)[:, None] + np.arange(wide)]
    _, rank = np.unique(raw.view(">u8").ravel() if wide == 8 else raw.ravel(), return_inverse=True)
    symbols = np.zeros(int((blocks_in + 1).sum()), np.int64)
    symbols[first[part] + nth] = rank + 1
    whole = np.zeros(len(symbols), bool)
    whole[(first[part] + nth)[nth + core <= blocks_in[part]]] = True
    order = np.array(suffix_array(symbols), np.int64)
    order = order[whole[order]]
    run = np.lib.stride_tricks.sliding_window_view(np.append(symbols, np.zeros(core, np.int64)), core)
    new = np.ones(len(order), bool)
    for k in range(1, len(order), 1 << 16):
        b = order[k : k + (1 << 16)]
        new[k : k + len(b)] = (run[order[k - 1 : k - 1 + len(b)]] != run[b]).any(axis=1)
    kind = np.cumsum(new) - 1
    many = np.bincount(kind) > 1 if len(kind) else np.zeros(0, bool)
    class_of = np.full(len(symbols), -1)
    class_of[order] = np.where(many[kind], kind, -1)

    part, offset = _windows(size, length)
    block = np.maximum(0, -(-(offset - phase[part]) // wide))
    lead = phase[part] + block * wide - offset
    kind = class_of[first[part] + block]
    keep = kind >= 0
    part, offset, lead, kind = part[keep], offset[keep], lead[keep], kind[keep]
    edge = length - core * wide
    at = np.arange(edge)[None, :]
    around = np.zeros((len(part), 16), np.uint8)
    around[:, :edge] = data[(head[part] + offset)[:, None] + at + np.where(at >= lead[:, None], core * wide, 0)]
    ends = around.view(np.uint64)
    keys = (ends[:, 1], ends[:, 0], kind * wide + lead)
    o = np.lexsort(keys)
    same = np.zeros(len(o), bool)
    same[1:] = np.logical_and.reduce([k[o][1:] == k[o][:-1] for k in keys])
    hit = np.sort(o[same])  # the sort is stable, so the first of equals is the earliest
    key, low = np.array([k for k, *_ in parts], np.int64), np.array([lo for _, lo, *_ in parts], np.int64)
    return key[part[hit]], low[part[hit]] + offset[hit]


_COMPARED = "key long, lo long, hi long, anchor long, off long, bytes binary"


def _compare(length: int, last: bool, array_bytes: int):
    """Sorted contexts and windows -> spans of repeats and, unless it is the ``last`` round, windows that stay (with bytes)."""
    names = ["key", "lo", "hi", "anchor", "off", "bytes"]

    def spans(key: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
        k, lo, hi = merged(key, at, at + length)
        none = pa.nulls(len(k), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(k), pa.array(lo), pa.array(hi), none, none, pa.nulls(len(k), pa.binary())], names)

    def stay(windows: list[tuple[Part, int]]) -> pa.RecordBatch:
        rows = [(key, lo, lo + length, group, off, data) for (key, lo, off, data), group in windows]
        kinds = [pa.int64()] * 5 + [pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def firsts(windows: list[tuple[Part, int]]) -> tuple[list[tuple[Part, int]], pa.RecordBatch]:
        windows = sorted(windows, key=lambda w: w[0][:2])  # parts of one group may follow each other
        key, at = _repeats([w for w, _ in windows], length)
        gone = set(zip(key.tolist(), at.tolist(), strict=True))
        return [w for w in windows if w[0][:2] not in gone], spans(key, at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts_, held, windows, now = [], 0, [], None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("anchor", "salt", "large", "key", "lo", "off", "bytes"))
            for anchor, salt, large, key, lo, off, data in zip(*columns, strict=True):
                if held > array_bytes and now != (anchor, salt):
                    yield spans(*_repeats(contexts_, length))
                    contexts_, held = [], 0
                if len(windows) * length > array_bytes:
                    left, found = firsts(windows)
                    yield found
                    # the group that goes on is held against its rows to come
                    windows, ended = [w for w in left if w[1] == now[0]], [w for w in left if w[1] != now[0]]
                    if ended and not last:
                        yield stay(ended)
                now = anchor, salt
                if large:
                    windows.append(((key, lo, off, data), anchor))
                else:
                    contexts_.append((key, lo, off, data))
                    held += len(data)
        if len(contexts_) > 1:
            yield spans(*_repeats(contexts_, length))
        if windows:
            left, found = firsts(windows)
            yield found
            if left and not last:
                yield stay(left)

    return run


def repeated_spans(docs: DataFrame, length: int = 100) -> DataFrame:
    """Of ``keyed`` documents: key, lo, hi (bytes) of repeats; spans may overlap."""
    gram = min(32, max(1, length // 2))
    rows = _places(docs, length, gram).repartition("anchor", "ctx").sortWithinPartitions("anchor", "ctx", "key", "lo")
    known = rows.mapInArrow(_decide, _ROWS)
    met = known.filter(F.col("kind") >= LONE).repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_meet, _ROWS)
    decided = stage(known.filter(F.col("kind") < LONE).unionByName(met).select("kind", "anchor", "key", "lo", "n", "off"), "contexts")
    competing = decided.filter(F.col("kind") == COMPETE)
    size = F.sum(F.col("n") + (length - 1))
    large = stage(competing.groupBy("anchor").agg(size.alias("held")).filter(F.col("held") > SPLIT_BYTES).select("anchor", F.lit(True).alias("large")), "large-anchors")
    flagged = competing.join(large, "anchor", "left").withColumn("large", F.coalesce("large", F.lit(False)))
    wanted = flagged.groupBy("key").agg(F.collect_list(F.struct("anchor", "lo", "n", "off", "large")).alias("wanted"))

    def rows_of(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        columns = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["anchor", "salt", "large", "key", "lo", "off", "bytes"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, texts, lists = batch.column("key").to_numpy(), batch.column("text"), batch.column("wanted").to_pylist()
            out: list[tuple] = []
            for k, text, wants in zip(key.tolist(), texts, lists, strict=True):
                raw = text.as_buffer().to_pybytes()
                for w in wants:
                    data = raw[w["lo"] : w["lo"] + w["n"] + length - 1]
                    if not w["large"]:
                        out.append((w["anchor"], 0, False, k, w["lo"], w["off"], data))
                        continue
                    at = np.arange(w["n"])
                    h = span_hash(np.frombuffer(data, np.uint8), at, at + length)
                    group = mix(h ^ np.int64(w["anchor"]).view(U64)).view(np.int64).tolist()
                    salt = int(mix(np.array([k]).view(U64))[0] % U64(SALTS))
                    out += [(g, salt, True, k, w["lo"] + o, w["off"] - o, data[o : o + length]) for o, g in enumerate(group)]
                if len(out) > 10_000:
                    yield rows_of(out)
                    out = []
            if out:
                yield rows_of(out)

    bytes_ = docs.select("key", "text").join(wanted, "key").mapInArrow(fetch, "anchor long, salt long, large boolean, key long, lo long, off long, bytes binary")
    bytes_ = bytes_.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt", "key", "lo")
    compared = stage(bytes_.mapInArrow(_compare(length, False, ARRAY_BYTES), _COMPARED), "compared")
    again = compared.filter(F.col("bytes").isNotNull()).select("anchor", F.lit(0).cast("long").alias("salt"), F.lit(True).alias("large"), "key", "lo", "off", "bytes")
    again = again.repartition("anchor").sortWithinPartitions("anchor", "key", "lo").mapInArrow(_compare(length, True, ARRAY_BYTES), _COMPARED)
    whole = decided.filter(F.col("kind") == WHOLE).select("key", "lo", (F.col("lo") + F.col("n") + (length - 1)).alias("hi"))
    return whole.unionByName(compared.filter(F.col("bytes").isNull()).select("key", "lo", "hi")).unionByName(again.select("key", "lo", "hi"))


def without_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """doc_id, n_bytes, removed (array of lo, hi), kept (binary) of every document."""
    known = keyed(docs)
    spans = repeated_spans(known, length).groupBy("key").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
        for batch in batches:
            sizes, removed, kept = [], [], []
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                raw = text.as_buffer().to_pybytes()
                sizes.append(len(raw))
                pairs = spans.values
                if pairs is None or not len(pairs):
                    removed.append([])
                    kept.append(raw)
                    continue
                lo, hi = pairs.field("lo").to_numpy(), pairs.field("hi").to_numpy()
                _, lo, hi = merged(np.zeros(len(lo), np.int64), lo, hi)
                removed.append([{"lo": s, "hi": e} for s, e in zip(lo.tolist(), hi.tolist(), strict=True)])
                kept.append(b"".join(raw[s:e] for s, e in zip([0, *hi.tolist()], [*lo.tolist(), len(raw)], strict=True)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, kind), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "removed", "kept"])

    joined = known.join(spans, "key", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(cut, "doc_id long, n_bytes long, removed array<struct<lo:bigint,hi:bigint>>, kept binary")


def digests(docs: DataFrame) -> DataFrame:
    """Contract of op3."""
    w = without_repeats(docs)
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s.hi - s.lo)
    return w.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
