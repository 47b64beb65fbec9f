"""Quality rules: counts of a text, and the log-likelihood ratio of hashed n-grams between trusted and raw text.

Words and pairs of words (A-Z folded) fall into hash buckets, one for every ``LOAD`` distinct n-grams of the corpus, so
that they collide as much at every size. A bucket's ratio is the log of its trusted share (label quality 1, toxic not 1)
over the corpus' trusted share; each bucket has ``PRIOR`` counts beforehand in the corpus' own proportion, so an
unseen or rare n-gram lies near 0 however large the table or the corpus is. A document's ratio is the mean
over its n-grams, and it is kept if that mean reaches ``THRESHOLD``, a constant.

Defined results: a null text or one without words has no n-grams, the ratio 0 and fails the base rule; without trusted
documents every ratio is 0; repeated rows count as often as they occur; other columns are ignored.

Scale: three passes over the texts. The first estimates the distinct n-grams from the ``SAMPLE`` smallest hashes (3 %), the
second counts, the third scores. Up to ``DENSE`` buckets a task's counts are packed by range of buckets and the ratios
are an array of 4 bytes a bucket that the driver sends out; beyond, buckets and ratios stay a distributed table that
the documents' n-grams are joined to, with the same result but a shuffle of all n-grams. Trusted ids set bits of a map
of at most ``FILTER_BITS``, which is broadcast: a document whose bit is not set is not trusted and stays where it was
read. The others are joined to the ids by merge, which shuffles their texts alone; at any number of ids the marks are
exact, only more texts move once the map is full.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import stage, text_of
from pagemill.llm.doc_stats import lines, repeat_words
from pagemill.llm.textvec import U64, Block, Words, blocks, shingles, word_hashes, words

#: Distinct n-grams for each bucket.
LOAD = 4
#: Counts that a bucket has beforehand.
PRIOR = 4.0
#: Buckets up to which the ratios are one array.
DENSE = 1 << 24
SAMPLE, RANGE = 1024, 1 << 15
#: Bits of the map for each trusted id, and bits at most (32 MB).
FILTER_LOAD, FILTER_BITS = 16, 1 << 28
#: Nats per n-gram; text like the trusted text lies near 0.
THRESHOLD = -0.25
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def _hashes(b: Block, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words, and of the pairs with each document's range in them."""
    h = word_hashes(b, w, fold=True)
    g, _, lo, hi = shingles(h, w, 2)
    return h, g, lo, hi


def _buckets(b: Block, w: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    h, g, lo, hi = _hashes(b, w)
    return (h % U64(n)).astype(np.int64), (g % U64(n)).astype(np.int64), lo, hi


def _pack(x: np.ndarray) -> bytes:
    """Integers as planes of bytes, compressed."""
    return zstandard.compress(np.ascontiguousarray(x.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpack(x: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(x), np.uint8).reshape(8, -1).T).view("<i8").ravel()


def distinct_ngrams(docs: DataFrame) -> int:
    """Estimate from the smallest hashes; exact below ``SAMPLE``."""

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.zeros(0, U64)
        for batch in batches:
            for b in blocks(batch.column("text")):
                new = np.concatenate(_hashes(b, words(b))[:2]) >> U64(1)
                if len(kept) == SAMPLE:
                    new = new[new < kept[-1]]
                kept = np.unique(np.concatenate((kept, new)))[:SAMPLE]
        yield pa.RecordBatch.from_arrays([pa.array(kept.astype(np.int64))], ["h"])

    found = [r["h"] for r in text_of(docs).select("text").mapInArrow(least, "h long").distinct().orderBy("h").limit(SAMPLE).collect()]
    return len(found) if len(found) < SAMPLE else round((SAMPLE - 1) / (found[-1] / 2**63))


def _marked(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """text and _trusted: whether the row's doc_id is among the trusted ones."""
    ids = trusted.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    bits = min(FILTER_BITS, 1 << max(15, (FILTER_LOAD * ids.count()).bit_length()))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(bits)) + 1
    at, bit = F.bitmap_bucket_number(place).alias("_at"), F.bitmap_bit_position(place)
    maps = ids.groupBy(at).agg(F.bitmap_construct_agg(bit).alias("_map"))
    byte = F.conv(F.hex(F.substring("_map", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    perhaps = F.col("doc_id").isNotNull() & F.coalesce(F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1, F.lit(False))
    # the maps have FILTER_BITS bits at most, however many ids there are
    seen = text_of(docs).select("*", at).join(F.broadcast(maps), "_at", "left").select("doc_id", "text", perhaps.alias("_perhaps"))
    rest = seen.filter(~F.col("_perhaps")).select("text", F.lit(False).alias("_trusted"))
    # a merge join at every size: the trusted ids grow with the corpus and are not broadcast
    asked = seen.filter("_perhaps").join(ids.withColumn("_trusted", F.lit(True)).hint("merge"), "doc_id", "left")
    return rest.unionByName(asked.select("text", F.coalesce("_trusted", F.lit(False)).alias("_trusted")))


def _seen(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of each block's n-grams, and of those in trusted documents."""
    for batch in batches:
        mark = np.array(batch.column("_trusted").to_pylist(), bool)
        for b in blocks(batch.column("text")):
            w = words(b)
            one, two, lo, hi = _buckets(b, w, n)
            m = mark[b.row : b.row + len(b.starts)]
            yield np.concatenate((one, two)), np.concatenate((one[np.repeat(m, w.last - w.first)], two[np.repeat(m, hi - lo)]))


def log_ratio(raw: np.ndarray, good: np.ndarray, share: float) -> np.ndarray:
    return np.log((good + PRIOR * share) / (share * (raw + PRIOR)))


def bucket_ratios(docs: DataFrame, trusted: DataFrame, n: int) -> np.ndarray:
    """The ratio of each of ``n`` buckets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
        for every, marked in _seen(batches, n):
            np.add.at(raw, every, 1)
            np.add.at(good, marked, 1)
        for lo in range(0, n, RANGE):
            at = np.flatnonzero(raw[lo : lo + RANGE])
            if at.size:
                yield pa.RecordBatch.from_pylist([{"part": lo // RANGE, "step": _pack(np.diff(at, prepend=0)), "raw": _pack(raw[lo + at]), "good": _pack(good[lo + at])}])

    def total(part: pa.Table) -> pa.Table:
        raw, good = np.zeros(RANGE, np.int64), np.zeros(RANGE, np.int64)
        for r in part.to_pylist():
            at = np.cumsum(_unpack(r["step"]))
            raw[at] += _unpack(r["raw"])
            good[at] += _unpack(r["good"])
        return pa.table({"part": part.column("part")[:1], "n_raw": [int(raw.sum())], "n_good": [int(good.sum())], "raw": [_pack(raw)], "good": [_pack(good)]})

    packed = _marked(docs, trusted).mapInArrow(count, "part long, step binary, raw binary, good binary")
    rows = packed.groupBy("part").applyInArrow(total, "part long, n_raw long, n_good long, raw binary, good binary").collect()
    out, all_good = np.zeros(n, np.float32), sum(r["n_good"] for r in rows)
    if all_good:
        share = all_good / sum(r["n_raw"] for r in rows)
        for r in rows:
            lo = r["part"] * RANGE
            out[lo : lo + RANGE] = log_ratio(_unpack(r["raw"]), _unpack(r["good"]), share)[: n - lo]
    return out


COLUMNS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, ratio double"


def measure(texts: DataFrame, weights: np.ndarray | None) -> DataFrame:
    """The base counts and the length-normalised ratio (0 without ``weights``) of every document; columns after the text pass through."""
    sent = None if weights is None else texts.sparkSession.sparkContext.broadcast(weights)

    def one(b: Block) -> list[np.ndarray]:
        w = words(b)
        n = w.last - w.first
        total = lambda flag: (lambda c: c[b.ends] - c[b.starts])(np.concatenate(([0], np.cumsum(flag))))
        chars = np.concatenate(([0], np.cumsum((b.buf & 0xC0) != 0x80)))
        size = chars[w.end] - chars[w.start]
        sums = np.concatenate(([0], np.cumsum(size)))
        ratio = np.zeros(len(n))
        if sent is not None:
            first, second, lo, hi = _buckets(b, w, len(sent.value))
            a, c = (np.concatenate(([0.0], np.cumsum(sent.value[x], dtype=np.float64))) for x in (first, second))
            ratio = (a[w.last] - a[w.first] + c[hi] - c[lo]) / np.maximum(1, n + hi - lo)
        return [n, sums[w.last] - sums[w.first], total(_SYMBOL[b.buf]), lines(b, w)[1], repeat_words(word_hashes(b, w, fold=False), w), ratio]

    more = texts.columns[2:]
    names = [x.split()[0] for x in COLUMNS.split(", ")] + more

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [one(b) for b in blocks(batch.column("text"))]
            columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 5 + [np.zeros(0)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, columns), *map(batch.column, more)], names)

    return texts.mapInArrow(apply, ", ".join([COLUMNS, *(f"{c} {texts.schema[c].dataType.simpleString()}" for c in more)]))


def measure_by_join(docs: DataFrame, trusted: DataFrame, n: int) -> DataFrame:
    """``measure`` with the ratios of ``n`` buckets as a table that no process holds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for every, marked in _seen(batches, n):
            at, raw = np.unique(every, return_counts=True)
            good = np.zeros(len(at), np.int64)
            np.add.at(good, np.searchsorted(at, marked), 1)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw), pa.array(good)], ["bucket", "raw", "good"])

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("_row").to_numpy()
            for b in blocks(batch.column("text")):
                w = words(b)
                one, two, lo, hi = _buckets(b, w, n)
                of = row[b.row : b.row + len(b.starts)]
                pair = np.stack((np.concatenate((np.repeat(of, w.last - w.first), np.repeat(of, hi - lo))), np.concatenate((one, two))))
                (r, at), c = np.unique(pair, axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(r), pa.array(at), pa.array(c)], ["_row", "bucket", "c"])

    counts = stage(_marked(docs, trusted).mapInArrow(count, "bucket long, raw long, good long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")), "buckets")
    sums = counts.agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).first()
    texts = stage(text_of(docs).withColumn("_row", F.monotonically_increasing_id()), "texts")
    base = measure(texts, None)
    if not sums["good"]:
        return base.drop("_row")
    share = sums["good"] / sums["raw"]
    ratios = counts.select("bucket", F.log((F.col("good") + PRIOR * share) / (share * (F.col("raw") + PRIOR))).alias("w"))
    per = texts.mapInArrow(grams, "_row long, bucket long, c long").join(ratios.hint("merge"), "bucket").groupBy("_row").agg((F.sum(F.col("c") * F.col("w")) / F.sum("c")).alias("_ratio"))
    return base.join(per, "_row", "left").withColumn("ratio", F.coalesce("_ratio", F.lit(0.0))).drop("_row", "_ratio")


def judged(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, dense: int = DENSE) -> DataFrame:
    """Contract of op7, and the ratio."""
    trusted = labels.filter((F.col("quality") == 1) & ~(F.coalesce(F.col("toxic"), F.lit(0)) == 1) & F.col("doc_id").isNotNull())
    n = max(1, math.ceil(distinct_ngrams(docs) / LOAD))
    m = measure(text_of(docs), bucket_ratios(docs, trusted, n)) if n <= dense else measure_by_join(docs, trusted, n)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return m.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("ratio") >= threshold))
