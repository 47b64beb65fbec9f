"""Quality scores from histogram gradient-boosted trees over document statistics.

Training takes labels only of documents whose crc32(doc_id as text) mod 5 is not 0, and of those at most
``max_labelled`` (20,000 by default), the ones with the smallest seeded hash of doc_id, one text each (of several with an id
the smallest); that bounds what is broadcast and what comes to the driver. Every document of every size is scored.

Defined results: a null or empty text has the statistics 0 and a score like any other; a null doc_id is not held
out; labels with a null quality do not count, of several labels of a document the largest does; without labels all
scores are 0.5, with labels of one kind near that kind. Repeated rows are scored each; in ``reject_low`` all other
columns pass through, whatever their names.

Scale: scoring is one pass without shuffle. Training reads the texts once more, past a broadcast of the bounded ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.boosting import Trees, fit
from pagemill.llm.common import text_of
from pagemill.llm.doc_stats import NAMES, features
from pagemill.llm.textvec import blocks

THRESHOLD = 0.3


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    found = [features(b) for b in blocks(column)]
    return np.concatenate(found) if found else np.zeros((0, len(NAMES)), np.float32)


def train(docs: DataFrame, labels: DataFrame, *, max_labelled: int = 20_000, seed: int = 4) -> Trees:
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("quality").cast("int").alias("_label"))
    known = known.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(max_labelled)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("_label"), pa.array(list(x), pa.list_(pa.float32()))], ["doc_id", "_label", "x"])

    rows = text_of(docs).join(F.broadcast(known), "doc_id").groupBy("doc_id", "_label").agg(F.min("text").alias("text"))
    rows = rows.mapInArrow(describe, "doc_id long, _label int, x array<float>").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["x"]))
    if not rows:
        return fit(np.zeros((0, len(NAMES))), np.zeros(0))
    return fit(np.array([r["x"] for r in rows], np.float32), np.array([r["_label"] for r in rows], np.float64))


def score(docs: DataFrame, model: Trees, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(_matrix(batch.column("text"))), pa.float64())], ["doc_id", "score"])

    scored = text_of(docs).mapInArrow(apply, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def reject_low(docs: DataFrame, model: Trees, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with all their columns."""
    text = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.score(_matrix(batch.column(text))) >= threshold))

    return docs.mapInArrow(keep, docs.schema)


def scored_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Contract of op4."""
    return score(docs, train(docs, labels))
