"""Mixing sources to target weights by capped water-filling, with seeded repetitions of whole documents.

``plan_mix`` gives one row per source, ``with_repeats`` says how often each document is taken,
``mix_sources`` repeats the rows.

Defined results: a null source is a source of its own, last in order; a null or empty text has size 0 and is
taken like any other (it adds no words); rows that share a doc_id share a fate; an empty table gives no rows;
other columns, whatever their names, pass through ``mix_sources`` and ``with_repeats`` untouched.

Scale: the texts are read once for their sizes (and once more where rows are repeated); everything after is
one aggregate row per source or per (source, hash bucket). No source's rows meet in one task: the cut within a
source is found by two rounds of 1,024 bucket sums and then inside one bucket of a millionth of its rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.common import WORD, broadcast_below, fresh, null_key, stage

BITS = 40


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _order(doc_id: Column, seed: int) -> Column:
    """A document's place in the seeded order, from 0 to 2 ** BITS."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id), 64 - BITS)


def sized(docs: DataFrame, seed: int) -> DataFrame:
    return docs.select(
        "doc_id", F.col("source").alias("_source"), null_key(F.col("source")).alias("_key"),
        word_count(F.col("text")).alias("size"), _order(F.col("doc_id"), seed).alias("_at"),
    )


def _ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with _rank, their place by code point, null last: a range sort, and one count for each range."""
    order = F.col("_source").asc_nulls_last()
    rows = sources.repartitionByRange(order).sortWithinPartitions(order).withColumn("_at", F.monotonically_increasing_id())
    rows = stage(rows, "mix-sources")
    part = F.shiftright("_at", 33).cast("int")
    before, sums = 0, {}
    for r in sorted(rows.groupBy(part.alias("part")).count().collect()):
        sums[r["part"]] = before
        before += r["count"]
    if not sums:
        return rows.withColumnRenamed("_at", "_rank")
    heads = F.array(*[F.lit(sums.get(k, 0)) for k in range(max(sums) + 1)])
    return rows.withColumn("_rank", F.element_at(heads, part + 1) + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_at")


def water_fill(sources: DataFrame, share: float, max_epochs: float, weights: Sequence[float]) -> DataFrame:
    """sources(_source, _key, source_size) -> the same and target.

    Sources above their cap by weight are clamped to it and what they leave is shared anew by weight, which raises the level
    for the others, until a round clamps nobody. A round is one aggregate row.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    w = stage(_ranked(sources).withColumns({"_weight": weight, "_cap": max_epochs * F.col("source_size").cast("double")}), "mix-weights")
    budget = share * (w.agg(F.sum("source_size").alias("s")).first()["s"] or 0)
    above = lambda level: F.col("_cap") < level * F.col("_weight")
    level, clamped = 0.0, -1
    while True:
        r = w.agg(F.count(F.when(above(level), 1)).alias("n"), F.sum(F.when(above(level), F.col("_cap"))).alias("cap"), F.sum(F.when(~above(level), F.col("_weight"))).alias("free")).first()
        if r["n"] == clamped:
            break
        level, clamped = ((budget - (r["cap"] or 0.0)) / r["free"] if r["free"] else math.inf), r["n"]
    target = F.least(F.col("_cap"), F.lit(level) * F.col("_weight"))
    return w.select("_source", "_key", "source_size", target.alias("target"))


def plan_mix(sizes: DataFrame, *, share: float, max_epochs: float, weights: Sequence[float]) -> DataFrame:
    """One row per source: target, whole repetitions, and the cut of the seeded order for the part of a repetition."""
    sources = sizes.groupBy("_source", "_key").agg(F.sum("size").alias("source_size"))
    plan = water_fill(sources, share, max_epochs, weights)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-9)).otherwise(0).cast("long")
    plan = plan.withColumn("whole", whole).withColumn("_want", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size")))
    plan = stage(plan.drop("_source"), "mix-plan")

    rows = sizes.select("_key", "size", "_at")
    base = plan.select("_key", F.col("_want").alias("_left"), F.lit(0).cast("long").alias("_low"))
    for shift in (BITS - 10, BITS - 20):
        here = rows.join(base, "_key").filter(F.shiftright("_at", shift + 10) == F.shiftright("_low", shift + 10))
        sums = here.groupBy("_key", "_left", F.shiftright("_at", shift).alias("_bucket")).agg(F.sum("size").alias("_sum"))
        sums = sums.withColumn("_upto", F.sum("_sum").over(Window.partitionBy("_key").orderBy("_bucket")))
        cross = sums.groupBy("_key").agg(
            F.min(F.when(F.col("_upto") > F.col("_left"), F.col("_bucket"))).alias("_bucket"),
            F.max(F.when(F.col("_upto") <= F.col("_left"), F.col("_upto"))).alias("_taken"),
            F.first("_left").alias("_left"),
        )
        cross = cross.filter(F.col("_bucket").isNotNull())
        base = cross.select("_key", (F.col("_left") - F.coalesce("_taken", F.lit(0))).alias("_left"), F.shiftleft("_bucket", shift).alias("_low"))
    shift = BITS - 20
    last = rows.join(base, "_key").filter(F.shiftright("_at", shift) == F.shiftright("_low", shift))
    last = last.groupBy("_key", "_left", "_low", "_at").agg(F.sum("size").alias("_sum"))
    last = last.withColumn("_upto", F.sum("_sum").over(Window.partitionBy("_key").orderBy("_at")))
    cut = last.groupBy("_key").agg(
        F.coalesce(F.max(F.when(F.col("_upto") <= F.col("_left"), F.col("_at"))), F.first("_low") - 1).alias("_cut"),
        (F.first("_left") - F.coalesce(F.max(F.when(F.col("_upto") <= F.col("_left"), F.col("_upto"))), F.lit(0))).alias("_gap"),
    )
    plan = stage(plan.join(cut, "_key", "left"), "mix-cut")
    # one more document, whose size comes nearest to what is still missing, if it helps
    rest = rows.join(plan.select("_key", "_cut", "_gap"), "_key").filter(F.col("_at") > F.col("_cut"))
    off = F.abs(F.col("size") - F.col("_gap"))
    fill = rest.filter(off < F.col("_gap")).groupBy("_key").agg(F.min_by("_at", F.struct(off, "_at")).alias("_fill"))
    # without a crossing bucket nothing is missing (cut -1) or, by rounding, all is wanted
    no_cut = F.when(F.col("_want") > 0, F.lit(1 << BITS)).otherwise(F.lit(-1))
    return stage(plan.join(fill, "_key", "left").withColumn("_cut", F.coalesce("_cut", no_cut)).drop("_want", "_gap"), "mix-fill")


def _repeats() -> Column:
    part = (F.col("_at") <= F.col("_cut")) | F.coalesce(F.col("_at") == F.col("_fill"), F.lit(False))
    return F.col("whole") + part.cast("long")


def with_repeats(docs: DataFrame, *, share: float = 1.5, max_epochs: float = 2.0, weights: Sequence[float] = (3, 1, 2), seed: int = 17) -> DataFrame:
    """doc_id, size, source_size, target and repeats of every document; the same on every run."""
    sizes = stage(sized(docs, seed), "mix-sizes")
    plan = broadcast_below(plan_mix(sizes, share=share, max_epochs=max_epochs, weights=weights), 100_000)
    return sizes.join(plan, "_key").select("doc_id", "size", "source_size", "target", _repeats().alias("repeats"))


def mix_sources(docs: DataFrame, *, share: float = 1.5, max_epochs: float = 2.0, weights: Sequence[float] = (3, 1, 2), seed: int = 17) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    sizes = stage(sized(docs, seed), "mix-sizes")
    plan = plan_mix(sizes, share=share, max_epochs=max_epochs, weights=weights).select("_key", "whole", "_cut", "_fill")
    at, source, key, whole, cut, fill, n, k = names = fresh(docs, "at", "source_key", "key", "whole", "cut", "fill", "n", "k")
    plan = broadcast_below(plan.toDF(*names[2:6]), 100_000)
    row = docs.withColumns({at: _order(F.col("doc_id"), seed), source: null_key(F.col("source"))})
    part = (F.col(at) <= F.col(cut)) | F.coalesce(F.col(at) == F.col(fill), F.lit(False))
    taken = row.join(plan, F.col(source) == F.col(key)).withColumn(n, F.col(whole) + part.cast("long"))
    taken = taken.filter(F.col(n) > 0).withColumn(k, F.explode(F.array_repeat(F.lit(0), F.col(n).cast("int"))))
    return taken.select(*[F.col(f"`{c}`") for c in docs.columns])


def mixed_words(docs: DataFrame) -> DataFrame:
    """Contract of op1."""
    m = with_repeats(docs)
    return m.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"), "repeats")
