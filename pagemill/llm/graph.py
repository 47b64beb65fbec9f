"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import forget, stage


def _seen(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("s")).first()
    return r["n"], int(r["s"])


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b) -> node, component (the smallest node reachable), for every node that has an edge to another one.

    Each round is two joins of the edges with one minimum per node, aggregated before the shuffle and written to the
    shared folder; the edges end as stars. A hub's neighbours may be split over tasks by adaptive skew joins.
    """
    now = stage(edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = _seen(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter(F.col("a") != F.col("b")).distinct()
        large = stage(large, "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        after = stage(small.filter(F.col("a") != F.col("b")).distinct(), "small-star")
        then = _seen(after)
        forget(now)
        forget(large)
        now, done, seen = after, then == seen, then
        if done:
            break
    return now.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component").unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
