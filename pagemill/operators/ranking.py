"""Exact ranks within groups of any size, without a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.session import staged


def ranked(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with _rank (from 0, by ``order``) and _n (rows) within each group of ``by``; nulls come first.

    Rows are sorted by ranges over all tasks and written once. A row's rank is its place in its range, less that of the
    group's first row there, plus what the group has in the ranges before: sums over one row for each (range, group).
    """
    rows = df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order).withColumn("_id", F.monotonically_increasing_id())
    rows = staged(rows, "ranked").withColumn("_range", F.shiftright("_id", 33))
    heads = rows.groupBy("_range", *by).agg(F.min("_id").alias("_first"), F.count("*").alias("_here"))
    group = Window.partitionBy(*by)
    before = F.coalesce(F.sum("_here").over(group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    heads = heads.withColumns({"_before": before, "_n": F.sum("_here").over(group)}).drop("_here")
    heads = heads.withColumnsRenamed({c: f"_of_{c}" for c in ("_range", *by)})
    same = F.col("_range") == F.col("_of__range")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return rows.join(heads, same).withColumn("_rank", F.col("_id") - F.col("_first") + F.col("_before")).select(*df.columns, "_rank", "_n")


def at_rank(value: str, rank: Column) -> Column:
    """Of a group of ranked rows the value at a rank, which may depend on _n."""
    return F.max(F.when(F.col("_rank") == rank, F.col(value)))
