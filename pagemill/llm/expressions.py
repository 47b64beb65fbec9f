"""Column expressions that more than one native operator uses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STEP = 256


def _plain(sizes: Column, start: Column) -> Column:
    zero = F.struct(start.alias("sum"), F.array().cast("array<bigint>").alias("all"))
    return F.aggregate(sizes, zero, lambda a, x: F.struct((a.sum + x).alias("sum"), F.concat(a.all, F.array(a.sum)).alias("all")), lambda a: a["all"])


def sums_before(sizes: Column) -> Column:
    """For each element of an array of longs, the sum of those before it. In steps, so that n elements cost n ** 1.5."""
    n = F.size(sizes)
    none = F.array().cast("array<array<bigint>>")
    parts = F.when(n > 0, F.transform(F.sequence(F.lit(0), F.floor((n - 1) / _STEP).cast("int")), lambda k: F.slice(sizes, k * _STEP + 1, F.lit(_STEP)))).otherwise(none)
    total = F.transform(parts, lambda p: F.aggregate(p, F.lit(0).cast("long"), lambda a, x: a + x))
    return F.flatten(F.zip_with(parts, _plain(total, F.lit(0).cast("long")), lambda p, s: _plain(p, s)))


def find_all(text: Column, pattern: str) -> Column:
    """array<struct<start, end, text, before>> of a pattern's matches, leftmost and not overlapping, in code points.

    Between the pieces that ``split`` leaves lie the matches, so the lengths of both give every place.
    ``before`` has up to 24 code points of the piece before the match.
    """
    match = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    piece = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(match))
    both = F.zip_with(piece, match, lambda p, m: F.struct(F.length(p).cast("long").alias("gap"), F.length(m).cast("long").alias("size"), m.alias("text"), F.substring(p, -24, 24).alias("before")))
    at = lambda b: F.zip_with(b, sums_before(F.transform(b, lambda x: x.gap + x["size"])), lambda x, s: F.struct((s + x.gap).alias("start"), (s + x.gap + x["size"]).alias("end"), x.text.alias("text"), x.before.alias("before")))
    # one element around it, so that the pairs are computed once
    return F.flatten(F.transform(F.array(both), at))
