"""Page geometry: reading order by recursive cuts, regions, headings, margins, overlap with tables, visual lines.

Boxes are structs (x0, y0, x1, y1) in points from the top left. What is a comparison of a block with constants, its page or
its neighbours is an expression; the recursive cut and the line clusters, which depend on what they did before, run
by Arrow batches over one array a page.
"""

from __future__ import annotations

import math
import string

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values
NARROW, SPAN_SHARE, SPAN_WIDTH, BASELINE = 100.0, 0.70, 200.0, 3.0
LEAST_OVERLAP, LEAST_GUTTER, TOP_SLACK = 0.20, -15.0, 2.0
HEADING_RATIO, COLUMN_JUMP, LINE_SLACK = 1.12, 50.0, 2.0
BOILERPLATE = (
    r"(?i)^(open\s+access|citation:|received:|accepted:|published:|copyright\b|all\s+rights\s+reserved|creative\s+commons|https?://|doi:10\.|doi\.org/|"
    r"page\s+\d+\s+of\s+\d+|\d+\s*/\s*\d+|vol\.\s*\d+|volume\s+\d+|issue\s+\d+|issn\s*\d+|isbn\s*\d+)"
)
NOISE = r"(?i)^(.)\1{3,}$|^[a-z]?1{4,}[a-z]?$|^(a1|1a|01|10){3,}$"

Item = tuple[float, float, float, float, int]  # a box and the block's seq


def _top_down(items: list[Item]) -> list[Item]:
    return sorted(items, key=lambda b: (math.floor(b[1] / BASELINE), b[0], b[4]))


def _bands(items: list[Item], spans) -> list[list[Item]]:
    """Items from top to bottom; each wide one is a band of its own and ends the one before."""
    out: list[list[Item]] = [[]]
    for b in sorted(items, key=lambda b: b[1]):
        if spans(b):
            out += [[b], []]
        else:
            out[-1].append(b)
    return [x for x in out if x]


def _gutter(items: list[Item]) -> tuple[list[Item], list[Item]] | None:
    """The best cut between two columns that run side by side."""
    by_centre = sorted(items, key=lambda b: b[0] + b[2])
    best, score = None, 0.0
    for k in range(1, len(items)):
        cut = (by_centre[k - 1][0] + by_centre[k - 1][2] + by_centre[k][0] + by_centre[k][2]) / 4
        left = [b for b in items if (b[0] + b[2]) / 2 < cut]
        right = [b for b in items if (b[0] + b[2]) / 2 >= cut]
        if not left or not right:
            continue
        gap = min(b[0] for b in right) - max(b[2] for b in left)
        tops, ends = [min(b[1] for b in s) for s in (left, right)], [max(b[3] for b in s) for s in (left, right)]
        height = max(ends) - min(tops)
        shared = max(0.0, min(ends) - max(tops)) / height if height > 0 else 0.0
        value = (100.0 if gap >= 0 else gap) + 50.0 * shared
        if shared >= LEAST_OVERLAP and gap >= LEAST_GUTTER and value > score:
            best, score = (left, right), value
    return best


def cut_order(items: list[Item]) -> list[Item]:
    """Reading order of a page's boxes."""
    if len(items) < 2:
        return items
    width = max(b[2] for b in items) - min(b[0] for b in items)
    if width < NARROW:
        return _top_down(items)
    spans = lambda b: width > SPAN_WIDTH and b[2] - b[0] >= SPAN_SHARE * width
    wide = sum(map(spans, items))
    if 0 < wide < len(items):
        return [b for band in _bands(items, spans) for b in (band if spans(band[0]) else cut_order(band))]
    columns = _gutter(items)
    if columns is None:
        return _top_down(items)
    top = min(b[1] for b in items) + TOP_SLACK
    above = [b for b in items if b[3] <= top]
    if above and len(above) < len(items):
        return cut_order(above) + cut_order([b for b in items if b[3] > top])
    return cut_order(columns[0]) + cut_order(columns[1])


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _ordered(pages: pd.Series) -> pd.Series:
    def one(blocks) -> list[int]:
        placed = [(b["box"]["x0"], b["box"]["y0"], b["box"]["x1"], b["box"]["y1"], b["seq"]) for b in blocks if b["box"] is not None]
        return [b[4] for b in cut_order(placed)] + sorted(b["seq"] for b in blocks if b["box"] is None)

    return pages.map(one)


def reading_order(blocks: DataFrame) -> DataFrame:
    """doc_id, page, seq, box -> the same with rank within the page; blocks without a box come last, by seq."""
    pages = blocks.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(F.struct("seq", "box"))).alias("b"))
    ranks = pages.select("doc_id", "page", F.posexplode(_ordered("b")).alias("rank", "seq"))
    return blocks.join(ranks, ["doc_id", "page", "seq"])


def baseline_order(y: Column, x: Column, seq: Column) -> list[Column]:
    return [F.floor(y / BASELINE), x, seq]


def two_column_order(page_width: Column, y: Column, x: Column) -> list[Column]:
    return [x > 0.48 * page_width, F.bround(y / 12), x]


def area(b: Column) -> Column:
    return F.greatest(F.lit(0.0), b.x1 - b.x0) * F.greatest(F.lit(0.0), b.y1 - b.y0)


def intersection(a: Column, b: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(a.x1, b.x1) - F.greatest(a.x0, b.x0)) * F.greatest(F.lit(0.0), F.least(a.y1, b.y1) - F.greatest(a.y0, b.y0))


def overlap_ratio(a: Column, b: Column) -> Column:
    """Share of a's area inside b; 0 without an area."""
    return F.when(area(a) > 0, intersection(a, b) / area(a)).otherwise(0.0)


def intersects(a: Column, b: Column) -> Column:
    return (a.x0 < b.x1) & (b.x0 < a.x1) & (a.y0 < b.y1) & (b.y0 < a.y1)


def contains_point(b: Column, x: Column, y: Column) -> Column:
    return x.between(b.x0, b.x1) & y.between(b.y0, b.y1)


def flip(b: Column, page_height: Column) -> Column:
    """From an origin at the bottom left to one at the top left."""
    return F.struct(b.x0.alias("x0"), (page_height - F.greatest(b.y0, b.y1)).alias("y0"), b.x1.alias("x1"), (page_height - F.least(b.y0, b.y1)).alias("y1"))


def quad_box(points: Column) -> Column:
    """array<struct<x, y>> -> box."""
    xs, ys = F.transform(points, lambda p: p.x), F.transform(points, lambda p: p.y)
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def union_box(box: str = "box") -> Column:
    """Aggregate: the box around all boxes."""
    return F.struct(*[f(F.col(f"{box}.{k}")).alias(k) for f, k in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))])


def outside_tables(blocks: DataFrame, tables: DataFrame, share: float = 0.6) -> DataFrame:
    """Blocks of which no table of their page covers more than ``share``."""
    t = tables.select(F.col("doc_id").alias("t_doc"), F.col("page").alias("t_page"), F.col("box").alias("t_box"))
    on = (F.col("doc_id") == F.col("t_doc")) & (F.col("page") == F.col("t_page")) & (overlap_ratio(F.col("box"), F.col("t_box")) > share)
    return blocks.join(t, on, "left_anti")


def regions(blocks: DataFrame) -> DataFrame:
    """doc_id, page, region, kind, block_ids, box: header, columns (a new one where centres jump), footnotes.

    blocks(doc_id, page, rank, block_id, box, page_width, page_height)
    """
    h, w = F.coalesce("page_height", F.lit(1000.0)), F.coalesce("page_width", F.lit(1000.0))
    wide, b = F.col("box.x1") - F.col("box.x0"), F.col("box")
    kind = F.when(b.y0.isNotNull() & (b.y0 >= 0.85 * h) & (wide < 0.6 * h), "footnote").when(b.y1.isNotNull() & (b.y1 <= 0.10 * h) & (wide >= 0.5 * w), "header").otherwise("column")
    placed = blocks.withColumns({"kind": kind, "_cx": (b.x0 + b.x1) / 2})
    order = Window.partitionBy("doc_id", "page", "kind").orderBy("rank")
    jump = (F.col("kind") == "column") & (F.abs(F.col("_cx") - F.lag("_cx").over(order)) > COLUMN_JUMP)
    alone = (F.col("kind") == "column") & (F.col("_cx").isNull() | F.lag("_cx").over(order).isNull()) & F.lag("rank").over(order).isNotNull()
    island = F.sum(F.when(jump | alone, 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    marked = placed.withColumn("island", island)
    out = marked.groupBy("doc_id", "page", "kind", "island").agg(F.array_sort(F.collect_list(F.struct("rank", "block_id"))).alias("m"), union_box().alias("box"))
    place = F.when(F.col("kind") == "header", 0).when(F.col("kind") == "column", 1).otherwise(2)
    n = F.row_number().over(Window.partitionBy("doc_id", "page").orderBy(place, "island")) - 1
    return out.select("doc_id", "page", n.alias("region"), "kind", F.transform("m", lambda x: x.block_id).alias("block_ids"), "box")


def is_noise(text: Column) -> Column:
    return ~text.rlike("[ \\n]") & text.rlike(NOISE)


def is_heading(text: Column, font_size: Column, body_median: Column, ratio: float = HEADING_RATIO) -> Column:
    """Larger than the body and built like a heading."""
    raw = F.regexp_replace(text, "(?U)^\\s+|\\s+$", "")
    words = F.size(F.filter(F.split(raw, "(?U)\\s+"), lambda x: x != ""))
    marks = F.length(raw) - F.length(F.regexp_replace(raw, "[" + "".join("\\" + c for c in string.punctuation) + "]", ""))
    ends = F.substring(raw, -1, 1).isin(".", "?", "!")
    lines = F.size(F.filter(F.split(raw, "\n"), lambda x: F.trim(x) != ""))
    fits = (F.length(raw) > 0) & ~((F.length(raw) <= 2) & ~raw.rlike("\\p{L}")) & (marks / F.greatest(F.length(raw), F.lit(1)) <= 0.5) & (words <= 25)
    fits = fits & ~(ends & ((words > 6) | raw.contains(". "))) & ~((lines > 2) & (words > 12))
    return F.coalesce((font_size > ratio * body_median) & fits, F.lit(False))


def smooth_headings(blocks: DataFrame) -> DataFrame:
    """After a heading, one that ends with a period or has more than eight words is a paragraph: a fold along the page."""
    item = F.struct("seq", F.col("heading"), (F.col("text").rlike("\\.\\s*$") | (F.size(F.split(F.trim("text"), "\\s+")) > 8)).alias("weak"))
    zero = F.struct(F.lit(False).alias("was"), F.array().cast("array<struct<seq:int,heading:boolean>>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        now = x.heading & ~(a.was & x.weak)
        return F.struct(now.alias("was"), F.concat(a["out"], F.array(F.struct(x.seq.cast("int").alias("seq"), now.alias("heading")))).alias("out"))

    pages = blocks.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(item)).alias("xs"))
    flat = pages.select("doc_id", "page", F.explode(F.aggregate("xs", zero, step)["out"]).alias("x"))
    return blocks.drop("heading").join(flat.select("doc_id", "page", F.col("x.seq").alias("seq"), F.col("x.heading").alias("heading")), ["doc_id", "page", "seq"])


def margin(text: Column, box: Column, page_height: Column) -> Column:
    """header, footer or null."""
    y = (box.y0 + box.y1) / 2 / page_height
    known = text.rlike(BOILERPLATE)
    return F.when((y < 0.06) | ((y < 0.10) & known), "header").when((y > 0.94) | ((y > 0.90) & known), "footer")


def several_columns(blocks: DataFrame) -> DataFrame:
    """Per page: whether left edges leave a gap of a tenth of the width and spread over a quarter of it."""
    order = Window.partitionBy("doc_id", "page").orderBy("box.x0")
    gap = F.col("box.x0") - F.lag("box.x0").over(order)
    g = blocks.withColumn("_gap", gap).groupBy("doc_id", "page").agg(F.max("_gap").alias("gap"), (F.max("box.x0") - F.min("box.x0")).alias("spread"), F.first("page_width").alias("w"))
    return g.select("doc_id", "page", F.coalesce((F.col("gap") > F.col("w") / 10) & (F.col("spread") > F.col("w") / 4), F.lit(False)).alias("multi_column"))


def image_share(images: DataFrame) -> DataFrame:
    """Per page: area of its images against the page's, at most 1, half-even at 4."""
    return images.groupBy("doc_id", "page").agg(F.bround(F.least(F.lit(1.0), F.sum(area(F.col("box"))) / F.first(F.col("page_width") * F.col("page_height"))), 4).alias("image_ratio"))


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def visual_lines(words: pd.Series) -> pd.Series:
    """Line numbers of words sorted by y: a word within 2 points of its line's first word is on that line."""

    def one(ys) -> list[int]:
        out, first, line = [], None, -1
        for y in ys:
            if first is None or y - first > LINE_SLACK:
                first, line = y, line + 1
            out.append(line)
        return out

    return words.map(one)
