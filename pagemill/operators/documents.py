"""Document tables: blocks from text, heading anchors, page order, previews under budgets, version choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Words that open a section, how numbered sections and references begin, running heads and feet.
SECTIONS = ("Abstract", "Introduction", "Methods", "Results", "Discussion", "Conclusion", "References")
NUMBERED_SECTION, REFERENCE_MARK = r"[0-9]+(?:\.[0-9]+)*\s+[A-Z]", r"^\[[0-9]+\]|^[0-9]+\.\s+[A-Z]"
RUNNING_HEADS = ("RESEARCH ARTICLE", "EDITORIAL COMMENTARY", "REVIEW ARTICLE")
RUNNING_FOOT = r"(?i)\bdoi:\s*10\.\d{4,9}/|\b\d+\s*/\s*\d+\s*$|^Page\s+\d+\s+of\s+\d+$"
SHORT_TITLE = 60

BLANK = "(?U)^[\\s\\x1C-\\x1F]+|[\\s\\x1C-\\x1F]+$"


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, BLANK, "")


def text_blocks(docs: DataFrame) -> DataFrame:
    """doc_id, text -> doc_id, seq (original line number), text, of lines with something in them."""
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("seq", "line"))
    return lines.select("doc_id", "seq", stripped(F.col("line")).alias("text")).filter(F.col("text") != "")


def heading_anchor(blocks: DataFrame) -> DataFrame:
    """Text of the nearest heading at or before each block of a document."""
    upto = Window.partitionBy("doc_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    return blocks.withColumn("anchor", F.coalesce(F.last(F.when(F.col("kind") == "heading", F.col("text")), ignorenulls=True).over(upto), F.lit("")))


def block_ids(blocks: DataFrame) -> DataFrame:
    """Per-page ordinal in reading order and the id ``doc/bPP_NNNN``."""
    n = F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("rank")) - 1
    name = F.concat(F.col("doc_id").cast("string"), F.lit("/b"), F.lpad(F.col("page").cast("string"), 2, "0"), F.lit("_"), F.lpad(n.cast("string"), 4, "0"))
    return blocks.withColumns({"ordinal": n, "block_id": name})


def global_sequence(parts: DataFrame) -> DataFrame:
    return parts.withColumn("global_seq", F.row_number().over(Window.partitionBy("doc_id").orderBy("page", "seq")) - 1)


def within_budget(rows: DataFrame, key: str, order: str, size: Column, budget: int, crossing: bool) -> DataFrame:
    """The first rows of each key whose sizes fit the budget; with ``crossing`` also the row that goes beyond it."""
    w = Window.partitionBy(key).orderBy(order)
    upto = F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long")
    kept = F.col("running") - size < budget if crossing else F.col("running") <= budget
    return rows.withColumn("running", upto).filter(kept)


def version_key(version: Column) -> Column:
    """Orders 0.10.0 above 0.9.0; parts that are no numbers stand above numbers, as text."""
    part = lambda p: F.struct(F.when(p.rlike("^[0-9]+$"), 0).otherwise(1).alias("text"), F.coalesce(p.try_cast("bigint"), F.lit(0)).alias("number"), F.when(p.rlike("^[0-9]+$"), "").otherwise(p).alias("name"))
    return F.transform(F.split(version, "\\."), part)


def latest_version(rows: DataFrame, key: str, version: str) -> DataFrame:
    return rows.groupBy(key).agg(F.max_by(version, version_key(F.col(version))).alias("latest"))


def evenly_spaced(total: Column, budget: Column) -> Column:
    """Page numbers spread evenly, first and last among them (half-even rounding)."""
    at = lambda i: F.bround(i * (total - 1) / (budget - 1)).cast("int")
    return F.when(total <= budget, F.sequence(F.lit(0), total - 1)).when(budget <= 1, F.array(F.lit(0))).otherwise(F.array_sort(F.array_distinct(F.transform(F.sequence(F.lit(0), budget - 1), at))))


def table_of_contents(pages: DataFrame) -> DataFrame:
    """Blocks, then tables, then images of each page, numbered through the document."""
    rank = F.element_at(F.create_map(F.lit("block"), F.lit(0), F.lit("table"), F.lit(1), F.lit("image"), F.lit(2)), F.col("type"))
    return pages.withColumn("place", F.row_number().over(Window.partitionBy("doc_id").orderBy("page", rank, "seq")) - 1)


def is_title_case(text: Column) -> Column:
    """Every run of letters has one capital, the first; at least one letter."""
    return text.rlike("\\p{L}") & ~text.rlike("(?<!\\p{L})[\\p{Ll}]|\\p{L}[\\p{Lu}\\p{Lt}]")


def block_kind(text: Column) -> Column:
    """heading, reference or paragraph, from the text alone."""
    t = stripped(F.coalesce(text, F.lit("")))
    opens = t.rlike(rf"(?i)^(?:{NUMBERED_SECTION}|(?:{'|'.join(SECTIONS)})\b)")
    loud = (t == F.upper(t)) & t.rlike("\\p{L}")
    short = (F.length(t) < SHORT_TITLE) & (loud | is_title_case(t)) & ~t.endswith(".")
    return F.when(t == "", "paragraph").when(opens | short, "heading").when(t.rlike(REFERENCE_MARK), "reference").otherwise("paragraph")


def margin_line(line: Column, title: Column | None = None) -> Column:
    """header for running heads and the document's own title, footer for page numbers and identifiers, else null."""
    t = stripped(line)
    plain = stripped(F.regexp_replace(t, "^#+", ""))
    running = F.upper(plain).isin(*RUNNING_HEADS)
    if title is not None:
        running = running | F.coalesce((F.length(plain) > 10) & (F.lower(plain) == F.lower(title)), F.lit(False))
    return F.when(t == "", None).when(running, "header").when(t.rlike(RUNNING_FOOT), "footer")


def shape(text: Column) -> Column:
    """struct<has_text, punctuation (share), n_lines, n_words, upper, title> of a text."""
    n = F.length(text)
    share = F.when(n > 0, (n - F.length(F.regexp_replace(text, "[.,;:!?]", ""))) / n).otherwise(0.0)
    words = F.size(F.regexp_extract_all(text, F.lit("(?U)[^\\s]+"), F.lit(0)))
    return F.struct((n > 0).alias("has_text"), share.alias("punctuation"), F.size(F.split(text, "\n", -1)).alias("n_lines"), words.alias("n_words"), ((text == F.upper(text)) & text.rlike("\\p{L}")).alias("upper"), is_title_case(text).alias("title"))


def without_text(pages: DataFrame, most: int | None = 16) -> DataFrame:
    """Pages without text, which need recognition; of a document the first ``most`` (None: all). pages(doc_id, page, chars)"""
    bare = pages.filter(F.coalesce("chars", F.lit(0)) == 0)
    if most is None:
        return bare
    return bare.withColumn("_k", F.row_number().over(Window.partitionBy("doc_id").orderBy("page"))).filter(F.col("_k") <= most).drop("_k")


def downscaled(width: Column, height: Column, longest: int = 2000) -> Column:
    """struct<width, height, scale> with the longer edge at most ``longest``."""
    scale = F.least(F.lit(1.0), F.lit(float(longest)) / F.greatest(width, height))
    at = lambda x: F.greatest(F.lit(1), F.bround(x * scale).cast("int"))
    return F.struct(at(width).alias("width"), at(height).alias("height"), scale.alias("scale"))
