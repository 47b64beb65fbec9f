"""Bibliographies: where they start, their entries, and the citations that point at them; expressions only.

The lines of a document's bibliography are cut at every mark of an entry, numbered by a running count of marks, and joined by
that number; of entries that share a number the longest is kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Labels of a bibliography, how citations and entries are marked, and the kinds of headings.
LABELS = ("references", "bibliography", "citations", "reference", "bibliographies", "literature cited", "works cited", "references and notes")
CITATION = r"\[(\d{1,4})\]"
ENTRY_MARKS = (r"\[(\d{1,4})\]", r"(\d{1,4})\.", r"\((\d{1,4})\)", r"(\d{1,4})\s{2,}")
HEADINGS = ("heading", "title")
LABEL_SLACK, SHORT, LEAST_ENTRIES = 15, 30, 3

#: Where a line begins with a mark; only the first three kinds of mark may follow a line break.
_NEXT_MARK = r"\n\s*(?=\[\d{1,4}\]|\d{1,4}\.|\(\d{1,4}\))"


def is_label(text: Column, kind: Column) -> Column:
    t = F.lower(F.trim(text))
    close = F.exists(F.array(*map(F.lit, LABELS)), lambda x: t.startswith(x) & (F.length(t) <= F.length(x) + LABEL_SLACK))
    return (kind.isin(*HEADINGS) | (F.length(t) <= SHORT)) & close


def entry_number(text: Column) -> Column:
    """The number that a line is marked with; null without a mark."""
    found = [F.nullif(F.regexp_extract(text, rf"^\s*{m}", 1), F.lit("")) for m in ENTRY_MARKS]
    return F.coalesce(*found)


def entry_text(text: Column) -> Column:
    """What follows the mark."""
    return F.trim(reduce(lambda t, m: F.when(text.rlike(rf"^\s*{m}"), F.regexp_replace(text, rf"^\s*{m}\s*", "")).otherwise(t), reversed(ENTRY_MARKS), text))


def citations(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(CITATION), F.lit(1)))


def _in_bibliography(blocks: DataFrame) -> DataFrame:
    """Blocks with named (a heading) and labelled (the document has a label), those outside a labelled bibliography left out."""
    doc = Window.partitionBy("doc_id")
    named = F.coalesce(F.col("kind").isin(*HEADINGS), F.lit(False))
    b = blocks.select("doc_id", "seq", "kind", F.coalesce("text", F.lit("")).alias("text"), named.alias("named"))
    b = b.withColumn("_start", F.min(F.when(is_label(F.col("text"), F.col("kind")), F.col("seq"))).over(doc))
    b = b.withColumn("_stop", F.min(F.when(F.col("named") & (F.col("seq") > F.col("_start")), F.col("seq"))).over(doc))
    inside = F.col("_start").isNull() | ((F.col("seq") > F.col("_start")) & F.coalesce(F.col("seq") < F.col("_stop"), F.lit(True)))
    return b.withColumn("labelled", F.col("_start").isNotNull()).filter(inside).drop("_start", "_stop")


def _believed(blocks: DataFrame) -> DataFrame:
    """Of documents without a label only those with entries enough, one of them cited."""
    number = entry_number(F.col("text"))
    per = blocks.filter(~F.col("labelled")).groupBy("doc_id").agg(F.count(number).alias("n"), F.collect_set(number).alias("numbers"), F.array_distinct(F.flatten(F.collect_set(citations(F.col("text"))))).alias("cited"))
    doubted = per.filter((F.col("n") < LEAST_ENTRIES) | ~F.arrays_overlap("numbers", "cited")).select("doc_id")
    return blocks.join(doubted, "doc_id", "left_anti")


def entries(blocks: DataFrame) -> DataFrame:
    """doc_id, seq, kind, text -> doc_id, number, seq (the order of entries), text with the lines that continue it.

    A heading ends the entry before it. In a labelled bibliography a block of several marked lines holds as many entries.
    """
    b = _believed(_in_bibliography(blocks)).filter(F.col("named") | (F.trim("text") != ""))
    lines = F.split(F.trim("text"), _NEXT_MARK, -1)
    marked = F.filter(lines, lambda x: entry_number(x).isNotNull())
    parts = F.when(~F.col("named") & F.col("labelled") & (F.size(marked) > 1), marked).otherwise(F.array(F.trim("text")))
    rows = b.select("doc_id", "seq", "named", F.posexplode(parts).alias("part", "line"))
    rows = rows.withColumn("number", F.when(~F.col("named"), entry_number(F.col("line"))))
    opens = (F.col("number").isNotNull() | F.col("named")).cast("int")
    rows = rows.withColumn("entry", F.sum(opens).over(Window.partitionBy("doc_id").orderBy("seq", "part").rowsBetween(Window.unboundedPreceding, 0)))
    said = F.when(F.col("number").isNotNull(), entry_text(F.col("line"))).otherwise(F.trim("line"))
    said = F.struct("seq", "part", said.alias("text"))
    whole = rows.filter((F.col("entry") > 0) & ~F.col("named")).groupBy("doc_id", "entry").agg(F.first("number", True).alias("number"), F.array_sort(F.collect_list(said)).alias("said"))
    text = F.trim(F.array_join(F.filter(F.transform("said", lambda s: s.text), lambda s: s != ""), " "))
    return whole.filter(F.col("number").isNotNull()).select("doc_id", "number", F.col("entry").alias("seq"), text.alias("text"))


def best_entries(found: DataFrame) -> DataFrame:
    """Of each document's number the longest text, the first on ties."""
    return found.groupBy("doc_id", "number").agg(F.max_by("text", F.struct(F.length("text"), -F.col("seq"))).alias("text"))


def extract(blocks: DataFrame) -> DataFrame:
    """doc_id, seq, kind, text -> doc_id, references in order of their numbers; empty where nothing is believed."""
    target = F.concat(F.col("doc_id").cast("string"), F.lit("/ref-"), F.col("number"))
    one = F.struct(F.lit("citation").alias("kind"), target.alias("target"), target.alias("id"), F.concat(F.lit("["), "number", F.lit("]")).alias("label"), "text")
    found = best_entries(entries(blocks)).select("doc_id", F.struct(F.col("number").cast("int").alias("n"), F.col("number"), one.alias("r")).alias("x"))
    found = found.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x.r).alias("references"))
    none = F.array().cast("array<struct<kind:string,target:string,id:string,label:string,text:string>>")
    return blocks.select("doc_id").distinct().join(found, "doc_id", "left").withColumn("references", F.coalesce("references", none))


def citation_index(references: Column) -> Column:
    """Number -> id."""
    return F.map_from_entries(F.transform(references, lambda r: F.struct(F.regexp_replace(r.label, "[\\[\\]]", ""), r.id)))


def cited(blocks: DataFrame, references: DataFrame) -> DataFrame:
    """doc_id, seq, number, reference id (null where nothing answers the citation)."""
    marks = blocks.select("doc_id", "seq", F.explode(citations(F.col("text"))).alias("number"))
    refs = references.select("doc_id", F.explode("references").alias("r")).select("doc_id", F.regexp_replace("r.label", "[\\[\\]]", "").alias("number"), F.col("r.id").alias("reference_id"))
    return marks.join(refs, ["doc_id", "number"], "left")
