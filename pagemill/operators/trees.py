"""Document trees: pages folded into documents, totals, and the normalizer over every string of a tree.

A tree is a row: doc_id, metadata struct<title, author, creator, producer, subject>, pages array<struct<page, blocks
array<struct<kind, text>>, tables array<struct<caption, header, rows>>, images array<struct<caption>>, annotations
array<struct<text>>>> and references array<struct<label, text>>.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.text_rules import DEFAULT_RULES, RULES

TREE = (
    "doc_id string, metadata struct<title:string,author:string,creator:string,producer:string,subject:string>, "
    "pages array<struct<page:int,blocks:array<struct<kind:string,text:string>>,tables:array<struct<caption:string,header:array<string>,rows:array<array<string>>>>,"
    "images:array<struct<caption:string>>,annotations:array<struct<text:string>>>>, references array<struct<label:string,text:string>>"
)
METADATA = ("title", "author", "creator", "producer", "subject")
#: Rules that treat code and formulas apart.
BY_KIND = ("strip_controls", "collapse_whitespace")
#: Categories whose empty strings are seen too.
ALWAYS_SEEN = ("blocks", "table_cells")
_STRING = "array<struct<path:string,category:string,kind:string,text:string>>"


def fold_pages(results: DataFrame, plans: DataFrame) -> DataFrame:
    """Page results and their documents' plans -> one tree a document: pages in order, blocks numbered through, bags joined.

    results(doc_id, page_index, route, engine_version, blocks, tables, images, annotations), plans(doc_id, metadata). A document
    is ``ordered`` by its engine if any page came from the heavy tier, whose version is carried; one without results is empty.
    """
    part = F.struct("page_index", "route", "engine_version", "blocks", "tables", "images", "annotations")
    per = results.groupBy("doc_id").agg(F.array_sort(F.collect_list(part)).alias("r"))
    every = lambda c: F.flatten(F.transform("r", lambda x: F.coalesce(x[c], F.array())))
    heavy = F.filter("r", lambda x: x.route == "docling")
    numbered = F.transform(every("blocks"), lambda b, i: F.struct(i.alias("seq"), b.kind.alias("kind"), b.text.alias("text")))
    folded = per.select(
        "doc_id", F.transform("r", lambda x: x.page_index).alias("page_indexes"), numbered.alias("blocks"), *[every(c).alias(c) for c in ("tables", "images", "annotations")],
        (F.size(heavy) > 0).alias("ordered"), F.get(F.filter(F.transform(heavy, lambda x: x.engine_version), lambda v: v.isNotNull()), F.lit(0)).alias("layout_version"),
    )
    return plans.select("doc_id", "metadata").join(folded, "doc_id", "left").withColumn("ordered", F.coalesce("ordered", F.lit(False)))


def totals(trees: DataFrame) -> DataFrame:
    """Pages, blocks, characters, tables, images, annotations and references of each document."""
    pages = F.coalesce("pages", F.array())
    n = lambda c: F.aggregate(pages, F.lit(0), lambda a, p: a + F.coalesce(F.size(p[c]), F.lit(0)))
    chars = F.aggregate(pages, F.lit(0).cast("long"), lambda a, p: F.aggregate(F.coalesce(p.blocks, F.array()), a, lambda b, x: b + F.length(F.coalesce(x.text, F.lit(""))).cast("long")))
    size = lambda c: F.coalesce(F.when(F.col(c).isNotNull(), F.size(c)), F.lit(0))
    return trees.select("doc_id", size("pages").alias("pages"), *[n(c).alias(c) for c in ("blocks", "tables", "images", "annotations")], chars.alias("chars"), size("references").alias("references"))


def strings(trees: DataFrame) -> DataFrame:
    """doc_id, path, category, kind, text of every string of a tree."""

    def item(path: Sequence, category: str, kind, text: Column) -> Column:
        name = F.concat_ws("/", *[x.cast("string") if isinstance(x, Column) else F.lit(x) for x in path])
        return F.struct(name.alias("path"), F.lit(category).alias("category"), (kind if isinstance(kind, Column) else F.lit(kind)).alias("kind"), text.alias("text"))

    def over(of: Column, make) -> Column:
        return F.transform(F.coalesce(of, F.array()), make)

    def in_table(i: Column):
        def make(t: Column, j: Column) -> Column:
            at = ("p", i, "t", j)
            head = over(t.header, lambda h, k: item((*at, "h", k), "table_cells", "table_cell", h))
            body = F.flatten(over(t.rows, lambda r, k: over(r, lambda c, m: item((*at, "r", k, m), "table_cells", "table_cell", c))))
            return F.concat(F.array(item((*at, "caption"), "captions", "caption", t.caption)), head, body)

        return make

    def in_page(p: Column, i: Column) -> Column:
        return F.concat(
            over(p.blocks, lambda b, j: item(("p", i, "b", j), "blocks", F.coalesce(b.kind, F.lit("paragraph")), b.text)),
            F.flatten(over(p.tables, in_table(i))),
            over(p.images, lambda x, j: item(("p", i, "i", j), "captions", "caption", x.caption)),
            over(p.annotations, lambda x, j: item(("p", i, "a", j), "annotations", "annotation", x.text)),
        )

    every = F.concat(
        F.flatten(over(F.col("pages"), in_page)),
        F.flatten(over(F.col("references"), lambda r, i: F.array(item(("ref", i, "text"), "references", "reference", r.text), item(("ref", i, "label"), "labels", "reference", r.label)))),
        F.array(*[item(("meta", m), "metadata_fields", "metadata", F.col(f"metadata.{m}")) for m in METADATA]),
    ).cast(_STRING)
    seen = F.coalesce(F.col("s.text") != "", F.lit(False)) | F.col("s.category").isin(*ALWAYS_SEEN) | ((F.col("s.category") == "references") & F.col("s.path").isNotNull())
    return trees.select("doc_id", F.explode(every).alias("s")).filter(seen).select("doc_id", "s.*")


def normalized(found: DataFrame, rules: Sequence[str] = DEFAULT_RULES) -> DataFrame:
    """``strings`` with raw, text (normalized by kind) and changed, the rules that changed it."""
    out, steps = found.withColumn("raw", F.col("text")), ["raw"]
    for k, rule in enumerate(rules):
        now = F.col(steps[-1])
        if rule in BY_KIND:
            new = F.when(F.col("kind") == "code", RULES[rule](now, "code")).when(F.col("kind") == "formula", RULES[rule](now, "formula")).otherwise(RULES[rule](now, "paragraph"))
        else:
            new = RULES[rule](now, "paragraph")
        out = out.withColumn(f"_step{k}", new)
        steps.append(f"_step{k}")
    marks = F.array(*[F.when(F.col(a) != F.col(b), F.lit(r)) for r, a, b in zip(rules, steps, steps[1:], strict=False)])
    changed = F.filter(marks, lambda x: x.isNotNull()) if rules else F.array().cast("array<string>")
    return out.withColumns({"text": F.col(steps[-1]), "changed": changed}).drop(*steps[1:])


def normalization_totals(done: DataFrame, rules: Sequence[str] = DEFAULT_RULES) -> DataFrame:
    """Per document: strings seen and changed by category, characters in and out, and how many strings each rule changed."""
    kinds = ("blocks", "table_cells", "captions", "annotations", "references", "metadata_fields")
    differs = F.coalesce(F.col("text") != F.col("raw"), F.lit(False))
    # a label belongs to its reference: it is changed there, but seen once
    of = lambda k: F.col("category").isin("references", "labels") if k == "references" else F.col("category") == k
    sums = [F.sum(F.when(c, 1).otherwise(0)).alias(f"{k}_{name}") for k in kinds for name, c in (("seen", F.col("category") == k), ("changed", of(k) & differs))]
    counts = F.create_map(*[x for r in rules for x in (F.lit(r), F.sum(F.array_contains("changed", r).cast("long")))])
    length = lambda c: F.coalesce(F.sum(F.length(c)), F.lit(0))
    return done.groupBy("doc_id").agg(*sums, length("raw").alias("chars_in"), length("text").alias("chars_out"), counts.alias("rule_counts"))


def rebuilt(trees: DataFrame, done: DataFrame) -> DataFrame:
    """The trees with their strings replaced by the normalized ones."""
    new = done.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("path", "text"))).alias("_new"))
    table = trees.join(new, "doc_id", "left").withColumn("_new", F.coalesce("_new", F.create_map().cast("map<string,string>")))

    def said(path: Sequence, old: Column) -> Column:
        return F.coalesce(F.element_at("_new", F.concat_ws("/", *[x.cast("string") if isinstance(x, Column) else F.lit(x) for x in path])), old)

    def page(p: Column, i: Column) -> Column:
        def one_table(t: Column, j: Column) -> Column:
            at = ("p", i, "t", j)
            rows = F.transform(t.rows, lambda r, k: F.transform(r, lambda c, m: said((*at, "r", k, m), c)))
            return F.struct(said((*at, "caption"), t.caption).alias("caption"), F.transform(t.header, lambda h, k: said((*at, "h", k), h)).alias("header"), rows.alias("rows"))

        return F.struct(
            p.page.alias("page"),
            F.transform(p.blocks, lambda b, j: F.struct(b.kind.alias("kind"), said(("p", i, "b", j), b.text).alias("text"))).alias("blocks"),
            F.transform(p.tables, one_table).alias("tables"),
            F.transform(p.images, lambda x, j: F.struct(said(("p", i, "i", j), x.caption).alias("caption"))).alias("images"),
            F.transform(p.annotations, lambda x, j: F.struct(said(("p", i, "a", j), x.text).alias("text"))).alias("annotations"),
        )

    meta = F.struct(*[said(("meta", m), F.col(f"metadata.{m}")).alias(m) for m in METADATA])
    refs = F.transform("references", lambda r, i: F.struct(said(("ref", i, "label"), r.label).alias("label"), said(("ref", i, "text"), r.text).alias("text")))
    return table.select("doc_id", meta.alias("metadata"), F.transform("pages", page).alias("pages"), refs.alias("references"))


def packed(parts: DataFrame, key: Sequence[str], blob: str | None = None) -> DataFrame:
    """Page parts as one JSON text a row, a binary column in base64."""
    cols = [F.base64(c).alias(c) if c == blob else F.col(c) for c in parts.columns if c not in key]
    return parts.select(*key, F.to_json(F.struct(*cols)).alias("json"))


def unpacked(rows: DataFrame, key: Sequence[str], schema: str, blob: str | None = None) -> DataFrame:
    """What ``packed`` was given; ``schema`` has the binary column as a string."""
    out = rows.select(*key, F.from_json("json", schema).alias("x")).select(*key, "x.*")
    return out if blob is None else out.withColumn(blob, F.unbase64(blob))
