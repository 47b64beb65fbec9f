"""Queries over document trees and page tables: totals, whole-tree normalization, kinds, manifests, rates, grids, ledgers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators import analytics, documents, routing, tables, trees
from pagemill.plans.table_queries import _FOLD, _checkpoint
from pagemill.plans.text_queries import LINES, NORMALIZED
from pagemill.session import shared_dir, table
from pagemill.streaming import ingest

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _lines_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def _trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as trees of one page: lines are blocks, the source is the title, the language a reference."""
    blocks = documents.text_blocks(table(spark, sf_dir, "documents"))
    page = F.struct(F.lit(0).alias("page"), F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda b: F.struct(F.lit("paragraph").alias("kind"), b.text.alias("text"))).alias("blocks"))
    pages = blocks.groupBy("doc_id").agg(page.alias("p"))
    empty = "cast(array() as array<struct<caption:string,header:array<string>,rows:array<array<string>>>>)"
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang").join(pages, "doc_id", "left")
    meta = F.struct(F.concat(F.lit("A  "), "source").alias("title"), *[F.lit(None).cast("string").alias(m) for m in trees.METADATA[1:]])
    full = F.struct("p.page", "p.blocks", F.expr(empty).alias("tables"), F.expr("cast(array() as array<struct<caption:string>>)").alias("images"), F.array(F.struct(F.lit("see  “it”").alias("text"))).alias("annotations"))
    return d.select(F.col("doc_id").cast("string").alias("doc_id"), meta.alias("metadata"), F.when(F.col("p").isNotNull(), F.array(full)).alias("pages"), F.array(F.struct(F.lit("[1]").alias("label"), F.col("lang").alias("text"))).alias("references"))


@query(f"""WITH {LINES}, {NORMALIZED}, b AS (SELECT doc_id, count(*) AS seen, sum((text <> raw)::INT) AS changed, sum(length(raw)) AS chars_in, sum(length(text)) AS chars_out FROM norm GROUP BY doc_id)
SELECT d.doc_id::VARCHAR AS doc_id, coalesce(seen, 0)::BIGINT AS blocks_seen, coalesce(changed, 0)::BIGINT AS blocks_changed, (seen IS NOT NULL)::BIGINT AS annotations_changed, 1::BIGINT AS metadata_fields_changed,
(coalesce(chars_in, 0) + CASE WHEN seen IS NULL THEN 0 ELSE 9 END + 3 + length(source) + 3 + length(lang))::BIGINT AS chars_in, (coalesce(chars_out, 0) + CASE WHEN seen IS NULL THEN 0 ELSE 8 END + 2 + length(source) + 3 + length(lang))::BIGINT AS chars_out
FROM documents d LEFT JOIN b USING (doc_id)""")
def tree_normalization(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every string of a tree is normalized and counted by category."""
    t = trees.normalization_totals(trees.normalized(trees.strings(_trees(spark, sf_dir))))
    return t.select("doc_id", *[F.col(c).cast("long").alias(c) for c in ("blocks_seen", "blocks_changed", "annotations_changed", "metadata_fields_changed", "chars_in", "chars_out")])


@query(f"""WITH {LINES}, {NORMALIZED} SELECT doc_id::VARCHAR AS doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY seq) - 1)::INTEGER AS place, text FROM norm""")
def rebuilt_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of the trees that the normalized strings were put back into."""
    t = _trees(spark, sf_dir)
    r = trees.rebuilt(t, trees.normalized(trees.strings(t)))
    return r.select("doc_id", F.posexplode(F.col("pages")[0].blocks).alias("place", "b")).select("doc_id", "place", "b.text")


def _page_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as page results: the flag picks the route, the quantity how many blocks a page has."""
    blocks = F.transform(F.sequence(F.lit(1), (F.col("l_linenumber") % 3 + 1).cast("int")), lambda i: F.struct(F.lit("paragraph").alias("kind"), F.concat("l_returnflag", i.cast("string")).alias("text")))
    none = lambda t: F.expr(f"cast(array() as {t})")
    images = F.when(F.col("l_linestatus") == "O", F.array(F.struct(F.lit("c").alias("caption")))).otherwise(none("array<struct<caption:string>>"))
    route = F.when(F.col("l_returnflag") == "R", "docling").otherwise("native")
    return _lines_of(spark, sf_dir).select(
        F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("page_index"), route.alias("route"), F.when(route == "docling", "v2").alias("engine_version"), blocks.alias("blocks"),
        none("array<struct<caption:string>>").alias("tables"), images.alias("images"), none("array<struct<text:string>>").alias("annotations"),
    )


@query("""SELECT o_orderkey AS doc_id, coalesce(sum(l_linenumber % 3 + 1), 0)::INTEGER AS n_blocks, coalesce(sum((l_linestatus = 'O')::INT), 0)::INTEGER AS n_images, coalesce(bool_or(l_returnflag = 'R'), false) AS ordered, CASE WHEN bool_or(l_returnflag = 'R') THEN 'v2' END AS layout_version,
(coalesce(sum(l_linenumber % 3 + 1), 0) - 1)::INTEGER AS last_seq FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def folded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages folded into their documents, blocks numbered through."""
    plans = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.lit("m").alias("metadata"))
    f = trees.fold_pages(_page_results(spark, sf_dir), plans)
    n = lambda c: F.coalesce(F.when(F.col(c).isNotNull(), F.size(c)), F.lit(0)).alias(f"n_{c}")
    return f.select("doc_id", n("blocks"), n("images"), "ordered", "layout_version", F.coalesce(F.array_max(F.transform("blocks", lambda b: b.seq)), F.lit(-1)).alias("last_seq"))


@query("""SELECT l_orderkey::VARCHAR AS doc_id, count(*)::INTEGER AS pages, sum(l_linenumber % 3 + 1)::INTEGER AS blocks, sum((l_linestatus = 'O')::INT)::INTEGER AS images, sum((l_linenumber % 3 + 1) * 2)::BIGINT AS chars FROM lineitem GROUP BY l_orderkey""")
def document_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Element totals of trees whose pages are line items."""
    page = F.struct(F.col("page_index").alias("page"), "blocks", "tables", "images", "annotations")
    t = _page_results(spark, sf_dir).groupBy(F.col("doc_id").cast("string").alias("doc_id")).agg(F.collect_list(page).alias("pages")).withColumn("references", F.array())
    return trees.totals(t).select("doc_id", "pages", "blocks", "images", "chars")


@query("""SELECT doc_id, CASE WHEN t = '' THEN 'paragraph' WHEN regexp_matches(t, '^([0-9]+(\\.[0-9]+)*\\s+[A-Za-z]|(?i:Abstract|Introduction|Methods|Results|Discussion|Conclusion|References)\\b)') THEN 'heading' WHEN length(t) < 60 AND t = upper(t) AND regexp_matches(t, '\\p{L}') AND NOT ends_with(t, '.') THEN 'heading'
WHEN regexp_matches(t, '^\\[[0-9]+\\]|^[0-9]+\\.\\s+[A-Z]') THEN 'reference' ELSE 'paragraph' END AS kind FROM (SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN '2.1 ' || source WHEN 1 THEN '[7] ' || source WHEN 2 THEN 'introduction: ' || source WHEN 3 THEN upper(source) || ' X' WHEN 4 THEN '3. A ' || source || ' y' ELSE 'the ' || source END AS t FROM documents)""".replace("\\\\", "\\"))
def block_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s = F.col("doc_id") % 6, F.col("source")
    t = F.when(k == 0, F.concat(F.lit("2.1 "), s)).when(k == 1, F.concat(F.lit("[7] "), s)).when(k == 2, F.concat(F.lit("introduction: "), s)).when(k == 3, F.concat(F.upper(s), F.lit(" X"))).when(k == 4, F.concat(F.lit("3. A "), s, F.lit(" y"))).otherwise(F.concat(F.lit("the "), s))
    return table(spark, sf_dir, "documents").select("doc_id", documents.block_kind(t).alias("kind"))


@query("""SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'footer' WHEN 1 THEN 'header' WHEN 2 THEN 'header' WHEN 3 THEN 'footer' END AS margin FROM documents""")
def margin_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page numbers, running heads, the title itself, identifiers and plain lines."""
    k, title = F.col("doc_id") % 5, F.concat(F.lit("A Study Of "), "source")
    t = F.when(k == 0, "Page 3 of 10").when(k == 1, "# Research article").when(k == 2, F.upper(title)).when(k == 3, "doi: 10.1234/x.y").otherwise(F.concat(F.lit("plain "), "source", F.lit(" words")))
    return table(spark, sf_dir, "documents").select("doc_id", documents.margin_line(t, title).alias("margin"))


@query("""SELECT doc_id, length(text) > 0 AS has_text, CASE WHEN length(text) > 0 THEN (length(text) - length(regexp_replace(text, '[.,;:!?]', '', 'g'))) / length(text) ELSE 0 END::DOUBLE AS punctuation, len(string_split(text, chr(10)))::INTEGER AS n_lines FROM documents""")
def text_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", documents.shape(F.col("text")).alias("s")).select("doc_id", "s.has_text", "s.punctuation", "s.n_lines")


@query("""SELECT o_orderkey, count(*) FILTER (WHERE l_tax > 0.07) > 0 OR count(*) FILTER (WHERE l_discount > 0.09) > 0 OR (count(*) FILTER (WHERE l_returnflag = 'R') > 0 AND any_value(o_custkey % 100) / 100.0 < 0.8) AS hard FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def hard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as documents: taxed lines are tables, discounted ones recognised pages, returned ones columns."""
    j = table(spark, sf_dir, "orders").join(_lines_of(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
    pages = lambda c: F.collect_list(F.when(c, F.col("l_linenumber")))
    g = j.groupBy("o_orderkey", ((F.col("o_custkey") % 100) / 100.0).alias("confidence")).agg(pages(F.col("l_tax") > 0.07).alias("t"), pages(F.col("l_discount") > 0.09).alias("o"), pages(F.col("l_returnflag") == "R").alias("c"))
    return g.select("o_orderkey", analytics.is_hard(F.col("t"), F.col("o"), F.col("c"), F.col("confidence")).alias("hard"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_returnflag = 'R' OR l_discount * 10 < 0.3 OR (l_linenumber % 2 = 1 AND l_tax * 10 < 0.3)""")
def low_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as verdicts: tables don't count, a metric that was not measured is not low."""
    m = F.create_map(F.lit("completeness"), F.col("l_discount") * 10, F.lit("tables"), F.lit(0.0), F.lit("fidelity"), F.when(F.col("l_linenumber") % 2 == 1, F.col("l_tax") * 10))
    verdict = F.when(F.col("l_returnflag") == "R", "fail").otherwise("PASS")
    return _lines_of(spark, sf_dir).filter(analytics.is_low(verdict, m, 0.3)).select("l_orderkey", "l_linenumber", "l_partkey")


@query("""SELECT d.doc_id, m.stratum FROM documents d JOIN (SELECT sha256(text) AS sha, min(lang) AS stratum FROM documents WHERE doc_id % 3 = 0 GROUP BY 1) m ON m.sha = sha256(d.text)""")
def manifest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with the stratum that a manifest of a third of them gives their content."""
    d = table(spark, sf_dir, "documents").withColumn("sha256", F.sha2(F.col("text").cast("binary"), 256))
    manifest = d.filter(F.col("doc_id") % 3 == 0).groupBy("sha256").agg(F.min("lang").alias("stratum"))
    return analytics.with_manifest(d.select("doc_id", "sha256"), manifest).select("doc_id", "stratum")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 30 OFFSET 15")
def sliced_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.slice_rows(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], 15, 30)


@query("SELECT l_suppkey, count(*) AS runs, count(DISTINCT l_returnflag) AS results, count(DISTINCT l_returnflag) = 1 AS deterministic FROM lineitem GROUP BY l_suppkey")
def determinism(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.deterministic(_lines_of(spark, sf_dir), "l_suppkey", "l_returnflag")


@query("SELECT l_orderkey, list(l_returnflag ORDER BY first_at) AS items FROM (SELECT l_orderkey, l_returnflag, min(l_linenumber * 1000000 + l_partkey) AS first_at FROM lineitem GROUP BY ALL) GROUP BY l_orderkey")
def fonts_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags as fonts, each once, by first use."""
    li = _lines_of(spark, sf_dir).withColumn("place", F.col("l_linenumber") * 1000000 + F.col("l_partkey"))
    return analytics.first_seen(li, "l_orderkey", "l_returnflag", "place")


@query("""SELECT event_type, date_trunc('hour', ts) AS window_start, max(value) AS value FROM events GROUP BY ALL UNION ALL SELECT event_type, NULL, max(value) FROM events GROUP BY event_type""")
def metric_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values as memory samples."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return analytics.peaks(e, "event_type", "ts", ["value"]).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("""SELECT o_orderpriority, count(*) AS docs, coalesce(sum(p), 0)::BIGINT AS pages, sum(s)::BIGINT AS seconds, 1000 * (sum(s) / sum(p)) AS ms_per_page, CASE WHEN sum(s) > 0 THEN sum(p) / sum(s) END AS pages_per_second, CASE WHEN sum(s) > 0 THEN count(*) / sum(s) END AS docs_per_second
FROM (SELECT o_orderpriority, o_custkey % 50 AS s, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS p FROM orders) GROUP BY o_orderpriority""")
def benchmark_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as documents with line items as pages."""
    d = table(spark, sf_dir, "orders").select("o_orderpriority", F.col("o_orderkey").alias("doc_id"), (F.col("o_custkey") % 50).alias("seconds"))
    return analytics.rates(d, _lines_of(spark, sf_dir).select(F.col("l_orderkey").alias("doc_id")), ["o_orderpriority"])


@query("""SELECT l_linenumber % 5 AS run, count(*)::BIGINT AS pages, count(*) FILTER (WHERE l_returnflag = 'R')::BIGINT AS docling, count(*) FILTER (WHERE l_linestatus = 'O')::BIGINT AS ok FROM lineitem GROUP BY l_linenumber % 5""")
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _lines_of(spark, sf_dir).select((F.col("l_linenumber") % 5).alias("run"), F.when(F.col("l_returnflag") == "R", "docling").otherwise("native").alias("route"), F.when(F.col("l_linestatus") == "O", "ok").otherwise("failed").alias("status"))
    m = analytics.run_metrics(p, ["run"])
    return m.select("run", "pages", F.coalesce(F.element_at("by_route", "docling"), F.lit(0)).alias("docling"), F.coalesce(F.element_at("by_status", "ok"), F.lit(0)).alias("ok"))


@query("""WITH n AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang), q AS (SELECT lang, round_even(97.0::DOUBLE * n / (SELECT sum(n) FROM n), 0) AS quota FROM n), r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS r FROM documents), i AS (SELECT doc_id, lang, r, r <= quota AS inside FROM r JOIN q USING (lang))
SELECT doc_id, lang FROM i ORDER BY inside DESC, CASE WHEN inside THEN lang END, CASE WHEN inside THEN r END, doc_id LIMIT 97""")
def topped_up_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A proportional sample of exactly 97 documents; the number is the feature."""
    return analytics.quota_sample(table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", ["doc_id"], 97, exact=True)


@query("SELECT page_id, md5(html) AS digest, url FROM pages")
def packed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page parts through JSON with their content in base64, and back."""
    p = table(spark, sf_dir, "pages").select("page_id", "url", F.encode("html", "UTF-8").alias("content"))
    back = trees.unpacked(trees.packed(p, ["page_id"], "content"), ["page_id"], "url string, content string", "content")
    return back.select("page_id", F.md5("content").alias("digest"), "url")


@query("SELECT n_nationkey, CASE WHEN n_regionkey = 0 THEN n_name ELSE n_name || '.' || n_regionkey END AS header FROM nation")
def header_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels of a header joined by dots."""
    below = F.when(F.col("n_regionkey") == 0, F.col("n_name")).otherwise(F.col("n_regionkey").cast("string"))
    return table(spark, sf_dir, "nation").select("n_nationkey", tables.joined_levels(F.array(F.col("n_name"), F.lit(" "), below)).alias("header"))


@query("""SELECT l_orderkey AS doc_id, 0 AS seq, count(*)::INTEGER AS n_rows FROM lineitem GROUP BY l_orderkey""")
def mapped_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grids with a title row, a header row and a line item a row."""
    row = F.array(F.col("l_partkey").cast("string"), F.concat(F.lit(" f  "), "l_returnflag"))
    g = _lines_of(spark, sf_dir).groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.collect_list(row).alias("rows"))
    grid = F.concat(F.array(F.array(F.lit("T 1"), F.lit("T 1")), F.array(F.lit("part"), F.lit("flag"))), F.col("rows"))
    flags = F.transform(grid, lambda r, i: F.transform(r, lambda c: i < 2))
    m = g.select("doc_id", tables.mapped_grid(grid, tables.header_rows(flags)).alias("m")).filter((F.col("m.caption") == "T 1") & (F.col("m.header") == F.array(F.lit("part"), F.lit("flag"))))
    return m.select("doc_id", F.lit(0).alias("seq"), F.size(F.filter("m.rows", lambda r: r[1].startswith("f "))).alias("n_rows"))


@query("""SELECT n_nationkey AS table_id, n_name AS cell_00, n_regionkey::VARCHAR || ' r' AS cell_11 FROM nation""")
def rebuilt_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two recognised lines put into the four cells of a table a nation."""
    n = table(spark, sf_dir, "nation").withColumn("page", F.col("n_nationkey"))
    box = lambda x, y, w: F.struct(F.lit(x).alias("x0"), F.lit(y).alias("y0"), F.lit(x + w).alias("x1"), F.lit(y + 10.0).alias("y1"))
    cells = n.select("page", F.col("n_nationkey").alias("table_id"), F.explode(F.array(*[F.struct(F.lit(2 * r + c).alias("cell"), F.lit(r).alias("row"), F.lit(c).alias("col"), box(100.0 * c, 20.0 * r, 90.0).alias("box")) for r in (0, 1) for c in (0, 1)])).alias("c")).select("page", "table_id", "c.*")
    said = [(0, F.col("n_name"), box(2.0, 1.0, 40.0)), (1, F.col("n_regionkey").cast("string"), box(102.0, 21.0, 20.0)), (2, F.lit("r"), box(130.0, 21.0, 20.0))]
    lines = n.select("page", F.explode(F.array(*[F.struct(F.lit(k).alias("line"), t.alias("text"), b.alias("box")) for k, t, b in said])).alias("l")).select("page", "l.*")
    g = tables.rebuilt_grid(lines, cells)
    return g.select("table_id", F.col("rows")[0][0].alias("cell_00"), F.col("rows")[1][1].alias("cell_11"))


@query("""SELECT l_orderkey AS doc_id, n AS page FROM (SELECT l_orderkey, n, row_number() OVER (PARTITION BY l_orderkey ORDER BY n) AS k FROM (SELECT l_orderkey, l_partkey AS n, max(CASE WHEN l_quantity < 25 THEN 0 ELSE l_quantity END) AS chars FROM lineitem GROUP BY ALL) WHERE chars = 0) WHERE k <= 2""")
def scanned_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without text, two of a document at most (the feature); parts are page numbers here."""
    p = _lines_of(spark, sf_dir).groupBy(F.col("l_orderkey").alias("doc_id"), F.col("l_partkey").alias("page")).agg(F.max(F.when(F.col("l_quantity") < 25, 0).otherwise(F.col("l_quantity"))).alias("chars"))
    return documents.without_text(p, 2).select("doc_id", "page")


@query("""SELECT o_orderkey AS doc_id, name, CASE name WHEN 'metric_image_count' THEN o_custkey % 7 WHEN 'metric_encrypted' THEN (o_custkey % 2)::DOUBLE WHEN 'metric_pdf_version' THEN 1.5 WHEN 'metric_unusual_font' THEN CASE WHEN o_custkey % 3 = 0 THEN 1.0 ELSE 0.0 END WHEN 'metric_text_ratio' THEN NULL END::DOUBLE AS value, CASE WHEN name = 'metric_text_ratio' THEN 'missing' ELSE 'ok' END AS status
FROM orders, (VALUES ('metric_image_count'), ('metric_encrypted'), ('metric_pdf_version'), ('metric_unusual_font'), ('metric_text_ratio')) v(name)""")
def file_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals of files whose text ratio nobody measured."""
    k = F.col("o_custkey")
    f = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("doc_id"), F.lit(2).alias("pages"), F.array(F.lit(100), F.lit(0)).alias("chars"), F.array(F.lit(3), F.lit(4)).alias("blocks"), F.array(F.lit(0.1), F.lit(0.95)).alias("image_ratio"), F.lit(0).alias("columns"), F.lit(0).alias("tables"),
        F.array(F.lit("Times-Roman"), F.when(k % 3 == 0, "Garamond").otherwise("ArialMT")).alias("fonts"), F.lit(40.0).alias("mean_line"), F.lit("t").alias("title"), (k % 7).alias("images"), (k % 2 == 1).alias("encrypted"), F.lit(1.5).alias("pdf_version"),
    )
    wanted = ("metric_image_count", "metric_encrypted", "metric_pdf_version", "metric_unusual_font", "metric_text_ratio")
    return routing.detect(f).filter(F.col("name").isin(*wanted)).select("doc_id", "name", "value", "status")


@query(f"{_FOLD} SELECT doc_id, page_index, status, checksum, last_seq, attempts::BIGINT AS attempts FROM f")
def stream_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger as keyed state of a stream, read batch by batch: the standing that the batch fold gives."""
    e = table(spark, sf_dir, "events")
    status = F.element_at(F.array(*map(F.lit, ("ok", "failed", "partial", "dead"))), (F.col("event_id") % 4 + 1).cast("int"))
    s = ingest.read_stream(spark, sf_dir, e.schema, "events.parquet").select(
        F.concat(F.lit("d-"), (F.col("user_id") % 50).cast("string")).alias("doc_id"), (F.col("event_id") % 7).cast("int").alias("page_index"), F.col("event_id").alias("seq"), status.alias("status"), F.md5(F.col("event_id").cast("string")).alias("checksum"), F.lit(1).alias("attempt"),
    )
    out = f"{shared_dir(spark)}/ledger-{uuid.uuid4().hex}"
    ingest.write_batches(ingest.ledger_stream(s), _checkpoint(spark), out, "update")
    rows = spark.read.parquet(out)
    # a later batch's standing replaces an earlier one's
    last = F.max_by(F.struct("status", "checksum", "last_seq", "attempts"), "batch").alias("s")
    return rows.groupBy("doc_id", "page_index").agg(last).select("doc_id", "page_index", "s.*")



