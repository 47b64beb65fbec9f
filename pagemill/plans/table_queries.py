"""Queries over numbers and events: means, percentiles, samples, comparisons, routing, ledgers, geometry, streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemill.functions.text_rules import is_idempotent
from pagemill.operators import analytics, documents, layout, ledger, routing, tables
from pagemill.session import shared_dir, table
from pagemill.sources import loaders
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


@query("SELECT event_type, quantile_cont(value::DOUBLE, 0.5) AS p50, quantile_cont(value::DOUBLE, 0.95) AS p95, quantile_cont(value::DOUBLE, 0.99) AS p99 FROM events GROUP BY event_type")
def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.percentiles(table(spark, sf_dir, "events"), ["event_type"], "value")


@query("SELECT l_suppkey, list_sort(list(l_quantity))[count(*) // 2 + 1] AS upper_median FROM lineitem GROUP BY l_suppkey")
def upper_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.upper_median(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_quantity")


@query("""WITH g AS (SELECT o_custkey, list_sort(list(o_totalprice)) AS x, count(*) AS n FROM orders GROUP BY o_custkey), p AS (SELECT *, 0.95::DOUBLE * (n + 1) AS pos, greatest(1, least(floor(0.95::DOUBLE * (n + 1)), n - 1))::BIGINT AS k FROM g)
SELECT o_custkey, n::INTEGER AS n, CASE WHEN n < 20 THEN list_max(x) ELSE x[k] + (pos - k) * (x[k + 1] - x[k]) END AS p95 FROM p""")
def exclusive_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.exclusive_p95(table(spark, sf_dir, "orders"), ["o_custkey"], "o_totalprice").select("o_custkey", "n", "p95")


_MEANS = "round_even(avg({m}), 4) AS mean_{m}, count({m}) AS n_{m}, round_even(sum(coalesce({m}, 0.0)) / count(*), 4) AS zero_mean_{m}"


@query(f"""SELECT lang, all_groups, n, {', '.join(f'mean_{m}, n_{m}, zero_mean_{m}' for m in ('quality', 'toxic'))} FROM (
SELECT lang, grouping(lang)::INTEGER AS all_groups, count(*) AS n, {_MEANS.format(m='quality')}, {_MEANS.format(m='toxic')}
FROM (SELECT d.lang, l.quality::DOUBLE AS quality, l.toxic::DOUBLE AS toxic FROM documents d LEFT JOIN labels l USING (doc_id)) GROUP BY ROLLUP (lang))""")
def metric_means_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left").select("lang", F.col("quality").cast("double").alias("quality"), F.col("toxic").cast("double").alias("toxic"))
    return analytics.metric_means(d, ["quality", "toxic"], "lang")


@query("""WITH v AS (SELECT lang, CASE WHEN u LIKE '%PASS_WITH_ISSUES%' THEN 'PASS_WITH_ISSUES' WHEN u LIKE '%PASS%' THEN 'PASS' ELSE 'FAIL' END AS v
FROM (SELECT d.lang, upper(trim(CASE WHEN l.quality = 1 AND l.toxic = 0 THEN ' pass ' WHEN l.quality = 1 THEN 'PASS_WITH_ISSUes' ELSE 'fail' END)) AS u FROM documents d JOIN labels l USING (doc_id)))
SELECT lang, count(*) AS n, count(*) FILTER (WHERE v = 'PASS') AS passed, count(*) FILTER (WHERE v = 'PASS_WITH_ISSUES') AS with_issues, count(*) FILTER (WHERE v = 'FAIL') AS failed,
round_even(count(*) FILTER (WHERE v <> 'FAIL') / count(*), 4) AS acceptance FROM v GROUP BY lang""")
def verdict_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as verdicts, in mixed case as judges write them."""
    said = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), " pass ").when(F.col("quality") == 1, "PASS_WITH_ISSUes").otherwise("fail")
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").withColumn("verdict", said)
    return analytics.verdict_rates(d, "verdict", ["lang"])


@query("SELECT o_orderpriority, o_orderstatus, grouping_id(o_orderpriority, o_orderstatus)::INTEGER AS level, count(*) AS n FROM orders GROUP BY CUBE (o_orderpriority, o_orderstatus)")
def issue_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as issues: priority is the severity, status the surface."""
    return analytics.issue_cube(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus")


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS i, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)
SELECT o_orderkey, o_orderpriority FROM r WHERE n <= 20 OR i IN (SELECT floor(k * n / 20)::BIGINT FROM unnest(range(20)) AS t(k))""")
def stratified_step_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.step_sample(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", ["o_orderkey"], 20)


@query("""WITH n AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang), q AS (SELECT lang, round_even(100.0::DOUBLE * n / (SELECT sum(n) FROM n), 0) AS quota FROM n), r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS r FROM documents)
SELECT doc_id, lang FROM r JOIN q USING (lang) WHERE r <= quota""")
def proportional_quota_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.quota_sample(table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", ["doc_id"], 100)


@query("SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 5")
def first_per_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.first_per(table(spark, sf_dir, "documents").select("doc_id", "source"), ["source"], ["doc_id"], 5)


@query("SELECT event_id, user_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 32")
def recent_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.first_per(table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), ["user_id"], [F.desc("ts"), F.desc("event_id")], 32).drop("ts")


@query("""SELECT l_orderkey, l_linenumber, score FROM (SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'R' THEN 10 WHEN 'A' THEN 3 ELSE 0 END + CASE WHEN l_linestatus = 'O' THEN 5 ELSE 0 END + CASE WHEN l_discount > 0.05 THEN 4 ELSE 0 END + CASE WHEN l_tax > 0.04 THEN 4 ELSE 0 END + CASE WHEN l_quantity < 10 THEN 3 ELSE 0 END AS score FROM lineitem)
WHERE score >= 6 ORDER BY score DESC, l_orderkey, l_linenumber LIMIT 250""")
def issue_priority_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 250 lines of the highest issue score; a top-k report."""
    rules = [(F.col("l_returnflag") == "R", 10), (F.col("l_returnflag") == "A", 3), (F.col("l_linestatus") == "O", 5), (F.col("l_discount") > 0.05, 4), (F.col("l_tax") > 0.04, 4), (F.col("l_quantity") < 10, 3)]
    return analytics.most_urgent(table(spark, sf_dir, "lineitem"), analytics.priority(rules), ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "score")


@query("""WITH a AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0), b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 4 <> 0)
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'only_a' WHEN a.o_orderkey IS NULL THEN 'only_b' ELSE 'both' END AS found_in, a.o_orderstatus AS a_o_orderstatus, b.o_orderstatus AS b_o_orderstatus,
a.o_totalprice AS a_o_totalprice, b.o_totalprice AS b_o_totalprice, a.o_orderstatus IS NOT DISTINCT FROM b.o_orderstatus AS same_o_orderstatus, a.o_totalprice IS NOT DISTINCT FROM b.o_totalprice AS same_o_totalprice FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey""")
def run_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over overlapping orders."""
    o = table(spark, sf_dir, "orders")
    b = o.filter(F.col("o_orderkey") % 4 != 0).withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")))
    return analytics.compare_runs(o.filter(F.col("o_orderkey") % 3 != 0), b, "o_orderkey", ["o_orderstatus", "o_totalprice"])


@query("""SELECT CASE WHEN a.o_custkey IS NULL THEN 'b' WHEN b.o_custkey IS NULL THEN 'a' ELSE 'both' END AS side, coalesce(a.o_custkey, b.o_custkey) AS o_custkey
FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F') a FULL JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'O') b ON a.o_custkey = b.o_custkey""")
def run_id_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return analytics.set_relations(o.filter(F.col("o_orderstatus") == "F"), o.filter(F.col("o_orderstatus") == "O"), "o_custkey")


@query("""SELECT a.event_type, a.total AS before, b.total AS after, CASE WHEN a.total <> 0 THEN 100.0 * (b.total - a.total) / a.total END AS change FROM (SELECT event_type, sum(value) AS total FROM events WHERE user_id % 2 = 0 GROUP BY 1) a JOIN (SELECT event_type, sum(value) AS total FROM events WHERE user_id % 2 = 1 GROUP BY 1) b USING (event_type)""")
def benchmark_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").groupBy("event_type").agg(F.sum(F.when(F.col("user_id") % 2 == 0, F.col("value"))).alias("before"), F.sum(F.when(F.col("user_id") % 2 == 1, F.col("value"))).alias("after"))
    return e.filter(F.col("before").isNotNull() & F.col("after").isNotNull()).select("event_type", "before", "after", analytics.percent_change(F.col("after"), F.col("before")).alias("change"))


@query("SELECT lang, avg(CASE WHEN quality > 0 THEN n_chars END) AS mean_of_good, avg(CASE WHEN toxic > 0 THEN n_chars END) AS mean_of_toxic FROM documents JOIN labels USING (doc_id) GROUP BY lang")
def conditional_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    pick = lambda c: analytics.conditional_mean(F.when(F.col(c) > 0, F.col("n_chars")))
    return d.groupBy("lang").agg(pick("quality").alias("mean_of_good"), pick("toxic").alias("mean_of_toxic"))


@query("""WITH p AS (SELECT o_orderkey, o_totalprice / 1000000 AS b, CASE WHEN o_orderkey % 7 = 0 THEN 0.0 ELSE o_totalprice / 900000 END AS a, (o_orderkey % 2)::DOUBLE AS b2, (o_orderkey % 2)::DOUBLE AS a2 FROM orders)
SELECT metric, count(*) AS n, round_even(100 * avg(x), 2) AS before, round_even(100 * avg(y), 2) AS after, round_even(round_even(100 * avg(y), 2) - round_even(100 * avg(x), 2), 2) AS change
FROM (SELECT 'price' AS metric, b AS x, a AS y FROM p UNION ALL SELECT 'odd', b2, a2 FROM p) GROUP BY metric""")
def paired_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, price = F.col("o_orderkey"), F.col("o_totalprice")
    m = lambda p: F.create_map(F.lit("price"), p, F.lit("odd"), (k % 2).cast("double"))
    p = table(spark, sf_dir, "orders").select(m(price / 1000000).alias("b"), m(F.when(k % 7 == 0, 0.0).otherwise(price / 900000)).alias("a"))
    return analytics.paired_means(p, "b", "a")


_SIGNALS = ("metric_scanned_page_probability", "metric_table_probability", "metric_reading_order_ambiguity", "metric_ocr_required")


def _signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as signals of their users: type and id pick the name, the value is scaled, some are missing, some unknown."""
    name = F.element_at(F.array(*map(F.lit, (*_SIGNALS, "metric_other"))), (F.col("event_id") % 5 + 1).cast("int"))
    status = F.when(F.col("event_id") % 11 == 0, "missing").otherwise("ok")
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("doc_id"), F.col("event_id").alias("place"), name.alias("name"), F.when(status == "ok", F.col("value") / 100).alias("value"), status.alias("status"))


_ROUTES = """WITH w(name, weight) AS (VALUES ('metric_scanned_page_probability', 15.0::DOUBLE), ('metric_table_probability', 25.0), ('metric_reading_order_ambiguity', 20.0), ('metric_ocr_required', 18.0)),
s AS (SELECT user_id AS doc_id, event_id, ['metric_scanned_page_probability', 'metric_table_probability', 'metric_reading_order_ambiguity', 'metric_ocr_required', 'metric_other'][event_id % 5 + 1] AS name, CASE WHEN event_id % 11 = 0 THEN NULL ELSE value / 100 END AS value FROM events),
u AS (SELECT doc_id, sum((name = 'metric_other')::INT) AS unknown FROM s GROUP BY doc_id),
l AS (SELECT s.doc_id, s.name, weight, greatest(0.0, least(1.0, value)) AS v FROM s JOIN w USING (name) WHERE value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id, s.name ORDER BY event_id DESC) = 1),
d AS (SELECT u.doc_id, round_even(greatest(0.0, least(100.0, coalesce(sum((weight * v)::DECIMAL(28,12))::DOUBLE, 0.0))), 3) AS score, round_even(coalesce(sum(weight), 0.0) / 163.0::DOUBLE, 4) AS confidence, any_value(unknown)::BIGINT AS unknown FROM u LEFT JOIN l USING (doc_id) GROUP BY u.doc_id),
r AS (SELECT *, CASE WHEN trunc(score) <= 30 THEN CASE WHEN confidence < 0.5 THEN 'enrichment' ELSE 'native' END WHEN trunc(score) <= 60 THEN CASE WHEN confidence < 0.35 THEN 'docling' ELSE 'enrichment' END ELSE 'docling' END AS route FROM d)"""


@query(f"{_ROUTES} SELECT doc_id, score, confidence, unknown, route FROM r")
def route_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.decide(_signals(spark, sf_dir), routing.weights_table(spark)).select("doc_id", "score", "confidence", "unknown", "route")


@query(f"{_ROUTES} SELECT route, floor(score / 10)::BIGINT AS score_bucket, floor(confidence * 10)::BIGINT AS confidence_bucket, count(*) AS n FROM r GROUP BY ALL")
def route_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.statistics(routing.decide(_signals(spark, sf_dir), routing.weights_table(spark)))


@query("""WITH s AS (SELECT user_id AS doc_id, event_id, ['metric_scanned_page_probability', 'metric_table_probability', 'metric_reading_order_ambiguity', 'metric_ocr_required', 'metric_other'][event_id % 5 + 1] AS name, CASE WHEN event_id % 11 = 0 THEN NULL ELSE value / 100 END AS value FROM events),
f AS (SELECT doc_id, name, event_id, value FROM s WHERE name <> 'metric_other' QUALIFY row_number() OVER (PARTITION BY doc_id, name ORDER BY event_id) = 1),
t AS (SELECT doc_id, event_id, CASE WHEN value >= 0.5 THEN 'high ' || name || ' (' || round(value::DECIMAL(18,8), 2)::DECIMAL(18,2)::VARCHAR || ')' WHEN value IS NULL THEN name || ' not measured (missing)' END AS t FROM f)
SELECT d.doc_id, coalesce(list_slice(list(t ORDER BY event_id) FILTER (WHERE t IS NOT NULL), 1, 8), []) AS reasons FROM (SELECT DISTINCT doc_id FROM s) d LEFT JOIN t USING (doc_id) GROUP BY d.doc_id""")
def route_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.reasons(_signals(spark, sf_dir), routing.weights_table(spark))


@query("""SELECT o_orderkey AS doc_id, name, CASE WHEN name = 'metric_table_probability' THEN round_even(least(1.0, t / 3), 3) WHEN name = 'metric_low_text_ratio' THEN round_even(low / n, 3) ELSE round_even(least(1.0, most / 40), 3) END AS value
FROM (SELECT l_orderkey AS o_orderkey, count(*)::DOUBLE AS n, count(*) FILTER (WHERE l_quantity < 30)::DOUBLE AS low, (l_orderkey % 4)::DOUBLE AS t, max(floor(l_quantity))::DOUBLE AS most FROM lineitem GROUP BY l_orderkey), (VALUES ('metric_table_probability'), ('metric_low_text_ratio'), ('metric_layout_complexity')) v(name)""")
def detector_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as documents, lines as pages: quantity is the characters and blocks of a page."""
    q = F.floor("l_quantity")
    f = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id")).agg(
        F.count("*").alias("pages"), F.collect_list(q).alias("chars"), F.collect_list(q).alias("blocks"), F.collect_list(F.col("l_discount") * 10).alias("image_ratio"),
        F.sum((F.col("l_tax") > 0.04).cast("long")).alias("columns"), (F.col("l_orderkey") % 4).alias("tables"), F.collect_set("l_returnflag").alias("fonts"), F.avg("l_quantity").alias("mean_line"), F.lit("t").alias("title"),
    )
    return routing.detect(f).filter(F.col("name").isin("metric_table_probability", "metric_low_text_ratio", "metric_layout_complexity")).select("doc_id", "name", "value")


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN p = 'native' THEN 'native' WHEN l_returnflag = 'R' AND NOT l_quantity < 10 THEN 'docling' WHEN l_discount > 0.05 THEN 'enrichment' ELSE 'native' END AS page_route
FROM (SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN 'native' ELSE 'docling' END AS p FROM lineitem)""")
def page_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.when(F.col("l_orderkey") % 3 == 0, "native").otherwise("docling")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", routing.page_tier(doc, F.col("l_returnflag") == "R", F.col("l_quantity") < 10, F.col("l_discount") > 0.05).alias("page_route"))


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as page events: the type picks the status."""
    status = F.element_at(F.array(*map(F.lit, ("ok", "failed", "partial", "dead"))), (F.col("event_id") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "events").select(F.concat(F.lit("d-"), (F.col("user_id") % 50).cast("string")).alias("doc_id"), (F.col("event_id") % 7).cast("int").alias("page_index"), F.col("event_id").alias("seq"), status.alias("status"), F.md5(F.col("event_id").cast("string")).alias("checksum"), F.lit(1).alias("attempt"))


_EVENTS = "e AS (SELECT 'd-' || (user_id % 50) AS doc_id, (event_id % 7)::INTEGER AS page_index, event_id AS seq, ['ok', 'failed', 'partial', 'dead'][event_id % 4 + 1] AS status, md5(event_id::VARCHAR) AS checksum FROM events)"
_FOLD = f"""WITH {_EVENTS}, g AS (SELECT doc_id, page_index, count(*) AS attempts, bool_or(status = 'ok') AS ok, arg_max(seq, seq) AS l, max(seq) FILTER (WHERE status NOT IN ('failed', 'dead')) AS w FROM e GROUP BY doc_id, page_index),
f AS (SELECT g.doc_id, g.page_index, e.status, e.checksum, e.seq AS last_seq, g.attempts FROM g JOIN e ON e.doc_id = g.doc_id AND e.page_index = g.page_index AND e.seq = CASE WHEN g.ok THEN g.w ELSE g.l END)"""


@query(f"{_FOLD} SELECT doc_id, page_index, status, checksum, last_seq, attempts FROM f")
def ledger_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.fold(_ledger(spark, sf_dir))


@query(f"{_FOLD} SELECT d.doc_id, p.page_index::INTEGER AS page_index, (coalesce(f.attempts, 0) + 1)::BIGINT AS attempt FROM (SELECT DISTINCT doc_id FROM e) d CROSS JOIN (SELECT unnest(range(9)) AS page_index) p LEFT JOIN f ON f.doc_id = d.doc_id AND f.page_index = p.page_index WHERE coalesce(f.status, 'new') <> 'ok'")
def resume_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine expected pages a document, of which the events know seven."""
    e = _ledger(spark, sf_dir)
    expected = e.select("doc_id").distinct().select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(8))).alias("page_index"))
    return ledger.plan(expected, ledger.fold(e))


_RESULTS = "r AS (SELECT l_orderkey AS doc_id, l_linenumber AS page_index, CASE WHEN l_returnflag = 'R' AND l_quantity > 40 THEN 'failed' WHEN l_returnflag = 'A' THEN 'partial' ELSE 'ok' END AS status, l_quantity > 5 AS content, CASE WHEN l_discount > 0.09 THEN 1 ELSE 0 END AS n_errors FROM lineitem WHERE l_tax < 0.08)"


@query(f"""WITH {_RESULTS}, x AS (SELECT l_orderkey AS doc_id, l_linenumber AS page_index FROM lineitem),
j AS (SELECT x.doc_id, x.page_index, r.status, coalesce((r.status IN ('ok', 'partial') AND content) OR (r.status = 'ok' AND NOT content AND n_errors = 0), false) AS ok FROM x LEFT JOIN r ON r.doc_id = x.doc_id AND r.page_index = x.page_index),
a AS (SELECT doc_id, count(*) AS expected_pages, sum(ok::INT) AS actual_pages, count(*) FILTER (WHERE NOT ok) AS missing, count(*) FILTER (WHERE status = 'failed') AS failed FROM j GROUP BY doc_id)
SELECT doc_id, expected_pages, actual_pages::BIGINT AS actual_pages, missing::INTEGER AS missing, failed::INTEGER AS failed, CASE WHEN missing = 0 AND failed = 0 THEN 'ok' WHEN actual_pages > 0 THEN 'partial' ELSE 'failed' END AS status, missing = 0 AS complete FROM a""")
def assembly_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers of an order are its expected pages; what is not taxed too high was processed."""
    li = table(spark, sf_dir, "lineitem").withColumnsRenamed({"l_orderkey": "doc_id", "l_linenumber": "page_index"})
    status = F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 40), "failed").when(F.col("l_returnflag") == "A", "partial").otherwise("ok")
    r = li.filter(F.col("l_tax") < 0.08).select("doc_id", "page_index", status.alias("status"), (F.col("l_quantity") > 5).alias("content_present"), (F.col("l_discount") > 0.09).cast("int").alias("n_errors"))
    a = ledger.assembly(li.select("doc_id", "page_index"), r)
    return a.select("doc_id", "expected_pages", "actual_pages", F.size("missing_pages").alias("missing"), F.size("failed_pages").alias("failed"), "status", "complete")


@query("""SELECT event_type AS format, count(*) AS total, count(*) FILTER (WHERE s = 'ok') AS ok, count(*) FILTER (WHERE s = 'failed') AS failed, count(*) FILTER (WHERE s = 'skipped') AS skipped, sum(event_id % 9)::BIGINT AS pages
FROM (SELECT *, ['ok', 'failed', 'skipped'][event_id % 3 + 1] AS s FROM events) GROUP BY event_type""")
def batch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.element_at(F.array(*map(F.lit, ("ok", "failed", "skipped"))), (F.col("event_id") % 3 + 1).cast("int"))
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("format"), status.alias("status"), (F.col("event_id") % 9).alias("pages"), F.col("value").alias("seconds"))
    return ledger.batch_report(e).select("format", "total", "ok", "failed", "skipped", "pages")


@query("""SELECT doc_id, min(sha) AS sha256 FROM (SELECT min(doc_id) OVER (PARTITION BY sha256(text)) AS doc_id, doc_id AS d, sha256(text) AS sha FROM documents) WHERE sha NOT IN (SELECT sha256(text) FROM documents WHERE doc_id % 10 = 0) GROUP BY doc_id""")
def pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as files; those of ids divisible by ten are in the manifest; equal contents are done once."""
    f = table(spark, sf_dir, "documents").select("doc_id", F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("path"), F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))
    return ledger.pending(f, f.filter(F.col("doc_id") % 10 == 0)).select("doc_id", "sha256")


@query("""WITH v AS (SELECT p_partkey % 20 AS k, 'norm-v0.' || (p_size % 12) || '.' || (p_partkey % 15) AS version, p_size % 12 AS a, p_partkey % 15 AS b FROM part)
SELECT k, arg_max(replace(version, 'norm-v', ''), a * 100 + b) AS latest FROM v GROUP BY k""")
def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select((F.col("p_partkey") % 20).alias("k"), F.concat(F.lit("0."), (F.col("p_size") % 12).cast("string"), F.lit("."), (F.col("p_partkey") % 15).cast("string")).alias("version"))
    return documents.latest_version(p, "k", "version")


@query("SELECT l_orderkey AS doc_id, l_linenumber AS seq, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber) - 1 AS global_seq FROM lineitem")
def global_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("seq"), F.col("l_shipdate").alias("page"))
    return documents.global_sequence(li).drop("page")


@query("SELECT l_orderkey AS doc_id, l_linenumber AS rank, l_orderkey || '/b' || lpad((l_linenumber % 2)::VARCHAR, 2, '0') || '_' || lpad((row_number() OVER (PARTITION BY l_orderkey, l_linenumber % 2 ORDER BY l_linenumber) - 1)::VARCHAR, 4, '0') AS block_id FROM lineitem")
def block_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("rank"), (F.col("l_linenumber") % 2).alias("page"))
    return documents.block_ids(li).select("doc_id", "rank", "block_id")


@query("""SELECT o_orderkey, list_sort(list_distinct(list_transform(range(5), lambda i: round_even(i * (n - 1) / 4, 0)::INTEGER))) AS pages FROM (SELECT o_orderkey, (o_custkey % 90 + 6)::INTEGER AS n FROM orders)""")
def preview_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = (F.col("o_custkey") % 90 + 6).cast("int")
    return table(spark, sf_dir, "orders").select("o_orderkey", documents.evenly_spaced(n, F.lit(5)).alias("pages"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items numbered within their order, since line numbers may repeat."""
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    return table(spark, sf_dir, "lineitem").withColumn("n", F.row_number().over(order))


_LINES = "li AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate)::INTEGER AS n FROM lineitem)"


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order as blocks of a page: part picks the column, quantity the height."""
    x, y = (F.col("l_partkey") % 3) * 200.0, F.col("l_quantity") * 15.0
    box = F.struct(x.alias("x0"), y.alias("y0"), (x + 100 + F.col("l_suppkey") % 90).alias("x1"), (y + 12).alias("y1"))
    return _lines(spark, sf_dir).select(F.col("l_orderkey").alias("doc_id"), F.lit(0).alias("page"), F.col("n").alias("seq"), box.alias("box"), F.lit(600.0).alias("page_width"), F.lit(800.0).alias("page_height"))


_BOXES = _LINES + ", b AS (SELECT l_orderkey AS doc_id, n AS seq, (l_partkey % 3) * 200.0::DOUBLE AS x0, l_quantity * 15.0 AS y0, (l_partkey % 3) * 200.0::DOUBLE + 100 + l_suppkey % 90 AS x1, l_quantity * 15.0 + 12 AS y1 FROM li)"


@query()
def reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.reading_order(_boxes(spark, sf_dir)).select("doc_id", "page", "seq", "rank")


@query(f"WITH {_BOXES} SELECT doc_id, seq, row_number() OVER (PARTITION BY doc_id ORDER BY floor(y0 / 3), x0, seq) AS rank FROM b")
def baseline_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = F.col("box")
    return _boxes(spark, sf_dir).select("doc_id", "seq", F.row_number().over(Window.partitionBy("doc_id").orderBy(*layout.baseline_order(b.y0, b.x0, F.col("seq")))).alias("rank"))


@query()
def page_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = layout.reading_order(_boxes(spark, sf_dir)).withColumn("block_id", F.concat_ws("/", "doc_id", "seq"))
    return layout.regions(b).select("doc_id", "region", "kind", F.size("block_ids").alias("n_blocks"), F.col("box.x0").alias("x0"), F.col("box.y1").alias("y1"))


@query(f"""WITH {_BOXES}, t AS (SELECT l_orderkey AS doc_id, min(l_quantity) * 15.0 AS y0, min(l_quantity) * 15.0 + 100 AS y1 FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey)
SELECT doc_id, seq FROM b WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.doc_id = b.doc_id AND greatest(0, least(b.x1, 400) - greatest(b.x0, 0)) * greatest(0, least(b.y1, t.y1) - greatest(b.y0, t.y0)) / ((b.x1 - b.x0) * (b.y1 - b.y0)) > 0.6)""")
def blocks_outside_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of an order covers two columns from its least returned quantity down."""
    y = F.min("l_quantity") * 15.0
    t = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R").groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.struct(F.lit(0.0).alias("x0"), y.alias("y0"), F.lit(400.0).alias("x1"), (y + 100).alias("y1")).alias("box")).withColumn("page", F.lit(0))
    return layout.outside_tables(_boxes(spark, sf_dir), t).select("doc_id", "seq")


@query(f"WITH {_BOXES} SELECT doc_id, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM b GROUP BY doc_id")
def union_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _boxes(spark, sf_dir).groupBy("doc_id").agg(layout.union_box().alias("b")).select("doc_id", "b.*")


@query(f"""WITH {_BOXES}, g AS (SELECT doc_id, x0, x0 - lag(x0) OVER (PARTITION BY doc_id ORDER BY x0) AS gap FROM b)
SELECT doc_id, coalesce(max(gap) > 60 AND max(x0) - min(x0) > 150, false) AS multi_column FROM g GROUP BY doc_id""")
def multi_column_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.several_columns(_boxes(spark, sf_dir)).drop("page")


@query(f"WITH {_BOXES} SELECT doc_id, round_even(least(1.0, sum((x1 - x0) * (y1 - y0)) / 480700.0), 4) AS image_ratio FROM b GROUP BY doc_id")
def image_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _boxes(spark, sf_dir).withColumns({"page_width": F.lit(550.0), "page_height": F.lit(874.0)})
    return layout.image_share(b).drop("page")


@query(f"""WITH {_BOXES}, m AS (SELECT doc_id, seq, (y0 + y1) / 2 / 800 AS y FROM b) SELECT doc_id, seq, CASE WHEN y < 0.06 OR (y < 0.10 AND doc_id % 2 = 0) THEN 'header' WHEN y > 0.94 OR (y > 0.90 AND doc_id % 2 = 0) THEN 'footer' END AS margin FROM m""")
def page_margins(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("doc_id") % 2 == 0, "Page 3 of 10").otherwise("Plain words")
    return _boxes(spark, sf_dir).select("doc_id", "seq", layout.margin(text, F.col("box"), F.col("page_height")).alias("margin"))


@query("""WITH h AS (SELECT l_orderkey AS doc_id, l_linenumber AS seq, l_quantity > 28 AND NOT (l_linenumber % 3 = 0 AND false) AS big FROM lineitem)
SELECT doc_id, seq, big AS heading FROM h""")
def heading_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity is the font size over a body of 25 (ratio 1.12), under a text that is built like a heading."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("seq"), layout.is_heading(F.lit("A Study of Things"), F.col("l_quantity") + 0.0, F.lit(25.0), 1.12).alias("heading"))


@query(f"""WITH RECURSIVE {_LINES}, h AS (SELECT l_orderkey AS d, n AS r, n AS seq, l_quantity > 25 AS big, l_tax > 0.04 AS weak FROM li),
s AS (SELECT d, r, seq, big AS heading FROM h WHERE r = 1 UNION ALL SELECT h.d, h.r, h.seq, h.big AND NOT (s.heading AND h.weak) FROM s JOIN h ON h.d = s.d AND h.r = s.r + 1) SELECT d AS doc_id, seq::INTEGER AS seq, heading FROM s""")
def smoothed_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("l_tax") > 0.04, "It ends here.").otherwise("Title")
    b = _lines(spark, sf_dir).select(F.col("l_orderkey").alias("doc_id"), F.lit(0).alias("page"), F.col("n").alias("seq"), text.alias("text"), (F.col("l_quantity") > 25).alias("heading"))
    return layout.smooth_headings(b).select("doc_id", "seq", "heading")


@query("""WITH c AS (SELECT l_orderkey AS table_id, l_linenumber AS r, l_partkey % 4 AS c, max(l_suppkey)::VARCHAR AS t FROM lineitem GROUP BY ALL), s AS (SELECT table_id, max(r) AS mr, max(c) AS mc FROM c GROUP BY 1)
SELECT s.table_id, count(*)::INTEGER AS n_cells, count(c.t)::INTEGER AS n_filled FROM s, unnest(range(0, mr + 1)) AS x(r), unnest(range(0, mc + 1)) AS y(c) LEFT JOIN c ON c.table_id = s.table_id AND c.r = x.r AND c.c = y.c GROUP BY s.table_id""".replace("FROM s, unnest(range(0, mr + 1)) AS x(r), unnest(range(0, mc + 1)) AS y(c)", "FROM (SELECT table_id, unnest(range(0, mr + 1)) AS r, mc FROM s) x, unnest(range(0, x.mc + 1)) AS y(c)").replace("s.table_id, count", "x.table_id, count").replace("c.table_id = s.table_id", "c.table_id = x.table_id").replace("GROUP BY s.table_id", "GROUP BY x.table_id"))
def dense_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("table_id"), F.col("l_linenumber").cast("int").alias("row"), (F.col("l_partkey") % 4).cast("int").alias("col")).agg(F.max("l_suppkey").cast("string").alias("text"))
    cells = F.flatten("rows")
    return tables.dense_grid(c).select("table_id", F.size(cells).alias("n_cells"), F.size(F.filter(cells, lambda x: x != "")).alias("n_filled"))


@query(f"""WITH {_LINES} SELECT l_orderkey AS table_id, n AS word, CASE WHEN l_partkey % 350 >= 244 THEN 2 WHEN l_partkey % 350 >= 94 THEN 1 ELSE 0 END::INTEGER AS col FROM li""")
def words_to_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _lines(spark, sf_dir)
    w = li.select(F.col("l_orderkey").alias("table_id"), F.col("n").alias("word"), (F.col("l_partkey") % 350).cast("double").alias("x0"))
    c = li.select(F.col("l_orderkey").alias("table_id")).distinct().select("table_id", F.explode(F.array(F.lit(0.0), F.lit(100.0), F.lit(250.0))).alias("start"))
    return tables.assign_words(w, c)


@query("""SELECT n_nationkey, x.page_index, 'planned' AS status FROM (SELECT n_nationkey, CASE WHEN n_regionkey = 0 THEN 1 ELSE n_nationkey % 4 + 1 END AS n FROM nation), unnest(range(0, n)) AS x(page_index)""".replace("x.page_index,", "x.page_index::INTEGER AS page_index,"))
def expected_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("doc_id"), F.when(F.col("n_regionkey") == 0, "csv").otherwise("pdf").alias("slug"), (F.col("n_nationkey") % 4 + 1).cast("int").alias("page_count"))
    return loaders.expected_pages(n).withColumnRenamed("doc_id", "n_nationkey")


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso FROM orders")
def metadata_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.concat(F.lit("D:"), F.date_format("o_orderdate", "yyyyMMddHHmmss"), F.lit("+00'00'"))
    return table(spark, sf_dir, "orders").select("o_orderkey", loaders.iso_date(d).alias("iso"))


@query("SELECT event_id, (props::JSON->>'k') AS k FROM events")
def salvaged_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.concat(F.lit("Sure:\n```json\n"), F.col("props"), F.lit("\n```"))
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object(loaders.salvage_json(said), "$.k").alias("k"))


@query("SELECT n_nationkey, (n_nationkey + 1) * 1.5::DOUBLE AS pages_per_second, NULL::DOUBLE AS wall FROM nation")
def report_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("# Run\n**Pages/s:** "), ((F.col("n_nationkey") + 1) * 1.5).cast("string"), F.lit("\nWall: n/a"))
    r = loaders.parse_report(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("path"), text.alias("value")), {"pages_per_second": r"Pages/s:\*\* ([0-9.]+)", "wall": r"Wall: ([0-9.]+)"})
    return r.withColumnRenamed("path", "n_nationkey")


@query("SELECT item_id, true AS idempotent FROM benchmark")
def rules_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", is_idempotent(F.col("text")).alias("idempotent"))


def _streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return ingest.read_stream(spark, sf_dir, e.schema, "events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def _checkpoint(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, sum(value) AS total FROM events GROUP BY ALL")
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts by type, as a stream over what is there."""
    t = ingest.table_after(ingest.windowed_counts(_streamed(spark, sf_dir)), f"w{uuid.uuid4().hex}", _checkpoint(spark))
    return t.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("SELECT count(*) AS n_first, count(DISTINCT k) AS n_keys FROM (SELECT DISTINCT md5(event_type || (user_id % 100)) AS k FROM events)")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents are let through once."""
    s = _streamed(spark, sf_dir).withColumn("sha256", F.md5(F.concat("event_type", (F.col("user_id") % 100).cast("string"))))
    t = ingest.table_after(ingest.new_content(s), f"d{uuid.uuid4().hex}", _checkpoint(spark), "append")
    return t.agg(F.count("*").alias("n_first"), F.countDistinct("sha256").alias("n_keys"))
