"""Trees, ranks, samples, signals and streams on small inputs with nulls, ties and empties."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from pagemill.operators import analytics, documents, embedding, ledger, ranking, routing, trees
from pagemill.streaming import ingest


@pytest.fixture(scope="module")
def some_trees(spark):
    page = (0, [("paragraph", "a  b"), (None, "para-\ngraph"), ("code", "x\t1\n y "), ("formula", " x  = 1 ")], [("Cap  1", ["h  1"], [["c  1", None], ["", "“q”"]])], [("I  1",), (None,)], [("ann",)])
    return spark.createDataFrame([("d", ("T  x", None, "c", "p", ""), [page, (1, None, None, None, None)], [("[1]", "R  1"), (None, None)]), ("e", None, None, None)], trees.TREE)


def test_every_string_is_normalized(some_trees):
    done = trees.normalized(trees.strings(some_trees))
    r = {x["doc_id"]: x for x in trees.normalization_totals(done).collect()}["d"]
    assert (r["blocks_seen"], r["blocks_changed"], r["table_cells_seen"], r["table_cells_changed"]) == (4, 4, 5, 3)
    assert (r["captions_seen"], r["captions_changed"], r["annotations_seen"], r["annotations_changed"]) == (2, 2, 1, 0)
    assert (r["references_seen"], r["references_changed"], r["metadata_fields_seen"], r["metadata_fields_changed"]) == (2, 1, 3, 1)
    assert r["rule_counts"]["dehyphenate"] == 1 and r["rule_counts"]["typography"] == 1
    new = {x["doc_id"]: x for x in trees.rebuilt(some_trees, done).collect()}
    d = new["d"]
    assert [b["text"] for b in d["pages"][0]["blocks"]] == ["a b", "paragraph", "x    1\n y", "x  = 1"] and d["pages"][1]["blocks"] is None
    assert d["pages"][0]["tables"][0].asDict(True) == {"caption": "Cap 1", "header": ["h 1"], "rows": [["c 1", None], ["", '"q"']]}
    assert [r.asDict() for r in d["references"]] == [{"label": "[1]", "text": "R 1"}, {"label": None, "text": None}] and d["metadata"]["title"] == "T x"
    assert new["e"]["pages"] is None


def test_totals_and_folds(spark, some_trees):
    t = {x["doc_id"]: x for x in trees.totals(some_trees).collect()}
    assert (t["d"]["pages"], t["d"]["blocks"], t["d"]["tables"], t["d"]["images"], t["d"]["annotations"], t["d"]["references"], t["e"]["pages"], t["e"]["blocks"]) == (2, 4, 1, 2, 1, 2, 0, 0)
    schema = "doc_id string, page_index int, route string, engine_version string, blocks array<struct<kind:string,text:string>>, tables array<string>, images array<string>, annotations array<string>"
    pages = spark.createDataFrame([("d", 2, "docling", "v9", [("p", "c")], ["t2"], [], None), ("d", 0, "native", None, [("p", "a"), ("h", "b")], ["t0"], ["i"], ["n"]), ("d", 1, "native", None, None, None, None, None)], schema)
    plans = spark.createDataFrame([("d", "m"), ("lost", "m")], "doc_id string, metadata string")
    got = {r["doc_id"]: r for r in trees.fold_pages(pages, plans).collect()}
    assert [(b["seq"], b["text"]) for b in got["d"]["blocks"]] == [(0, "a"), (1, "b"), (2, "c")] and got["d"]["tables"] == ["t0", "t2"]
    assert got["d"]["ordered"] and got["d"]["layout_version"] == "v9" and not got["lost"]["ordered"] and got["lost"]["blocks"] is None


def test_ranks(spark):
    r = random.Random(5)
    rows = [(r.choice(["hot"] * 9 + ["a", "b", None]), r.choice([None, *range(50)]), i) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, v int, i int")
    by = {}
    for g, v, i in rows:
        by.setdefault(g, []).append((v is not None, v or 0, i))
    got = {(x["g"], x["i"]): (x["_rank"], x["_n"]) for x in ranking.ranked(df, ["g"], ["v", "i"]).collect()}
    assert got == {(g, i): (k, len(xs)) for g, xs in by.items() for k, (_, _, i) in enumerate(sorted(xs))}
    assert ranking.ranked(df.limit(0), ["g"], ["v"]).collect() == []


def test_percentiles_by_several_definitions(spark):
    import statistics

    r = random.Random(6)
    groups = {k: [r.choice([r.random(), 1.0, 2.0]) for _ in range(n)] for k, n in (("one", 1), ("two", 2), ("few", 19), ("many", 400))}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in [*vs, None]], "k string, v double")
    p = {x["k"]: x for x in analytics.percentiles(df, ["k"], "v", (0.5, 0.95)).collect()}
    m = {x["k"]: x["upper_median"] for x in analytics.upper_median(df, ["k"], "v").collect()}
    e = {x["k"]: x for x in analytics.exclusive_p95(df, ["k"], "v").collect()}
    for k, vs in groups.items():
        assert p[k]["p50"] == pytest.approx(statistics.median(vs)) and m[k] == sorted(vs)[len(vs) // 2]
        assert e[k]["p95"] == pytest.approx(max(vs) if len(vs) < 20 else statistics.quantiles(vs, n=20)[-1]) and e[k]["n"] == len(vs) and e[k]["total"] == pytest.approx(sum(vs))


def test_samples_are_topped_up_and_cut(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(["a"] * 5 + ["b"] * 5 + ["c"] * 5)], "i int, s string")
    assert len(analytics.quota_sample(df, "s", ["i"], 4).collect()) == 3  # 1.33 each
    got = [(x["i"], x["s"]) for x in analytics.quota_sample(df, "s", ["i"], 4, exact=True).collect()]
    assert sorted(got) == [(0, "a"), (1, "a"), (5, "b"), (10, "c")]
    assert len(analytics.quota_sample(df, "s", ["i"], 5, exact=True).collect()) == 5  # 1.67 each would be six


def test_detectors_fail_alone(spark):
    df = spark.createDataFrame([("d", 2, [10, 0], [1, 1], [0.0, 1.0], 0, 1, ["Arial", "Comic"], 5.0, "t")], "doc_id string, pages long, chars array<long>, blocks array<long>, image_ratio array<double>, columns long, tables long, fonts array<string>, mean_line double, title string")
    routing.register_detector("broken", lambda: [routing._signal("x", F.col("no_such_column"))])
    routing.register_detector("worse", lambda: 1 / 0)
    try:
        signals = routing.detect(df)
        got = {(x["detector"], x["name"]): (x["value"], x["status"]) for x in signals.collect()}
    finally:
        del routing.DETECTORS["broken"], routing.DETECTORS["worse"]
    assert got["broken", "metric_detector_failed"] == (None, "failed") and got["worse", "metric_detector_failed"] == (None, "failed")
    assert got["font", "metric_unusual_font"] == (1.0, "ok") and got["image", "metric_full_image_page_count"] == (1.0, "ok") and got["metadata", "metric_encrypted"] == (None, "missing")
    record = routing.decision_records(signals, routing.weights_table(spark)).first()
    assert record["detector_failed"] and record["n_failed"] == 2 and record["route"] in ("native", "enrichment", "docling")


def test_kinds_of_text(spark):
    cases = [("Introduction to x", "heading"), ("A Fine Title", "heading"), ("LOUD", "heading"), ("[3] ref", "reference"), ("1. Smith wrote", "reference"), ("plain words here", "paragraph"), ("2.1 Aims", "heading"), ("", "paragraph"), (None, "paragraph"), ("A Title.", "paragraph")]
    df = spark.createDataFrame([(t,) for t, _ in cases], "t string")
    assert [r[0] for r in df.select(documents.block_kind(F.col("t"))).collect()] == [k for _, k in cases]
    sizes = spark.createDataFrame([(4000, 1000), (100, 50)], "w int, h int").select(documents.downscaled(F.col("w"), F.col("h")).alias("s"))
    assert [(r["s"]["width"], r["s"]["height"]) for r in sizes.collect()] == [(2000, 500), (100, 50)]


def test_vectors_are_stored_by_embedder(spark, tmp_path):
    b = spark.createDataFrame([("d", "b1", "same"), ("d", "b2", "same"), ("d", "b3", " "), ("e", "b1", None)], "doc_id string, block_id string, text string")
    v = embedding.embed_blocks(b, lambda: embedding.hash_embedder(8))
    assert {(r["doc_id"], r["block_id"]) for r in v.collect()} == {("d", "b1"), ("d", "b2")}
    path = str(tmp_path / "v")
    for name in ("org/model@1", "other"):
        embedding.write_vectors(v, path, name, "c1")
        embedding.write_vectors(v, path, name, "c1")
    assert embedding.read_vectors(spark, path).count() == 4 and embedding.read_vectors(spark, path, "org/model@1").count() == 2


def test_ledger_stream_equals_the_fold(spark, tmp_path):
    r = random.Random(8)
    rows = [(f"d{r.randrange(4)}", r.randrange(3), i, r.choice(["ok", "partial", "failed", "dead"]), f"c{i}", r.choice([1, 2, None])) for i in range(120)]
    schema = "doc_id string, page_index int, seq long, status string, checksum string, attempt int"
    events = spark.createDataFrame(rows, schema)
    for k in range(3):  # three batches, in order
        events.filter(F.floor(F.col("seq") / 40) == k).coalesce(1).write.parquet(str(tmp_path / "in" / f"b={k}"))
    stream = ingest.read_stream(spark, str(tmp_path / "in" / "*"), events.schema, files_per_trigger=1)
    ingest.write_batches(ingest.ledger_stream(stream), str(tmp_path / "cp"), str(tmp_path / "out"), "update")
    out = spark.read.parquet(str(tmp_path / "out"))
    last = out.groupBy("doc_id", "page_index").agg(F.max_by(F.struct("status", "checksum", "last_seq", "attempts"), "batch").alias("s")).select("doc_id", "page_index", "s.*")
    want = ledger.fold(events).select(*last.columns)
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, want.collect()))


def test_verdicts_stop_at_the_target(spark, tmp_path):
    schema = "doc_id long, verdict string"
    for k in range(3):
        spark.range(10 * k, 10 * k + 10).select(F.col("id").alias("doc_id"), F.lit("PASS").alias("verdict")).coalesce(1).write.parquet(str(tmp_path / "in" / f"b={k}"))
    stream = ingest.read_stream(spark, str(tmp_path / "in" / "*"), spark.createDataFrame([], schema).schema, files_per_trigger=1)
    out = str(tmp_path / "out")
    ingest.judge_until(spark, stream, str(tmp_path / "cp"), 25, out)
    assert spark.read.schema(schema).parquet(out).count() == 25
    ingest.judge_until(spark, stream, str(tmp_path / "cp"), 25, out)  # nothing new
    assert spark.read.schema(schema).parquet(out).count() == 25


def test_events_of_documents(spark):
    r = spark.createDataFrame([("d", "ok", 1, None), ("e", "failed", 2, "bad")], "doc_id string, status string, ts int, error string")
    got = [(x["event"], x["payload"]) for x in ingest.document_events(r).orderBy("ts").collect()]
    assert got == [("document.parsed.v1", '{"doc_id":"d","status":"ok"}'), ("document.parse_failed", '{"doc_id":"e","status":"failed","error":"bad"}')]


def test_flags_without_a_place_come_last(spark, tmp_path):
    import duckdb

    from pagemill.plans import document_queries

    rows = [(1, 10, 1, "B"), (1, None, 2, "A"), (1, 5, 3, "C"), (2, None, 1, "A"), (2, 3, 1, "Z"), (2, None, None, "Z"), (3, 5, 1, None), (3, 6, 1, "A"), (4, None, None, "Q"), (5, -5, 0, "N"), (5, 0, 0, "M"), (5, None, None, None)]
    rows += [(None, 1, 2, "K"), (None, 1, 1, "L")]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_linenumber int, l_returnflag string").coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    got = {x["l_orderkey"]: x["items"] for x in document_queries.fonts_in_order(spark, str(tmp_path)).collect()}
    assert got == {1: ["B", "C", "A"], 2: ["Z", "A"], 3: [None, "A"], 4: ["Q"], 5: ["N", "M", None], None: ["L", "K"]}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    assert got == dict(con.execute(document_queries.SQL["fonts_in_order"]).fetchall())
    ties = [(1, f, p) for f, p in (("R", 7), ("A", 7), (None, 7), ("N", 8), ("Z", None), ("Y", None))]
    for some in (ties, ties[::-1]):
        assert analytics.first_seen(spark.createDataFrame(some, "k int, f string, p long"), "k", "f", "p").first()["items"] == ["A", "R", None, "N", "Y", "Z"]
