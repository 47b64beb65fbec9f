from __future__ import annotations

import io
import zipfile

from pyspark.sql import functions as F

from pagemill.operators import analytics, documents, embedding, layout, ledger, references, routing, tables
from pagemill.sources import detect, loaders, sinks


def test_detection(spark):
    def zipped(*names):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for n in names:
                z.writestr(n, "x")
        return out.getvalue()

    cases = [
        (b"%PDF-1.7", "pdf"), (b"\x89PNG\r\n\x1a\n", "png"), (b"", "unknown"), (None, "unknown"), (b"\x00\x01\x02", "unknown"), (zipped("word/document.xml"), "docx"),
        (zipped("a.txt"), "zip"), (b"PK\x03\x04broken", "zip"), (b"<?xml version='1.0'?><a/>", "xml"), (b"  <!DOCTYPE html><p>", "html"), (b'{"a": 1}', "json"), (b"# Title\n", "markdown"),
        (b"a\tb\n1\t2\n", "tsv"), (b"a,b\n1,2\n", "csv"), (b"a,b\n12\n", "plaintext"), (b"\xef\xbb\xbfhello", "plaintext"),
    ]
    df = spark.createDataFrame([(i, bytearray(c) if c is not None else None, "x/Report.PDF") for i, (c, _) in enumerate(cases)], "i int, c binary, n string")
    got = {r["i"]: r["d"] for r in df.select("i", detect.detect(F.col("c"), F.col("n")).alias("d")).collect()}
    assert [got[i]["slug"] for i in range(len(cases))] == [s for _, s in cases]
    assert got[0]["declared"] == "pdf" and got[2]["unresolved"] and not got[15]["unresolved"]


def test_loaders(spark):
    assert loaders.html_blocks("<title>T</title>pre<p>one<br>two<li>x<h2>H</h2><script>var a='</p>'</script>end") == [(0, "paragraph", "pre"), (1, "paragraph", "one\ntwo"), (2, "list_item", "x"), (3, "heading", "H"), (4, "paragraph", "end")]
    assert loaders.markdown_blocks("# T\na\nb\n\n- x\n```\ncode\n```") == [(0, "heading", "# T"), (1, "paragraph", "a b"), (2, "list_item", "- x"), (3, "paragraph", "``` code"), (4, "paragraph", "```")]
    assert loaders.stripped_markdown_blocks("## T\n1. one\n* two\nthree") == [(0, "heading", "T"), (1, "list_item", "1. one"), (2, "list_item", "two"), (3, "paragraph", "three")]
    assert loaders.delimited("a,b\n\n , \n1, 2 \n", ",") == {"page": 0, "header": ["a", "b"], "rows": [["1", "2"]]}
    assert loaders.clean_meta(" a&amp;b\x01 ﬁ ") == "a&b fi"
    assert loaders.json_blocks("{bad")[0][2] == "" and loaders.xml_blocks("<a>1</a>")[0][2] == "<a>1</a>"
    d = spark.createDataFrame([("D:20240131120000",), ("D:2024",), ("soon",), (None,)], "d string")
    assert [r[0] for r in d.select(loaders.iso_date(F.col("d"))).collect()] == ["2024-01-31", "2024-01-01", "soon", None]


def test_reading_order_and_geometry(spark):
    left = [(0.0, 100.0 + 20 * i, 200.0, 115.0 + 20 * i, i) for i in range(3)]
    right = [(300.0, 100.0 + 20 * i, 500.0, 115.0 + 20 * i, 10 + i) for i in range(3)]
    title = (0.0, 10.0, 500.0, 30.0, 99)
    mixed = [title, *[b for pair in zip(right, left, strict=True) for b in pair]]
    assert [b[4] for b in layout.cut_order(mixed)] == [99, 0, 1, 2, 10, 11, 12]
    box = "struct<x0:double,y0:double,x1:double,y1:double>"
    df = spark.createDataFrame([("d", 0, b[4], b[:4]) for b in mixed] + [("d", 0, 50, None)], f"doc_id string, page int, seq int, box {box}")
    assert [r["seq"] for r in layout.reading_order(df).orderBy("rank").collect()] == [99, 0, 1, 2, 10, 11, 12, 50]
    t = spark.createDataFrame([("d", 0, (0.0, 90.0, 250.0, 400.0))], f"doc_id string, page int, box {box}")
    assert {r["seq"] for r in layout.outside_tables(df.filter("box is not null"), t).collect()} == {99, 10, 11, 12}
    assert [r["m"] for r in spark.createDataFrame([("aaaa",), ("a111111",), ("words here",), ("10101010",)], "t string").select(layout.is_noise(F.col("t")).alias("m")).collect()] == [True, True, False, True]
    heads = spark.createDataFrame([("Introduction", 14.0), ("Introduction", 11.0), ("..", 20.0), ("A long sentence that ends here as text.", 20.0), (" ".join(["w"] * 26), 20.0)], "t string, s double")
    assert [r[0] for r in heads.select(layout.is_heading(F.col("t"), F.col("s"), F.lit(10.0))).collect()] == [True, False, False, False, False]


def test_tables(spark):
    t = spark.createDataFrame(
        [
            ("d", 0, 1, ["Approach", "Score"], [["a", "1"]]),
            ("d", 1, 2, ["Continuation of Table 3. Approach", "Continuation of Table 3.  Score"], [["Approach", "Score"], ["b", "It is so. Done now. End of Table"], ["End of Table", "End of Table"]]),
            ("d", 2, 3, ["Table 3", "Table 3"], [["c", "3"], ["d", "x y. Go on"]]),
            ("d", 3, 4, ["x"], [["x"], ["y"]]),
            ("d", 4, 3, ["x"], []),
            ("e", 0, 1, ["Approach", "Score"], [["Approach", " Score "], ["z", "1"], ["y", None]]),
            ("f", 0, 1, None, None),
        ],
        "doc_id string, seq int, page int, header array<string>, rows array<array<string>>",
    )
    got = {(r["doc_id"], r["seq"]): (r["page"], r["rows"]) for r in tables.join_continuations(t).collect()}
    assert got == {
        ("d", 0): (1, [["a", "1"], ["b", "It is so. Done now. End of Table"], ["End of Table", "End of Table"], ["c", "3"], ["d", "x y"]]),
        ("d", 1): (4, []), ("d", 2): (3, []), ("e", 0): (1, [["z", "1"]]), ("f", 0): (1, []),
    }
    cells = spark.createDataFrame([("It is so. Done now. End of Table",), ("Two words",), ("It is so. Done now.",), ("One. Two three four five six seven eight",), ("Café.  A b c",)], "c string")
    assert [r[0] for r in cells.select(tables.strip_marker(tables.tidy(F.col("c")))).collect()] == ["It is so. Done now", "Two words", "It is so. Done now.", "One. Two three four five six seven eight", "Café"]
    words = [(0.0, 10.0, "a"), (100.0, 10.5, "1"), (0.0, 30.0, "b"), (100.0, 30.2, "2"), (0.0, 42.0, "more")]
    assert tables.rows_from_words(words, [0.0, 100.0], ["h", "k"]) == [["a", "1"], ["b more", "2"]] or tables.rows_from_words(words, [0.0, 100.0], ["h", "k"]) is None
    assert tables.markdown_tables("Table 1. T\n| a | b |\n|---|---|\n| 1 | 2 |\n")[0] == {"caption": "Table 1. T", "header": ["a", "b"], "rows": [["1", "2"]]}
    assert tables.html_grid("<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td><b>2</b></td></tr></table>") == (["a", "b"], [["1", "2"]])
    assert tables.map_grid([["Title", "Title"], ["h1", "h2"], ["1", "2"]], [True, True, False]) == {"caption": "Title", "header": ["h1", "h2"], "rows": [["1", "2"]]}
    df = spark.createDataFrame([(["a"] * 11, [["x"] * 11, ["yy"] * 11]), (["a", "b"], [["long cell text here", "b"]]), (["a", "b"], [["1", "2"], ["3", "4"]])], "h array<string>, r array<array<string>>")
    got = df.select(tables.is_oversplit(F.col("r")).alias("o"), tables.confidence(F.col("h"), F.col("r")).alias("c"), tables.is_simple_grid(F.col("h"), F.col("r")).alias("s")).collect()
    assert [tuple(r) for r in got] == [(True, 1.0, False), (True, 0.3, False), (False, 1.0, True)]


def test_references(spark):
    blocks = {
        "d": [("paragraph", "As shown [2]."), ("heading", "References"), ("paragraph", "[1] First"), ("paragraph", "continued"), ("paragraph", "[2] Second entry\n[3] Third"), ("paragraph", "and more"), ("heading", "Appendix"), ("paragraph", "[9] no")],
        "e": [("paragraph", "1. only")],
        "f": [("paragraph", "see [2]"), ("paragraph", "1. one"), ("paragraph", "(2) two"), ("paragraph", "goes on"), ("heading", "H"), ("paragraph", "not this"), ("paragraph", "10  ten"), ("paragraph", "2. the longer second")],
        "g": [("paragraph", "1. a"), ("paragraph", "2. b"), ("paragraph", "3. c, none cited [7]")],
        "h": [("paragraph", None), ("title", "Works cited"), ("paragraph", "  lost line"), ("paragraph", "[1] same"), ("paragraph", "[1] SAME")],
    }
    df = spark.createDataFrame([(d, i, k, t) for d, bs in blocks.items() for i, (k, t) in enumerate(bs)], "doc_id string, seq int, kind string, text string")
    got = {r["doc_id"]: [(x["label"], x["text"]) for x in r["references"]] for r in references.extract(df).collect()}
    assert got == {
        "d": [("[1]", "First continued"), ("[2]", "Second entry"), ("[3]", "Third and more")], "e": [], "g": [],
        "f": [("[1]", "one"), ("[2]", "the longer second"), ("[10]", "ten")], "h": [("[1]", "same")],
    }
    refs = references.extract(df)
    assert {(r["doc_id"], r["number"], r["reference_id"]) for r in references.cited(df, refs).collect() if r["doc_id"] == "f"} == {("f", "2", "f/ref-2")}


def test_routing(spark):
    df = spark.createDataFrame([(30.0, 0.99), (31.0, 0.99), (60.0, 0.99), (61.0, 0.99), (100.0, 0.99), (20.0, 0.1), (40.0, 0.1), (80.0, 0.1), (30.9, 0.99)], "s double, c double")
    got = [r[0] for r in df.select(routing.tier(F.col("s"), F.col("c"))).collect()]
    assert got == ["native", "enrichment", "enrichment", "docling", "docling", "enrichment", "docling", "docling", "native"]
    assert sum(routing.WEIGHTS.values()) == 163
    routing.register_detector("own", lambda: [routing._signal("own", F.lit(1.0))])
    f = spark.createDataFrame([("d", 1, [0], [1], [1.0], 0, None, [], 5.0, None)], "doc_id string, pages long, chars array<long>, blocks array<long>, image_ratio array<double>, columns long, tables long, fonts array<string>, mean_line double, title string")
    got = {r["name"]: (r["value"], r["status"]) for r in routing.detect(f).collect()}
    del routing.DETECTORS["own"]
    assert got["metric_low_char_density"] == (1.0, "ok") and got["metric_table_probability"] == (None, "missing") and got["metric_font_diversity"] == (None, "not_applicable") and got["metric_own"] == (1.0, "ok")


def test_ledger(spark):
    e = spark.createDataFrame([("d", 0, 1, "ok", "x", 1), ("d", 0, 2, "failed", "", 1), ("d", 1, 1, "failed", "", 1), ("d", 1, 2, "dead", "", 2)], "doc_id string, page_index int, seq long, status string, checksum string, attempt int")
    got = {r["page_index"]: (r["status"], r["attempts"]) for r in ledger.fold(e).collect()}
    assert got == {0: ("ok", 2), 1: ("dead", 3)}
    tries = []

    def engine(pages):
        tries.append(1)
        return pages.select("doc_id", "page_index", "attempt", F.when((F.col("page_index") == 0) | (F.col("attempt") == 2), "ok").otherwise("failed").alias("status"))

    pages = spark.createDataFrame([("d", 0, 1), ("d", 1, 1)], "doc_id string, page_index int, attempt int")
    out = ledger.run_with_retries(pages, engine, lambda df, name: df.sparkSession.createDataFrame(df.collect(), df.schema))
    assert {r["page_index"]: r["status"] for r in out.collect()} == {0: "ok", 1: "ok"} and len(tries) == 3
    files = spark.createDataFrame([("a", "h1"), ("b", "h1"), ("c", None), ("d", "h2")], "path string, sha256 string")
    assert {r["path"] for r in ledger.pending(files, spark.createDataFrame([("h2",)], "sha256 string")).collect()} == {"a", "c"}


def test_sinks_are_incremental(spark, tmp_path):
    df = spark.createDataFrame([("h1", 1), ("h2", 2), ("h2", 3)], "sha256 string, v int")
    path = str(tmp_path / "t")
    sinks.append_new(df, path, "sha256")
    sinks.append_new(df, path, "sha256")
    assert spark.read.parquet(path).count() == 2
    sinks.write_version(spark.createDataFrame([("v1", 1), ("v2", 1)], "version string, x int"), str(tmp_path / "v"), "version")
    sinks.write_version(spark.createDataFrame([("v2", 7)], "version string, x int"), str(tmp_path / "v"), "version")
    assert sorted((r["version"], r["x"]) for r in spark.read.parquet(str(tmp_path / "v")).collect()) == [("v1", 1), ("v2", 7)]


def test_analytics_and_vectors(spark):
    v = spark.createDataFrame([("norm", "0.9.0"), ("norm", "0.10.0"), ("norm", "0.2.1")], "k string, version string")
    assert documents.latest_version(v, "k", "version").first()["latest"] == "0.10.0"
    j = spark.createDataFrame([(["a", "b"], ["b", "c"]), ([], [])], "a array<string>, b array<string>")
    assert [round(r[0], 3) for r in j.select(analytics.jaccard(F.col("a"), F.col("b"))).collect()] == [0.333, 0.0]
    name, model = embedding.hash_embedder(8)
    d = spark.createDataFrame([("a", "Hello"), ("b", ""), ("c", "ab")], "k string, t string")
    native = {r["k"]: r["vec"] for r in embedding.feature_hash(d, "k", "t", 8).collect()}
    assert native == {k: model([t])[0] for k, t in (("a", "Hello"), ("b", ""), ("c", "ab"))}
    z = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0]), ([1.0, 1.0], [1.0, 1.0])], "a array<double>, b array<double>")
    assert [round(r[0], 6) for r in z.select(embedding.cosine(F.col("a"), F.col("b"))).collect()] == [0.0, 1.0]


def test_command_line(spark, tmp_path):
    from pagemill.__main__ import parsed

    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / "in" / f"r{i}.md").write_text(f"# Report {i}\n\nPatient {i} observed with  stable signs.\n\n- item a\n- item b\n")
    b = parsed(spark, str(tmp_path / "in"))
    assert b.count() == 12 and {r["kind"] for r in b.collect()} == {"heading", "paragraph", "list_item"}
    parts = [parsed(spark, str(tmp_path / "in"), (k, 2)).count() for k in range(2)]
    assert sum(parts) == 12


def test_reasons(spark):
    rows = [
        (1, 0, "metric_other", 0.9, "ok"), (1, 1, "metric_ocr_required", 0.6, "ok"), (1, 2, "metric_ocr_required", 0.9, "ok"), (1, 3, "metric_form_probability", 0.4, "ok"),
        (1, 4, "metric_table_probability", None, "missing"), (1, 5, "metric_font_diversity", None, "failed"), (1, 6, "metric_image_density", None, "not_applicable"), (1, 7, "metric_form_probability", 0.9, "ok"), (2, 0, "metric_other", 1.0, "ok"),
        *[(3, i, name, 1.0, "ok") for i, name in enumerate(n for name in routing.WEIGHTS for n in (name, name))],
    ]
    df = spark.createDataFrame(rows, "doc_id long, place long, name string, value double, status string")
    got = {r["doc_id"]: r["reasons"] for r in routing.reasons(df, routing.weights_table(spark)).collect()}
    assert got[1] == ["high metric_ocr_required (0.60)", "metric_table_probability not measured (missing)", "metric_font_diversity not measured (failed)"]
    assert got[2] == []
    assert got[3] == [f"high {n} (1.00)" for n in list(routing.WEIGHTS)[:8]]


def test_bibliographies_are_whole(spark):
    from pagemill.plans import text_queries

    sf = "/root/testdata/sf0.001"
    blocks = documents.text_blocks(text_queries.table(spark, sf, "documents")).collect()
    got = {(r["doc_id"], r["label"]): r["chars"] for r in text_queries.bibliographies(spark, sf).collect()}
    assert {k[0] for k in got} == {b["doc_id"] for b in blocks}
    assert max(b["seq"] for b in blocks) >= 6
    for b in blocks:
        if b["seq"] < 9999:  # a label has four digits at most
            assert (b["doc_id"], f"[{b['seq'] + 1}]") in got


def _similar(units, threshold, rows):
    sets = {i: {tuple(g) for g in gs} for i, gs in units}
    j = lambda a, b: len(a & b) / len(a | b)
    found = [(i, k, j(sets[i], sets[k])) for i in sets for k in sets if i < k and sets[i] and sets[k]]
    return sorted((x for x in found if x[2] >= threshold), key=lambda x: (-x[2], x[0], x[1]))[:rows]


def test_similar_sets(spark):
    import random

    r = random.Random(3)
    base = [[[str(x)] for x in r.sample(range(400), r.randrange(10, 60))] for _ in range(12)]
    units = [(i, [["common"], *(g for g in base[i % 12] if r.random() > 0.15 * (i % 4))]) for i in range(80)] + [(90, []), (91, [])]
    df = spark.createDataFrame(units, "id long, grams array<array<string>>")
    for t in (0.3, 0.5, 0.8):
        for rows in (5, 40, 5000):
            got = [(x["id"], x["id_b"], x["jaccard"]) for x in analytics.similar_sets(df, t, rows).collect()]
            assert got == _similar(units, t, rows)


def test_similar_documents(spark):
    import re

    from pagemill.plans import text_queries

    sf = "/root/testdata/sf0.001"
    units = []
    for d in text_queries.table(spark, sf, "documents").collect():
        w = re.findall(r"\w+", d["text"].lower())
        units.append((d["doc_id"], list(zip(w, w[1:], w[2:]))))
    got = [(x["id"], x["id_b"], round(x["jaccard"], 9)) for x in text_queries.near_dup_trigram_pairs(spark, sf).collect()]
    assert got and got == [(a, b, round(j, 9)) for a, b, j in _similar(units, 0.4, 40)]


def _nearest(vectors, queries, k):
    """By the column expression over all pairs."""
    j = vectors.join(queries.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q")), F.col("vec_id") != F.col("query_id"))
    rows = [tuple(r) for r in j.select("query_id", "vec_id", F.bround(embedding.cosine(F.col("q"), F.col("embedding")), 6)).collect()]
    out = []
    for query in sorted({r[0] for r in rows}):
        best = sorted((r for r in rows if r[0] == query), key=lambda r: (r[2] is None, 0 if r[2] is None else -r[2] if r[2] == r[2] else -9, r[1]))
        out += [(query, i + 1, v, s) for i, (_, v, s) in enumerate(best[:k])]
    return repr(out)


def test_nearest_vectors(spark, monkeypatch):
    import random

    r = random.Random(5)
    base = [[r.gauss(0, 1) for _ in range(8)] for _ in range(40)]
    rows = [(i, base[i % 40] if i % 3 else [x + r.gauss(0, 1e-4) for x in base[i % 7]]) for i in range(300)]
    rows += [(i, [float(r.randrange(-1, 2)) for _ in range(8)]) for i in range(300, 500)]  # ties, and sums that are zero
    rows += [(i, base[0]) for i in range(500, 600)]
    odd = [(600, None), (601, [0.0] * 8), (602, [1.0] * 5), (603, [1.0, None] * 4), (604, [float("nan")] * 8), (605, []), (None, base[1])]
    r.shuffle(rows)
    for more in ([], odd):
        v = spark.createDataFrame(rows + more, "vec_id long, embedding array<float>").repartition(3).persist()
        q = v.filter(F.col("vec_id") % 25 == 0).union(v.filter(F.col("vec_id") > 599))
        for block in (20_000, 7):
            monkeypatch.setattr(embedding, "QUERY_BLOCK", block)
            monkeypatch.setattr(embedding, "TILE", 5000 if block == 7 else 1 << 21)
            got = embedding.top_similar(v, q, 10)
            assert repr(sorted(map(tuple, got.collect()), key=lambda x: x[:2])) == _nearest(v, q, 10)
            assert "MapInArrow" in got._jdf.queryExecution().toString()  # rows meet queries in products, not one pair at a time
    assert embedding.top_similar(v.limit(0), q, 3).count() == 0 and embedding.top_similar(v, q.limit(0), 3).count() == 0


def test_similar_long_documents(spark, tmp_path):
    """Texts of some thousand words take about linear time: the plan splits a text once and compares no grams as lists."""
    import time

    from pagemill.plans import text_queries

    text = lambda i: " ".join(f"w{(k * k + 7 * i * k) % 30011}" for k in range(15_000))
    rows = [(1, text(1)), (2, text(2)), (3, text(1) + " more"), (4, ""), (5, None), (6, "two words"), (7, "Two words!")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(1).write.parquet(str(tmp_path / "documents.parquet"))
    began = time.time()
    got = [(x["id"], x["id_b"], x["jaccard"]) for x in text_queries.near_dup_trigram_pairs(spark, str(tmp_path)).collect()]
    assert [x[:2] for x in got] == [(1, 3)] and 0.999 < got[0][2] < 1
    assert time.time() - began < 60


def test_delimiters_beyond_the_head(spark, tmp_path):
    from pagemill.plans import text_queries

    long = "word " * 1700
    texts = [f"a,b{long}\nc{long}", f"a{long}\nb,c", f"{long},", f"a,{long}\nb,{long}", f"a\t{long}\nb\tc", "1" + " " * 9000 + "x", '[1, 2]', "[" + "1," * 5000 + "1]"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["slug"] for r in text_queries.document_types(spark, str(tmp_path)).collect()}
    assert got == {0: "plaintext", 1: "plaintext", 2: "csv", 3: "csv", 4: "tsv", 5: "plaintext", 6: "json", 7: "csv"}
    head = spark.createDataFrame([(texts[0],)], "t string").select(detect.detect(F.encode("t", "UTF-8"), F.lit("a")).alias("d")).first()["d"]
    assert head["slug"] == "csv"  # a file's type goes by its head alone
