from __future__ import annotations

from pagemill.operators import chunking as ch


def block(i, text, kind="paragraph"):
    return (f"b{i}", kind, 0, text, "page_order")


def test_heading_opens_a_chunk():
    out = ch.pack([block(0, "Intro text here."), block(1, "Title", "heading"), block(2, "Y" * 4000)])
    assert [c["kind"] for c in out] == ["paragraph", "heading", "paragraph"]
    assert out[1]["overlap_of"] == 0 and out[1]["text"].startswith("Intro text here.")
    assert out[2]["heading_anchor"] == "Title"


def test_merge_and_band():
    out = ch.pack([block(i, "a" * 150) for i in range(8)])
    assert len(out) == 1 and len(out[0]["source_block_ids"]) == 8
    out = ch.pack([block(0, "a" * 600), block(1, "b" * 2000), block(2, "c" * 2000)])
    assert [c["source_block_ids"] for c in out] == [["b0", "b1"], ["b2"]]


def test_oversized():
    out = ch.pack([block(0, "This is a sentence of some length. " * 300)])
    assert len(out) >= 2 and all(len(c["text"]) // 4 <= 400 for c in out) and [c["piece_index"] for c in out] == list(range(len(out)))
    out = ch.pack([block(0, "Y" * 8400)])
    assert len(out) == 2 and all(c["forced_split"] for c in out) and out[0]["text"] == out[1]["text"]
    assert len(ch.pack([block(0, "a" * 8195)])) == 1  # 2,048 tokens
    assert ch.pack([block(0, "  "), block(1, "x")])[0]["skipped_empty"] == 1


def test_order_ids_and_budget(spark):
    b = spark.createDataFrame([("d", 0, 0, "a", "A"), ("d", 0, 1, "b", "B"), ("d", 1, 0, "c", "C"), ("e", 0, 0, "a", "E")], "doc_id string, page int, place int, block_id string, text string")
    chain = spark.createDataFrame([("d", 0, "c"), ("d", 1, "missing"), ("d", 2, "a")], "doc_id string, at int, block_id string")
    got = [(r["doc_id"], r["seq"], r["block_id"], r["source"]) for r in ch.resolve_order(b, chain).orderBy("doc_id", "seq").collect()]
    assert got == [("d", 0, "c", "reading_order"), ("d", 1, "a", "reading_order"), ("d", 2, "b", "orphan"), ("e", 0, "a", "page_order")]
    rows = spark.createDataFrame([("d", i, f"d/b{i}", "paragraph", 0, t, "page_order") for i, t in enumerate(["Y" * 8400, "tail", None, ""])], "doc_id string, seq int, block_id string, kind string, page int, text string, source string")
    c = ch.chunk(rows).collect()
    assert len({x["chunk_id"] for x in c}) == len(c) == 3
    r = ch.report(ch.chunk(rows)).first()
    assert r["chunks_created"] == 3 and r["forced_splits"] == 2 and r["blocks_skipped_empty"] == 2
    sizes = lambda n, k, budget: [len([1 for x in ch.group_by_budget(spark.createDataFrame([("k", i, n) for i in range(k)], "k string, o long, n long"), "k", "o", "n", budget).collect() if x["call"] == c]) for c in range(10)]
    assert sizes(100, 10, ch.Budget(per_call=250))[:5] == [2, 2, 2, 2, 2]
    assert sizes(1, 10, ch.Budget(texts_per_call=3))[:5] == [3, 3, 3, 1, 0]
    assert sizes(50, 4, ch.Budget(per_call=100))[:3] == [2, 2, 0]
    assert sizes(500, 3, ch.Budget(per_call=100))[:4] == [1, 1, 1, 0]
