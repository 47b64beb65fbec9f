"""Operators that hold documents against others: near duplicates, substrings, benchmark items; and the pipeline."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.llm import decontaminate, graph, near_dups, substring_dedup
from tests.llm.helpers import make_docs, morse, words

FOLD = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def shingle_set(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


class Sets:
    def __init__(self):
        self.root = {}

    def find(self, x):
        self.root.setdefault(x, x)
        while self.root[x] != x:
            x = self.root[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.root[max(a, b)] = min(a, b)


def components(rows, k, percent):
    s = Sets()
    sets = [(d, shingle_set(t, k)) for d, t in rows if d is not None]
    for i, (a, x) in enumerate(sets):
        s.find(a)
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                s.join(a, b)
    return s


def edited(rnd, text, share):
    w = text.split(" ")
    for _ in range(int(len(w) * share)):
        w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
    return " ".join(w)


def test_graph(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    s = Sets()
    for a, b in edges:
        s.join(a, b)
    got = {x["node"]: x["component"] for x in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: s.find(x) for x in linked}
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.fixture(scope="module")
def near_rows():
    r = random.Random(4)
    rows, at = [], 0
    common = words(r, 60, 10**6)
    for group in range(25):
        text = words(r, r.choice([4, 8, 30, 120, 400]), 10**6)
        for share in [0, 0, 0.01, 0.02, 0.03, 0.05, 0.1][: r.randrange(1, 8)]:
            rows.append((at, edited(r, text, share) if share else text))
            at += 1
    for _ in range(60):  # many texts share a passage and nothing else
        rows.append((at, f"{words(r, 50, 10**6)} {common} {words(r, 50, 10**6)}"))
        at += 1
    text = words(r, 300, 10**6)
    for _ in range(90):  # one large group of near copies of each other
        rows.append((at, edited(r, text, r.choice([0.005, 0.01, 0.02, 0.04]))))
        at += 1
    r.shuffle(rows)
    a, b = morse(1024, "a", "b"), morse(1024, "b", "a")
    rows += [(at + 4, f"x y z {a}"), (at + 5, f"x y z {b}")]  # unlike, though their letters are alike
    return [*rows, (0, "again with id zero"), (at, None), (at + 1, " "), (None, rows[0][1]), (at + 2, "One two"), (at + 3, "one  TWO")]


@pytest.mark.parametrize(("width", "threshold", "block"), [(3, 85, 400), (5, 80, 20)])
def test_near_duplicates(spark, near_rows, width, threshold, block, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK", block)  # 20: the large group goes over several tasks
    monkeypatch.setattr(near_dups, "CENTRES", 3)
    monkeypatch.setattr(near_dups, "HOT", 8)  # the larger groups meet in long lists
    monkeypatch.setattr(near_dups, "TIED", 16)  # which fall into parts
    docs = make_docs(spark, near_rows).withColumns({"rep": F.lit(1), "component": F.lit(2), "n": F.lit(3), "gone": F.lit(4), "_gone": F.lit(5)})
    want = components(near_rows, width, threshold)
    got = near_dups.near_components(docs, threshold=threshold, width=width).collect()
    assert len(got) == len(near_rows)
    assert sorted((x["doc_id"] if x["doc_id"] is not None else -1, x["n_shingles"]) for x in got) == sorted((d if d is not None else -1, len(shingle_set(t, width))) for d, t in near_rows)
    for x in got:
        d = x["doc_id"]
        assert x["component_id"] == (None if d is None else want.find(d)) and x["kept"] == (d is None or want.find(d) == d), x
    kept = near_dups.drop_near(docs, threshold=threshold, width=width)
    assert kept.columns == docs.columns
    assert sorted(x["doc_id"] for x in kept.filter("doc_id is not null").collect()) == sorted(d for d, _ in near_rows if d is not None and want.find(d) == d)


def test_pairs_at_the_similarity_among_templates(spark):
    """Texts that are mostly a template of many others, in pairs just at 85 percent: every pair is found, and no other."""
    r = random.Random(21)
    templates = [words(r, n, 10**6) for n in (40, 70, 100)]
    rows, want = [], set()
    for k in range(150):
        w = f"{templates[k % 3]} {words(r, 60, 10**6)}".split()
        n = len(w) - 2
        other, edits = w[:], 0
        while True:  # one word changes three shingles
            more = other[:]
            more[len(w) - 2 - 4 * edits] = f"y{k}_{edits}"
            a, b = shingle_set(" ".join(w), 3), shingle_set(" ".join(more), 3)
            if 100 * len(a & b) < 85 * len(a | b):
                break
            other, edits = more, edits + 1
        assert edits and n
        rows += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(other))]
        want.add((2 * k, 2 * k + 1))
    got = near_dups.near_components(make_docs(spark, rows), threshold=85, width=3).filter("not kept").collect()
    assert {(x["component_id"], x["doc_id"]) for x in got} == want


def test_overlaps():
    for percent in (80, 85):
        for size in range(1, near_dups.SKETCH + 1):
            m, c = near_dups.overlap(size, percent), near_dups.meetings(size, percent)
            assert 1 <= c <= m <= size
        assert near_dups.overlap(10, percent) == -(-percent * 10 // 100)  # small sets are whole
    r = np.random.default_rng(3)
    shared = r.binomial(near_dups.SKETCH, 0.8, 200_000)
    assert shared.min() >= near_dups.overlap(near_dups.SKETCH, 80)


def test_near_duplicates_of_odd_rows(spark, odd_docs, odd_rows, no_docs):
    got = near_dups.near_components(odd_docs).collect()
    assert len(got) == len(odd_rows)
    assert all(x["kept"] for x in got)
    assert near_dups.near_components(no_docs).collect() == []


def cut(rows, length):
    """Documents in order (doc_id, text); what also starts earlier goes."""
    seen, out = set(), []
    for d, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - length + 1):
            w = raw[p : p + length]
            if w in seen:
                gone[p : p + length] = True
            seen.add(w)
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((d, len(raw), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(raw, np.uint8)[~gone])).hexdigest()))
    return out


def digest(rows):
    return sorted((x["doc_id"], x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in rows)


def test_substrings(spark, monkeypatch):
    r = random.Random(6)
    passages = ["".join(r.choice("abcdé ") for _ in range(r.randrange(90, 400))) for _ in range(12)]
    rows = []
    for i in range(150):
        parts = ["".join(r.choice("abcdefgh ") for _ in range(r.randrange(200))) for _ in range(3)]
        parts.insert(1, r.choice(passages)[r.randrange(30) :])
        rows.append((i, "".join(parts)))
    rows += [(150, "a" * 1000), (151, "ab" * 300 + "a" * 150), (152, rows[3][1]), (153, "é" * 49), (154, "é" * 300), (155, ""), (156, None)]
    shuffled = rows[:]
    r.shuffle(shuffled)
    docs = make_docs(spark, shuffled).withColumns({"key": F.lit(1), "spans": F.lit(2)})
    assert digest(substring_dedup.digests(docs).collect()) == sorted(cut(rows, 100))
    # every anchor too large for one array: windows are dealt out, and arrays hold a few of them
    monkeypatch.setattr(substring_dedup, "SPLIT_BYTES", 0)
    monkeypatch.setattr(substring_dedup, "ARRAY_BYTES", 2_000)
    assert digest(substring_dedup.digests(docs).collect()) == sorted(cut(rows, 100))


def test_substrings_of_odd_rows(spark, odd_docs, odd_rows, no_docs):
    got = digest([x.asDict() | {"doc_id": -1 if x["doc_id"] is None else x["doc_id"]} for x in substring_dedup.digests(odd_docs).collect()])
    order = sorted(((-1 if d is None else d, t or "") for d, t in odd_rows))
    assert [x[:3] for x in got] == [x[:3] for x in sorted(cut(order, 100))]
    assert substring_dedup.digests(no_docs).collect() == []
    assert substring_dedup.without_repeats(no_docs).columns == ["doc_id", "n_bytes", "removed", "kept"]


@pytest.fixture(scope="module")
def leaks():
    r = random.Random(8)
    items = [(i, words(r, r.choice([2, 4, 5, 6, 12, 40, 90]), 10**6)) for i in range(40)] + [(40, None), (41, ""), (None, words(r, 20, 10**6)), (42, "")]
    items.append((43, items[5][1]))
    rows = []
    for d in range(200):
        text = words(r, r.choice([0, 3, 50, 500, 3000]), 10**6)
        for _ in range(r.choice([0, 0, 1, 2])):
            _, item = r.choice(items[:40])
            w = item.split(" ")
            if r.random() < 0.3:
                w = w[r.randrange(2) :]
            cutting = text.split(" ")
            at = r.randrange(len(cutting) + 1)
            text = " ".join([*cutting[:at], *w, *cutting[at:]])
        rows.append((d, text if r.random() < 0.5 else text.upper()))
    return rows, items


def test_leaks(spark, leaks, odd_docs, no_docs):
    rows, items = leaks
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = {(x["doc_id"], x["item_id"]): x for x in decontaminate.find_items(make_docs(spark, rows), bench).collect()}
    want = {}
    for d, t in rows:
        for i, item in items:
            k = min(5, len((item or "").split()))
            q = shingle_set(item, k) if k else frozenset()
            n = len(q & shingle_set(t, k)) if k and len((t or "").split()) >= k else 0
            if q and n >= 0.8 * len(q):
                want[d, i] = (len(q), n)
    assert {p: (x["n_item"], x["n_shared"]) for p, x in got.items()} == want and want
    clean = decontaminate.drop_leaks(make_docs(spark, rows), bench)
    assert {x["doc_id"] for x in clean.collect()} == {d for d, _ in rows} - {d for d, _ in want}
    assert decontaminate.drop_leaks(odd_docs, bench).count() == odd_docs.count()
    assert decontaminate.drop_leaks(odd_docs, bench).columns == odd_docs.columns
    assert decontaminate.find_items(no_docs, bench).collect() == [] and decontaminate.find_items(odd_docs, bench.limit(0)).collect() == []


def test_blocks_of_items(spark, leaks, monkeypatch):
    rows, items = leaks
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = make_docs(spark, rows[:60])
    one = sorted(map(repr, decontaminate.find_items(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 9)
    assert sorted(map(repr, decontaminate.find_items(docs, bench).collect())) == one


def test_pipeline(spark, odd_docs, odd_rows, no_docs, tmp_path):
    import corpus_pipeline

    r = random.Random(12)
    good = [(i, " ".join(words(r, 12, 5000) + "." for _ in range(r.randrange(5, 20))), f"s{i % 3}") for i in range(120)]
    bad = [(200 + i, " ".join(w.upper() + "!!" for w in words(r, 90, 30).split()), "s0") for i in range(40)]
    item = words(r, 30, 10**6)
    rows = [*good, *bad, (300, good[0][1], "s1"), (301, good[1][1] + " " + item, "s1")]
    make_docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(d, int(d < 200), 0) for d, _, _ in rows], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    sf = str(tmp_path)
    docs, by = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, f in corpus_pipeline.STAGES[:-1]:
        out = f(spark, docs, sf)
        assert out.columns == docs.columns, name
        by[name] = sorted(x["doc_id"] for x in out.collect())
        docs = out
    assert not {d for d in by["quality"] if 200 <= d < 300} and {d for d, _, _ in good} <= set(by["quality"])
    assert 300 not in by["near_duplicates"] and 0 in by["near_duplicates"]
    assert 301 not in by["decontamination"]
    got = corpus_pipeline.run(spark, sf).collect()
    count = defaultdict(int)
    for x in got:
        count[x["doc_id"]] += 1
    assert sorted(d for d, n in count.items() for _ in range(n)) == by["mixture"] and max(count.values()) <= 2
    ends = sorted((x["start"], x["n_tokens"]) for x in got)
    assert all(a + n == b for (a, n), (b, _) in zip(ends, ends[1:], strict=False))
    for name, f in corpus_pipeline.STAGES:
        assert f(spark, no_docs, sf).collect() == []
        out = f(spark, odd_docs, sf)
        rows = sorted((x.asDict()["doc_id"] if x["doc_id"] is not None else -1) for x in out.collect())
        every = sorted(-1 if d is None else d for d, _ in odd_rows)
        if name != "token_output":
            assert out.columns == odd_docs.columns
        if name in ("decontamination", "token_output"):  # no odd row has an item, and each is written
            assert rows == every
        elif name == "near_duplicates":  # rows that share an id are one node, which stands for its group
            assert rows == every
        else:  # a subset by score, or repeated at most twice
            assert set(rows) <= set(every) and all(rows.count(x) <= 2 * every.count(x) for x in rows)
    # the odd rows run through all stages, and the result is that of the stages one by one
    (tmp_path / "odd").mkdir()
    odd_docs.select(docs.columns).unionByName(make_docs(spark, rows_of := [(1000 + d, t, s) for d, t, s in good[:30]])).write.parquet(str(tmp_path / "odd" / "documents.parquet"))
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{t}.parquet").write.parquet(str(tmp_path / "odd" / f"{t}.parquet"))
    d = spark.read.parquet(str(tmp_path / "odd" / "documents.parquet"))
    for _, f in corpus_pipeline.STAGES:
        d = f(spark, d, str(tmp_path / "odd"))
    key = lambda x: (x["doc_id"] is not None, x["doc_id"] or 0, x["n_tokens"], x["ids_crc32"])
    assert sorted(map(key, d.collect())) == sorted(map(key, corpus_pipeline.run(spark, str(tmp_path / "odd")).collect())) and rows_of
