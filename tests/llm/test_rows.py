"""Operators that judge each document for itself: mixing, quality, rules, personal data, chats."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.llm import boosting, chat, mixing, ngram_ratio, personal_data, quality_model
from tests.llm.helpers import make_docs, morse, words


def fill(sizes, weights, budget, cap):
    """Water-filling as it is said: clamp whoever is above, share the rest anew."""
    target, clamped = {}, {}
    while True:
        free = [s for s in sizes if s not in clamped]
        left = budget - sum(clamped.values())
        target = clamped | {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = [s for s in free if target[s] > cap * sizes[s] + 1e-9]
        if not over:
            return target
        clamped |= {s: cap * sizes[s] for s in over}


def test_mix(spark):
    r = random.Random(3)
    rows = [(i, words(r, r.randrange(1, 80)), r.choice(["a"] * 12 + ["b", "c", "d", None])) for i in range(1500)]
    docs = make_docs(spark, rows)
    got = mixing.mixed_words(docs).collect()
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(t.split())
    order = sorted(sizes, key=lambda s: (s is None, s))
    want = fill(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, 1.5 * sum(sizes.values()), 2)
    taken = defaultdict(int)
    of = {d: s for d, _, s in rows}
    assert len(got) == len(rows)
    for x in got:
        assert x["source_size"] == sizes[of[x["doc_id"]]] and x["target"] == pytest.approx(want[of[x["doc_id"]]]) and x["taken"] <= 2 * x["size"]
        taken[of[x["doc_id"]]] += x["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 3
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mixed_words(docs).collect()))
    repeats = {x["doc_id"]: x["repeats"] for x in got}
    mixed = mixing.mix_sources(docs)
    assert mixed.columns == docs.columns
    assert {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {d: n for d, n in repeats.items() if n}


def test_mix_of_odd_rows(spark, odd_docs, odd_rows, no_docs):
    got = mixing.mixed_words(odd_docs).collect()
    assert len(got) == len(odd_rows) and all(x["taken"] <= 2 * x["size"] for x in got)
    assert mixing.mix_sources(odd_docs).columns == odd_docs.columns
    assert mixing.mixed_words(no_docs).collect() == [] and mixing.mix_sources(no_docs).collect() == []


def test_mix_keeps_columns_of_any_name(spark):
    r = random.Random(4)
    names = ("at", "source_key", "key", "whole", "cut", "fill", "n", "k", "_mix_at", "_mix_src")
    docs = make_docs(spark, [(i, words(r, 9), "ab"[i % 2]) for i in range(40)]).withColumns({c: F.lit(f"mine {c}") for c in names})
    mixed = mixing.mix_sources(docs)
    assert mixed.columns == docs.columns
    assert {tuple(x[c] for c in names) for x in mixed.collect()} == {tuple(f"mine {c}" for c in names)}


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 1, "c": 1}, {"a": 5, "b": 50, "c": 500, "d": 5000, None: 3}, {"a": 0, "b": 7}, {f"s{i:03}": 2 ** (i % 12) for i in range(200)}])
def test_water_levels(spark, sizes):
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    want = fill(sizes, weights, 1.5 * sum(sizes.values()), 2)
    rows = spark.createDataFrame([(s, repr(s), n) for s, n in sizes.items()], "_source string, _key string, source_size long")
    got = {x["_source"]: x["target"] for x in mixing.water_fill(rows, 1.5, 2.0, (3, 1, 2)).collect()}
    assert got == pytest.approx(want)


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from pagemill.llm import common

    session = lambda folder: SimpleNamespace(sparkContext=SimpleNamespace(master="spark://somewhere:7077"), conf=SimpleNamespace(get=lambda *_: folder))
    assert common.shared_dir(session("hdfs://x/y/")) == "hdfs://x/y"
    with pytest.raises(RuntimeError):
        common.shared_dir(session(None))


def test_boosting():
    r = np.random.default_rng(1)
    x = r.normal(size=(3000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    m = boosting.fit(x[:2000], y[:2000])
    assert ((m.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95
    for t in range(3):  # the flattened walk is the walk node by node
        for row in x[:50]:
            k = 0
            while k < len(m.feature[t]):
                k = 2 * k + 1 + int(row[m.feature[t][k]] > m.cut[t][k])
            one = boosting.Trees(0.0, m.feature[t : t + 1], m.cut[t : t + 1], m.leaf[t : t + 1])
            assert one.score(row[None])[0] == pytest.approx(1 / (1 + np.exp(-m.leaf[t][k - len(m.feature[t])])))
    assert boosting.fit(x[:0], y[:0]).score(x[:2]).tolist() == [0.5, 0.5]
    assert boosting.fit(x[:5], np.ones(5)).score(x[:2]).min() > 0.9


@pytest.fixture(scope="module")
def labelled(spark):
    r = random.Random(9)
    good = [(i, " ".join(words(r, 12, 5000) + "." for _ in range(r.randrange(5, 20)))) for i in range(300)]
    bad = [(300 + i, " ".join(w.upper() + "!!" for w in words(r, r.randrange(60, 200), 30).split())) for i in range(100)]
    labels = spark.createDataFrame([(d, 1, 0) for d, _ in good] + [(d, 0, 0) for d, _ in bad] + [(1, None, 1)], "doc_id long, quality int, toxic int")
    return make_docs(spark, good + bad), labels


def test_quality(spark, labelled, odd_docs, odd_rows, no_docs):
    docs, labels = labelled
    rows = quality_model.scored_documents(docs, labels).collect()
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    out = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == (r["doc_id"] < 300) for r in out) / len(out) > 0.97
    model = quality_model.train(docs, labels)
    kept = quality_model.reject_low(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in rows if r["predicted"]}
    odd = quality_model.score(odd_docs, model).collect()
    assert len(odd) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in odd) and not any(r["held_out"] for r in odd if r["doc_id"] is None)
    assert quality_model.reject_low(odd_docs, model).columns == odd_docs.columns
    assert quality_model.scored_documents(no_docs, labels).collect() == []
    assert {r["score"] for r in quality_model.scored_documents(odd_docs, labels.limit(0)).collect()} == {0.5}


def test_rules(spark, labelled, odd_docs, odd_rows, no_docs):
    docs, labels = labelled
    rows = {r["doc_id"]: r for r in ngram_ratio.judged(docs, labels).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for d, t in list(texts.items())[::20]:
        w = t.split()
        r = rows[d]
        assert (r["n_words"], r["word_chars"], r["n_symbols"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)))
        assert r["base_failed"] == (len(w) < 50 or 100 * r["n_repeat_words"] > 50 * len(w)) and (not r["kept"] or not r["base_failed"])
    assert all(rows[d]["kept"] or rows[d]["base_failed"] for d in range(300))
    assert not any(rows[d]["kept"] for d in range(300, 400))
    odd = ngram_ratio.judged(odd_docs, labels).collect()
    assert len(odd) == len(odd_rows) and all(r["base_failed"] and r["ratio"] == 0 for r in odd if r["n_words"] == 0)
    assert {r["ratio"] for r in ngram_ratio.judged(odd_docs, labels.limit(0)).collect()} == {0.0}
    assert ngram_ratio.judged(no_docs, labels).collect() == []


@pytest.mark.parametrize("ids", [[], [0], list(range(-40, 4000, 7)), list(range(0, 200_000, 2))])
def test_trusted_marks_are_exact(spark, ids, monkeypatch):
    """Also where the ids fill the map of bits, so that most other documents have to be asked, too."""
    monkeypatch.setattr(ngram_ratio, "FILTER_BITS", 1 << 15)
    asked = [*range(-50, 5000), None, None, 3, 3, 199_998, 2**62]
    docs = make_docs(spark, [(d, None if d == 5 else f"{d}") for d in asked])
    trusted = spark.createDataFrame([(d,) for d in ids * 2 if d < 10_000] + [(d,) for d in ids if d >= 10_000], "doc_id int")
    got = Counter((x["text"], x["_trusted"]) for x in ngram_ratio._marked(docs, trusted).collect())
    assert got == Counter(("" if d == 5 else f"{d}", d in set(ids)) for d in asked)


def test_ratios_by_brute_force(spark, monkeypatch):
    """With far more buckets than n-grams they do not collide, and the ratio is the formula over a dictionary."""
    monkeypatch.setattr(ngram_ratio, "LOAD", 1 / 1024)
    r = random.Random(13)
    rows = [(i, words(r, r.randrange(0, 90), 60).title()) for i in range(80)] + [(80, None), (81, "One"), (82, "same\nline\n\nsame\n" + f"{morse(1024, 'a', 'b')}\n{morse(1024, 'b', 'a')}")]
    labels = spark.createDataFrame([(d, int(d % 3 == 0), int(d % 6 == 0)) for d in range(80)], "doc_id long, quality int, toxic int")
    got = {x["doc_id"]: x for x in ngram_ratio.judged(make_docs(spark, rows), labels).collect()}
    grams, raw, good = {}, Counter(), Counter()
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        # a text of one word has that word as its only pair
        grams[d] = [(x,) for x in w] + ([("pair", *w)] if len(w) == 1 else [("pair", *x) for x in zip(w, w[1:], strict=False)])
        raw.update(grams[d])
        if d < 80 and d % 3 == 0 and d % 6:
            good.update(grams[d])
    share = sum(good.values()) / sum(raw.values())
    weight = {g: math.log((good[g] + ngram_ratio.PRIOR * share) / (share * (n + ngram_ratio.PRIOR))) for g, n in raw.items()}
    for d, _ in rows:
        want = sum(weight[g] for g in grams[d]) / len(grams[d]) if grams[d] else 0.0
        assert got[d]["ratio"] == pytest.approx(want, abs=4e-3)
        assert got[d]["kept"] == (not got[d]["base_failed"] and got[d]["ratio"] >= ngram_ratio.THRESHOLD)
    assert got[82]["n_dup_lines"] == 1


@pytest.mark.parametrize("n", [200, 4000])
def test_rules_separate_at_two_sizes(spark, n):
    """Junk of words that trusted text does not have stays out, and text like it in, however many distinct n-grams there are."""
    r = random.Random(n)
    good = [(i, words(r, 120, 20 * n)) for i in range(n)]
    bad = [(n + i, " ".join(f"x{r.randrange(8 * n // 10)}" for _ in range(120))) for i in range(n // 10)]
    labels = spark.createDataFrame([(d, 1, 0) for d, _ in good if d % 2] + [(d, 0, 0) for d, _ in bad], "doc_id long, quality int, toxic int")
    docs = make_docs(spark, good + bad)
    rows = ngram_ratio.judged(docs, labels).collect()
    assert sum(x["kept"] for x in rows if x["doc_id"] < n) > 0.97 * n
    assert not any(x["kept"] for x in rows if x["doc_id"] >= n)


def test_rules_without_an_array(spark, labelled, odd_docs):
    docs, labels = labelled
    for d in (docs, odd_docs.select(docs.columns)):
        a, b = (sorted(ngram_ratio.judged(d, labels, dense=k).collect(), key=repr) for k in (ngram_ratio.DENSE, 0))
        assert [[*x][:6] + [x["kept"]] for x in a] == [[*x][:6] + [x["kept"]] for x in b]
        assert [x["ratio"] for x in a] == pytest.approx([x["ratio"] for x in b], abs=1e-5)


KINDS = ("email", "ip", "card", "phone")
RULES = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base(text):
    out = []
    for k, p in enumerate(RULES):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            if (k == 0) or (k == 1 and all(int(x) <= 255 for x in m[0].split("."))) or (k == 2 and 12 <= len(d) <= 19 and luhn(d)) or (k == 3 and 9 <= len(d) <= 15):
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_personal_data(spark, odd_docs, odd_rows, no_docs):
    r = random.Random(2)
    alphabet = list("ab.@-+ 0123456789()_é😀%") + ["4111111111111111", "+1 (555) 123-4567", "1.2.3.4", "a@b.c"]
    rows = [(i, "".join(r.choice(alphabet) for _ in range(r.randrange(60)))) for i in range(600)]
    rows += [(1000, "a@b.c_d@e.f and x@y 1.2.3.4.5.6.7.8 300.1.1.1 0255.0.0.001"), (1001, "4111 1111-1111 1111 1 + +12 4111111111111112"), (1002, "9" * 30_000), (1003, "a" * 30_000 + "@"), (1004, "1 " * 15_000)]
    rows += [(2000 + i, f'words before token = "{hashlib.sha1(str(i).encode()).hexdigest()}" and version 1234567{i} after page 2024-01-0{i % 9}') for i in range(60)]
    got = {x["doc_id"]: x for x in personal_data.reported(make_docs(spark, rows)).collect()}
    for d, t in rows:
        want, x = base(t), got[d]
        assert x["base_sha256"] == hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in want).encode()).hexdigest(), t[:80]
        assert [x[f"n_{k}"] for k in KINDS] == [sum(1 for _, j, _ in want if j == i) for i in range(4)]
        listed = [tuple(y.split(":")) for y in x["spans"].split(",") if y]
        assert [(int(s), KINDS.index(k), int(e)) for k, s, e in listed if k != "secret"] == want
    for i in range(60):
        s = rows[-60 + i][1].index('"') + 1
        assert f"secret:{s}:{s + 40}" in got[2000 + i]["spans"] and "secret" not in got[2000 + i]["spans"].replace(f"secret:{s}:{s + 40}", "")
    assert len(personal_data.reported(odd_docs).collect()) == len(odd_rows)
    assert personal_data.reported(no_docs).collect() == []


def test_further_kinds(spark):
    """Planted persons, addresses and secrets are found; look-alikes are left alone."""
    r = random.Random(7)
    people = ["Dr. Maria Keller", "Mrs Jane Whitmore", "Herr Klaus Baumann", "Sarah O. Lindqvist", "Pierre Dubois-Martin", "Señora Carmen Ortega"]
    places = ["221 Baker Street", "14 Old Mill Road", "Gartenstraße 12", "12, rue de la Paix", "Calle de Alcalá, 45"]
    rows, want = [], defaultdict(set)
    for i in range(120):
        kind, found = r.choice([("person", people), ("address", places), ("secret", [hashlib.sha1(str(i).encode()).hexdigest()])])
        x = r.choice(found)
        before = words(r, 5) + {"person": " signed by ", "address": " lives at ", "secret": ' api_key="'}[kind]
        rows.append((i, f"{before}{x}{chr(34) if kind == 'secret' else ''} {words(r, 5)}"))
        want[i].add((kind, len(before), len(before) + len(x)))
    clean = ["Version 20240131 of chapter 12345678.", "The Street was long and 15 People came.", "Drive 55 is Way off.", "Dr no was seen at 1234-5678-90", "paul walked; may came in june 2024-06-01", ""]
    rows += [(200 + i, t) for i, t in enumerate(clean)]
    got = {x["doc_id"]: x for x in personal_data.reported(make_docs(spark, rows)).collect()}
    spans = {d: {(k, int(s), int(e)) for k, s, e in (y.split(":") for y in x["spans"].split(",") if y)} for d, x in got.items()}
    hit = sum(want[d] <= spans[d] for d in want)
    assert hit >= 0.95 * len(want), (hit, len(want))
    assert all(not spans[200 + i] and got[200 + i]["n_spans"] == 0 for i in range(len(clean)))
    assert all(x["n_spans"] == len(spans[d]) and x["n_secret"] == sum(k == "secret" for k, *_ in spans[d]) for d, x in got.items())


def test_expectation_maximisation():
    counts = {(1, 0, 1, 0, 1, 1): 50, (0, -1, 0, -1, -1, -1): 200, (0, 0, 0, 0, 0, 0): 5}
    post = personal_data.expectation_maximisation(counts)
    assert post[1, 0, 1, 0, 1, 1] > 0.95 and post[0, -1, 0, -1, -1, -1] < 0.05


def test_chats(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string, n int"
    rows = [
        (1, 0, "user", "hi <|im_end|> \\ \\<|x", "f", 1), (1, 2, "assistant", "b\n", "f", 1), (1, 1, "assistant", "a", "f", 1), (1, 3, "assistant", None, "f", 1), (1, 4, "user", "<", "f", 1), (1, 5, "assistant", "|im_end|>", "f", 1),
        (2, None, None, None, "f", 1), (2, 7, "us<|er", "é😀" * 2000, "f", 1), (3, 1, "user", "t", "f", 1), (3, 1, "user", "s", "f", 1), (3, 1, "user", "s", "f", 1), (None, 0, "assistant", "x", "f", 1),
    ]
    c = spark.createDataFrame(rows, schema)
    got = {r["conv_id"]: r for r in chat.digests(chat.with_probe(spark, c)).collect()}
    by = defaultdict(list)
    for conv, turn, role, text, *_ in [*rows, (-1, 0, "user", chat.PROBE), (-1, 1, "assistant", chat.PROBE)]:
        by[conv].append((turn if turn is not None else -1, role or "", text or ""))
    assert set(got) == set(by)
    for conv, turns in by.items():
        turns.sort()
        learnt = "".join(t for _, r, t in turns if r == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(turns) and r["loss_chars"] == len(learnt)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{x}\n{t}\n" for _, x, t in turns).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(learnt.encode()).hexdigest()
    f = chat.format_chats(c.filter("conv_id = 1")).first()
    assert f["formatted"].count("<|im_start|>") == 4 and f["formatted"].count("<|im_next|>") == 2
    assert chat.digests(c.limit(0)).collect() == []
    assert chat.format_chats(c).select(F.size("loss")).count() == 4
