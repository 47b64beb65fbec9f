from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagemill.llm import doc_stats as ds
from pagemill.llm import textvec as tv
from pagemill.llm.suffixes import suffix_array
from tests.llm.helpers import morse

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.text(alphabet="ab A\n\té|!", max_size=40) | st.none(), max_size=12)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 4), st.integers(5, 60))
def test_words_shingles_and_lines(texts, k, size):
    at = 0
    by_hash: dict = {}
    for b in tv.blocks(pa.array(texts, pa.string()), size):
        assert b.row == at
        w = tv.words(b)
        h = tv.word_hashes(b, w, fold=False)
        g, _, lo, hi = tv.shingles(h, w, k)
        rep, (n_lines, dup) = ds.repeat_words(h, w), ds.lines(b, w)
        for i in range(len(b.starts)):
            raw = (texts[at] or "").encode()
            at += 1
            mine = WORD.findall(raw)
            assert w.last[i] - w.first[i] == len(mine)
            grams = [tuple(mine[j : j + k]) for j in range(len(mine) - k + 1)] if len(mine) >= k else [tuple(mine)] if mine else []
            assert hi[i] - lo[i] == len(grams)
            for x, gram in zip(g[lo[i] : hi[i]].tolist(), grams, strict=True):
                assert by_hash.setdefault(x, gram) == gram
            three = [tuple(mine[j : j + 3]) for j in range(len(mine) - 2)]
            many = Counter(three)
            assert rep[i] == len({j + d for j, x in enumerate(three) if many[x] > 1 for d in range(3)})
            full = [x for x in raw.split(b"\n") if WORD.search(x)]
            assert (n_lines[i], dup[i]) == (len(full), len(full) - len(set(full)))
    assert at == len(texts)


@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array(text):
    assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("text", [[5] * 500, [1, 2] * 200, list(range(100)), list(range(100, 0, -1)), [2, 1, 2, 1, 1, 2] * 50])
def test_suffix_array_of_runs(text):
    assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_span_hashes():
    spans = [b"", b"a", b"\0", b"\0\0", b"abcdefgh", b"abcdefg\0", b"abcdefghi", *(morse(n, a, b).encode() for n in (16, 128, 256, 512, 4096) for a, b in ("ab", "ba"))]
    buf = np.frombuffer(b"x".join(spans), np.uint8)
    start = np.cumsum([0, *(len(x) + 1 for x in spans[:-1])])
    end = start + [len(x) for x in spans]
    got = tv.span_hash(buf, start, end).tolist()
    assert len(set(got)) == len(spans)
    for x, h in zip(spans, got, strict=True):  # the same wherever the span stands
        assert tv.span_hash(np.frombuffer(b"qq" + x + b"tail", np.uint8), np.array([2]), np.array([2 + len(x)]))[0] == h


def plain_features(text):
    """The statistics as they are told, by plain Python."""
    raw = text.encode()
    w = WORD.findall(raw)
    n = len(w)
    if not n:
        return [0.0] * len(ds.NAMES)
    fold = [x.lower() if x.isascii() else bytes(c + 32 if 65 <= c <= 90 else c for c in x) for x in w]
    count = lambda chars: lambda x: sum(c in chars for c in x)
    upper, lower, digit = count(range(65, 91)), count(range(97, 123)), count(range(48, 58))
    three = [tuple(fold[j : j + 3]) for j in range(n - 2)]
    many = Counter(three)
    lines_ = [x for x in raw.split(b"\n") if WORD.search(x)]
    known = set(b"\n\t\x0b\x0c\r .,;:!#*$%&<>|") | set(range(48, 58)) | set(range(65, 91)) | set(range(97, 123)) | set(range(128, 256))
    size = [len(x) for x in w]
    mean = sum(size) / n
    bounds = [m.start() for m in WORD.finditer(raw)]
    chunks = [(raw[0 if k == 0 else bounds[k] : bounds[k + 32] if k + 32 < n else len(raw)], fold[k : k + 32], k) for k in range(0, n, 32)]
    most = lambda f: max([f(*c) if len(c[1]) >= 8 else 0.0 for c in chunks])
    same = lambda k, m: sum(fold[j] == fold[j - 1] for j in range(max(k, 1), k + m))
    share = lambda f: lambda raw_, words_, k: f(raw_) / len(words_)
    return [
        np.log1p(n), mean, max(0, sum(x * x for x in size) / n - mean**2) ** 0.5,
        upper(raw) / max(1, upper(raw) + lower(raw)), digit(raw) / len(raw), count(b".,;:")(raw) / n,
        count(b"!")(raw) / n, count(b"#*$%&<>")(raw) / n, count(b"|")(raw) / n, raw.count(b"\n") / n,
        len(set(fold)) / n, max(Counter(fold).values()) / n, same(0, n) / n, len({j + d for j, x in enumerate(three) if many[x] > 1 for d in range(3)}) / n,
        (len(lines_) - len(set(lines_))) / len(lines_), n / len(lines_),
        sum(upper(x) == 1 and lower(x) > 0 for x in w) / n, sum(x <= 3 for x in size) / n, count(range(128, 192))(raw) / len(raw),
        sum(c not in known for c in raw) / n, sum(upper(x) > 1 and lower(x) == 0 for x in w) / n,
        most(lambda r, f, k: upper(r) / max(1, upper(r) + lower(r))), most(share(count(b"!"))), most(share(count(b"#*$%&<>"))), most(share(count(b"|"))), most(share(digit)),
        most(lambda r, f, k: same(k, len(f)) / len(f)), min([len(set(f)) / len(f) if len(f) >= 8 else 1.0 for _, f, _ in chunks]),
    ]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abAB  \n\té|!.#7(", max_size=400) | st.none(), max_size=6), st.integers(20, 900))
def test_features(texts, size):
    got = np.concatenate([ds.features(b) for b in tv.blocks(pa.array(texts, pa.string()), size)]) if texts else np.zeros((0, len(ds.NAMES)))
    for row, t in zip(got, texts, strict=True):
        want = plain_features(t or "")
        # three words are the least that a window has
        assert row.tolist() == pytest.approx(want, abs=1e-5), dict(zip(ds.NAMES, zip(row.tolist(), want, strict=True), strict=True))
