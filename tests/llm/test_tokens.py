from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tests.llm.helpers import make_docs, morse

from pagemill.llm import pretokens, token_counts, token_files
from pagemill.llm.common import scratch
from pagemill.llm.queries import tokenizer
from pagemill.llm.textvec import blocks


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer())


def test_pieces_equal_the_library(library):
    r = random.Random(5)
    letters = "abstmdrevl'  \n\t.,!0123é \xa0　ßÇ²½٣中😀​\x1c\x85|<>-_"
    texts = ["".join(r.choice(letters) for _ in range(r.randrange(40))) for _ in range(1500)]
    texts += ["it's we'll they've 'd'd's'", "''s", "x <|endoftext|> y", "", " ", "\n\n a", None]
    k = pretokens.Pieces(tokenizer(), limit=50)  # forgets all the time
    got = [x.tolist() for b in blocks(pa.array(texts), 4096) for x in k.encode(b)]
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


MORSE = [morse(n, a, b) for n in (8, 64, 1024, 8192) for a, b in ("ab", "ba", "et", "te", "xa", "ax")]


def test_repetitive_words_equal_the_library(library, monkeypatch):
    want = [library.encode(t, add_special_tokens=False).ids for t in MORSE]

    def check():
        k, c = pretokens.Pieces(tokenizer()), pretokens.PieceCounts(tokenizer(), limit=3)
        assert [x.tolist() for b in blocks(pa.array(MORSE)) for x in k.encode(b)] == want
        assert [x for b in blocks(pa.array(MORSE)) for x in c.counts(b).tolist()] == list(map(len, want))

    check()
    # were all spans over eight bytes to collide, their bytes would still tell them apart
    real = pretokens.span_hash
    monkeypatch.setattr(pretokens, "span_hash", lambda buf, s, e: np.where(e - s > 8, np.uint64(1), real(buf, s, e)))
    check()


def test_counts(spark, odd_docs, odd_rows, no_docs, library):
    got = sorted(((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts.over_limit(odd_docs, tokenizer()).collect()))
    want = sorted((d or -1, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 1024) for d, t in odd_rows)
    assert got == want
    assert token_counts.over_limit(no_docs, tokenizer()).collect() == []


def test_files(spark, odd_docs, odd_rows, no_docs, library):
    rows = sorted(token_files.encoded_documents(odd_docs, tokenizer()).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == sorted((d for d, _ in odd_rows), key=lambda d: (d is not None, d))
    start, want = 0, []
    for d, t in odd_rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((d or -1, len(ids), zlib.crc32(ids.tobytes())))
    for r in rows:
        assert r["start"] == start
        start += r["n_tokens"]
    assert sorted((r["doc_id"] or -1, r["n_tokens"], r["ids_crc32"]) for r in rows) == sorted(want)
    assert token_files.encoded_documents(no_docs, tokenizer()).collect() == []


def test_readers_fetch_single_documents_and_see_damage(spark, library):
    docs = make_docs(spark, [(i, f"text number {i} " * 200) for i in range(300)])
    manifest = token_files.write_tokens(docs, tokenizer(), scratch(spark, "t"), end_id=None).collect()
    assert sum(m["n_docs"] for m in manifest) == 300
    for m in manifest:
        f = token_files.Reader(m["path"])
        assert len(f.table) > 1
        for row in f.find(int(f.doc_ids[-1])):
            ((r, ids),) = f.documents([row])
            assert r == row and library.decode(ids.tolist()) == f"text number {f.doc_ids[-1]} " * 200
    path = manifest[0]["path"].removeprefix("file://")
    raw = bytearray(open(path, "rb").read())
    raw[len(raw) // 4] ^= 0xFF
    open(path, "wb").write(raw)
    with pytest.raises(Exception):  # noqa: B017 - zstandard or the checksum notices
        list(token_files.Reader(manifest[0]["path"]).documents())
