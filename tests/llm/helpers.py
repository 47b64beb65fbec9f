from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def make_docs(spark, rows, schema=DOCS):
    """rows of (doc_id, text) or (doc_id, text, source)."""
    return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows], schema)


def words(rnd, n, vocabulary=400):
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


def morse(n, a, b):
    """A Thue-Morse word of n letters (a power of two): polynomial hashes modulo 2 ** 64 take it for its complement."""
    w = a
    while len(w) < n:
        w += w.translate({ord(a): b, ord(b): a})
    return w
