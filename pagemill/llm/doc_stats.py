"""Statistics of whole documents, by numpy over blocks: bytes by class, words, repeats, and extremes over runs of 32 words."""

from __future__ import annotations

import numpy as np

from pagemill.llm.textvec import U64, Block, Words, mix, runs, shingles, span_hash, word_hashes, words

LOWER, UPPER, DIGIT, STOP, BANG, SYMBOL, BAR, LINE, BLANK, INNER, LEAD, PUNCT = range(12)
_CLASS = np.full(256, PUNCT, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = LOWER, UPPER, DIGIT
_CLASS[[ord(c) for c in ".,;:"]] = STOP
_CLASS[ord("!")] = BANG
_CLASS[[ord(c) for c in "#*$%&<>"]] = SYMBOL
_CLASS[ord("|")] = BAR
_CLASS[10] = LINE
_CLASS[[9, 11, 12, 13, 32]] = BLANK
_CLASS[128:192], _CLASS[192:] = INNER, LEAD
CHUNK = 32


def keyed(h: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Hashes told apart by the document that they are in."""
    with np.errstate(over="ignore"):
        return mix(h + owner.astype(U64) * U64(0x9E3779B97F4A7C15))


def owner_of(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(first)), last - first)


def repeated(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each place whether its key occurs more than once; each distinct key's first place and count."""
    _, first, back, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    return (count > 1)[back], first, count


def repeat_words(h: np.ndarray, w: Words) -> np.ndarray:
    """Words in 3-word windows that a document has twice or more."""
    g, at, lo, hi = shingles(h, w, 3)
    n = w.last - w.first
    inside = np.repeat(n >= 3, hi - lo)
    twice, _, _ = repeated(keyed(g, owner_of(lo, hi)))
    at = at[twice & inside]
    covered = np.zeros(len(h) + 3, bool)
    for j in range(3):
        covered[at + j] = True
    total = np.concatenate(([0], np.cumsum(covered[: len(h)])))
    return total[w.last] - total[w.first]


def lines(b: Block, w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Of each document: lines with a word, and those of them that equal an earlier one."""
    start, end = runs(b.buf != 10, b.starts, b.ends)
    full = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    start, end = start[full], end[full]
    first, last = np.searchsorted(start, b.starts), np.searchsorted(start, b.ends)
    owner = owner_of(first, last)
    _, one, count = repeated(keyed(span_hash(b.buf, start, end), owner))
    return last - first, np.bincount(owner[one], count - 1, len(b.starts)).astype(np.int64)


NAMES = (
    "log_words word_length word_spread upper digits stops bangs symbols bars lines distinct top_word same_next repeats "
    "dup_lines line_words title short_words inner punct all_caps max_upper max_bangs max_symbols max_bars max_digits max_same min_distinct"
).split()


def features(b: Block) -> np.ndarray:
    """A row of ``NAMES`` for each document; ratios, so that length matters little. All 0 for a text without words."""
    w = words(b)
    n_docs, n = len(b.starts), w.last - w.first
    h = word_hashes(b, w, fold=True)
    owner = owner_of(w.first, w.last)
    # chunks of 32 words tile each document's bytes; a document has one at least
    per = np.maximum(1, -(-n // CHUNK))
    chunk_doc = np.repeat(np.arange(n_docs), per)
    head = np.cumsum(per) - per
    step = np.arange(per.sum()) - head[chunk_doc]
    word = w.first[chunk_doc] + step * CHUNK
    at = np.where(step == 0, b.starts[chunk_doc], w.start[np.minimum(word, max(0, len(h) - 1))] if len(h) else 0)
    size = np.diff(np.append(at, len(b.buf)))
    key = np.repeat(np.arange(len(at), dtype=np.int64) << 4, size)
    by_chunk = np.bincount(key + _CLASS[b.buf], minlength=len(at) << 4).reshape(-1, 16).astype(np.float64)
    total = np.add.reduceat(by_chunk, head)
    words_in = np.minimum(CHUNK, np.maximum(0, n[chunk_doc] - step * CHUNK)).astype(np.float64)

    length = (w.end - w.start).astype(np.float64)
    same = np.zeros(len(h))
    same[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    letters_up = np.concatenate(([0], np.cumsum(_CLASS[b.buf] == UPPER)))
    letters_low = np.concatenate(([0], np.cumsum(_CLASS[b.buf] == LOWER)))
    up, low = letters_up[w.end] - letters_up[w.start], letters_low[w.end] - letters_low[w.start]
    _, one, count = repeated(keyed(h, owner))
    distinct = np.bincount(owner[one], minlength=n_docs)
    top = np.zeros(n_docs, np.int64)
    np.maximum.at(top, owner[one], count)
    chunk_of = head[owner] + (np.arange(len(h)) - w.first[owner]) // CHUNK
    _, chunk_one, _ = repeated(keyed(h, chunk_of))
    chunk_distinct = np.bincount(chunk_of[chunk_one], minlength=len(at))
    n_lines, dup_lines = lines(b, w)

    N, size_of = np.maximum(n, 1), np.maximum(b.ends - b.starts, 1)
    mean = lambda x: np.bincount(owner, x, n_docs) / N
    average = mean(length)
    full = words_in >= 8
    most = lambda x: np.maximum.reduceat(np.where(full, x / np.maximum(words_in, 1), 0), head)
    letters = by_chunk[:, UPPER] + by_chunk[:, LOWER]
    upper_share = np.where(letters > 0, by_chunk[:, UPPER] / np.maximum(letters, 1), 0) * np.maximum(words_in, 1)
    out = np.column_stack([
        np.log1p(n), average, np.sqrt(np.maximum(0, mean(length**2) - average**2)),
        total[:, UPPER] / np.maximum(total[:, UPPER] + total[:, LOWER], 1), total[:, DIGIT] / size_of, total[:, STOP] / N,
        total[:, BANG] / N, total[:, SYMBOL] / N, total[:, BAR] / N, total[:, LINE] / N,
        distinct / N, top / N, mean(same), repeat_words(h, w) / N, dup_lines / np.maximum(n_lines, 1), N / np.maximum(n_lines, 1),
        mean((up == 1) & (low > 0)), mean(length <= 3), total[:, INNER] / size_of, total[:, PUNCT] / N, mean((up > 1) & (low == 0)),
        most(upper_share), most(by_chunk[:, BANG]), most(by_chunk[:, SYMBOL]), most(by_chunk[:, BAR]), most(by_chunk[:, DIGIT]),
        most(np.bincount(chunk_of, same, len(at))), np.minimum.reduceat(np.where(full, chunk_distinct / np.maximum(words_in, 1), 1), head),
    ])
    out[n == 0] = 0
    return out.astype(np.float32)
