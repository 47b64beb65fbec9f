"""numpy passes over the UTF-8 bytes of Arrow text columns: words, spans and their 64-bit hashes.

A batch is cut into blocks of about ``BLOCK_BYTES``; a longer text is a block by itself, never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

BLOCK_BYTES = 1 << 20
U64 = np.uint64
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose bits depend on all bits of the argument."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


#: A-Z as a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Longest span that is hashed in step with the others; a longer one is hashed by itself.
LONG = 256
_STEP = U64(0x9E3779B97F4A7C15)
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)


@dataclass
class Block:
    """Rows ``row`` to ``row + len(starts)`` of a batch; ``buf`` has their bytes without gaps."""

    row: int
    buf: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[Block]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not pa.types.is_string(column.type) and not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    wide = np.int32 if pa.types.is_string(column.type) else np.int64
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return
    at = np.frombuffer(offsets, wide)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + size, "right")) - 1)
        yield Block(lo, data[at[lo] : at[hi]], at[lo:hi] - at[lo], at[lo + 1 : hi + 1] - at[lo])
        lo = hi


def windows(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as an integer; zeros follow the end."""
    return np.ndarray(len(buf) + 1, "<u8", np.concatenate((buf, np.zeros(8, np.uint8))), strides=(1,))


def span_hash(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64 bits for each span, of its bytes alone: its length, then eight bytes at a time, each mixed into all bits.

    Spans of one length of up to eight bytes never collide; others with a chance of 2 ** -64 a pair, whatever they repeat.
    """
    size = end - start
    with np.errstate(over="ignore"):
        out = mix(size.astype(U64) * _STEP)
        view, at, left, live = windows(buf), start, size, None
        for done in range(0, LONG, 8):
            if done:
                live = np.flatnonzero((size > done) & (size <= LONG)) if live is None else live[left > 8]
                if not live.size:
                    break
                at, left = start[live] + done, size[live] - done
            part = view[at] & _MASKS[np.clip(left, 0, 8)]
            if live is None:
                out = mix((out ^ part) + _STEP)
            else:
                out[live] = mix((out[live] ^ part) + _STEP)
    long = np.flatnonzero(size > LONG)
    if long.size:
        raw = memoryview(np.ascontiguousarray(buf))
        out[long] = [xxhash.xxh3_64_intdigest(raw[s:e]) for s, e in zip(start[long].tolist(), end[long].tolist(), strict=True)]
    return out


def gram_hash(buf: np.ndarray, gram: int) -> np.ndarray:
    """A cheap hash of the ``gram`` bytes at each place that has so many; to choose by, not to compare by."""
    view, n = windows(buf), len(buf) - gram + 1
    out = np.zeros(n, U64)
    with np.errstate(over="ignore"):
        for k, weight in zip(range(0, gram, 8), _weights(-(-gram // 8)), strict=True):
            out += (view[k : k + n] & _MASKS[min(8, gram - k)]) * weight
        return mix(out)


def runs(inside: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, which end where a document does."""
    full = starts < ends
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    first[starts[full]] = inside[starts[full]]
    last[ends[full] - 1] = inside[ends[full] - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


@dataclass
class Words:
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # of each document, its first word's index
    last: np.ndarray  # and the index after its last


def words(b: Block) -> Words:
    start, end = runs(~WHITE[b.buf], b.starts, b.ends)
    return Words(start, end, np.searchsorted(start, b.starts), np.searchsorted(start, b.ends))


def word_hashes(b: Block, w: Words, fold: bool) -> np.ndarray:
    return span_hash(LOWER[b.buf] if fold else b.buf, w.start, w.end)


def _weights(k: int) -> np.ndarray:
    return mix(np.arange(1, k + 1, dtype=U64) * U64(0xC2B2AE3D27D4EB4F)) | U64(1)


def shingles(h: np.ndarray, w: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles, the word index where each starts, and each document's range in both.

    A document of 1 to k - 1 words has one shingle, of them all; one without words has none.
    """
    n, c = w.last - w.first, _weights(k)
    g = np.zeros(len(h), U64)
    valid = np.ones(len(h), bool)
    with np.errstate(over="ignore"):
        if len(h) >= k:
            m = len(h) - k + 1
            for j in range(k):
                g[:m] += h[j : m + j] * c[j]
        for j in range(1, k):
            valid[w.last[n >= j] - j] = False
        short = np.flatnonzero((n > 0) & (n < k))
        if short.size:
            f = w.first[short]
            valid[f] = True
            g[f] = n[short].astype(U64) * U64(0x165667B19E3779F9)
            for j in range(k - 1):
                more = n[short] > j
                g[f[more]] += h[f[more] + j] * c[j]
    at = np.flatnonzero(valid)
    return mix(g[at]), at, np.searchsorted(at, w.first), np.searchsorted(at, w.last)


def per_document(ids: pa.Array) -> list:
    return ids.to_pylist()
