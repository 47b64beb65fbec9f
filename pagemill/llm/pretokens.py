"""Byte-level BPE by distinct pre-token: numpy finds the pre-tokens, the tokenizers library encodes each distinct one once.

The pre-tokens are those of the byte-level pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``;
they tile a text, so each is told by where it starts. Merges never cross them, hence ids of a text are the ids
of its pre-tokens in order.
"""

from __future__ import annotations

import json
import os

import numpy as np
import regex

from pagemill.llm.textvec import Block, span_hash, windows

LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3
_lut: list[np.ndarray] = []


def _classes_of_code_points() -> np.ndarray:
    if not _lut:
        points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
        text = "".join(map(chr, points))
        lut = np.full(0x110000, OTHER, np.uint8)
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"[\x09-\x0D\x20\x85\xA0  -     　]+")):
            for m in regex.finditer(pattern, text):
                lut[points[m.start()] : points[m.end() - 1] + 1] = kind
        lut[0xD800:0xE000] = OTHER
        _lut.append(lut)
    return _lut[0]


def classes(buf: np.ndarray) -> np.ndarray:
    """The class of the character that each byte belongs to."""
    lut = _classes_of_code_points()
    out = lut[:256][buf]
    lead = np.flatnonzero(buf >= 0xC0)
    if lead.size:
        first = buf[lead].astype(np.int32)
        more = [(buf[np.minimum(lead + j, len(buf) - 1)] & 0x3F).astype(np.int32) for j in (1, 2, 3)]
        two = (first & 0x1F) << 6 | more[0]
        three = (first & 0x0F) << 12 | more[0] << 6 | more[1]
        four = (first & 0x07) << 18 | more[0] << 12 | more[1] << 6 | more[2]
        kind = lut[np.minimum(np.where(first < 0xE0, two, np.where(first < 0xF0, three, four)), 0x10FFFF)]
        out[lead] = out[lead + 1] = kind
        for j, least in ((2, 0xE0), (3, 0xF0)):
            long = first >= least
            out[lead[long] + j] = kind[long]
    return out


def starts(b: Block) -> np.ndarray:
    """Where pre-tokens start; each ends where the next one or the block does."""
    buf, n = b.buf, len(b.buf)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes(buf)
    change = np.empty(n, bool)
    change[0] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    head = np.zeros(n + 1, bool)
    head[b.starts] = True
    head[n] = True
    change |= head[:n]
    at = np.flatnonzero(change)
    end = np.append(at[1:], n)
    of = kind[at]
    mark = change
    # white space before something: its last character stands alone, or goes to what follows if it is a space
    white = np.flatnonzero((of == SPACE) & ~head[end])
    last = end[white] - 1
    for _ in range(3):
        last -= (buf[last] & 0xC0) == 0x80
    mark[last] = True
    plain = buf[last] == 32
    mark[end[white][plain]] = False
    # 's 't 'm 'd 're 've 'll where a lone apostrophe, not taken by a space, meets letters
    quote = np.flatnonzero((of == OTHER) & (end - at == 1) & (buf[at] == 39) & ~head[end] & mark[at])
    quote = quote[of[np.minimum(quote + 1, len(of) - 1)] == LETTER]
    if quote.size:
        here, size = at[quote], end[quote + 1] - at[quote + 1]
        one, two = buf[here + 1], buf[np.minimum(here + 2, n - 1)]
        single = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        double = (size > 1) & (((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108))
        take = np.where(single, 1, np.where(double, 2, 0))
        cut, take, size = here[take > 0], take[take > 0], size[take > 0]
        mark[cut + 1] = False
        rest = take < size
        mark[cut[rest] + 1 + take[rest]] = True
    return np.flatnonzero(mark)


def distinct(b: Block, at: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The block's distinct pre-tokens, and which of them each one is.

    They are grouped by 64-bit hashes, and every member is then held against its group's first, byte by byte: a group
    of unequal ones, should it ever occur, is told apart by its bytes.
    """
    end = np.append(at[1:], len(b.buf))
    _, first, back = np.unique(span_hash(b.buf, at, end), return_index=True, return_inverse=True)
    raw = b.buf.tobytes()
    keys = [raw[s:e] for s, e in zip(at[first].tolist(), end[first].tolist(), strict=True)]
    odd = unequal(b.buf, at, end, first[back])
    if odd.size:
        seen = {x: i for i, x in enumerate(keys)}
        for i in odd.tolist():
            back[i] = seen.setdefault(raw[at[i] : end[i]], len(seen))
        keys = list(seen)
    return keys, back


def unequal(buf: np.ndarray, start: np.ndarray, end: np.ndarray, like: np.ndarray) -> np.ndarray:
    """Which spans differ in bytes from the span whose index ``like`` gives."""
    size = end - start
    differs = size != size[like]
    # spans of one length of up to eight bytes have unequal hashes unless they are equal
    live = np.flatnonzero((size > 8) & (like != np.arange(len(like))) & ~differs)
    view, done = windows(buf), 0
    while live.size:
        # the last eight bytes again where fewer are left
        back = np.minimum(done, size[live] - 8)
        differs[live] |= view[start[live] + back] != view[start[like[live]] + back]
        done += 8
        live = live[(size[live] > done) & ~differs[live]]
    return np.flatnonzero(differs)


class Bpe:
    """A byte-level BPE from a file of the tokenizers library, applied to single pre-tokens or to whole texts."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"] or {}
        if spec["normalizer"] is not None or pre.get("type") != "ByteLevel" or not pre.get("use_regex") or pre.get("add_prefix_space"):
            raise ValueError("a byte-level BPE without normalizer and prefix space is needed")
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.special = [t["content"].encode() for t in spec["added_tokens"]]
        self.plain = Tokenizer.from_file(path)
        self.plain.no_truncation()
        self.plain.no_padding()
        self.plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.id_type = np.uint16 if self.whole.get_vocab_size() <= 1 << 16 else np.uint32

    def encode(self, keys: list[bytes]) -> tuple[np.ndarray, list[int]]:
        """How many pieces each pre-token has, and all their ids."""
        got = self.plain.encode([k.decode() for k in keys], is_pretokenized=True, add_special_tokens=False)
        return np.bincount(np.array(got.word_ids, np.int64), minlength=len(keys)), got.ids

    def special_rows(self, b: Block) -> list[int]:
        """Documents with a special token inside: they go whole to the library, which decides."""
        raw = b.buf.tobytes()
        if not any(x in raw for x in self.special):
            return []
        return [i for i, (s, e) in enumerate(zip(b.starts.tolist(), b.ends.tolist(), strict=True)) if any(x in raw[s:e] for x in self.special)]

    def by_library(self, b: Block, row: int) -> list[int]:
        return self.whole.encode(b.buf[b.starts[row] : b.ends[row]].tobytes().decode(), add_special_tokens=False).ids


ROUND = 20_000


class PieceCounts:
    """How many pieces a pre-token has, counted once for each distinct one; no ids are kept.

    At most ``limit`` pre-tokens are held; beyond, all are forgotten and counted anew as they come, which costs time but
    changes no result.
    """

    def __init__(self, path: str, limit: int = 1_000_000):
        self.bpe, self.limit = Bpe(path), limit
        self.known: dict[bytes, int] = {}

    def of(self, keys: list[bytes]) -> np.ndarray:
        if len(self.known) + len(keys) > max(self.limit, len(keys)):
            self.known = {}
        new = [k for k in keys if k not in self.known]
        for lo in range(0, len(new), ROUND):
            part = new[lo : lo + ROUND]
            self.known.update(zip(part, self.bpe.encode(part)[0].tolist(), strict=True))
        return np.fromiter(map(self.known.__getitem__, keys), np.int64, len(keys))

    def counts(self, b: Block) -> np.ndarray:
        """Tokens of each document: its pre-token frequencies, joined to the pieces of each pre-token, summed."""
        at = starts(b)
        if not len(at):
            return np.zeros(len(b.starts), np.int64)
        keys, which = distinct(b, at)
        doc = np.searchsorted(b.starts, at, "right") - 1
        # the frequency table: one row for each (document, pre-token), with how often it occurs there
        pair, often = np.unique(doc * len(keys) + which, return_counts=True)
        out = np.bincount(pair // len(keys), often * self.of(keys)[pair % len(keys)], len(b.starts)).astype(np.int64)
        for i in self.bpe.special_rows(b):
            out[i] = len(self.bpe.by_library(b, i))
        return out


class Pieces:
    """Ids of distinct pre-tokens, encoded once each while a worker lives, under a bound like that of ``PieceCounts``."""

    def __init__(self, path: str, limit: int = 1_000_000):
        self.bpe, self.limit = Bpe(path), limit
        self.id_type = self.bpe.id_type
        self.forget()

    def forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.at = np.zeros(1 << 16, np.int64)
        self.size = np.zeros(1 << 16, np.int32)
        self.ids = np.zeros(1 << 18, self.id_type)
        self.used = 0

    def learn(self, keys: list[bytes]) -> None:
        for lo in range(0, len(keys), ROUND):
            part = keys[lo : lo + ROUND]
            size, ids = self.bpe.encode(part)
            k = len(self.index)
            while k + len(part) > len(self.at):
                self.at, self.size = np.resize(self.at, 2 * len(self.at)), np.resize(self.size, 2 * len(self.size))
            while self.used + len(ids) > len(self.ids):
                self.ids = np.resize(self.ids, 2 * len(self.ids))
            self.at[k : k + len(part)] = self.used + np.cumsum(size) - size
            self.size[k : k + len(part)] = size
            self.ids[self.used : self.used + len(ids)] = ids
            self.used += len(ids)
            self.index.update(zip(part, range(k, k + len(part)), strict=True))

    def find(self, b: Block, at: np.ndarray) -> np.ndarray:
        """The number under which each pre-token's ids are held."""
        keys, which = distinct(b, at)
        if len(self.index) + len(keys) > max(self.limit, len(keys)):
            self.forget()
        self.learn([k for k in keys if k not in self.index])
        return np.fromiter(map(self.index.__getitem__, keys), np.int64, len(keys))[which]

    def encode(self, b: Block) -> list[np.ndarray]:
        """Ids of each document."""
        at = starts(b)
        if not len(at):
            return [np.zeros(0, self.id_type) for _ in b.starts]
        found = self.find(b, at)
        size = self.size[found].astype(np.int64)
        sums = np.concatenate(([0], np.cumsum(size)))
        flat = self.ids[np.repeat(self.at[found] - sums[:-1], size) + np.arange(sums[-1])]
        lo, hi = sums[np.searchsorted(at, b.starts)].tolist(), sums[np.searchsorted(at, b.ends)].tolist()
        out = [flat[s:e] for s, e in zip(lo, hi, strict=True)]
        for i in self.bpe.special_rows(b):
            out[i] = np.array(self.bpe.by_library(b, i), self.id_type)
        return out


_held: dict[tuple[type, str], Pieces | PieceCounts] = {}


def held(kind: type, path: str) -> Pieces | PieceCounts:
    """This worker's ``Pieces`` or ``PieceCounts``."""
    if (kind, path) not in _held:
        _held[kind, path] = kind(path)
    return _held[kind, path]
