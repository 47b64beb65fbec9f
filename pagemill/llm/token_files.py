"""Token ids in files of independent zstandard frames, with a trailing document index and seek table.

A file is, in order:

* data frames, each an independent zstandard frame of the little-endian ids of some whole documents;
* a skippable frame (magic 0x184D2A50) with the documents: one zstandard frame of int64 doc_ids, uint8 null flags,
  uint32 frame numbers and uint32 id counts, column after column, preceded by "PMTI", the bytes per id and the count;
* a skippable frame (magic 0x184D2A5E), the seek table of the public seekable format: for each frame before it, the
  document index included, compressed size, decompressed size and the low 32 bits of XXH64 of the decompressed
  bytes; then the number of frames, a descriptor and the magic 0x8F92EAB1.

A reader takes the last 9 bytes, the seek table, the index, and then only the frames of the documents it wants.

Defined results: a null text has no ids but the end id; null doc_ids come first; rows that share a doc_id stand side
by side in the order of their texts; an empty table gives no files; other columns are ignored.

Scale: one range shuffle of doc_id and text puts documents in order; each task writes one file through
``pyarrow.fs`` (any file system with a URI, under a fresh name and renamed when whole, so a repeated task does no
harm) and returns one manifest row. Offsets across files are sums over manifest rows, one per task.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.common import scratch, stage, text_of
from pagemill.llm.pretokens import Pieces, held
from pagemill.llm.textvec import blocks

INDEX_MAGIC, SEEK_MAGIC, SEEK_END = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80
FRAME_IDS = 1 << 17
MANIFEST = "path string, part int, n_docs long, n_ids long"


def _opened(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class Writer:
    """Appends documents in the order given; ``close`` writes index and seek table and shows the file under its name."""

    def __init__(self, uri: str, id_type: np.dtype, level: int = 3):
        self.fs, self.path = _opened(uri)
        self.hidden = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.out = self.fs.open_output_stream(self.hidden)
        self.id_type, self.pack = np.dtype(id_type).newbyteorder("<"), zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.frames: list[tuple[int, int, int]] = []
        self.open: list[np.ndarray] = []
        self.held = self.n_ids = 0
        self.docs: list[tuple[int | None, int, int]] = []

    def _frame(self, raw: bytes, skip: bool = False) -> None:
        packed = self.pack.compress(raw)
        if skip:
            packed = struct.pack("<II", INDEX_MAGIC, len(packed)) + packed
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.out.write(packed)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(self.frames), len(ids)))
        self.open.append(ids)
        self.held += len(ids)
        self.n_ids += len(ids)
        if self.held >= FRAME_IDS:
            self.flush()

    def flush(self) -> None:
        if self.open:
            self._frame(np.concatenate(self.open).astype(self.id_type, copy=False).tobytes())
            self.open, self.held = [], 0

    def close(self) -> None:
        self.flush()
        n = len(self.docs)
        ids, frames, sizes = zip(*self.docs, strict=True) if n else ((), (), ())
        index = struct.pack("<4sBQ", b"PMTI", self.id_type.itemsize, n) + np.array([x or 0 for x in ids], "<i8").tobytes()
        index += np.array([x is None for x in ids], "u1").tobytes() + np.array(frames, "<u4").tobytes() + np.array(sizes, "<u4").tobytes()
        self._frame(index, skip=True)
        table = b"".join(struct.pack("<III", *x) for x in self.frames) + struct.pack("<IBI", len(self.frames), CHECKSUMS, SEEK_END)
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(table)) + table)
        self.out.close()
        self.fs.move(self.hidden, self.path)


class Reader:
    """Random access to one file; only the frames asked for are fetched and decompressed, and checked."""

    def __init__(self, uri: str):
        fs, path = _opened(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEK_END or flags != CHECKSUMS:
            raise ValueError(f"{uri} has no seek table")
        self.table = np.frombuffer(self.file.read_at(12 * n, size - 9 - 12 * n), "<u4").reshape(n, 3)
        self.at = np.concatenate(([0], np.cumsum(self.table[:, 0], dtype=np.int64)))
        raw = self._frame(n - 1, 8)
        tag, width, count = struct.unpack("<4sBQ", raw[:13])
        if tag != b"PMTI":
            raise ValueError(f"{uri} has no document index")
        self.id_type, at = np.dtype(f"<u{width}"), 13
        self.doc_ids = np.frombuffer(raw, "<i8", count, at)
        self.null = np.frombuffer(raw, "u1", count, at + 8 * count).astype(bool)
        self.frame_of = np.frombuffer(raw, "<u4", count, at + 9 * count).astype(np.int64)
        self.sizes = np.frombuffer(raw, "<u4", count, at + 13 * count).astype(np.int64)
        self.start = np.cumsum(self.sizes) - self.sizes

    def _frame(self, k: int, skip: int = 0) -> bytes:
        packed, size, check = self.table[k].tolist()
        raw = zstandard.ZstdDecompressor().decompress(self.file.read_at(packed - skip, int(self.at[k]) + skip), max_output_size=size)
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k} is damaged")
        return raw

    def documents(self, rows: Iterable[int] | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """(row, ids) of the rows, in order; of all without ``rows``."""
        now, ids, base = -1, None, 0
        for r in range(len(self.sizes)) if rows is None else sorted(rows):
            k = int(self.frame_of[r])
            if k != now:
                now, ids = k, np.frombuffer(self._frame(k), self.id_type)
                base = int(self.start[np.searchsorted(self.frame_of, k)])
            yield r, ids[self.start[r] - base : self.start[r] - base + self.sizes[r]]

    def find(self, doc_id: int) -> list[int]:
        """Rows of a document; the index is in order, nulls first."""
        lo = int(self.null.sum())
        return list(range(lo + int(np.searchsorted(self.doc_ids[lo:], doc_id)), lo + int(np.searchsorted(self.doc_ids[lo:], doc_id, "right"))))


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, end_id: int | None = 2) -> DataFrame:
    """Write all documents in ascending doc_id order; the manifest (path, part, n_docs, n_ids), written too."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, known, out, path = TaskContext.get().partitionId(), held(Pieces, tokenizer), None, ""
        tail = [] if end_id is None else [end_id]
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for b in blocks(batch.column("text")):
                for k, x in enumerate(known.encode(b)):
                    if out is None:
                        path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.tokens"
                        out = Writer(path, known.id_type)
                    out.add(ids[b.row + k], np.append(x, np.array(tail, x.dtype)))
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": path, "part": part, "n_docs": len(out.docs), "n_ids": out.n_ids}], pa.schema([("path", pa.string()), ("part", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    base, path = _opened(folder)
    base.create_dir(path, recursive=True)
    # rows that are equal altogether are told apart by their place, so that no range has to hold them all
    ordered = text_of(docs).withColumns({"_tie": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    ordered = ordered.repartitionByRange("doc_id", "_tie", "_row").sortWithinPartitions("doc_id", "_tie", "text", "_row")
    return stage(ordered.select("doc_id", "text").mapInArrow(write, MANIFEST), "token-manifest")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    spark = manifest.sparkSession
    files = sorted(manifest.collect(), key=lambda r: r["part"])  # one row per file
    start, rows = 0, []
    for r in files:
        rows.append((r["path"], start))
        start += r["n_ids"]
    out = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not rows:
        return spark.createDataFrame([], out)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in batches:
            for path, before in zip(*(batch.column(c).to_pylist() for c in ("path", "before")), strict=True):
                f = Reader(path)
                crc = np.fromiter((zlib.crc32(ids.astype("<u4").tobytes()) for _, ids in f.documents()), np.int64, len(f.sizes))
                yield pa.RecordBatch.from_arrays([pa.array(f.doc_ids, mask=f.null), pa.array(f.start + before), pa.array(f.sizes), pa.array(crc)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    parts = min(len(rows), 4096)
    table = spark.createDataFrame(rows, "path string, before long").repartition(parts)
    return table.mapInArrow(read, out)


def encoded_documents(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Contract of op9: the files are written to the shared folder and read back."""
    spark: SparkSession = docs.sparkSession
    return read_tokens(write_tokens(docs, tokenizer, scratch(spark, "tokens"), end_id))
