"""Explicit schemas of the tables between stages; new fields are only ever added, with nulls for old rows."""

from __future__ import annotations

from pyspark.sql import types as T

VERSIONS = {"parser": "parser-v0.1.0", "dom": "dom-schema-v0.1.0", "normalizer": "normalizer-v0.2.0", "chunker": "chunker-v0.1.0", "chunks": "chunks-v1", "page": "v0.1.0"}


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


_S, _I, _L, _D, _B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()
BOX = struct(x0=_D, y0=_D, x1=_D, y1=_D)
BLOCK = struct(seq=_I, kind=_S, text=_S)
PLACED_BLOCK = struct(doc_id=_S, page=_I, seq=_I, block_id=_S, kind=_S, text=_S, box=BOX, confidence=_D, font_size=_D, bold=_B, source=_S)
TABLE = struct(page=_I, header=T.ArrayType(_S), rows=T.ArrayType(T.ArrayType(_S)))
PAGE_RESULT = struct(
    doc_id=_S, page_index=_I, route=_S, status=_S, content_present=_B, engine=_S, attempt=_I, seq=_L, checksum=_S,
    errors=T.ArrayType(struct(page_no=_I, category=_S, message=_S, traceback=_S)), timings=T.MapType(_S, _D),
)
SIGNAL = struct(doc_id=_S, place=_I, name=_S, value=_D, status=_S)
REFERENCE = struct(kind=_S, target=_S, id=_S, label=_S, text=_S)
VERDICT = struct(doc_id=_S, metrics=T.MapType(_S, _D), verdict=_S, issues=T.ArrayType(struct(severity=_S, surface=_S, detail=_S, suggestion=_S)), notes=_S)
EMBEDDING = struct(doc_id=_S, chunk_id=_S, chunker_version=_S, embedder_id=_S, dim=_I, vec=T.ArrayType(T.FloatType()))
