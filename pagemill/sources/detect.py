"""What a file is: magic bytes, then the members of a ZIP, then the look of its first 8,192 bytes."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type, MIME.
MIME = {
    "pdf": "application/pdf",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    "epub": "application/epub+zip",
    "png": "image/png",
    "jpg": "image/jpeg",
    "gif": "image/gif",
    "tiff": "image/tiff",
    "rtf": "application/rtf",
    "csv": "text/csv",
    "tsv": "text/tab-separated-values",
    "json": "application/json",
    "xml": "application/xml",
    "html": "text/html",
    "markdown": "text/markdown",
    "plaintext": "text/plain",
    "zip": "application/zip",
    "riff": "application/octet-stream",
    "unknown": "application/octet-stream",
}
# First bytes, type.
MAGIC = (
    (b"%PDF-", "pdf"), (b"\x89PNG\r\n\x1a\n", "png"), (b"\xff\xd8\xff", "jpg"), (b"GIF87a", "gif"), (b"GIF89a", "gif"),
    (b"II*\x00", "tiff"), (b"MM\x00*", "tiff"), (b"{\\rtf", "rtf"), (b"RIFF", "riff"),
)
ZIP_MAGIC = (b"PK\x03\x04", b"PK\x05\x06", b"PK\x07\x08")
# Member prefix, type; the first that occurs decides.
MEMBERS = (("word/", "docx"), ("xl/", "xlsx"), ("ppt/", "pptx"), ("META-INF/", "epub"))
HEAD = 8192


def declared_extension(name: Column) -> Column:
    base = F.regexp_extract(name, "([^/\\\\]*)$", 1)
    return F.lower(F.when(base.contains("."), F.regexp_extract(base, "\\.([^.]*)$", 1)).otherwise(""))


@F.pandas_udf(T.StringType())
def zip_kind(content: pd.Series) -> pd.Series:
    def one(data: bytes) -> str:
        try:
            names = zipfile.ZipFile(io.BytesIO(data)).namelist()
        except Exception:  # noqa: BLE001 - whatever is wrong with it, it is a ZIP of unknown content
            return "zip"
        return next((kind for prefix, kind in MEMBERS if any(n.startswith(prefix) for n in names)), "zip")

    return content.map(one, na_action="ignore")


@F.pandas_udf(T.BooleanType())
def is_json(text: pd.Series) -> pd.Series:
    def one(t: str) -> bool:
        try:
            json.loads(t)
        except ValueError:
            return False
        return True

    return text.map(one, na_action="ignore")


def _once(x: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of ``x``, which is evaluated once however often ``f`` uses it."""
    return F.transform(F.array(x), f)[0]


def delimiter(text: Column) -> Column:
    """Tab or comma, if it occurs equally often in each of the first twelve lines with something in them."""
    lines = F.slice(F.filter(F.split(text, "\\r\\n|[\\n\\r\\x0B\\f]", -1), lambda x: F.trim(F.regexp_replace(x, "\\s", "")) != ""), 1, 12)

    def steady(ls: Column, d: str) -> Column:
        n = F.transform(ls, lambda x: F.length(x) - F.length(F.replace(x, F.lit(d), F.lit(""))))
        return (F.size(ls) > 0) & (F.array_min(n) == F.array_max(n)) & (F.array_min(n) > 0)

    return _once(lines, lambda ls: F.when(steady(ls, "\t"), "\t").when(steady(ls, ","), ","))


def sniff(text: Column, lines: Column | None = None, whole: Column | None = None) -> Column:
    """struct<slug, confidence> of a text's head; delimiters by ``lines``, if given, and JSON only where ``whole`` holds."""
    lead = F.regexp_replace(text, "(?U)^\\s+", "")
    low = F.lower(F.substring(lead, 1, 256))
    kind = lambda s, c: F.struct(F.lit(s).alias("slug"), F.lit(c).alias("confidence"))
    starts = lambda c, *xs: F.lit(False) if not xs else _any([c.startswith(x) for x in xs])
    may_be_json = lead.rlike('^[\\[{"tfnN0-9I-]') if whole is None else whole & lead.rlike('^[\\[{"tfnN0-9I-]')
    by_lines = _once(delimiter(text if lines is None else lines), lambda mark: F.when(mark == "\t", kind("tsv", 0.9)).when(mark == ",", kind("csv", 0.88)).otherwise(kind("plaintext", 0.55)))
    return (
        F.when(lead.startswith("<?xml"), kind("xml", 0.92))
        .when(starts(low, "<!doctype", "<html", "<head"), kind("html", 0.95))
        .when(F.coalesce(is_json(F.when(may_be_json, text)), F.lit(False)), kind("json", 0.97))
        .when(starts(lead, "# ", "## ", "### ", "```", "* ", "- "), kind("markdown", 0.8))
        .otherwise(by_lines)
    )


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def detect(content: Column, name: Column, whole: bool = False) -> Column:
    """struct<slug, mime, probe, confidence, declared, unresolved>.

    With ``whole``, the head's end cuts nothing: delimiters are counted in the first twelve lines as they are, and what goes
    on beyond the head is no JSON.
    """
    raw = lambda x: F.lit(bytearray(x))
    found = lambda slug, probe, confidence, lost=False: F.struct(slug.alias("slug"), F.lit(probe).alias("probe"), (confidence if isinstance(confidence, Column) else F.lit(confidence)).alias("confidence"), F.lit(lost).alias("unresolved"))
    def text_of(data: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(F.make_valid_utf8(data.cast("string")), "^\\uFEFF", ""), "\\uFFFD", "")

    text = text_of(F.substring(content, 1, HEAD))
    result = F.when(content.isNull() | (F.length(content) == 0), found(F.lit("unknown"), "empty", 0.0, True))
    for magic, slug in MAGIC:
        result = result.when(F.startswith(content, raw(magic)), found(F.lit(slug), "magic", 0.99))
    is_zip = _any([F.startswith(content, raw(x)) for x in ZIP_MAGIC])
    kind = zip_kind(F.when(is_zip, content))
    result = result.when(is_zip, found(kind, "container", F.when(kind == "zip", 0.7).otherwise(0.92)))
    seen = sniff(text, text_of(content), F.length(content) <= HEAD) if whole else sniff(text)
    result = result.when(~F.contains(F.substring(content, 1, 4096), raw(b"\0")), _once(seen, lambda x: found(x.slug, "sniff", x.confidence)))
    result = result.otherwise(found(F.lit("unknown"), "unknown", 0.0, True))
    mime = lambda slug: F.element_at(F.create_map(*[F.lit(x) for kv in MIME.items() for x in kv]), slug)
    return _once(result, lambda x: F.struct(x.slug.alias("slug"), mime(x.slug).alias("mime"), x.probe.alias("probe"), x.confidence.alias("confidence"), declared_extension(name).alias("declared"), x.unresolved.alias("unresolved")))
