"""Files to blocks and tables: each format is one plain function, run by Arrow batches over a column of content."""

from __future__ import annotations

import csv
import io
import json
import re
import unicodedata
import zipfile
from collections.abc import Callable
from html import unescape
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.schemas import BLOCK, TABLE

# Suffixes of files that are read.
SUFFIXES = ("pdf", "docx", "xlsx", "pptx", "html", "htm", "md", "markdown", "txt", "csv", "tsv", "json", "xml", "png", "jpg", "jpeg")
_HTML_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li pre div td th".split())
_HTML_SILENT = frozenset("script style title".split())


def scan(spark: SparkSession, root: str, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """path, name, size, sha256, content of the files below ``root``; an unreadable file would have a null hash."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    files = files.filter(F.lower(F.regexp_extract("path", r"\.([^./\\]+)$", 1)).isin(*suffixes))
    return files.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"), "content")


def document_id(sha256: Column) -> Column:
    return F.concat(F.lit("d-"), F.substring(sha256, 1, 16))


_TAG = r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*"
_UNSEEN = re.compile(rf"(?is)<!--.*?(?:-->|\Z)|<({'|'.join(sorted(_HTML_SILENT))})\b{_TAG}>.*?(?:</\1\s*>|\Z)")
_LINE_END = re.compile(r"(?i)<br\b[^>]*>")
_BLOCK_TAG = re.compile(rf"(?is)<(/?)({'|'.join(sorted(_HTML_BLOCKS))})\b{_TAG}>")
_ANY_TAG = re.compile(rf"(?s)</?[A-Za-z]{_TAG}>|<[!?][^>]*>")


def html_blocks(text: str) -> list[tuple[int, str, str]]:
    """A page cut at every block tag; a piece has the kind of the tag that opens it. Scripts, styles, titles and comments go."""
    seen = _LINE_END.sub("\n", _UNSEEN.sub("", text))
    first, *rest = _BLOCK_TAG.split(seen)
    kinds = ["paragraph"] + ["paragraph" if closes else "heading" if tag[0] in "hH" else "list_item" if tag.lower() == "li" else "paragraph" for closes, tag in zip(rest[::3], rest[1::3], strict=True)]
    said = [unescape(_ANY_TAG.sub("", piece)).strip() for piece in (first, *rest[2::3])]
    return [(i, kind, t) for i, (kind, t) in enumerate((k, t) for k, t in zip(kinds, said, strict=True) if t)]


def markdown_blocks(text: str) -> list[tuple[int, str, str]]:
    """Paragraphs end at blank lines and before marked lines; markers stay in the text; a fence is part of a paragraph."""
    found: list[tuple[str, str]] = []
    held: list[str] = []

    def end() -> None:
        if held:
            found.append(("paragraph", " ".join(held).strip()))
            held.clear()

    for raw in text.splitlines():
        line = raw.rstrip()
        first = line.lstrip()[:3]
        if not first:
            end()
        elif first[0] in "#-*" or first == "```":
            end()
            if first == "```":
                held.append(line)
            else:
                found.append(("heading" if first[0] == "#" else "list_item", line.strip()))
        else:
            held.append(line)
    end()
    return [(i, kind, t) for i, (kind, t) in enumerate(found)]


_PLAIN = re.compile(r"^(?:(#+)\s+(.*)|([-*+])\s+(.*)|(\d+\.\s+.*))$")


def stripped_markdown_blocks(text: str) -> list[tuple[int, str, str]]:
    """As ``markdown_blocks``, with heading and bullet markers off and numbered items kept as written."""
    found: list[tuple[str, str]] = []
    held: list[str] = []

    def end() -> None:
        if held:
            found.append(("paragraph", " ".join(held)))
            held.clear()

    for line in (x.strip() for x in text.splitlines()):
        m = _PLAIN.match(line)
        if m or not line:
            end()
        if m:
            found.append(("heading", m[2]) if m[1] else ("list_item", m[4] if m[3] else m[5]))
        elif line:
            held.append(line)
    end()
    return [(i, kind, t) for i, (kind, t) in enumerate(found)]


def text_blocks(text: str) -> list[tuple[int, str, str]]:
    return [(i, "paragraph", x.strip()) for i, x in enumerate(text.split("\n")) if x.strip()]


def json_blocks(text: str) -> list[tuple[int, str, str]]:
    try:
        out = json.dumps(json.loads(text), ensure_ascii=False)
    except ValueError:
        out = ""
    return [(0, "code", out)]


def xml_blocks(text: str) -> list[tuple[int, str, str]]:
    try:
        out = ElementTree.tostring(ElementTree.fromstring(text), encoding="unicode")
    except ElementTree.ParseError:
        out = text
    return [(0, "code", out)]


BLOCK_LOADERS: dict[str, Callable[[str], list[tuple[int, str, str]]]] = {
    "html": html_blocks, "markdown": markdown_blocks, "markdown_plain": stripped_markdown_blocks, "plaintext": text_blocks, "json": json_blocks, "xml": xml_blocks,
}


def blocks_of(slug: str):
    """A column function: text of this type -> array of blocks (seq, kind, text). A text that can't be read has none."""

    @F.pandas_udf(T.ArrayType(BLOCK))
    def load(text: pd.Series) -> pd.Series:
        return text.map(lambda t: [{"seq": s, "kind": k, "text": x} for s, k, x in BLOCK_LOADERS[slug](t)] if t else [])

    return load


def delimited(text: str, mark: str) -> dict | None:
    rows = [[c.strip() for c in r] for r in csv.reader(io.StringIO(text.removeprefix("﻿")), delimiter=mark)]
    rows = [r for r in rows if any(r)]
    return {"page": 0, "header": rows[0], "rows": rows[1:]} if rows else None


_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def docx(data: bytes) -> tuple[list[tuple[int, str, str]], list[dict]]:
    """Body paragraphs and tables of a word-processor file."""
    body = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(data)).read("word/document.xml")).find(f"{_W}body")
    said = lambda e: "".join(t.text or "" for t in e.iter(f"{_W}t"))
    blocks, tables = [], []
    for e in body if body is not None else ():
        if e.tag == f"{_W}p" and said(e).strip():
            blocks.append((len(blocks), "paragraph", said(e).strip()))
        elif e.tag == f"{_W}tbl":
            grid = [[" ".join(said(p) for p in c.iter(f"{_W}p")).strip() for c in r.iter(f"{_W}tc")] for r in e.iter(f"{_W}tr")]
            if grid:
                tables.append({"page": 0, "header": grid[0], "rows": grid[1:]})
    return blocks, tables


def xlsx(data: bytes) -> list[dict]:
    """One table a sheet, all cells as text, blank rows dropped."""
    z = zipfile.ZipFile(io.BytesIO(data))
    names = z.namelist()
    shared: list[str] = []
    if "xl/sharedStrings.xml" in names:
        shared = ["".join(t.text or "" for t in s.iter(f"{_S}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_S}si")]
    out = []
    sheets = sorted((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n)[0]))
    for page, name in enumerate(sheets):
        grid = []
        for row in ElementTree.fromstring(z.read(name)).iter(f"{_S}row"):
            cells: dict[int, str] = {}
            for k, c in enumerate(row.iter(f"{_S}c")):
                letters = re.match(r"[A-Z]*", c.get("r") or "")[0]
                at = k
                if letters:
                    at = -1
                    for x in letters:
                        at = (at + 1) * 26 + ord(x) - 65
                v = c.find(f"{_S}v")
                text = "".join(t.text or "" for t in c.iter(f"{_S}t")) if c.get("t") == "inlineStr" else "" if v is None else v.text or ""
                cells[at] = shared[int(text)] if c.get("t") == "s" and text else text
            grid.append([cells.get(i, "").strip() for i in range(max(cells, default=-1) + 1)])
        width = max(map(len, grid), default=0)
        grid = [r + [""] * (width - len(r)) for r in grid if any(r)]
        if grid:
            out.append({"page": page, "header": grid[0], "rows": grid[1:]})
    return out


def tables_of(mark: str):
    """A column function: delimited text -> array of tables."""

    @F.pandas_udf(T.ArrayType(TABLE))
    def load(text: pd.Series) -> pd.Series:
        return text.map(lambda t: [x] if t and (x := delimited(t, mark)) else [])

    return load


def container_tables(slug: str):
    """A column function: bytes of a spreadsheet or word-processor file -> array of tables; none if it can't be read."""

    def one(data: bytes) -> list[dict]:
        try:
            return xlsx(data) if slug == "xlsx" else docx(data)[1]
        except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
            return []

    @F.pandas_udf(T.ArrayType(TABLE))
    def load(content: pd.Series) -> pd.Series:
        return content.map(one)

    return load


def clean_meta(value: str | None) -> str:
    """Entities decoded, compatibility characters folded, controls but line breaks and tabs dropped."""
    text = unicodedata.normalize("NFKC", unescape(value or ""))
    return "".join(c for c in text if ord(c) >= 32 or c in "\n\t").strip()


@F.pandas_udf(T.StringType())
def clean_metadata(value: pd.Series) -> pd.Series:
    return value.map(clean_meta)


def iso_date(value: Column) -> Column:
    """``D:YYYYMMDD…`` to ``YYYY-MM-DD``; the text as it is where there is no such date."""
    p = r"^(?:D:)?(\d{4})(\d{2})?(\d{2})?"
    part = lambda i: F.when(F.regexp_extract(value, p, i) == "", "01").otherwise(F.regexp_extract(value, p, i))
    return F.when(value.rlike(p), F.concat_ws("-", F.regexp_extract(value, p, 1), part(2), part(3))).otherwise(value)


def expected_pages(scans: DataFrame) -> DataFrame:
    """A row for each page that must come out: 0 to n - 1 of a PDF, 0 of any other file. A PDF without pages is a failure row."""
    bad = (F.col("slug") == "pdf") & (F.coalesce("page_count", F.lit(0)) < 1)
    pages = F.when(bad, F.array(F.lit(None).cast("int"))).when(F.col("slug") == "pdf", F.sequence(F.lit(0), F.col("page_count") - 1)).otherwise(F.array(F.lit(0)))
    return scans.select("doc_id", F.explode(pages).alias("page_index"), F.when(bad, "unreadable").otherwise("planned").alias("status"))


def parse_report(reports: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Numbers out of whole report texts: path, value -> a double column for each pattern's first group."""
    return reports.select("path", *[F.regexp_extract("value", p, 1).try_cast("double").alias(k) for k, p in patterns.items()])


def salvage_json(text: Column) -> Column:
    """The outermost braces of an answer that may be fenced or talked around; null if they hold no JSON."""
    inner = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    return F.when(F.try_parse_json(inner).isNotNull(), inner)
