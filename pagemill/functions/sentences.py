"""Sentence boundaries and token budgets: patterns propose boundaries, filters hold some back; and an Arrow wrapper."""

from __future__ import annotations

import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

FINAL = ".!?。！？…"
# Abbreviations, without their last period.
ABBREVIATIONS = ("dr", "mr", "mrs", "ms", "st", "vs", "etc", "inc", "jr", "sr", "e.g", "i.e", "u.s", "u.k")
#: The stop that ends an abbreviation, and the one after an initial.
_SHORT_FORMS = [regex.compile(rf"(?<![\p{{L}}.])(?:{x})([{FINAL}])") for x in (f"(?i:{'|'.join(map(regex.escape, ABBREVIATIONS))})", r"\p{Lu}")]
#: Stops and blanks before a capital, a digit or a Chinese character.
_BOUNDARY = regex.compile(rf"([{FINAL}]++)[ \t\n\r\f\v]*+(?=[\p{{Uppercase}}\p{{Nd}}\p{{No}}一-鿿])")
#: What ends at a place and may be a designation: read backwards from there.
_TOKEN = regex.compile(r"(?r)[\p{L}\p{N}/.-]+")


def tokens(text: str) -> int:
    """The four-characters-a-token estimate."""
    return max(1, len(text) // 4)


def token_count(text: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(text) / 4).cast("int"))


def _designates(text: str, at: int) -> bool:
    """Whether a digit of a token that has letters as well ends at ``at``."""
    m = _TOKEN.search(text, 0, at) if at and text[at - 1].isdigit() else None
    return m is not None and m.end() == at and any(c.isalpha() for c in m[0])


def split_sentences(text: str) -> tuple[list[str], int]:
    """(sentences, boundaries that a guard held back)."""
    short = {m.start(1) for form in _SHORT_FORMS for m in form.finditer(text)}
    # a run that is a short form's stop alone is no boundary; further stops after it are
    proposed = [(m.start() + (m.start() in short), m.end()) for m in _BOUNDARY.finditer(text) if not (m.start() in short and len(m[1]) == 1)]
    ends = [end for at, end in proposed if not _designates(text, at)]
    pieces = [text[a:b].strip() for a, b in zip([0, *ends], [*ends, len(text)], strict=True)]
    return [p for p in pieces if p], len(short) + len(proposed) - len(ends)


def tail_sentences(text: str, budget: int) -> list[str]:
    """The last sentences that fit the budget, one at least."""
    found, _ = split_sentences(text)
    spent, k = 0, len(found)
    while k and (k == len(found) or spent + tokens(found[k - 1]) <= budget):
        spent += tokens(found[k - 1])
        k -= 1
    return found[k:]


def cut_after(text: str, mark: str) -> list[str]:
    """Pieces that end with ``mark``; nothing is lost."""
    parts = text.split(mark)
    return [p for p in [*(x + mark for x in parts[:-1]), parts[-1]] if p]


def force_split(text: str, limit: int) -> list[str]:
    """Pieces within ``limit`` tokens: at blank lines, then lines, then each kind of stop, at last in the middle."""
    if tokens(text) <= limit:
        return [text]
    for mark in ("\n\n", "\n", *FINAL):
        pieces = cut_after(text, mark)
        if len(pieces) > 1:
            break
    else:
        pieces = [text[: len(text) // 2], text[len(text) // 2 :]]
    return [q for p in pieces for q in force_split(p, limit)]


@F.pandas_udf(T.StructType([T.StructField("sentences", T.ArrayType(T.StringType())), T.StructField("ambiguous", T.IntegerType())]))
def sentences(text: pd.Series) -> pd.DataFrame:
    found = [split_sentences(t or "") for t in text]
    return pd.DataFrame({"sentences": [s for s, _ in found], "ambiguous": [n for _, n in found]})
