"""Text normalization as a chain of column expressions, each with its own 'changed' flag.

A rule is a function ``(text: Column, kind: str) -> Column``; ``register_rule`` adds one, ``apply_rules`` runs a list of
rule ids in order. Only NFC needs Python (Arrow batches): texts without a character that NFC could touch are sent as nulls.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Rule = Callable[[Column, str], Column]

# Characters that strip_controls deletes (tab, LF and CR are handled apart).
CONTROLS = "\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F\\uFEFF\\u200B\\u2060\\u180E"
JOINERS = "\\u200C\\u200D"
# Ligatures and what they stand for.
LIGATURES = (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬅ", "st"), ("ﬆ", "st"))
# Typographic characters that become ', ", -, space.
SINGLE_QUOTES, DOUBLE_QUOTES = "\u2018\u2019\u201a\u201b", "\u201c\u201d\u201e\u201f\u00ab\u00bb"
DASHES, SPACES = "\u2013\u2012\u2015\u2014", "\u00a0\u202f\u2007\u2008\u2009\u200a"
SOFT_HYPHEN = "\u00ad"
# Compounds that keep their hyphen at a line break.
COMPOUNDS = frozenset(
    """cost-effective cost-effectiveness evidence-based beta-blocker beta-blockers follow-up follow-ups self-reported well-known
    first-line second-line third-line post-operative post-treatment pre-existing pre-treatment x-ray x-rays cross-sectional
    peer-reviewed long-term short-term double-blind single-blind high-risk low-risk low-dose high-dose placebo-controlled
    non-invasive open-label dose-dependent dose-response cut-off cut-offs scale-up side-effect side-effects end-point end-points
    time-dependent treatment-resistant health-related all-cause case-control intent-to-treat statistically-significant
    disease-free progression-free over-the-counter gold-standard real-world state-of-the-art""".split()
)
# First parts that keep the hyphen between two words in capitals.
PREFIXES = frozenset("non pre post anti multi sub co cross self well beta dose peer first second third long short high low all half gold real".split())

_LETTER = "A-Za-zÀ-ÖØ-öø-ÿĀ-ž"
_BREAK = rf"(?U)\b([{_LETTER}]+)[-\u00ad\u2010\u2011]\s*\n\s*([{_LETTER}]+)\b"


def strip_controls(text: Column, kind: str = "paragraph", keep_joiners: bool = True) -> Column:
    """CRLF and CR to LF, tabs to a space (four in code), control and zero-width characters away."""
    lines = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    tabs = F.replace(lines, F.lit("\t"), F.lit("    " if kind == "code" else " "))
    return F.regexp_replace(tabs, f"[{CONTROLS}{'' if keep_joiners else JOINERS}]", "")


@cache
def unstable() -> str:
    """A class of all characters that may not be in NFC: marks, parts of Hangul syllables, and what NFC replaces by itself."""
    odd = [c for c in range(0x80, 0x30000) if not 0xD800 <= c < 0xE000 and not unicodedata.is_normalized("NFC", chr(c))]
    spans: list[list[int]] = []
    for c in odd:
        if spans and spans[-1][1] == c - 1:
            spans[-1][1] = c
        else:
            spans.append([c, c])
    return "[\\p{M}\\x{1161}-\\x{1175}\\x{11A8}-\\x{11C2}" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in spans) + "]"


@F.pandas_udf(T.StringType())
def _nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda s: unicodedata.normalize("NFC", s), na_action="ignore")


@F.pandas_udf(T.ArrayType(T.StringType()))
def _nfc_all(texts: pd.Series) -> pd.Series:
    return texts.map(lambda ts: [None if t is None else unicodedata.normalize("NFC", t) for t in ts], na_action="ignore")


def unicode_nfc(text: Column, kind: str = "paragraph") -> Column:
    # a UDF inside ``when`` runs for every row, so those that need nothing go as nulls
    return F.coalesce(_nfc(F.when(text.rlike(unstable()), text)), text)


def unicode_nfc_all(texts: Column) -> Column:
    """``unicode_nfc`` of an array's elements."""
    return F.coalesce(_nfc_all(F.when(F.exists(texts, lambda t: t.rlike(unstable())), texts)), texts)


def expand_ligatures(text: Column, kind: str = "paragraph") -> Column:
    for one, many in LIGATURES:
        text = F.replace(text, F.lit(one), F.lit(many))
    return text


def dehyphenate(text: Column, kind: str = "paragraph") -> Column:
    """Words cut at a line break are joined; known compounds, and prefixes in capitals, keep their hyphen."""
    first, second = (F.regexp_extract_all(text, F.lit(_BREAK), F.lit(g)) for g in (1, 2))

    def joined(a: Column, b: Column) -> Column:
        pair = F.concat(a, F.lit("-"), b)
        loud = (a == F.upper(a)) & (b == F.upper(b)) & F.lower(a).isin(*sorted(PREFIXES))
        return F.when(F.lower(pair).isin(*sorted(COMPOUNDS)) | loud, pair).otherwise(F.concat(a, b))

    words = F.concat(F.zip_with(first, second, joined), F.array(F.lit("")))
    mended = F.array_join(F.zip_with(F.split(text, _BREAK, -1), words, lambda a, b: F.concat(a, b)), "")
    mended = F.when(text.rlike("(?U)[-\u2010\u2011\u00AD]\\s*\\n"), mended).otherwise(text)
    return F.replace(mended, F.lit(SOFT_HYPHEN), F.lit(""))


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, "(?U)^[\\s\\x1C-\\x1F]+|[\\s\\x1C-\\x1F]+$", "")


def collapse_whitespace(text: Column, kind: str = "paragraph", keep_paragraphs: bool = True) -> Column:
    """Code keeps its lines, formulas are stripped, paragraphs are joined by one blank line (or by nothing but a space)."""
    if kind == "code":
        lines = F.regexp_replace(text, "(?m)[ \\t\\x0B\\f]+$", "")
        return F.regexp_replace(lines, "^\\n+|\\n+$", "")
    if kind == "formula":
        return _strip(text)
    if not keep_paragraphs:
        return _strip(F.regexp_replace(text, "(?:[ \\t]*\\n)+[ \\t]*|[ \\t]{2,}", " "))
    tidy = lambda p: _strip(F.regexp_replace(F.replace(p, F.lit("\n"), F.lit(" ")), "[ \\t]{2,}", " "))
    parts = F.transform(F.split(text, "(?U)\\n\\s*\\n+", -1), tidy)
    return F.array_join(F.filter(parts, lambda p: p != ""), "\n\n")


def typography(text: Column, kind: str = "paragraph") -> Column:
    text = F.regexp_replace(text, "(\\S)—(\\S)", "$1 - $2")
    old = SINGLE_QUOTES + DOUBLE_QUOTES + DASHES + SPACES + SOFT_HYPHEN
    new = "'" * len(SINGLE_QUOTES) + '"' * len(DOUBLE_QUOTES) + "-" * len(DASHES) + " " * len(SPACES)
    return F.translate(text, old, new)


RULES: dict[str, Rule] = {
    "strip_controls": strip_controls,
    "unicode": unicode_nfc,
    "expand_ligatures": expand_ligatures,
    "dehyphenate": dehyphenate,
    "collapse_whitespace": collapse_whitespace,
    "typography": typography,
}
DEFAULT_RULES = tuple(RULES)


def register_rule(rule_id: str, rule: Rule) -> None:
    """Make a rule known; it runs where its id is listed."""
    RULES[rule_id] = rule


def apply_rules(text: Column, rules: Sequence[str] = DEFAULT_RULES, kind: str = "paragraph") -> Column:
    for r in rules:
        text = RULES[r](text, kind)
    return text


def traced(df, column: str, rules: Sequence[str] = DEFAULT_RULES, kind: str = "paragraph"):
    """``df`` with ``column`` normalized, and ``changed``: the ids of the rules that changed something."""
    now = F.col(column)
    steps = [now]
    for i, r in enumerate(rules):
        df = df.withColumn(f"_step{i}", RULES[r](steps[-1], kind))
        steps.append(F.col(f"_step{i}"))
    marks = F.array(*[F.when(a != b, F.lit(r)) for r, a, b in zip(rules, steps[:-1], steps[1:], strict=True)])
    changed = F.filter(marks, lambda x: x.isNotNull()) if rules else F.array().cast("array<string>")
    return df.withColumns({"changed": changed, column: steps[-1]}).drop(*[f"_step{i}" for i in range(len(rules))])


def is_idempotent(text: Column, rules: Sequence[str] = DEFAULT_RULES, kind: str = "paragraph") -> Column:
    """Whether a second pass changes nothing; runs of no-break spaces are the known exception."""
    once = apply_rules(text, rules, kind)
    return once == apply_rules(once, rules, kind)
