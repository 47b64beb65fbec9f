from __future__ import annotations

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemill.functions import sentences as sn
from pagemill.functions import text_rules as tr

CASES = [
    ("strip_controls", "paragraph", "Line 1\r\nLine 2\rLine 3\nLine 4", "Line 1\nLine 2\nLine 3\nLine 4"),
    ("strip_controls", "paragraph", "Patient:\tJohn Doe\tAge:\t45", "Patient: John Doe Age: 45"),
    ("strip_controls", "code", "def foo():\n\treturn 42", "def foo():\n    return 42"),
    ("strip_controls", "paragraph", "a​b﻿c\x85", "abc\x85"),
    ("unicode", "paragraph", "10² mg H₂O ½", "10² mg H₂O ½"),
    ("unicode", "paragraph", "étude", "étude"),
    ("expand_ligatures", "paragraph", "ﬂuid level: 10² mL, ½ cup", "fluid level: 10² mL, ½ cup"),
    ("dehyphenate", "paragraph", "para-\ngraph break", "paragraph break"),
    ("dehyphenate", "paragraph", "DIAG-\nNOSIS confirmed", "DIAGNOSIS confirmed"),
    ("dehyphenate", "paragraph", "télé-\nphone and Über-\ntragung", "téléphone and Übertragung"),
    ("dehyphenate", "paragraph", "cost-\neffective treatment", "cost-effective treatment"),
    ("dehyphenate", "paragraph", "NON-\nINVASIVE procedure", "NON-INVASIVE procedure"),
    ("dehyphenate", "paragraph", "a-\nb-\nc", "ab-\nc"),
    ("collapse_whitespace", "paragraph", "  BP   :120/80  mmHg  ", "BP :120/80 mmHg"),
    ("collapse_whitespace", "paragraph", "Paragraph 1 line a\nline b.\n\n\nParagraph 2 line c\nline d.", "Paragraph 1 line a line b.\n\nParagraph 2 line c line d."),
    ("collapse_whitespace", "code", "\n  a  \n b\n\n", "  a\n b"),
    ("collapse_whitespace", "formula", "  x  =  1 ", "x  =  1"),
    ("typography", "paragraph", "pages 10–25, dose 5–10 mg", "pages 10-25, dose 5-10 mg"),
    ("typography", "paragraph", "The symptom—dyspnea—occurred during exertion.", "The symptom - dyspnea - occurred during exertion."),
    ("typography", "paragraph", "“a” ‘b’ c­", "\"a\" 'b' c"),
]


def test_rules(spark):
    for kind in ("paragraph", "code", "formula"):
        mine = [c for c in CASES if c[1] == kind]
        df = spark.createDataFrame([(i, c[2]) for i, c in enumerate(mine)], "i int, t string")
        rows = {r["i"]: r for r in df.select("i", *[tr.RULES[x](F.col("t"), kind).alias(x) for x in tr.RULES]).collect()}
        for i, (rule, _, _, want) in enumerate(mine):
            assert rows[i][rule] == want, mine[i]


def test_flat_whitespace(spark):
    df = spark.createDataFrame([("Para 1\n\nPara 2",)], "t string")
    assert df.select(tr.collapse_whitespace(F.col("t"), keep_paragraphs=False)).first()[0] == "Para 1 Para 2"


def test_changed_flags_and_idempotence(spark):
    df = spark.createDataFrame([("a  b",), ("plain text",), (None,), ("",)], "t string")
    rows = tr.traced(df, "t").collect()
    assert [r["t"] for r in rows] == ["a  b", "plain text", None, ""]
    assert rows[0]["changed"] == ["typography"] and rows[1]["changed"] == []
    same = df.select(tr.is_idempotent(F.col("t")).alias("x")).collect()
    assert [r["x"] for r in same] == [False, True, None, True]  # no-break spaces are the known exception


def test_own_rule(spark):
    tr.register_rule("shout", lambda t, kind: F.upper(t))
    df = spark.createDataFrame([("a",)], "t string")
    assert df.select(tr.apply_rules(F.col("t"), ["shout"])).first()[0] == "A"
    del tr.RULES["shout"]


@pytest.mark.parametrize(
    ("text", "n", "held"),
    [("Dr. Smith took aspirin. It helped.", 2, True), ("BP120/80. The patient rested.", 1, True), ("The dose is 45. He improved.", 2, False), ("他说完了。然后他走了。", 2, False), ("", 0, False), ("J. Smith. e.g. aspirin", 1, True)],
)
def test_sentences(text, n, held):
    found, ambiguous = sn.split_sentences(text)
    assert len(found) == n and (ambiguous > 0) == held


@given(st.text(alphabet="aB1.!? \n。中", max_size=60))
def test_sentences_lose_nothing(text):
    found, _ = sn.split_sentences(text)
    assert "".join("".join(found).split()) == "".join(text.split())


@given(st.text(alphabet="ab.\n!", max_size=200), st.integers(1, 10))
def test_force_split(text, limit):
    pieces = sn.force_split(text, limit)
    assert "".join(pieces) == text
    assert all(sn.tokens(p) <= limit for p in pieces)


def test_tail_sentences():
    assert sn.tail_sentences("One is here. Two is here. Three is here.", 1) == ["Three is here."]
