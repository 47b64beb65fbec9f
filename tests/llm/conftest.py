from __future__ import annotations

import random

import pytest

from tests.llm.helpers import DOCS, make_docs, words

@pytest.fixture(scope="session")
def rnd():
    return random.Random(11)


@pytest.fixture(scope="session")
def odd_rows(rnd):
    """Nulls, empty and blank texts, a very long one, repeated rows and ids, ties."""
    long = words(rnd, 40_000)
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, long), (5, long), (6, "two words"), (6, "other text of the same id"), (None, "no id here"), (None, None), (7, "é" * 50), (8, words(rnd, 60)), (9, words(rnd, 60))]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """With columns whose names operators also use."""
    from pyspark.sql import functions as F

    d = make_docs(spark, odd_rows)
    return d.withColumns({c: F.lit("x") for c in ("key", "size", "target", "n", "score", "kept", "n_tokens", "_key", "spans", "rep", "component")})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
