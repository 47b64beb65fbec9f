"""Every query of the catalogue against its SQL on the smallest tables, and at another number of partitions."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from pagemill.plans import catalog
from pagemill.session import TABLES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, list) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    mine = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in catalog.ORACLE_SQL:
        assert mine
        return
    rel = duck.sql(catalog.ORACLE_SQL[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    assert mine == sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)


@pytest.mark.parametrize("name", ["chunks", "reading_order", "ledger_fold", "token_budget_batches"])
def test_partitions_change_nothing(spark, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        rows = []
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            rows.append(sorted(map(repr, catalog.QUERIES[name](spark, SF).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert rows[0] == rows[1]
