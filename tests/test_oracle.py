"""Every registered query against its DuckDB oracle (the correctness gate)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from ledgerline.plans.queries import QUERIES  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402

from core_support import SF001, SF01  # noqa: E402

SF = os.environ.get("ORACLE_SF_DIR", SF01)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = df.collect()
    res = duck.execute(entry.oracle_sql()[name])
    want = res.fetchall()
    onames = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(onames)
    assert len(got) == len(want)
    assert rows_of(df.columns, got) == rows_of(onames, want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["id", "type", "value", "props"]
    assert os.path.isdir(SF001)
