"""The operators that SQL can express, against their SQL."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from check_oracle import rows_of  # noqa: E402

from ledgerline.llm.queries import QUERIES, SQL  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    got, res = df.collect(), con.execute(SQL[name])
    names = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, got) == rows_of(names, res.fetchall())
