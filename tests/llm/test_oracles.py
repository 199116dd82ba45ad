"""Queries against their DuckDB SQL on the driver's table."""

from __future__ import annotations

import duckdb
import pytest

from mercato.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.sql(ORACLE_SQL[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    order = [want.columns.index(c) for c in got.columns]
    assert sorted(map(tuple, got.collect())) == sorted(tuple(r[i] for i in order) for r in want.fetchall())
