"""Every query with an SQL form against DuckDB."""

from __future__ import annotations

import os

import duckdb
import pytest

from strata.llm import checks, queries

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", list(checks.SQL))
def test_query_matches_sql(name, spark):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    result = con.execute(checks.SQL[name])
    columns = [d[0] for d in result.description]
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}
    assert {f.name: kinds[f.dataType.simpleString()] for f in got.schema} == {d[0]: str(d[1]) for d in result.description}
    want = sorted(result.fetchall(), key=repr)
    assert want
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=repr) == want
