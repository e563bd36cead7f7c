"""Every catalogue query against its SQL form in DuckDB."""

from __future__ import annotations

import os

import duckdb
import pytest

from strata.catalogue import checks, queries as catalogue
from strata.catalogue.queries import Warehouse, source_without_ties, written_source
from strata.catalogue.sources import GIVEN_TABLES
from strata.specs import TABLES

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
QUERIES, CHECKS = catalogue.queries(), checks.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in GIVEN_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    yield con
    con.close()


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    def value(v):
        return f"{v:.6f}" if isinstance(v, float) else repr(v)
    return sorted(tuple(value(r[i]) for i in order) for r in rows)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, duck):
    got = QUERIES[name](spark, SF)
    result = duck.execute(CHECKS[name])
    columns = [d[0] for d in result.description]
    want = result.fetchall()
    assert sorted(got.columns) == sorted(columns)
    kinds = {d[0]: str(d[1]) for d in result.description}
    names = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    assert {f.name: names[f.dataType.simpleString()] for f in got.schema} == kinds
    assert want, "the check should return rows"
    assert rows_of(got.columns, got.collect()) == rows_of(columns, want)


@pytest.mark.parametrize("table", ["rental", "customer_address", "payment", "inventory_item"])
def test_two_loads_end_like_one(table, spark):
    """Support tickets differ by design: a row that turns invalid leaves the old one."""
    names = TABLES[table].business_columns
    one, two = (sorted(map(tuple, QUERIES[q](spark, SF).select(*names).collect()), key=repr) for q in (f"silver_{table}", f"silver_{table}_incremental"))
    assert one == two and one


def test_lone_keys_of_one_given_table_are_not_ranked(spark, tmp_path):
    """Payments are a scan of the orders: their keys are counted, and no row moves."""
    orders = spark.sql(
        "SELECT id AS o_orderkey, id % 5 AS o_custkey, 'F' AS o_orderstatus, 10.0D AS o_totalprice,"
        " TIMESTAMP_NTZ '1995-01-01 00:00:00' AS o_orderdate, '1-URGENT' AS o_orderpriority FROM range(20)"
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    payments = Warehouse(spark, str(tmp_path)).silver("payment")["payment"]
    assert "Window" not in payments._jdf.queryExecution().executedPlan().toString()
    assert payments.count() == 20


def test_bronze_of_a_join_is_written_once_for_two_loads(spark, tmp_path):
    for table, text in {
        "orders": "SELECT id AS o_orderkey, id % 5 AS o_custkey, TIMESTAMP_NTZ '1995-01-01 00:00:00' AS o_orderdate FROM range(4)",
        "lineitem": "SELECT id % 4 AS l_orderkey, int(id div 8) AS l_linenumber, 1L AS l_partkey, 1L AS l_suppkey, 10.0D AS l_quantity,"
        " 5.0D AS l_extendedprice, 0.1D AS l_tax, 'R' AS l_returnflag, 'O' AS l_linestatus,"
        " TIMESTAMP_NTZ '1995-02-01 00:00:00' AS l_shipdate FROM range(12)",
    }.items():
        spark.sql(text).write.parquet(str(tmp_path / f"{table}.parquet"))
    whole = Warehouse(spark, str(tmp_path))
    whole.land("rental", "payment")
    for load in (whole, whole.before("2030-01-01 00:00:00")):
        rentals = load.silver("rental")["rental"]
        assert not any(f.endswith("lineitem.parquet") or "lineitem.parquet/" in f for f in rentals.inputFiles())
        assert rentals.count() == 8
    assert whole.before("2019-01-01 00:00:00").silver("rental")["rental"].count() == 0


def test_a_source_that_comes_of_a_join_is_joined_once(spark, tmp_path):
    for table, text in {
        "orders": "SELECT id AS o_orderkey, id % 5 AS o_custkey, TIMESTAMP_NTZ '1995-01-01 00:00:00' AS o_orderdate FROM range(4)",
        "lineitem": "SELECT id % 4 AS l_orderkey, int(id div 8) AS l_linenumber, 1L AS l_partkey, 1L AS l_suppkey, 10.0D AS l_quantity,"
        " 5.0D AS l_extendedprice, 0.1D AS l_tax, 'R' AS l_returnflag, 'O' AS l_linestatus,"
        " TIMESTAMP_NTZ '1995-02-01 00:00:00' AS l_shipdate FROM range(12)",
    }.items():
        spark.sql(text).write.parquet(str(tmp_path / f"{table}.parquet"))
    for rentals in (source_without_ties(spark, str(tmp_path), "rental"), written_source(spark, str(tmp_path))("rental")):
        assert not any("lineitem.parquet" in f for f in rentals.inputFiles())
        assert sorted(r["rental_id"] for r in rentals.collect()) == [0, 1, 10, 11, 20, 21, 30, 31]
