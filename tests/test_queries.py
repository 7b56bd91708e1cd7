"""Every registered query against its SQL in DuckDB, on the whole small tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    return repr(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        tuple(plain(row[i]) for i in order) for row in rows
    )


@pytest.mark.parametrize("name", [n for n in contract.queries() if n not in contract.LLM_QUERIES])
def test_query(spark, duck, name):
    result = contract.queries()[name](spark, SF_DIR)
    rows = result.collect()
    assert rows
    if name in contract.oracle_sql():
        cursor = duck.execute(contract.oracle_sql()[name])
        columns = [d[0] for d in cursor.description]
        assert table(result.columns, rows) == table(columns, cursor.fetchall())


def test_daily_sales_are_in_order(spark):
    """Nulls first, then by date."""
    dates = [r.OrderDate for r in contract.queries()["q08_daily_sales"](spark, SF_DIR).collect()]
    assert None in dates and dates == sorted(dates, key=lambda d: (d is not None, d))


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns == ["Year", "Month", "BikeFrame", "TotalQuantity"]
