"""Every registered query against its SQL on a second engine."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as driver
from conftest import SMALL

QUERIES, ORACLES = driver.QUERIES, driver.ORACLES
ROWS_ONLY = {"rf_rmse", "predictions"}


@pytest.fixture(scope="module")
def second_engine():
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{SMALL}/events.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((value is not None, value) for value in row))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, second_engine, name):
    found = QUERIES[name](spark, SMALL)
    columns = sorted(found.columns)
    expected = second_engine.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(c[0] for c in second_engine.execute(ORACLES[name]).description) == columns
    assert ordered(tuple(r) for r in found.select(*columns).collect()) == ordered(expected)


def test_all_queries_are_covered():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY and set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert driver.entry(spark).count() == 888
