"""The corpus queries with SQL against a second engine."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as driver
from conftest import SMALL


@pytest.mark.parametrize("name", sorted(driver.CORPUS_ORACLES))
def test_against_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "conversations", "embeddings", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    found = driver.CORPUS_QUERIES[name](spark, SMALL)
    columns = sorted(found.columns)
    expected = connection.execute(f"SELECT {', '.join(columns)} FROM ({driver.CORPUS_ORACLES[name]})").fetchall()

    def ordered(rows):
        return sorted(rows, key=lambda row: tuple((value is not None, value) for value in row))

    assert ordered(tuple(r) for r in found.select(*columns).collect()) == ordered(expected)


def test_sql_of_the_corpus():
    assert set(driver.CORPUS_ORACLES) == {
        "op6_quality_rules",
        "op8_chat_formatting",
        "op9_exact_dedup",
        "op11_hard_negatives",
        "op12_lexical_search",
        "op13_shingle_join",
    }
