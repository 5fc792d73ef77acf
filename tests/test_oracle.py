"""Every registered query against its checking SQL, over whole tables."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from conftest import SF_CHECK, SF_SMALL

import __spark_entry__ as entry_points
from ledgerloom.checks.oracle import ORACLE as CHECKS
from ledgerloom.checks.queries import registered

QUERIES = registered()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in Path(SF_CHECK).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.10g}"
    return value


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def test_every_query_has_checking_sql():
    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(CHECKS) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, database, name):
    df = QUERIES[name](spark, SF_CHECK)
    answer = database.execute(CHECKS[name])
    columns = [c[0] for c in answer.description]
    assert sorted(df.columns) == sorted(columns)
    assert _bag(df.columns, df.collect()) == _bag(columns, answer.fetchall())


def test_entry_returns_the_whole_year(spark):
    assert entry_points.entry(spark).count() == 365
    assert SF_SMALL in entry_points.entry.__code__.co_consts
