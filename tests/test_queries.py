"""Every registered query against the checking engine, on the smallest data."""

from __future__ import annotations

import collections
import math

import duckdb
import pytest

import __spark_entry__ as entry
from tidemill.plans.frames import SOURCES

SF = "/root/testdata/sf0.001"


def normal(value):
    return None if isinstance(value, float) and math.isnan(value) else float(f"{value:.10g}") if isinstance(value, float) else value


def counted(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(repr(tuple(normal(row[i]) for i in order)) for row in data)


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in SOURCES:
        connection.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, db, name):
    df = entry.queries()[name](spark, SF)
    got = df.collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cursor = db.execute(sql)
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert counted(df.columns, got) == counted(columns, cursor.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() == 10


def test_no_query_of_a_star_shape_crosses_tables(spark):
    """Joins are on keys: no query's plan has a cartesian product or a nested loop."""
    eager = {n for n in entry.queries() if n.startswith(("stream_", "als_", "embed_", "vector_"))}
    eager |= {"login_alerts_stream", "login_enriched_stream", "cdc_apply_stream", "medallion_gold"}
    for name in sorted(set(entry.queries()) - eager):
        text = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
