"""Every registered query against its SQL twin on the smallest test tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from tierworks import checks
from tierworks.sources import readers

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are missing")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (int, float)):
        return None if math.isnan(value) else round(float(value), 9)
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(checks.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = checks.queries()[name](spark, SF_DIR)
    found = table(df.columns, df.collect())
    cursor = duck.execute(checks.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert found == table(columns, cursor.fetchall())


def test_file_inventory(spark):
    [line] = readers.file_inventory(spark, SF_DIR, "*.parquet").collect()
    sizes = [os.path.getsize(f"{SF_DIR}/{t}.parquet") for t in TABLES]
    assert line["directory"] == os.path.basename(SF_DIR)
    assert line["file_count"] == len(TABLES)
    assert line["total_mb"] == pytest.approx(sum(sizes) / 1024**2, abs=0.01)


def test_entry_points(spark):
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert set(checks.queries()) <= set(entry_points.queries())
    assert set(checks.queries()) <= set(entry_points.oracle_sql())
    assert entry_points.entry(spark).count() > 0
