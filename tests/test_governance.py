"""Drift between versions, masks by grant, bitmaps of keys and merged distinct counts."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tierworks.operators import aggregates, drift, joins, personal_data
from tierworks.sources import sinks

VERSION = "label string, amount double"


def test_drift_equals_plain_sums(spark):
    old = spark.createDataFrame([("a", float(i)) for i in range(80)] + [("b", None)] * 20, VERSION)
    new = spark.createDataFrame([("a", float(i + 40)) for i in range(50)] + [("c", 5.0)] * 50, VERSION)
    cuts = drift.edges(old, ["amount"], 4)
    assert cuts["amount"] == sorted(cuts["amount"]) and len(cuts["amount"]) == 3
    found = {r["column_name"]: r for r in drift.compare(
        drift.histograms(old, ["label"], cuts), drift.histograms(new, ["label"], cuts)).collect()}
    psi = js = 0
    for p, q in ((0.8, 0.5), (0.2, 1e-6), (1e-6, 0.5)):
        psi += (q - p) * math.log(q / p)
        js += (p * math.log2(2 * p / (p + q)) + q * math.log2(2 * q / (p + q))) / 2
    assert found["label"]["psi"] == pytest.approx(psi, abs=1e-5)
    assert found["label"]["js"] == pytest.approx(js, abs=1e-5)
    assert (found["label"]["new_labels"], found["label"]["gone_labels"], found["label"]["drifted"]) == (1, 1, True)
    assert found["amount"]["drifted"] and found["amount"]["new_labels"] == 0


def test_no_drift_nulls_and_empty_versions(spark):
    old = spark.createDataFrame([("a", 1.0), (None, 2.0)] * 10, VERSION)
    one = drift.histograms(old, ["label"], {"amount": [1.5]})
    [first, second] = sorted(drift.compare(one, one).collect())
    assert (first["psi"], first["js"], first["drifted"]) == (0.0, 0.0, False) and not second["drifted"]
    assert ("label", "label", drift.NULL_LABEL, 10) in rows(one)
    empty = drift.histograms(old.limit(0), ["label"], {"amount": [1.5]})
    gone = {r["column_name"]: r["gone_labels"] for r in drift.compare(one, empty).collect()}
    assert gone == {"label": 2, "amount": 0} and drift.compare(empty, empty).count() == 0
    assert rows(drift.moved_labels(one, empty)) == [("label", drift.NULL_LABEL, "gone", 10), ("label", "a", "gone", 10)]


def test_masks_follow_the_grants_of_the_reader(spark, folder):
    spark.sql(f"CREATE DATABASE grants_test LOCATION '{folder}'")
    spark.createDataFrame([(1, "anna@example.org", "x")], "id int, email string, note string").write.saveAsTable("grants_test.people")
    spark.sql("CREATE TABLE grants_test.grants (user_name STRING, table_name STRING, level STRING) USING parquet")
    policy = {"email": {"full": "email", "partial": "left(email, 2)", "none": "'***'"}, "note": {"none": "NULL"}}
    personal_data.granted_view(spark, "grants_test.shown", "grants_test.people", policy, "grants_test.grants")
    seen = lambda: [tuple(r) for r in spark.table("grants_test.shown").collect()]
    me = spark.sql("SELECT current_user()").first()[0]
    grant = lambda user, table, level: spark.sql(
        f"INSERT INTO grants_test.grants VALUES ('{user}', '{table}', '{level}')")
    assert seen() == [(1, "***", None)]
    for user, table, level in [("someone else", "grants_test.people", "full"), (me, "grants_test.other", "full"),
                               (me, "grants_test.people", "sudo")]:
        grant(user, table, level)
    assert seen() == [(1, "***", None)]
    grant(me, "grants_test.people", "partial")
    assert seen() == [(1, "an", None)]
    grant(me, "grants_test.people", "full")
    assert seen() == [(1, "anna@example.org", None)]
    spark.sql("INSERT OVERWRITE grants_test.grants SELECT 'x', 'y', 'full'")
    assert seen() == [(1, "***", None)]
    with pytest.raises(ValueError, match="do not exist"):
        personal_data.granted_view(spark, "v", "grants_test.people", {"age": {"none": "0"}}, "grants_test.grants")
    with pytest.raises(ValueError, match="no level none"):
        personal_data.granted_view(spark, "v", "grants_test.people", {"email": {"full": "email"}}, "grants_test.grants")


def test_bitmaps_find_the_same_orphans(spark):
    child = spark.createDataFrame([(k,) for k in [1, 1, 2, 32768, 32769, 70000, -5, -5, 0, None, 2**40]], "k long")
    parent = spark.createDataFrame([(k,) for k in [1, 32768, 70000, 0, 99, None, 5 * 10**9]], "p long")
    expected = [(-5, 2), (2, 1), (32769, 1), (2**40, 1)]
    assert sorted(rows(joins.orphans_by_bitmap(child, parent, "k", "p"))) == sorted(expected)
    assert rows(joins.orphans(child, parent, "k", "p")) == rows(joins.orphans_by_bitmap(child, parent, "k", "p"))
    assert joins.orphans_by_bitmap(parent.select(F.col("p").alias("k")), parent, "k", "p").count() == 0
    assert joins.orphans_by_bitmap(child.limit(0), parent, "k", "p").count() == 0
    assert len(rows(joins.orphans_by_bitmap(child, parent.limit(0), "k", "p"))) == 8


def test_sketches_merge_over_any_groups(spark):
    df = spark.range(60_000).selectExpr("id % 7 AS day", "id % 20000 AS user", "id % 2 AS side")
    daily = aggregates.distinct_sketches(df, ["day", "side"], "user", "users")
    for by, exact in (([], 20_000), (["side"], 10_000)):
        for r in aggregates.merged_distinct(daily, by, "users", "n").collect():
            assert abs(r["n"] - exact) <= exact * aggregates.sketch_error()
    assert aggregates.sketch_error(12, 1) == pytest.approx(0.01625)


def test_automatic_clustering_opens_fewer_files(spark, folder):
    df = spark.range(20_000).selectExpr(
        "id", "hash(id) % 1000 AS x", "pmod(hash(id, 7), 5000) * 0.5 AS y", "concat('k', lpad(pmod(hash(id, 9), 900), 3, '0')) AS s",
        "IF(id % 50 = 0, NULL, date_add(DATE '2024-01-01', CAST(pmod(hash(id, 3), 300) AS INT))) AS d", "id % 2 = 0 AS flag",
        "id % 3 AS small", "IF(id % 3 = 0, 7, CAST(id AS INT)) AS hot",
    )
    assert sinks.auto_columns(df, ["small", "flag", "s", "x", "missing"]) == ["x", "s"]
    assert len(sinks.auto_columns(df)) == 3 and sinks.auto_columns(df, ["small"]) == []
    columns = ["x", "y", "s", "d"]
    reports = {}
    for name, laid in (("sort", sinks.clustered), ("curve", sinks.on_curve)):
        laid(df, columns, 32).write.parquet(f"{folder}/{name}")
        written = spark.read.parquet(f"{folder}/{name}")
        assert written.count() == 20_000 and rows(written) == rows(df)
        reports[name] = {r["column_name"]: (r["files"], r["opened"]) for r in sinks.files_opened(written, columns).collect()}
    for c in ("y", "s", "d"):
        assert reports["curve"][c][1] < 0.8 * reports["sort"][c][1]
    assert sum(o for _, o in reports["curve"].values()) < 0.8 * sum(o for _, o in reports["sort"].values())


def test_clustering_of_hot_values_and_odd_tables(spark, folder):
    df = spark.range(4000).selectExpr("IF(id % 3 = 0, 5, id) AS k", "id AS v")
    sinks.on_curve(df, ["k", "v"], 8).write.parquet(f"{folder}/hot")
    sizes = spark.read.parquet(f"{folder}/hot").groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in sizes) < 1500
    same = spark.range(100).selectExpr("1 AS k", "CAST(NULL AS STRING) AS s")
    sinks.write(same, f"{folder}/same", cluster_by=sinks.AUTO)
    assert spark.read.parquet(f"{folder}/same").count() == 100
    sinks.on_curve(same.limit(0), ["k", "s"], 4).write.parquet(f"{folder}/none")
    assert spark.read.parquet(f"{folder}/none").count() == 0
