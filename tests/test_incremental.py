"""Splitting buckets and measures that follow a change feed."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tierworks.operators import changes, retract
from tierworks.plans.incremental import IncrementalView
from tierworks.plans.publish import Governance
from tierworks.plans.refresh import Medallion
from tierworks.sources import directory as dr
from tierworks.streaming import changes as stream_changes

SCHEMA = "id int, place string, price double, day int"
MEASURES = [
    retract.Measure("n", "count"), retract.Measure("priced", "count", "price"),
    retract.Measure("total", "sum", "price"), retract.Measure("mean", "avg", "price"),
    retract.Measure("first", "min", "day"), retract.Measure("last", "max", "day"),
]


def recomputed(df):
    total = F.sum(F.col("price").cast("decimal(38,2)")).cast("double")
    return rows(df.groupBy("place").agg(
        F.count("*"), F.count("price"), total, total / F.count("price"), F.min("day"), F.max("day")))


def versions(rng, count=5):
    """States of a table: rows come, change and go, groups appear and vanish."""
    state, found = {}, []
    for step in range(count):
        for _ in range(60):
            i = rng.randrange(80)
            if rng.random() < 0.3 or step == count - 1:
                state.pop(i, None)
            else:
                state[i] = (i, rng.choice(["a", "b", "c", None, f"p{step}"]), rng.choice([None, 1.5, 2.25, 10.1]),
                            rng.choice([None, 1, 2, 3, 50]))
        found.append(list(state.values()))
    return [*found, []]


@pytest.mark.parametrize("seed", [1, 2])
def test_view_equals_the_recompute_after_every_version(spark, folder, seed):
    view = IncrementalView(spark, folder, ["place"], MEASURES, bucket_rows=2)
    before = spark.createDataFrame([], SCHEMA)
    for number, state in enumerate(versions(random.Random(seed)), 1):
        after = spark.createDataFrame(state, SCHEMA)
        report = view.refresh(changes.diff(before, after, "id"), after, number)
        assert view.version() == number and report["buckets_written"] <= report["buckets"]
        assert rows(view.read()) == recomputed(after)
        before = after
    assert view.read().count() == 0


def test_only_touched_buckets_are_written_and_lost_extremes_read_again(spark, folder):
    first = [(i, f"p{i % 40}", 1.0, i) for i in range(400)]
    start = spark.createDataFrame(first, SCHEMA)
    view = IncrementalView(spark, folder, ["place"], MEASURES, bucket_rows=4)
    nothing = spark.createDataFrame([], SCHEMA)
    view.refresh(changes.diff(nothing, start, "id"), start, 1)
    # A new row: one group, one bucket, nothing read again.
    grown = start.union(spark.createDataFrame([(1000, "p7", 2.0, 200)], SCHEMA))
    report = view.refresh(changes.diff(start, grown, "id"), grown, 2)
    assert (report["groups"], report["again"], report["buckets_written"]) == (1, 0, 1) and report["buckets"] >= 10
    # The group's last day goes: its rows are read again.
    shrunk = grown.filter("id <> 399")
    report = view.refresh(changes.diff(grown, shrunk, "id"), shrunk, 3)
    assert (report["groups"], report["again"]) == (1, 1)
    assert rows(view.read()) == recomputed(shrunk)
    # A version that is there already changes nothing.
    assert view.refresh(changes.diff(grown, shrunk, "id"), shrunk, 3)["groups"] == 0
    assert rows(view.read()) == recomputed(shrunk)


def test_sums_taken_back_leave_nothing_behind(spark):
    feed = spark.createDataFrame(
        [("a", 0.1, "insert")] * 3 + [("a", 0.3, "delete"), ("a", 5.0, "insert")],
        "place string, price double, _change_type string",
    )
    measures = [retract.Measure("total", "sum", "price")]
    [row] = retract.state_of(feed, ["place"], measures, retract.weight()).collect()
    assert row["_s0"] == Decimal("5.00") and row["_rows"] == 3


def test_measures_are_checked(spark, folder):
    with pytest.raises(ValueError, match="kind must be"):
        IncrementalView(spark, folder, ["place"], [retract.Measure("x", "median", "price")])
    with pytest.raises(ValueError, match="needs an expression"):
        IncrementalView(spark, folder, ["place"], [retract.Measure("x", "sum")])
    with pytest.raises(ValueError, match="never refreshed"):
        IncrementalView(spark, folder, ["place"], MEASURES).read()


def test_catalog_view_follows_the_feed_of_a_table(spark, folder):
    tables = Medallion(spark, "incremental_test", folder)
    for state in ([(1, "a", 1.0, 1), (2, "b", 2.0, 2)], [(1, "a", 1.0, 1), (3, "a", 4.0, 0)]):
        df = spark.createDataFrame(state, SCHEMA).withColumns({
            "data_quality_flag": F.lit("CLEAN"), "audit_timestamp": F.current_timestamp(),
            "source_system": F.lit("shop")})
        tables.materialized(
            "silver_sales", lambda t, df=df: df, Governance("silver", "Sales", "data-engineering", "sales"), key=["id"])
        tables.incremental(
            "gold_sales", "silver_sales", ["place"], MEASURES, Governance("gold", "Sales by place", "data-engineering", "sales"))
        reports = tables.run()
        assert rows(tables.ref("gold_sales")) == recomputed(df)
    assert reports[1]["groups"] == 2 and tables.run("gold_sales")[0]["version"] == 2
    tables.vacuum()
    assert rows(tables.ref("gold_sales")) == recomputed(df)
    with pytest.raises(ValueError, match="no change feed"):
        tables.incremental("gold_x", "gold_sales", ["place"], MEASURES, Governance("gold", "x", "data-engineering", "sales"))
    with pytest.raises(ValueError, match="personal"):
        tables.incremental("gold_x", "silver_sales", ["email"], MEASURES, Governance("gold", "x", "data-engineering", "sales"))


def test_buckets_cover_every_hash_once():
    directory = dr.Directory.of_size(900, 100, 2)
    assert directory.depth == 4
    split = directory.split({(4, 3): 1000, (4, 5): 100, (4, 7): 101}, 100)
    assert (4, 5) in split.entries and (4, 3) not in split.entries and (8, 3 + 16 * 5) in split.entries
    for value in range(1 << split.depth):
        assert sum(value & ((1 << d) - 1) == b for d, b in split.entries) == 1
    deep = dr.Directory().split({(0, 0): 1 << 60}, 1 << 50)
    assert deep.depth == 10


def test_rows_stay_in_the_bucket_of_their_key(spark):
    directory = dr.Directory().split({(0, 0): 4}, 1).split({(2, 1): 8}, 1)
    df = spark.range(500).select(F.col("id").alias("k"))
    found = directory.placed(df, ["k"]).withColumn("h", F.xxhash64("k")).collect()
    assert len(found) == 500 and {r["_bucket"] for r in found} == {dr.name(b) for b in directory.entries}
    for r in found:
        depth, bits = dr.bucket_of(r["_bucket"])
        assert r["h"] & ((1 << depth) - 1) == bits


def test_buckets_split_as_they_grow_and_untouched_ones_stay(spark, folder):
    schema = "k long, v int, seq int, _change_type string"
    initial = spark.range(200).selectExpr("id AS k", "0 AS v")
    rng, expected = random.Random(5), {k: 0 for k in range(200)}
    for batch in range(4):
        lines = []
        for k in [rng.randrange(3000) for _ in range(400)] if batch < 3 else [5]:
            gone = rng.random() < 0.2
            lines.append((k, batch, batch * 1000 + len(lines), "delete" if gone else "insert"))
            expected.pop(k, None)
            if not gone:
                expected[k] = batch
        spark.createDataFrame(lines, schema).coalesce(1).write.mode("append").parquet(f"{folder}/log")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/log")
        found = stream_changes.apply_stream(
            stream, initial, f"{folder}/target", f"{folder}/check", "k", "seq", bucket_rows=50)
        assert dict(rows(found)) == expected
    numbers = dr.versions(spark, f"{folder}/target")
    last = dr.read(spark, f"{folder}/target", numbers[-1])
    assert len(last.entries) > 16  # what the first 600 rows need
    assert max(e.rows for e in last.entries.values()) <= 100
    assert sum(e.version == numbers[-1] for e in last.entries.values()) <= 2  # the last batch has one key


def test_digests_tell_which_buckets_changed(spark):
    schema = "k int, a string, b string, t double"
    old = spark.createDataFrame([(i, "x", None, 1.0) for i in range(1000)], schema)
    new = old.filter("k <> 7").withColumns({
        # A value that moves to another column changes no hash of values alone.
        "a": F.when(F.col("k") == 11, None).otherwise(F.col("a")), "b": F.when(F.col("k") == 11, "x"),
        "t": F.when(F.col("k") == 13, -1.0).otherwise(F.col("t")),
    }).union(spark.createDataFrame([(5000, "n", "n", 0.0)], schema))
    one, two = (changes.digests(df, "k", 256) for df in (old, new))
    changed = {r["_bucket"] for r in changes.changed_buckets(one, two).collect()}
    keys = spark.createDataFrame([(7,), (11,), (13,), (5000,)], "k int")
    assert changed == {r[0] for r in keys.select(changes.key_bucket(["k"], 256)).collect()}
    found = changes.diff_changed(old, new, "k", changes.changed_buckets(one, two), 256)
    assert rows(found) == rows(changes.diff(old, new, "k"))
    assert changes.changed_buckets(one, changes.digests(old, "k", 256)).count() == 0
    # Columns that are ignored make no difference, NULL keys and maps are fine.
    stamped = old.withColumn("t", F.lit(9.0))
    assert changes.changed_buckets(*(changes.digests(df, "k", 8, ["t"]) for df in (old, stamped))).count() == 0
    odd = spark.createDataFrame([(None, {"a": 1}), (1, None)], "k int, m map<string,int>")
    assert changes.changed_buckets(changes.digests(odd, "k", 8), changes.digests(odd.limit(0), "k", 8)).count() >= 1


def test_refresh_joins_only_changed_buckets(spark, folder, monkeypatch):
    monkeypatch.setattr(changes, "DIGEST_ROWS", 10)
    tables = Medallion(spark, "digest_test", folder)
    joined = []
    whole, part = changes.diff, changes.diff_changed
    monkeypatch.setattr(changes, "diff", lambda old, new, *a, **k: joined.append(old.count() + new.count()) or whole(old, new, *a, **k))
    monkeypatch.setattr(changes, "diff_changed", part)
    states = [spark.range(3000).selectExpr("id", "'a' AS v")]
    states += [states[0], states[0].withColumn("v", F.when(F.col("id") == 77, "b").otherwise(F.col("v"))).filter("id <> 99")]
    states += [states[2].withColumn("more", F.lit(1)), states[2].withColumn("more", F.lit(1))]
    for state in states:
        df = state.withColumns({"data_quality_flag": F.lit("CLEAN"), "audit_timestamp": F.current_timestamp(), "source_system": F.lit("s")})
        tables.materialized("silver_d", lambda t, df=df: df, Governance("silver", "D", "data-engineering", "d"), key=["id"])
        tables.run()
    assert joined[0] == 3000 and joined[1] == 0 and 0 < joined[2] < 200 and joined[3] > 5000 and joined[4] == 0
    feed = tables.changes("silver_d").groupBy("version", "_change_type").count()
    assert rows(feed)[:4] == [(1, "insert", 3000), (3, "delete", 1), (3, "update_postimage", 1), (3, "update_preimage", 1)]
