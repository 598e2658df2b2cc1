import datetime
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tierworks.operators import quality
from tierworks.plans import audit, products as pr
from tierworks.plans.publish import Governance, read_properties
from tierworks.plans.refresh import Medallion
from tierworks.session import fresh_path, subfolders
from tierworks.sources import financial, mirror, readers, sinks, synth
from tierworks.streaming import bronze as stream_bronze, changes as stream_changes

COMMON = {"data_owner": "data-engineering", "domain": "customer"}
TS = "2024-01-01 00:00:00"
COUNTER = iter(range(1000))


@pytest.fixture
def tables(spark):
    name = f"db_{next(COUNTER)}"
    return Medallion(spark, name, fresh_path(spark, name))


def customers(spark, data):
    return spark.createDataFrame(data, "customer_id int, email string, balance double")


def silver(source):
    def build(tables):
        flagged = source().select("customer_id", "balance", quality.flag(quality.negative("balance")))
        return pr.add_audit(flagged, "crm", TS)

    return build


def declare_silver(tables, source, **options):
    tables.materialized(
        "silver_customers", silver(source),
        Governance("silver", "Cleaned customers", **COMMON, docs={"customer_id": "Unique customer"}),
        expectations=[quality.expect("has_id", "customer_id IS NOT NULL", "fail"),
                      quality.expect("has_balance", "balance IS NOT NULL", "drop")],
        key=["customer_id"], **options,
    )


def test_failed_refresh_keeps_the_last_good_table(spark, tables):
    data = [[(1, "a@b.c", 5.0), (2, "d@e.f", None)]]
    declare_silver(tables, lambda: customers(spark, data[0]))
    [first] = tables.run()
    assert (first["input_rows"], first["has_balance"], first["has_id"]) == (2, 1, 0)
    data[0] = [(None, "x@y.z", 1.0)]
    with pytest.raises(quality.ExpectationFailed):
        tables.run()
    assert rows(tables.ref("silver_customers").select("customer_id")) == [(1,)]


def test_refresh_is_repeatable_and_keeps_metadata(spark, tables):
    declare_silver(tables, lambda: customers(spark, [(1, "a@b.c", -5.0)]))
    tables.run()
    before = rows(tables.ref("silver_customers"))
    tables.run()
    assert rows(tables.ref("silver_customers")) == before
    assert before[0][2] == "NEGATIVE_BALANCE"
    name = tables.table("silver_customers")
    properties = read_properties(spark, name)
    assert properties["quality"] == "silver" and properties["change_feed"] == "true"
    assert properties["version"] == "2"
    docs = {f.name: f.metadata.get("comment") for f in spark.table(name).schema.fields}
    assert docs["customer_id"] == "Unique customer"
    assert docs["audit_timestamp"] == "Pipeline execution timestamp"


def test_changed_layout_is_published(spark, tables):
    extra = [False]

    def source():
        df = customers(spark, [(1, "a@b.c", 5.0)])
        return df.withColumn("balance", F.col("balance").cast("int")) if extra[0] else df

    declare_silver(tables, source)
    tables.run()
    extra[0] = True
    tables.run()
    assert dict(tables.ref("silver_customers").dtypes)["balance"] == "int"


def test_feed_and_tracking_across_refreshes(spark, tables):
    data = [[(1, "", 1.0), (2, "", 2.0)]]
    declare_silver(tables, lambda: customers(spark, data[0]), feed=True, track=True)
    tables.run()
    data[0] = [(1, "", 1.0), (2, "", 9.0), (3, "", 3.0)]
    tables.run()
    feed = spark.read.parquet(tables.feed_path("silver_customers"))
    kinds = rows(feed.select("customer_id", "_change_type", "version"))
    assert kinds == [(1, "insert", 1), (2, "insert", 1), (2, "update_postimage", 2),
                     (2, "update_preimage", 2), (3, "insert", 2)]
    versions = rows(tables.ref("silver_customers").select("customer_id", "row_version"))
    assert versions == [(1, 1), (2, 2), (3, 2)]
    assert tables.ref("silver_customers").columns[-2:] == ["audit_timestamp", "source_system"]


def test_death_between_feed_and_publishing_is_repaired(spark, tables, monkeypatch):
    from tierworks.plans import refresh

    data = [[(1, "", 1.0)]]
    declare_silver(tables, lambda: customers(spark, data[0]), feed=True)
    tables.run()
    data[0] = [(1, "", 2.0)]

    def dies(*args):
        raise RuntimeError("killed")

    with monkeypatch.context() as patched:
        patched.setattr(refresh, "attach", dies)
        with pytest.raises(RuntimeError):
            tables.run()
    assert rows(tables.ref("silver_customers").select("balance")) == [(1.0,)]
    tables.run()
    feed = spark.read.parquet(tables.feed_path("silver_customers"))
    assert rows(feed.select("balance", "_change_type", "version")) == [
        (1.0, "insert", 1), (1.0, "update_preimage", 2), (2.0, "update_postimage", 2)
    ]


def test_feed_and_tracking_take_a_new_column(spark, tables):
    def build(df):
        return lambda t: pr.add_audit(df.withColumn("data_quality_flag", F.lit("CLEAN")), "crm", TS)

    governance = Governance("silver", "Cleaned items", **COMMON)
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    second = spark.createDataFrame([(1, "a", 5), (3, "c", None)], "id int, v string, extra int")
    for df in (first, second):
        tables.materialized("silver_items", build(df), governance, key=["id"], track=True)
        tables.run()
    feed = tables.changes("silver_items")
    assert rows(feed.select("id", "_change_type", "version", "extra")) == rows(spark.createDataFrame(
        [(1, "insert", 1, None), (2, "insert", 1, None), (1, "update_preimage", 2, None),
         (1, "update_postimage", 2, 5), (2, "delete", 2, None), (3, "insert", 2, None)],
        "id int, k string, v int, e int"))
    assert rows(tables.ref("silver_items").select("id", "row_version")) == [(1, 2), (3, 2)]
    properties = read_properties(spark, tables.table("silver_items"))
    assert properties["change_feed"] == properties["row_tracking"] == "true"


def test_properties_are_only_stated_when_true(spark, tables):
    df = spark.createDataFrame([(1, 2.0)], "id int, amount double")
    for properties in ({"sla": "daily"}, {}):
        tables.materialized(
            "gold_sums", lambda t: pr.add_audit(df, "gold_aggregation", TS),
            Governance("gold", "Sums", **COMMON, properties=properties,
                       tags={"sla": "1d"} if properties else {},
                       docs={"amount": "Sum"} if properties else {}))
        tables.run()
    said = read_properties(spark, tables.table("gold_sums"))
    assert not {"change_feed", "row_tracking", "sla", "tag.sla"} & set(said)
    assert not tables.ref("gold_sums").schema["amount"].metadata.get("comment")


def test_gold_values_are_guarded(spark, tables):
    df = spark.createDataFrame([("write to anna@example.org",)], "note string")
    tables.materialized("gold_notes", lambda t: pr.add_audit(df, "gold_aggregation", TS),
                        Governance("gold", "Notes", **COMMON))
    with pytest.raises(quality.ExpectationFailed):
        tables.run()
    assert not spark.catalog.tableExists(tables.table("gold_notes"))


def test_vacuum_spares_the_live_folder(spark, tables):
    data = [[(1, "", 1.0)]]
    declare_silver(tables, lambda: customers(spark, data[0]), cluster_by=["balance"])
    for k in range(4):
        data[0] = [(1, "", float(k))]
        tables.run()
    assert len(tables.vacuum(keep=2)) == 2 and tables.vacuum(keep=2) == []
    assert rows(tables.ref("silver_customers").select("balance")) == [(3.0,)]
    assert len(tables.vacuum(keep=0)) == 1
    assert rows(tables.ref("silver_customers").select("balance")) == [(3.0,)]


def test_retention_is_applied_on_refresh(spark, tables):
    df = spark.createDataFrame([(1, datetime.date(2024, 1, 1)), (2, datetime.date(2024, 3, 1))], "id int, day date")
    tables.materialized(
        "bronze_days", lambda t: pr.bronze(df, ["id"], "x", TS),
        Governance("bronze", "Raw days", **COMMON, retention_days=30),
        retain_on="day", run_date="2024-03-15",
    )
    tables.run()
    assert rows(tables.ref("bronze_days").select("id")) == [(2,)]
    assert read_properties(spark, tables.table("bronze_days"))["retention_days"] == "30"


def test_personal_columns_are_labelled(spark, tables):
    df = customers(spark, [(1, "a@b.c", 5.0)])
    tables.materialized("bronze_customers", lambda t: pr.bronze(df, ["customer_id"], "crm", TS),
                        Governance("bronze", "Raw customer data ingested from crm", **COMMON))
    tables.run()
    name = tables.table("bronze_customers")
    properties = read_properties(spark, name)
    assert properties["contains_pii"] == "true" and properties["pii_columns"] == "email"
    assert {k: v for k, v in properties.items() if k.startswith("tag.")} == {
        "tag.quality": "bronze", "tag.domain": COMMON["domain"], "tag.pii": "true",
        "tag.data_classification": "confidential"}
    assert spark.catalog.getTable(name).description.endswith(" - CONTAINS PII: email")
    docs = {f.name: f.metadata.get("comment") for f in spark.table(name).schema.fields}
    assert docs["email"] == "[PII: EMAIL - HIGH]"


@pytest.mark.parametrize(
    "name, layer, options, columns",
    [
        ("customers", "bronze", {}, ["id"]),
        ("bronze_Customers", "bronze", {}, ["id"]),
        ("silver_customers", "silver", {}, ["id"]),
        ("gold_customers", "gold", {}, ["email"]),
        ("bronze_customers", "bronze", {"comment": " "}, ["id"]),
        ("bronze_customers", "bronze", {"properties": {"owner": "me"}}, ["id"]),
        ("bronze_customers", "bronze", {"docs": {"absent": "?"}}, ["id"]),
    ],
)
def test_rule_breaking_tables_are_refused(name, layer, options, columns):
    governance = Governance(**{"layer": layer, "comment": "Text", **COMMON, **options})
    with pytest.raises(ValueError):
        governance.check(name, [*columns, "audit_timestamp", "source_system"])


def test_audit_columns_must_be_last():
    governance = Governance("bronze", "Text", **COMMON)
    with pytest.raises(ValueError):
        governance.check("bronze_x", ["audit_timestamp", "source_system", "id"])


def test_expectations_belong_to_silver(tables):
    with pytest.raises(ValueError):
        tables.materialized("bronze_x", lambda t: None, Governance("bronze", "Text", **COMMON),
                            expectations=[quality.expect("x", "true")])


def test_unknown_reference(tables):
    with pytest.raises(KeyError):
        tables.ref("bronze_absent")


def test_audit_finds_what_is_wrong(spark):
    df = spark.createDataFrame([(1, "CLEAN", "good"), (1, "ODD", "bad"), (None, "CLEAN", None)],
                               "id int, data_quality_flag string, label string")
    contract = audit.Contract("silver", ["id"], {"label": ["good"]})
    found = {r["rule"]: r["failing"] for r in audit.check_frame(df, "silver_x", contract).collect()}
    assert found == {"key_filled": 1, "key_unique": 1, "flag_in_domain": 1, "label_in_domain": 1,
                     "snake_case_names": 0, "layer_prefix": 0, "audit_columns_last": 2,
                     "quality_flag_present": 0}


def test_profile_sketch_and_exact_agree_on_small_tables(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "id int, v string")
    assert rows(audit.profile(df)) == rows(audit.profile(df, exact=True))


# --- streams -----------------------------------------------------------------------

def test_streaming_table_takes_only_new_files(spark, tables, folder):
    schema = "review_id long, review_text string"
    tables.streaming(
        "bronze_reviews",
        lambda t: stream_bronze.prepare(readers.stream_files(spark, folder, schema), ["review_id", "review_text"], "shop", TS),
        Governance("bronze", "Raw reviews ingested from shop", **COMMON, streaming=True),
    )
    spark.createDataFrame([(1, "a"), (None, "b"), (2, None)], schema).write.parquet(folder)
    tables.run()
    assert rows(tables.ref("bronze_reviews").select("review_id")) == [(1,)]
    spark.createDataFrame([(3, "c")], schema).write.mode("append").parquet(folder)
    tables.run()
    tables.run()
    assert rows(tables.ref("bronze_reviews").select("review_id")) == [(1,), (3,)]
    properties = read_properties(spark, tables.table("bronze_reviews"))
    assert "row_tracking" not in properties and properties["quality"] == "bronze"


def test_streams_do_not_promise_retention(tables):
    with pytest.raises(ValueError):
        tables.streaming("bronze_s", lambda t: None,
                         Governance("bronze", "Raw", **COMMON, streaming=True, retention_days=3))


def test_stream_over_a_table(spark, tables, folder):
    df = customers(spark, [(1, "a@b.c", 5.0), (None, "d@e.f", 1.0)])
    tables.materialized("bronze_customers", lambda t: pr.add_audit(df, "crm", TS),
                        Governance("bronze", "Raw customer data ingested from crm", **COMMON))
    tables.run()
    stream = readers.stream_table(spark, tables.table("bronze_customers"))
    stream_bronze.append(stream.filter("customer_id IS NOT NULL"), f"{folder}/out", f"{folder}/check")
    assert spark.read.parquet(f"{folder}/out").count() == 1


def test_stream_of_csv_equals_batch(spark, folder):
    df = spark.createDataFrame([(i, f"name {i}") for i in range(20)], "id int, name string")
    sinks.csv(df, f"{folder}/in")
    stream = readers.stream_files(spark, f"{folder}/in", df.schema, "csv", files_per_trigger=1)
    stream_bronze.append(stream, f"{folder}/out", f"{folder}/check")
    assert rows(spark.read.parquet(f"{folder}/out")) == rows(readers.csv(spark, f"{folder}/in", df.schema))


def test_changes_over_several_batches(spark, folder):
    schema = "k int, v string, seq int, _change_type string"
    initial = spark.createDataFrame([(1, "old", 0)], "k int, v string, seq int")

    def run():
        stream = readers.stream_files(spark, f"{folder}/log", schema)
        return stream_changes.apply_stream(stream, initial, f"{folder}/target", f"{folder}/check", "k", "seq")

    spark.createDataFrame([(1, "x", 2, "insert"), (2, "y", 1, "insert")], schema).write.parquet(f"{folder}/log")
    assert rows(run()) == [(1, "x", 2), (2, "y", 1)]
    late = [(1, "late", 1, "insert"), (2, None, 2, "delete")]
    spark.createDataFrame(late, schema).write.mode("append").parquet(f"{folder}/log")
    assert rows(run()) == [(1, "x", 2)]
    assert rows(run()) == [(1, "x", 2)]


def test_a_late_change_does_not_bring_a_deleted_row_back(spark, folder):
    schema = "k int, v string, seq int, _change_type string"
    initial = spark.createDataFrame([(k, "old") for k in range(40)], "k int, v string")

    def send(*lines):
        spark.createDataFrame(list(lines), schema).write.mode("append").parquet(f"{folder}/log")
        stream = readers.stream_files(spark, f"{folder}/log", schema)
        return dict(rows(stream_changes.apply_stream(
            stream, initial, f"{folder}/target", f"{folder}/check", "k", "seq", buckets=8)))

    def files():
        return {r["path"].split("/target/")[1] for r in spark.read.format("binaryFile").option(
            "recursiveFileLookup", True).load(f"{folder}/target/version=0").select("path").collect()}

    found = send((1, None, 5, "delete"), (2, "new", 5, "update_postimage"))
    assert 1 not in found and found[2] == "new" and found[3] == "old" and len(found) == 39
    before = files()
    assert send((1, "late", 3, "insert"), (2, "late", 4, "update_postimage")) == found
    assert files() == before
    assert len(subfolders(spark, f"{folder}/target/version=1")) <= 2
    assert send((1, "again", 6, "insert")) == found | {1: "again"}


# --- sources -------------------------------------------------------------------------

def test_synthetic_tables_have_their_sizes_and_parents(spark):
    rows_wanted = dict(financial.ROWS) | {"customers": 500, "accounts": 800, "transactions": 2000}
    made = {n: financial.table(spark, n, rows_wanted, partitions=2) for n in financial.ROWS}
    for name, df in made.items():
        assert df.count() == rows_wanted[name]
    for child, key, parent in [("accounts", "customer_id", "customers"), ("accounts", "product_id", "products"),
                               ("transactions", "account_id", "accounts"), ("accounts", "branch_id", "branches")]:
        assert made[child].join(made[parent], key, "left_anti").count() == 0
    for name, key in [("customers", "customer_id"), ("transactions", "transaction_id")]:
        assert made[name].select(key).distinct().count() == rows_wanted[name]


def test_synthetic_values_do_not_depend_on_partitions(spark):
    one, many = (rows(financial.table(spark, "customers", dict(financial.ROWS) | {"customers": 300}, partitions=n))
                 for n in (1, 7))
    assert one == many


def test_weights_and_null_shares_are_met(spark):
    t = financial.table(spark, "transactions", dict(financial.ROWS) | {"transactions": 40000})
    got = t.agg(
        F.avg((F.col("status") == "Completed").cast("double")), F.avg(F.col("merchant_name").isNull().cast("double")),
        F.avg("amount"), F.min("amount"), F.max("amount"),
    ).first()
    assert got[0] == pytest.approx(0.96, abs=0.01)
    assert got[1] == pytest.approx(0.4, abs=0.02)
    assert got[2] == pytest.approx(5000, rel=0.03) and got[3] >= 1 and got[4] <= 10000


def test_template_shapes(spark):
    spec = {"a": synth.template(r"BR\d\d\d"), "b": synth.template(r"+1 \d\d\d-\w+ \w\w'x"), "c": synth.template(r"\w+.\w+\d@x")}
    for r in synth.table(spark, spec, 50, 2).collect():
        import re

        assert re.fullmatch(r"BR\d{3}", r["a"])
        assert re.fullmatch(r"\+1 \d{3}-[a-z]{6} [a-z]{2}'x", r["b"])
        assert re.fullmatch(r"[a-z]{6}\.[a-z]{6}\d@x", r["c"])


def test_positional_lists_stay_in_step(spark):
    made = financial.table(spark, "products")
    pairs = {(r["product_name"], r["product_category"]) for r in made.collect()}
    assert pairs == {(n, c) for c, names in financial.PRODUCTS.items() for n in names}
    assert made.filter("product_category = 'Loan' AND product_type <> 'Liability'").count() == 0


def test_bad_generator_arguments(spark):
    with pytest.raises(ValueError):
        synth.choice(["a"], [0.1, 0.2])
    with pytest.raises(ValueError):
        synth.choice(["a"]).nulls(1.5)
    with pytest.raises(ValueError):
        financial.table(spark, "unknown")
    with pytest.raises(ValueError):
        financial.table(spark, "branches", dict(financial.ROWS) | {"branches": 10**6})
    with pytest.raises(ValueError):
        financial.write_all(spark, "")


def test_write_all_and_inventory(spark, folder):
    small = {"branches": 20, "products": 32, "date_dimensions": 60, "customers": 50, "accounts": 80, "transactions": 100}
    financial.write_all(spark, folder, small)
    lines = {r["directory"]: r for r in readers.file_inventory(spark, folder, "*.csv").collect()}
    assert set(lines) == set(small)
    for name in small:
        parts = [f for f in os.listdir(f"{folder}/{name}") if f.endswith(".csv")]
        assert lines[name]["file_count"] == len(parts)
    schema = financial.table(spark, "customers").schema
    assert readers.csv(spark, f"{folder}/customers", schema).count() == 50


def test_mirror_needs_a_source_and_its_required_tables(spark, folder):
    spark.range(3).write.parquet(f"{folder}/src/a")
    spark.sql(f"CREATE DATABASE mirror_t LOCATION '{folder}/db'")
    good = f"parquet.`{folder}/src/{{table}}`"
    with pytest.raises(mirror.MirrorFailed):
        mirror.tables(spark, [("a", "a")], ["nowhere.{table}"], "mirror_t")
    with pytest.raises(mirror.MirrorFailed):
        mirror.tables(spark, [("a", "a"), ("b", "b")], [good], "mirror_t", required=["b"])
    for _ in range(2):
        report = mirror.tables(spark, [("a", "a"), ("b", "b")], ["nowhere.{table}", good], "mirror_t", required=["a"])
        assert [(r["target"], r["status"].split(":")[0], r["target_rows"]) for r in report.collect()] == [
            ("a", "copied", 3), ("b", "skipped", None)
        ]
    assert rows(mirror.verify(spark, "mirror_t")) == [("a", 3)]


def test_a_failing_copy_leaves_the_last_good_one(spark, folder):
    spark.sql(f"CREATE DATABASE mirror_f LOCATION '{folder}/db'")
    spark.range(5).createOrReplaceTempView("mirror_source_a")
    assert mirror.tables(spark, [("a", "a")], ["mirror_source_{table}"], "mirror_f").first()["status"] == "copied"
    stop = F.raise_error(F.lit("broken")).cast("long")
    broken = spark.range(9).select(F.when(F.col("id") == 7, stop).otherwise(F.col("id")).alias("id"))
    broken.createOrReplaceTempView("mirror_source_a")
    spark.range(1).createOrReplaceTempView("mirror_source_probe")
    report = mirror.tables(spark, [("a", "a")], ["mirror_source_{table}"], "mirror_f", probe="probe")
    assert report.first()["status"].startswith("skipped")
    assert rows(spark.table("mirror_f.a")) == [(k,) for k in range(5)]


def test_foreign_keys_reach_parents_beyond_one_draw(spark):
    from tierworks.sources import synth

    width = 8_000_000_000
    drawn = spark.range(2000).selectExpr(f"pmod({synth.draw_for(1, 'c', width)}, {width}L) AS v")
    low, high = drawn.selectExpr("min(v)", "max(v)").first()
    assert 0 <= low < width * 0.01 and width * 0.99 < high < width
    with pytest.raises(ValueError):
        synth.draw_for(1, "c", 2**63)


def test_clustering_keeps_rows_and_splits_hot_keys(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") < 3000, 1).otherwise(F.col("id")).alias("k"))
    laid = sinks.clustered(df, ["k"], 8)
    assert rows(laid) == rows(df)
    biggest = laid.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert biggest < 2000
