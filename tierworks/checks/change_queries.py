"""Changes, streams, refreshes, sinks and mirrors on the shared test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierworks.checks import tables as tb, text_queries as tq
from tierworks.checks.tables import AS_OF, RUN_TS, audit_sql, with_views
from tierworks.checks.tables_queries import ORACLE as TABLE_ORACLE
from tierworks.checks.text_queries import ORACLE as TEXT_ORACLE
from tierworks.functions import calendar
from tierworks.operators import changes, drift, personal_data, retract
from tierworks.plans import audit, products as pr
from tierworks.plans.publish import Governance, attach
from tierworks.plans.refresh import Medallion
from tierworks.session import fresh_path
from tierworks.sources import mirror, readers, sinks
from tierworks.streaming import bronze as stream_bronze, changes as stream_changes

FEED_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                "o_orderpriority"]


def _before(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as they stood at the start of 2001."""
    orders = tb.read(spark, sf, "orders")
    return orders.filter(F.col("o_orderdate") < "2001-01-01").select(*FEED_COLUMNS)


def _after(spark: SparkSession, sf: str) -> DataFrame:
    """Later: small orders are gone, old pending ones finished, new ones came."""
    done = (F.col("o_orderstatus") == "P") & (F.col("o_orderdate") < "1997-01-01")
    status = F.when(done, F.lit("F")).otherwise(F.col("o_orderstatus"))
    orders = tb.read(spark, sf, "orders").withColumn("o_orderstatus", status)
    return orders.filter("o_totalprice >= 20000").select(*FEED_COLUMNS)


def change_feed(spark, sf):
    return changes.diff(_before(spark, sf), _after(spark, sf), "o_orderkey")


def change_feed_bucketed(spark, sf):
    """The same from two tables bucketed by the key: no shuffle for the join."""
    database = f"buckets_{uuid.uuid4().hex}"
    root = fresh_path(spark, database)
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}'")
    for name, df in [("before", _before(spark, sf)), ("after", _after(spark, sf))]:
        sinks.write_bucketed(df, f"{database}.{name}", f"{root}/{name}", "o_orderkey", 8)
    return changes.diff(
        spark.table(f"{database}.before"), spark.table(f"{database}.after"), "o_orderkey"
    )


def change_feed_digests(spark, sf):
    """The same from digests of key buckets: only buckets that differ are joined."""
    before, after = _before(spark, sf), _after(spark, sf)
    buckets = changes.buckets_for(after.count(), 20)
    sides = [changes.digests(df, "o_orderkey", buckets) for df in (before, after)]
    return changes.diff_changed(before, after, "o_orderkey", changes.changed_buckets(*sides), buckets)


def change_replay(spark, sf):
    feed = changes.diff(_before(spark, sf), _after(spark, sf), "o_orderkey")
    return changes.replay(_before(spark, sf), feed, "o_orderkey")


def row_tracking(spark, sf):
    first = changes.track_rows(_before(spark, sf), "o_orderkey", 1)
    return changes.track_merge(first, _after(spark, sf), "o_orderkey", 2)


def _profiles(spark, sf) -> DataFrame:
    """One row per customer before any event."""
    return tb.read(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), F.lit("none").alias("event_type"),
        F.lit(0.0).alias("value"),
    )


def _as_changes(events: DataFrame) -> DataFrame:
    kind = F.when(F.col("event_type") == "error", F.lit(changes.DELETE)).otherwise(
        F.lit(changes.INSERT)
    )
    return events.select("user_id", "event_type", "value", "ts", "event_id",
                         kind.alias(changes.CHANGE_COLUMN))


def cdc_apply(spark, sf):
    """Last event per user wins; an error removes the user."""
    log = _as_changes(tb.read(spark, sf, "events"))
    return changes.apply(_profiles(spark, sf), log, "user_id", ["ts", "event_id"])


def _event_stream(spark, sf) -> DataFrame:
    schema = tb.read(spark, sf, "events").schema
    # A pattern, so that it does not matter whether the table is a file or a folder.
    return readers.stream_files(spark, f"{sf}/events.parquet*", schema)


def cdc_apply_stream(spark, sf):
    root = fresh_path(spark, "cdc")
    return stream_changes.apply_stream(
        _as_changes(_event_stream(spark, sf)), _profiles(spark, sf), f"{root}/target",
        f"{root}/checkpoint", "user_id", ["ts", "event_id"],
    )


def cdc_apply_late(spark, sf):
    """The same events in batches that arrive in reverse order, deletes among them."""
    root = fresh_path(spark, "late")
    log = _as_changes(tb.read(spark, sf, "events"))
    for part in (3, 2, 1, 0):
        day = F.dayofmonth("ts")
        late = log.filter((day > part * 8) & (day <= part * 8 + 8))
        late.coalesce(1).write.mode("append").parquet(f"{root}/log")
    stream = readers.stream_files(spark, f"{root}/log", log.schema, files_per_trigger=1)
    return stream_changes.apply_stream(
        stream, _profiles(spark, sf), f"{root}/target", f"{root}/checkpoint", "user_id",
        ["ts", "event_id"], buckets=8,
    )


def feed_replay_versions(spark, sf):
    """The whole feed of a table over three versions, one with a new column, replayed."""
    name = f"feed_{uuid.uuid4().hex}"
    tables = Medallion(spark, name, fresh_path(spark, name))
    steps = [_before(spark, sf), _after(spark, sf),
             _after(spark, sf).withColumn("is_large", F.col("o_totalprice") > 200000)]
    for step in steps:
        tables.materialized(
            "silver_orders",
            lambda t, step=step: pr.bronze(
                step.withColumn("data_quality_flag", F.lit("CLEAN")), ["o_orderkey"], "shop", RUN_TS),
            Governance("silver", "Cleaned orders of the shop", "data-engineering", "orders"),
            key=["o_orderkey"], track=True,
        )
        tables.run()
    feed = tables.changes("silver_orders")
    nothing = tables.ref("silver_orders").limit(0)
    rebuilt = changes.apply(nothing, feed, "o_orderkey", "version")
    return rebuilt.select(*FEED_COLUMNS, "is_large")


def cdc_apply_split(spark, sf):
    """The same changes, day by day, into buckets of 200 rows that split as they grow."""
    root = fresh_path(spark, "split")
    log = _as_changes(tb.read(spark, sf, "events"))
    for part in range(4):
        log.filter(F.dayofmonth("ts") % 4 == part).write.mode("append").parquet(f"{root}/log")
    stream = readers.stream_files(spark, f"{root}/log", log.schema, files_per_trigger=2)
    return stream_changes.apply_stream(
        stream, _profiles(spark, sf), f"{root}/target", f"{root}/checkpoint", "user_id",
        ["ts", "event_id"], bucket_rows=200,
    )


MEASURES = [
    retract.Measure("order_count", "count"),
    retract.Measure("customer_values", "count", "nullif(o_custkey % 5, 0)"),
    retract.Measure("total_price", "sum", "o_totalprice"),
    retract.Measure("mean_price", "avg", "o_totalprice"),
    retract.Measure("first_day", "min", "o_orderdate"),
    retract.Measure("highest_price", "max", "o_totalprice"),
]


def _order_versions(spark, sf) -> list[DataFrame]:
    """Three states of the orders: inserts, then updates and deletes, then a few of each."""
    after = _after(spark, sf)
    few = after.filter(F.col("o_orderkey") % 50 != 7).withColumn(
        "o_totalprice",
        F.when(F.col("o_orderkey") % 60 == 1, F.col("o_totalprice") + 100.25).otherwise(F.col("o_totalprice")),
    )
    return [_before(spark, sf), after, few]


def incremental_view(spark, sf):
    """Measures by month, brought up to date from three versions of a change feed."""
    name = f"increments_{uuid.uuid4().hex}"
    tables = Medallion(spark, name, fresh_path(spark, name))
    for step in _order_versions(spark, sf):
        tables.materialized(
            "silver_orders",
            lambda t, step=step: pr.bronze(
                step.withColumns({"data_quality_flag": F.lit("CLEAN"), "order_month": F.trunc("o_orderdate", "month")}),
                ["o_orderkey"], "shop", RUN_TS),
            Governance("silver", "Cleaned orders of the shop", "data-engineering", "orders"),
            key=["o_orderkey"],
        )
        tables.incremental(
            "gold_orders_by_month", "silver_orders", ["order_month", "o_orderstatus"], MEASURES,
            Governance("gold", "Orders by month and status", "data-engineering", "orders"), bucket_rows=64,
        )
        tables.run()
    return tables.ref("gold_orders_by_month")


PRICES = [25000.0, 50000.0, 100000.0, 150000.0, 200000.0, 300000.0]


def _histograms(spark, sf):
    return [drift.histograms(df, ["o_orderstatus", "o_orderpriority"], {"o_totalprice": PRICES})
            for df in (_before(spark, sf), _after(spark, sf))]


def drift_versions(spark, sf):
    """How far the orders moved between two versions."""
    return drift.compare(*_histograms(spark, sf))


def drift_labels(spark, sf):
    """The days of one version that the other lacks, as labels."""
    days = [drift.histograms(df, ["o_orderdate"], {}) for df in (_before(spark, sf), _after(spark, sf))]
    return drift.moved_labels(*days)


EMAIL_POLICY = {
    "email": {"full": "email", "partial": "concat(left(trim(email), 3), '***')", "none": "'***'"},
    "phone": {"full": "phone", "none": "CAST(NULL AS STRING)"},
}


def granted_view(spark, sf):
    """One view, read without a grant, with a partial and with a full one."""
    database = f"granted_{uuid.uuid4().hex}"
    root = fresh_path(spark, database)
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}'")
    people, grants = f"{database}.customers", f"{database}.grants"
    tb.customers(spark, sf).select("customer_id", "email", "phone").write.option(
        "path", f"{root}/people").format("parquet").saveAsTable(people)
    spark.sql(f"CREATE TABLE {grants} (user_name STRING, table_name STRING, level STRING) USING parquet LOCATION '{root}/grants'")
    personal_data.granted_view(spark, f"{database}.shown", people, EMAIL_POLICY, grants)
    found = None
    for level in ("none", "partial", "full"):
        if level != "none":
            spark.sql(f"INSERT INTO {grants} SELECT current_user(), '{people}', '{level}'")
        seen = spark.table(f"{database}.shown").withColumn("granted", F.lit(level))
        # Written, since a view shows what is granted when it is read.
        seen.write.parquet(f"{root}/seen-{level}")
        seen = spark.read.schema(seen.schema).parquet(f"{root}/seen-{level}")
        found = seen if found is None else found.unionByName(seen)
    return found


def gold_guard(spark, sf):
    """What the guard says about a good gold frame and a bad one."""
    people = tb.customers(spark, sf)
    good = people.groupBy("region", "customer_segment").agg(F.count("*").alias("customer_count"))
    bad = people.select(
        "region", "date_of_birth", F.sha2("email", 256).alias("email_hash"),
        F.concat(F.lit("written to "), F.trim("email")).alias("note"),
    )
    parts = [personal_data.gold_report(df).withColumn("frame", F.lit(n))
             for n, df in (("good", good), ("bad", bad))]
    return parts[0].unionByName(parts[1])


def bronze_events_stream(spark, sf):
    root = fresh_path(spark, "events")
    prepared = stream_bronze.prepare(_event_stream(spark, sf), ["event_id"], "clickstream", RUN_TS)
    stream_bronze.append(prepared, f"{root}/data", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/data")


def dedupe_replay(spark, sf):
    """Every event is delivered twice; each is kept once."""
    root = fresh_path(spark, "replay")
    events = tb.read(spark, sf, "events")
    for _ in range(2):
        events.write.mode("append").parquet(f"{root}/landing")
    stream = readers.stream_files(spark, f"{root}/landing", events.schema)
    once = stream_bronze.drop_replays(stream, ["event_id"], "ts", "60 days")
    stream_bronze.append(once, f"{root}/data", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/data")


def incremental_consume(spark, sf):
    """Two feed versions arrive; each run of the consumer sees only the new one."""
    root = fresh_path(spark, "consume")
    old, new = _before(spark, sf), _after(spark, sf)

    def handle(batch: DataFrame, number: int) -> None:
        counted = batch.groupBy(changes.CHANGE_COLUMN).agg(F.count("*").alias("row_count"))
        run = F.lit(number).cast("long").alias("run")
        counted.select(run, F.col(changes.CHANGE_COLUMN).alias("change_type"), "row_count").write.mode(
            "overwrite"
        ).parquet(f"{root}/seen/batch={number}")

    for version, (a, b) in enumerate([(old, new), (new, old)], start=1):
        feed = changes.diff(a, b, "o_orderkey")
        feed.write.parquet(f"{root}/feed/version={version}")
        schema = feed.withColumn("version", F.lit(version)).schema
        stream_changes.consume(
            readers.stream_files(spark, f"{root}/feed", schema), f"{root}/checkpoint", handle
        )
    return spark.read.parquet(f"{root}/seen").select("run", "change_type", "row_count")


def csv_round_trip(spark, sf):
    path = fresh_path(spark, "csv")
    customers = tb.customers(spark, sf).withColumn("email", F.trim("email"))
    sinks.csv(customers, path)
    return readers.csv(spark, path, customers.schema)


def clustered_write(spark, sf):
    path = fresh_path(spark, "clustered")
    orders = tb.read(spark, sf, "orders")
    sinks.write(orders, path, cluster_by=["o_orderstatus", "o_totalprice"])
    return spark.read.parquet(path)


def clustered_auto(spark, sf):
    """Orders on a curve over the columns that were chosen for them."""
    path = fresh_path(spark, "auto")
    sinks.write(tb.read(spark, sf, "orders"), path, cluster_by=sinks.AUTO)
    return spark.read.parquet(path)


def cluster_report(spark, sf):
    """Whether range filters on two columns open fewer files on a curve than after a sort."""
    columns = ["o_custkey", "o_totalprice"]
    totals = []
    for name, laid in (("sorted", sinks.clustered), ("curve", sinks.on_curve)):
        path = fresh_path(spark, name)
        laid(tb.read(spark, sf, "orders"), columns, 16).write.parquet(path)
        report = sinks.files_opened(spark.read.parquet(path), columns)
        totals.append(report.agg(F.count("*").alias("column_count"), F.sum("opened").alias(name)))
    both = totals[0].join(totals[1], "column_count")
    return both.select("column_count", (F.col("curve") < F.col("sorted")).alias("fewer_files"))


def file_inventory(spark, sf):
    """Orders in one folder per status and one file per folder, with the rows of each."""
    path = fresh_path(spark, "inventory")
    orders = tb.read(spark, sf, "orders").withColumn("status", F.col("o_orderstatus"))
    orders.repartition("status").write.partitionBy("status").parquet(path)
    rows = spark.read.parquet(path).groupBy(F.concat(F.lit("status="), "status").alias("directory"))
    files = readers.file_inventory(spark, path, "*.parquet").select("directory", "file_count")
    return files.join(rows.agg(F.count("*").alias("row_count")), "directory", "left")


MIRRORED = [("customer.parquet", "customers"), ("supplier.parquet", "franchises"),
            ("orders.parquet", "transactions"), ("missing.parquet", "absent")]


def _mirror(spark, sf) -> tuple[str, DataFrame]:
    database = f"mirror_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{fresh_path(spark, database)}'")
    sources = ["no_such_catalog.{table}", f"parquet.`{sf}/{{table}}`"]
    done = mirror.tables(spark, MIRRORED, sources, database, required=["customers"])
    return database, done


def mirror_tables(spark, sf):
    report = _mirror(spark, sf)[1]
    return report.withColumn("status", F.split_part("status", F.lit(":"), F.lit(1)))


def mirror_verify(spark, sf):
    return mirror.verify(spark, _mirror(spark, sf)[0])


SEGMENT_DOCS = {"region": "Region of the customers", "customer_count": "Number of customers"}


def medallion(spark, sf) -> Medallion:
    """The customer tables from bronze to gold, declared but not refreshed."""
    name = f"bank_{uuid.uuid4().hex}"
    tables = Medallion(spark, name, fresh_path(spark, name))
    common = {"data_owner": "data-engineering", "domain": "customer"}
    raw = tb.customers(spark, sf)
    tables.materialized(
        "bronze_customers",
        lambda t: pr.bronze(raw, ["customer_id"], "crm_system", RUN_TS),
        Governance("bronze", "Raw customer data ingested from crm_system", **common,
                   docs={"customer_id": "Unique customer identifier from crm_system"}),
        key=["customer_id"],
    )
    tables.materialized(
        "silver_customers",
        lambda t: pr.silver_customers(t.ref("bronze_customers"), AS_OF, "crm_system", RUN_TS),
        Governance("silver", "Cleaned and validated customers from bronze_customers", **common,
                   docs={"customer_id": "Unique customer identifier from crm_system"},
                   tags={"data_classification": "confidential", "sla": "daily"}),
        expectations=pr.CUSTOMER_EXPECTATIONS,
        key=["customer_id"],
        feed=True,
    )
    tables.materialized(
        "gold_customer_segments",
        lambda t: pr.gold_customer_segments(t.ref("silver_customers"), RUN_TS),
        Governance("gold", "Business aggregation: customers by region and tiers", **common,
                   docs=SEGMENT_DOCS),
        key=["region", "income_tier", "credit_tier"],
    )
    return tables


def _review_tables(spark, sf) -> Medallion:
    """Mirrored documents, streamed to bronze, enriched to silver, counted to gold."""
    name = f"voice_{uuid.uuid4().hex}"
    tables = Medallion(spark, name, fresh_path(spark, name))
    candidates = ["no_such_catalog.{table}", f"parquet.`{sf}/{{table}}`"]
    mirror.tables(spark, [("documents.parquet", "customer_reviews")], candidates, name,
                  required=["customer_reviews"])
    common = {"data_owner": "dsml", "domain": "customer_voice"}
    key_doc = {"review_id": "Unique review identifier from customer_reviews"}

    def arriving(t: Medallion) -> DataFrame:
        raw = readers.stream_table(spark, t.table("customer_reviews"))
        return pr.bronze_reviews(tb.as_reviews(raw), "voice_of_customer", RUN_TS)

    tables.streaming(
        "bronze_reviews", arriving,
        Governance("bronze", "Raw reviews ingested from customer_reviews", **common, docs=key_doc,
                   streaming=True),
    )
    tables.materialized(
        "silver_review_sentiment",
        lambda t: pr.silver_review_sentiment(
            t.ref("bronze_reviews"), "voice_of_customer", RUN_TS, tq.LEXICON,
            tq.TAXONOMY, tq.FIELDS,
        ),
        Governance("silver", "Reviews with sentiment, topic and entities from bronze_reviews",
                   **common, docs=key_doc, tags={"ai_generated": "true"}),
        expectations=pr.review_expectations(tq.TAXONOMY),
        key=["review_id"],
    )
    tables.materialized(
        "gold_review_topics_by_franchise",
        lambda t: pr.gold_review_topics_by_franchise(
            t.ref("silver_review_sentiment"), tb.franchises(spark, sf), RUN_TS
        ),
        Governance("gold", "Business aggregation: review mood by franchise and topic", **common),
    )
    return tables


def bronze_reviews_stream(spark, sf):
    tables = _review_tables(spark, sf)
    tables.run("bronze_reviews")
    return tables.ref("bronze_reviews")


def review_tables_refresh(spark, sf):
    tables = _review_tables(spark, sf)
    tables.run()
    return tables.ref("gold_review_topics_by_franchise")


def account_tables_refresh(spark, sf):
    """Accounts and products through all layers, clustered by what gold reads."""
    tables = medallion(spark, sf)
    common = {"data_owner": "data-engineering", "domain": "accounts"}
    held, sold = tb.accounts(spark, sf), tb.products(spark, sf)
    for layer, name, build, options in [
        ("bronze", "accounts", lambda t: pr.bronze(held, ["account_id"], "core_banking", RUN_TS), {}),
        ("bronze", "products", lambda t: pr.bronze(sold, ["product_id"], "catalog", RUN_TS), {}),
        ("silver", "accounts",
         lambda t: pr.silver_accounts(t.ref("bronze_accounts"), "core_banking", RUN_TS),
         {"expectations": pr.ACCOUNT_EXPECTATIONS, "cluster_by": ["customer_id"]}),
        ("silver", "products",
         lambda t: pr.silver_products(t.ref("bronze_products"), "catalog", RUN_TS),
         {"expectations": pr.PRODUCT_EXPECTATIONS, "key": ["product_id"], "track": True}),
        ("gold", "account_summary",
         lambda t: pr.gold_account_summary(
             t.ref("silver_customers"), t.ref("silver_accounts"), t.ref("silver_products"), RUN_TS),
         {}),
    ]:
        governance = Governance(layer, f"{layer} {name.replace('_', ' ')} of the bank", **common)
        tables.materialized(f"{layer}_{name}", build, governance, **options)
    tables.run("bronze_customers", "silver_customers", "bronze_accounts", "bronze_products",
               "silver_accounts", "silver_products", "gold_account_summary")
    return tables.ref("gold_account_summary")


CONTRACTS = {
    "bronze_customers": audit.Contract("bronze", ["customer_id"]),
    "silver_customers": audit.Contract(
        "silver", ["customer_id"],
        {"income_tier": ["High Income", "Upper Middle", "Middle", "Lower Middle"]},
    ),
    "gold_customer_segments": audit.Contract("gold"),
}


def medallion_refresh(spark, sf):
    """Staged, checked and published three-layer refresh; read back from the catalog."""
    tables = medallion(spark, sf)
    tables.run()
    return tables.ref("gold_customer_segments")


def table_audit(spark, sf):
    tables = medallion(spark, sf)
    tables.run()
    return audit.audit(spark, tables.database, CONTRACTS)


def audit_bad_table(spark, sf):
    """Rules broken by a table that states a feed, row tracking and personal data it lacks."""
    name = f"bad_{uuid.uuid4().hex}"
    root = fresh_path(spark, name)
    spark.sql(f"CREATE DATABASE {name} LOCATION '{root}'")
    nations = pr.bronze(tb.read(spark, sf, "nation"), ["n_nationkey"], "shop", RUN_TS)
    nations.write.parquet(f"{root}/silver_nations/v1")
    attach(spark, f"{name}.silver_nations", f"{root}/silver_nations/v1", nations.schema,
           Governance("silver", "Nations of the shop", "data-engineering", "shop",
                      properties={"change_feed": "true", "row_tracking": "true", "tag.pii": "true"}))
    found = audit.audit(spark, name, {"silver_nations": audit.Contract("silver", ["n_nationkey"])})
    return found.filter("NOT passed")


def frame_audit(spark, sf):
    """Rules on an ungoverned table: most of them fail."""
    contract = audit.Contract("silver", ["l_orderkey", "l_linenumber"], {"l_returnflag": ["A", "N"]})
    return audit.check_frame(tb.read(spark, sf, "lineitem"), "LineItem", contract)


def column_profile(spark, sf):
    return audit.profile(tb.read(spark, sf, "customer"), exact=True)


def date_dimension(spark, sf):
    """Calendar attributes of every day on which orders were placed."""
    orders = tb.read(spark, sf, "orders")
    days = orders.groupBy(F.to_date("o_orderdate").alias("d")).agg(F.count("*").alias("order_count"))
    return days.select(
        F.col("d").cast("string").alias("full_date"), *calendar.attributes(F.col("d")), "order_count"
    )


def bronze_date_dimensions(spark, sf):
    """The calendar as a CSV directory, read back with its schema into bronze."""
    path = fresh_path(spark, "dates")
    days = date_dimension(spark, sf)
    sinks.csv(days, path)
    landed = readers.csv(spark, path, days.schema)
    return pr.bronze(landed, ["full_date"], "calendar", RUN_TS)


def pii_table_labels(spark, sf):
    """What the published customer table says about its personal data."""
    tables = medallion(spark, sf)
    tables.run("bronze_customers")
    name = tables.table("bronze_customers")
    shown = ("quality", "data_owner", "domain", "contains_pii", "pii_columns")
    properties = spark.sql(f"SHOW TBLPROPERTIES {name}").filter(F.col("key").isin(*shown))
    published = spark.table(name)
    notes = [(f.name, f.metadata["comment"]) for f in published.schema.fields
             if "[PII" in f.metadata.get("comment", "")]
    described = [("comment", spark.catalog.getTable(name).description), *notes]
    said = properties.unionAll(spark.createDataFrame(described, properties.schema))
    filled = ", ".join(f"struct('{c}' AS key, count({c}) AS filled)" for c, _ in notes)
    counted = published.selectExpr(f"array({filled}) AS columns").selectExpr("inline(columns)")
    return said.join(counted, "key", "left")


QUERIES = {
    f.__name__: f
    for f in (
        change_feed, change_feed_bucketed, change_feed_digests, change_replay, row_tracking, cdc_apply, cdc_apply_stream,
        cdc_apply_late, cdc_apply_split, feed_replay_versions, incremental_view, gold_guard,
        drift_versions, drift_labels, granted_view,
        bronze_events_stream, dedupe_replay, incremental_consume, csv_round_trip, clustered_write, clustered_auto,
        cluster_report,
        file_inventory, mirror_tables, mirror_verify, medallion_refresh, bronze_reviews_stream,
        review_tables_refresh, account_tables_refresh, table_audit, audit_bad_table, frame_audit,
        column_profile, date_dimension, bronze_date_dimensions, pii_table_labels,
    )
}

_LIST = ", ".join(FEED_COLUMNS)
_BEFORE = f"SELECT {_LIST} FROM orders WHERE o_orderdate < '2001-01-01'"
_AFTER = f"""SELECT o_orderkey, o_custkey,
    CASE WHEN o_orderstatus = 'P' AND o_orderdate < '1997-01-01' THEN 'F' ELSE o_orderstatus END
    AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_totalprice >= 20000"""
_FEED = """
    SELECT a.*, 'insert' AS _change_type FROM a LEFT JOIN b USING (o_orderkey) WHERE b.o_custkey IS NULL
    UNION ALL
    SELECT b.*, 'delete' FROM b LEFT JOIN a USING (o_orderkey) WHERE a.o_custkey IS NULL
    UNION ALL
    SELECT b.*, 'update_preimage' FROM b JOIN a USING (o_orderkey)
    WHERE b.o_orderstatus <> a.o_orderstatus
    UNION ALL
    SELECT a.*, 'update_postimage' FROM a JOIN b USING (o_orderkey)
    WHERE b.o_orderstatus <> a.o_orderstatus"""
_APPLIED = """
    WITH last AS (SELECT * FROM events
                  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
    SELECT user_id, event_type, value FROM last WHERE event_type <> 'error'
    UNION ALL
    SELECT c_custkey, 'none', 0.0 FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM last)"""


def _rule_sql(table: str, rule: str, failing: str = "0", source: str = "") -> str:
    return (
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, ({failing}) = 0 AS passed, "
        f"CAST({failing} AS BIGINT) AS failing {source}"
    )


def _audit_sql() -> str:
    layout = ["snake_case_names", "layer_prefix", "audit_columns_last"]
    documents = ["comment_present", "required_properties", "quality_matches_layer", "column_docs",
                 "required_tags", "row_tracking_true"]
    lines = []
    for table, extra in {
        "bronze_customers": ["pii_labelled", "pii_in_comment"],
        "silver_customers": ["quality_flag_present", "change_feed_enabled", "flag_in_domain",
                             "income_tier_in_domain"],
        "gold_customer_segments": ["no_personal_columns", "change_feed_enabled"],
    }.items():
        lines += [_rule_sql(table, r) for r in [*layout, *documents, *extra, "audit_columns_filled"]]
        if table != "gold_customer_segments":
            lines.append(_rule_sql(
                table, "key_filled", "count(*) FILTER (WHERE c_custkey IS NULL)", "FROM customer"))
            lines.append(_rule_sql(
                table, "key_unique", "count(c_custkey) - count(DISTINCT c_custkey)", "FROM customer"))
    return " UNION ALL ".join(lines)


_PERSONAL = {
    "first_name": "NAME - MEDIUM", "last_name": "NAME - MEDIUM", "email": "EMAIL - HIGH",
    "phone": "PHONE - HIGH", "date_of_birth": "DOB - MEDIUM", "credit_score": "FINANCIAL - HIGH",
    "annual_income": "FINANCIAL - HIGH",
}
_CALENDAR = """SELECT CAST(d AS VARCHAR) AS full_date, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key,
           year(d) AS calendar_year, quarter(d) AS calendar_quarter,
           'Q' || quarter(d) || ' ' || year(d) AS calendar_quarter_name,
           month(d) AS month_number, strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_short,
           strftime(d, '%Y-%m') AS year_month, week(d) AS week_of_year, day(d) AS day_of_month,
           dayofweek(d) + 1 AS day_of_week_number, strftime(d, '%A') AS day_of_week_name,
           strftime(d, '%a') AS day_of_week_short,
           CASE WHEN month(d) >= 4 THEN year(d) ELSE year(d) - 1 END AS fiscal_year,
           CAST(floor(((month(d) + 8) % 12) / 3) AS INTEGER) + 1 AS fiscal_quarter,
           CASE WHEN dayofweek(d) IN (0, 6) THEN 'Y' ELSE 'N' END AS is_weekend,
           CASE WHEN last_day(d) = d THEN 'Y' ELSE 'N' END AS is_month_end,
           CASE WHEN month(d) = 12 AND day(d) = 31 THEN 'Y' ELSE 'N' END AS is_year_end,
           order_count
           FROM (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS order_count FROM orders GROUP BY 1)"""
_PROFILE = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,
        count(DISTINCT {c}) AS distinct_count, CAST(min({c}) AS VARCHAR) AS min_value,
        CAST(max({c}) AS VARCHAR) AS max_value FROM customer"""
    for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
)

ORACLE = {
    "change_feed": f"WITH b AS ({_BEFORE}), a AS ({_AFTER}) {_FEED}",
    "change_feed_bucketed": f"WITH b AS ({_BEFORE}), a AS ({_AFTER}) {_FEED}",
    "change_feed_digests": f"WITH b AS ({_BEFORE}), a AS ({_AFTER}) {_FEED}",
    "change_replay": _AFTER,
    "row_tracking":
        f"""WITH b AS ({_BEFORE}), a AS ({_AFTER})
            SELECT a.*, sha256(CAST(a.o_orderkey AS VARCHAR)) AS row_id,
                   CASE WHEN b.o_orderstatus = a.o_orderstatus THEN 1 ELSE 2 END AS row_version
            FROM a LEFT JOIN b USING (o_orderkey)""",
    "cdc_apply": _APPLIED,
    "cdc_apply_stream": _APPLIED,
    "cdc_apply_late": _APPLIED,
    "cdc_apply_split": _APPLIED,
    "incremental_view":
        f"""WITH few AS (
                SELECT * REPLACE (CASE WHEN o_orderkey % 60 = 1 THEN o_totalprice + 100.25
                                       ELSE o_totalprice END AS o_totalprice)
                FROM ({_AFTER}) WHERE o_orderkey % 50 <> 7)
            SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month, o_orderstatus,
                   count(*) AS order_count, count(nullif(o_custkey % 5, 0)) AS customer_values,
                   CAST(sum(CAST(o_totalprice AS DECIMAL(38, 2))) AS DOUBLE) AS total_price,
                   CAST(sum(CAST(o_totalprice AS DECIMAL(38, 2))) AS DOUBLE) / count(*) AS mean_price,
                   min(o_orderdate) AS first_day, max(o_totalprice) AS highest_price
            FROM few GROUP BY ALL""",
    "drift_versions": f"""
        WITH o AS (SELECT 'a' AS side, * FROM ({_BEFORE}) UNION ALL SELECT 'b', * FROM ({_AFTER})),
        v AS (SELECT side, 'o_orderstatus' AS column_name, 'label' AS kind, o_orderstatus AS value FROM o
              UNION ALL SELECT side, 'o_orderpriority', 'label', o_orderpriority FROM o
              UNION ALL SELECT side, 'o_totalprice', 'number', 'bin ' || ({
                  " + ".join(f"CAST(o_totalprice > {x} AS INTEGER)" for x in PRICES)}) FROM o),
        h AS (SELECT column_name, kind, value, count(*) FILTER (side = 'a') AS a, count(*) FILTER (side = 'b') AS b
              FROM v GROUP BY ALL),
        s AS (SELECT *, greatest(a / sum(a) OVER w, 1e-6) AS p, greatest(b / sum(b) OVER w, 1e-6) AS q
              FROM h WINDOW w AS (PARTITION BY column_name))
        SELECT column_name, kind, round(sum((q - p) * ln(q / p)), 6) AS psi,
               round(sum((p * log2(2 * p / (p + q)) + q * log2(2 * q / (p + q))) / 2), 6) AS js,
               count(*) FILTER (kind = 'label' AND a = 0) AS new_labels,
               count(*) FILTER (kind = 'label' AND b = 0) AS gone_labels,
               psi >= 0.2 OR new_labels + gone_labels > 0 AS drifted
        FROM s GROUP BY column_name, kind""",
    "drift_labels": f"""
        WITH a AS (SELECT o_orderdate AS d, count(*) AS n FROM ({_BEFORE}) GROUP BY 1),
        b AS (SELECT o_orderdate AS d, count(*) AS n FROM ({_AFTER}) GROUP BY 1)
        SELECT 'o_orderdate' AS column_name, CAST(d AS VARCHAR) AS value, 'new' AS change, n FROM b ANTI JOIN a USING (d)
        UNION ALL SELECT 'o_orderdate', CAST(d AS VARCHAR), 'gone', n FROM a ANTI JOIN b USING (d)""",
    "granted_view": with_views("""
        SELECT customer_id, granted, CASE granted WHEN 'full' THEN email
                   WHEN 'partial' THEN left(trim(email), 3) || '***' ELSE '***' END AS email,
               CASE granted WHEN 'full' THEN phone END AS phone
        FROM customers, (VALUES ('none'), ('partial'), ('full')) AS g(granted)""", "customers"),
    "feed_replay_versions": f"SELECT *, o_totalprice > 200000 AS is_large FROM ({_AFTER})",
    "gold_guard":
        """SELECT * FROM (VALUES ('date_of_birth', 'DOB', 'name', 'bad'),
           ('email_hash', 'DERIVED', 'name', 'bad'), ('note', 'EMAIL', 'value', 'bad'))
           AS t(column_name, pii_type, evidence, frame)
           WHERE (SELECT count(*) FROM customer WHERE c_custkey IS NOT NULL) > 0""",
    "bronze_events_stream":
        f"SELECT *, {audit_sql('clickstream')} FROM events WHERE event_id IS NOT NULL",
    "dedupe_replay": "SELECT * FROM events",
    "incremental_consume":
        f"""WITH b AS ({_BEFORE}), a AS ({_AFTER}), feed AS ({_FEED})
            SELECT 0 AS run, _change_type AS change_type, count(*) AS row_count FROM feed GROUP BY 2
            UNION ALL
            SELECT 1, CASE _change_type WHEN 'insert' THEN 'delete' WHEN 'delete' THEN 'insert'
                      ELSE _change_type END, count(*) FROM feed GROUP BY 2""",
    "csv_round_trip": with_views(
        "SELECT * REPLACE (trim(email) AS email) FROM customers", "customers"),
    "clustered_write": "SELECT * FROM orders",
    "clustered_auto": "SELECT * FROM orders",
    "cluster_report": "SELECT 2 AS column_count, true AS fewer_files FROM orders LIMIT 1",
    "file_inventory":
        """SELECT 'status=' || o_orderstatus AS directory, 1 AS file_count, count(*) AS row_count
           FROM orders GROUP BY o_orderstatus""",
    "mirror_tables":
        """SELECT 'customer.parquet' AS source, 'customers' AS target, 'copied' AS status,
                  count(*) AS source_rows, count(*) AS target_rows FROM customer
           UNION ALL SELECT 'supplier.parquet', 'franchises', 'copied', count(*), count(*) FROM supplier
           UNION ALL SELECT 'orders.parquet', 'transactions', 'copied', count(*), count(*) FROM orders
           UNION ALL SELECT 'missing.parquet', 'absent', 'skipped', NULL, NULL""",
    "mirror_verify":
        """SELECT 'customers' AS table_name, count(*) AS row_count FROM customer
           UNION ALL SELECT 'franchises', count(*) FROM supplier
           UNION ALL SELECT 'transactions', count(*) FROM orders""",
    "medallion_refresh": TABLE_ORACLE["gold_customer_segments"],
    "bronze_reviews_stream": TABLE_ORACLE["bronze_reviews"],
    "review_tables_refresh": TEXT_ORACLE["gold_review_topics_by_franchise"],
    "account_tables_refresh": TABLE_ORACLE["gold_account_summary"],
    "table_audit": _audit_sql(),
    "audit_bad_table": " UNION ALL ".join(
        _rule_sql("silver_nations", rule, "CASE WHEN count(*) > 0 THEN 1 ELSE 0 END", "FROM nation")
        for rule in ("quality_flag_present", "column_docs", "change_feed_enabled",
                     "required_tags", "row_tracking_true")
    ),
    "frame_audit": " UNION ALL ".join([
        _rule_sql("LineItem", "snake_case_names", "1"), _rule_sql("LineItem", "layer_prefix", "1"),
        _rule_sql("LineItem", "audit_columns_last", "2"),
        _rule_sql("LineItem", "quality_flag_present", "1"),
        _rule_sql("LineItem", "key_filled",
                  "count(*) FILTER (WHERE l_orderkey IS NULL OR l_linenumber IS NULL)", "FROM lineitem"),
        _rule_sql("LineItem", "key_unique", "count(*) - count(DISTINCT (l_orderkey, l_linenumber))",
                  "FROM lineitem"),
        _rule_sql("LineItem", "l_returnflag_in_domain",
                  "count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N'))", "FROM lineitem"),
    ]),
    "column_profile": _PROFILE,
    "date_dimension": _CALENDAR,
    "bronze_date_dimensions": f"SELECT *, {audit_sql('calendar')} FROM ({_CALENDAR})",
    "pii_table_labels": with_views(f"""SELECT key, value, CAST(NULL AS BIGINT) AS filled FROM (VALUES
        ('quality', 'bronze'), ('data_owner', 'data-engineering'), ('domain', 'customer'),
        ('contains_pii', 'true'), ('pii_columns', '{",".join(_PERSONAL)}'),
        ('comment', 'Raw customer data ingested from crm_system - CONTAINS PII: {", ".join(_PERSONAL)}')
        ) AS t(key, value) UNION ALL """ + " UNION ALL ".join(
            f"SELECT '{c}', '[PII: {k}]', count({c}) FROM customers" for c, k in _PERSONAL.items()
        ), "customers"),
}
