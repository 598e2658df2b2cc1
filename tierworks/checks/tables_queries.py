"""Standard tables, quality, personal data and joins on the shared test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierworks.checks import tables as tb
from tierworks.checks.tables import AS_OF, RUN_TS, audit_sql, with_views
from tierworks.functions import masking, text as tx, tiers
from tierworks.operators import aggregates, joins, personal_data, quality, shape
from tierworks.plans import products as pr

INCOME_SQL = """CASE WHEN annual_income >= 250000 THEN 'High Income'
    WHEN annual_income >= 100000 THEN 'Upper Middle'
    WHEN annual_income >= 50000 THEN 'Middle' ELSE 'Lower Middle' END"""
CREDIT_SQL = """CASE WHEN credit_score >= 750 THEN 'Excellent' WHEN credit_score >= 700 THEN 'Good'
    WHEN credit_score >= 650 THEN 'Fair' ELSE 'Poor' END"""
EMAIL_SQL = "sha256(lower(trim(email)))"
PHONE_SQL = "'***-***-' || right(regexp_replace(phone, '[^0-9]', '', 'g'), 4)"
AGE_SQL = f"CAST(floor(date_diff('day', date_of_birth, DATE '{AS_OF}') / 365) AS BIGINT)"
INCOME_FLAG_SQL = """CASE WHEN customer_id IS NULL THEN 'MISSING_CUSTOMER_ID'
    WHEN annual_income IS NULL THEN 'MISSING_ANNUAL_INCOME'
    WHEN annual_income < 0 THEN 'NEGATIVE_ANNUAL_INCOME' ELSE 'CLEAN' END"""
SILVER_CUSTOMERS_SQL = f"""
    SELECT customer_id, region, customer_segment, {EMAIL_SQL} AS email_hash,
           {PHONE_SQL} AS phone_masked, {AGE_SQL} AS age, {INCOME_SQL} AS income_tier,
           {CREDIT_SQL} AS credit_tier, {INCOME_FLAG_SQL} AS data_quality_flag,
           {audit_sql('crm_system')} FROM customers"""
SILVER_ACCOUNTS_SQL = f"""
    SELECT account_id, customer_id, product_id, status, opened_date, current_balance,
           CASE WHEN customer_id IS NULL THEN 'MISSING_CUSTOMER_ID'
                WHEN current_balance IS NULL THEN 'MISSING_CURRENT_BALANCE'
                WHEN current_balance < 0 THEN 'NEGATIVE_CURRENT_BALANCE'
                ELSE 'CLEAN' END AS data_quality_flag, {audit_sql('core_banking')}
    FROM accounts"""
SILVER_PRODUCTS_SQL = f"""
    SELECT product_id, product_name, product_category, product_type,
           CASE WHEN product_id IS NULL THEN 'MISSING_PRODUCT_ID'
                WHEN product_name IS NULL THEN 'MISSING_PRODUCT_NAME'
                ELSE 'CLEAN' END AS data_quality_flag, {audit_sql('catalog')}
    FROM products"""


def bronze_customers(spark: SparkSession, sf: str) -> DataFrame:
    raw = pr.bronze(tb.customers(spark, sf), ["customer_id"], "crm_system", RUN_TS)
    return raw.withColumn("date_of_birth", F.col("date_of_birth").cast("string"))


def bronze_transactions(spark, sf):
    return pr.bronze(tb.read(spark, sf, "lineitem"), ["l_orderkey"], "pos", RUN_TS)


def bronze_accounts(spark, sf):
    return pr.bronze(tb.accounts(spark, sf), ["account_id"], "core_banking", RUN_TS)


def bronze_products(spark, sf):
    return pr.bronze(tb.products(spark, sf), ["product_id"], "catalog", RUN_TS)


def bronze_reviews(spark, sf):
    return pr.bronze_reviews(tb.reviews(spark, sf), "voice_of_customer", RUN_TS)


def silver_customers(spark, sf):
    return pr.silver_customers(tb.customers(spark, sf), AS_OF, "crm_system", RUN_TS)


def silver_accounts(spark, sf):
    silver = pr.silver_accounts(tb.accounts(spark, sf), "core_banking", RUN_TS)
    return quality.enforce(silver, pr.ACCOUNT_EXPECTATIONS)


def silver_products(spark, sf):
    return pr.silver_products(tb.products(spark, sf), "catalog", RUN_TS)


def gold_customer_segments(spark, sf):
    silver = quality.enforce(silver_customers(spark, sf), pr.CUSTOMER_EXPECTATIONS)
    return pr.gold_customer_segments(silver, RUN_TS)


def gold_account_summary(spark, sf):
    return pr.gold_account_summary(
        tb.customers(spark, sf), tb.accounts(spark, sf), tb.products(spark, sf), RUN_TS
    )


def gold_daily_revenue(spark, sf):
    daily = pr.gold_daily_revenue(
        tb.read(spark, sf, "orders"), "o_orderdate", "o_totalprice", RUN_TS
    )
    return daily.withColumn("day", F.col("day").cast("string"))


def income_tier(spark, sf):
    c = tb.customers(spark, sf)
    return c.select("customer_id", tiers.income_tier(F.col("annual_income")).alias("income_tier"))


def credit_tier(spark, sf):
    c = tb.customers(spark, sf)
    return c.select("customer_id", tiers.credit_tier(F.col("credit_score")).alias("credit_tier"))


def hash_email(spark, sf):
    c = tb.customers(spark, sf)
    return c.select("customer_id", masking.hash_normalised(F.col("email")).alias("email_hash"))


def mask_phone(spark, sf):
    c = tb.customers(spark, sf)
    return c.select("customer_id", masking.mask_phone(F.col("phone")).alias("phone_masked"))


def mask_email(spark, sf):
    shown = [masking.mask_email(F.trim("email"), a).alias(f"email_{a}") for a in masking.ACCESS_LEVELS]
    return tb.customers(spark, sf).select("customer_id", *shown)


def mask_email_function(spark, sf):
    masking.register_mask_email(spark, "partial", "mask_email_partial")
    c = tb.customers(spark, sf)
    return c.select("customer_id", F.expr("mask_email_partial(trim(email))").alias("email"))


def age_from_dob(spark, sf):
    today = F.lit(AS_OF).cast("date")
    c = tb.customers(spark, sf)
    return c.select("customer_id", masking.age_in_years(F.col("date_of_birth"), today).alias("age"))


def masked_view(spark, sf):
    c = tb.customers(spark, sf).withColumn("email", F.trim("email"))
    policy = {
        "email": {a: masking.mask_email(F.col("email"), a) for a in masking.ACCESS_LEVELS},
        "phone": {"full": F.col("phone"), "none": masking.mask_phone(F.col("phone"))},
    }
    base = c.select("customer_id", "email", "phone", "region")
    personal_data.masked(base, policy, "partial").createOrReplaceTempView("customers_partial")
    return spark.table("customers_partial")


def redact_text(spark, sf):
    d = tb.read(spark, sf, "documents")
    return d.select("doc_id", masking.redact(F.col("text")).alias("redacted_text"))


def pii_columns(spark, sf):
    return personal_data.columns_report(tb.customers(spark, sf))


def pii_scan_documents(spark, sf):
    return personal_data.scan_text(tb.read(spark, sf, "documents"), ["text"])


def pii_scan_pages(spark, sf):
    return personal_data.scan_text(tb.read(spark, sf, "pages"), ["url", "html"])


def dq_flag(spark, sf):
    rules = [quality.missing("customer_id"), quality.missing("annual_income"),
             quality.negative("annual_income")]
    return tb.customers(spark, sf).select("customer_id", quality.flag(*rules))


TOXIC = "toxic IS NULL OR toxic = 0"
EVENT_EXPECTATIONS = (
    quality.expect("known_type", "event_type IN ('click', 'view', 'purchase')", "drop"),
    quality.expect("valued", "value >= 5", "drop"),
    quality.expect("has_id", "event_id IS NOT NULL", "fail"),
)


def expect_drop(spark, sf):
    kept = quality.dropped(tb.read(spark, sf, "events"), EVENT_EXPECTATIONS)
    return kept.select("event_id", "event_type", "value")


def expect_fail(spark, sf):
    """Rows pass through; one without an id would end the job."""
    kept = quality.enforce(tb.read(spark, sf, "events"), EVENT_EXPECTATIONS)
    return kept.groupBy("event_type").agg(F.count("*").alias("row_count"))


def drift_report(spark, sf):
    return quality.report(tb.read(spark, sf, "events"), EVENT_EXPECTATIONS)


def label_domain(spark, sf):
    known = quality.expect_labels("event_type", ["click", "view", "purchase", "signup"])
    kept = quality.dropped(tb.read(spark, sf, "events"), [known])
    return kept.groupBy("event_type").agg(F.count("*").alias("row_count"))


def quality_summary(spark, sf):
    return quality.summary(silver_customers(spark, sf), "silver_customers")


def snake_case_columns(spark, sf):
    c = tb.read(spark, sf, "customer").select(
        F.col("c_custkey").alias("CustomerID"),
        F.col("c_name").alias("Customer Name"),
        F.col("c_acctbal").alias("acctBal"),
        F.col("c_mktsegment").alias("MKT-Segment"),
    )
    return shape.snake_case_columns(c)


def column_order(spark, sf):
    """Column positions of a silver table after ordering by role."""
    silver = silver_customers(spark, sf)
    ordered = shape.order_columns(
        silver.select(*reversed(silver.columns)),
        ids=["customer_id"],
        dimensions=["region", "customer_segment"],
        measures=["age"],
        derived=["income_tier", "credit_tier"],
    )
    places = [
        F.struct(F.lit(i).cast("long").alias("position"), F.lit(c).alias("column_name"),
                 F.count(F.col(c)).alias("filled"))
        for i, c in enumerate(ordered.columns)
    ]
    return ordered.agg(F.array(*places).alias("places")).select(F.inline("places"))


def sample_deterministic(spark, sf):
    d = shape.hash_sample(tb.read(spark, sf, "documents"), "doc_id", 1.0)
    return d.select("doc_id", "source")


def conditional_concat(spark, sf):
    e = tb.read(spark, sf, "events")
    detail = F.when(F.col("event_type").isin("purchase", "view"), F.get_json_object("props", "$.k"))
    return e.select("event_id", shape.describe_event(F.col("event_type"), detail).alias("description"))


def full_name(spark, sf):
    c = tb.customers(spark, sf)
    return c.select("customer_id", F.concat_ws(" ", "first_name", "last_name").alias("full_name"))


def category_map(spark, sf):
    p = tb.read(spark, sf, "part")
    kinds = {"Asset": ("ECONOMY", "STANDARD", "PROMO")}
    return p.select("p_partkey", pr.product_type(F.col("p_type"), kinds).alias("product_type"))


def min_length_gate(spark, sf):
    d = tb.read(spark, sf, "documents")
    gated = F.when(tx.long_enough(F.col("text")), F.upper("lang"))
    return d.select("doc_id", gated.alias("gated_lang"))


def nullable_predicate(spark, sf):
    """Labels of all documents that are not known to be toxic."""
    d = tb.read(spark, sf, "documents").join(tb.read(spark, sf, "labels"), "doc_id", "left")
    return d.filter(TOXIC).select("doc_id", "quality", "toxic")


def retention(spark, sf):
    e = tb.read(spark, sf, "events")
    return shape.retain(e, "ts", 10, "2024-01-31").select("event_id", "event_type")


def fk_check(spark, sf):
    """Labels, orders and parts without a parent, against narrowed parents."""
    docs = tb.read(spark, sf, "documents").filter("lang = 'en'")
    orphans = joins.orphans(tb.read(spark, sf, "labels"), docs, "doc_id", "doc_id")
    asia = tb.customers(spark, sf).filter("region <> 'ASIA'")
    orders = joins.orphans(tb.read(spark, sf, "orders"), asia, "o_custkey", "customer_id")
    parts = joins.orphans(
        tb.read(spark, sf, "lineitem"), tb.products(spark, sf), "l_partkey", "product_id"
    )
    named = [
        df.select(F.lit(n).alias("reference"), F.col(df.columns[0]).alias("key"), "row_count")
        for n, df in [("labels", orphans), ("orders", orders), ("lineitem", parts)]
    ]
    return named[0].unionByName(named[1]).unionByName(named[2])


def join_dim_inner(spark, sf):
    o = tb.read(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("customer_id"))
    c = tb.customers(spark, sf).select("customer_id", "region", "customer_segment")
    return joins.lookup(o, c, "customer_id")


def join_dim_hot(spark, sf):
    """The same kind of join with the heaviest keys found and spread."""
    d = tb.read(spark, sf, "documents").select("doc_id", "n_chars", F.col("lang").alias("key"))
    names = d.groupBy("key").agg(F.max("n_chars").alias("longest"))
    hot = joins.hot_keys(d, "key", 0.3)
    return joins.lookup(d, names, "key", hot=hot, spread_by=["doc_id"], slices=8)


def group_count(spark, sf):
    e = tb.read(spark, sf, "events")
    return e.groupBy("event_type").agg(F.count("*").alias("row_count"))


def global_count(spark, sf):
    return tb.read(spark, sf, "lineitem").agg(F.count("*").alias("row_count"))


def fk_check_bitmap(spark, sf):
    """The same references by bitmaps of their keys."""
    docs = tb.read(spark, sf, "documents").filter("lang = 'en'")
    asia = tb.customers(spark, sf).filter("region <> 'ASIA'")
    checked = [
        ("labels", tb.read(spark, sf, "labels"), docs, "doc_id", "doc_id"),
        ("orders", tb.read(spark, sf, "orders"), asia, "o_custkey", "customer_id"),
        ("lineitem", tb.read(spark, sf, "lineitem"), tb.products(spark, sf), "l_partkey", "product_id"),
    ]
    found = None
    for name, child, parent, key, parent_key in checked:
        part = joins.orphans_by_bitmap(child, parent, key, parent_key)
        part = part.select(F.lit(name).alias("reference"), F.col(key).alias("key"), "row_count")
        found = part if found is None else found.unionByName(part)
    return found


def count_distinct_merged(spark, sf):
    """Users by event type from daily sketches, held against the exact count."""
    events = tb.read(spark, sf, "events")
    daily = aggregates.distinct_sketches(
        events.withColumn("day", F.to_date("ts")), ["day", "event_type"], "user_id", "users")
    merged = aggregates.merged_distinct(daily, ["event_type"], "users", "estimate")
    exact = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("user_count"))
    off = F.abs(F.col("estimate") - F.col("user_count"))
    within = off <= F.col("user_count") * aggregates.sketch_error()
    return exact.join(merged, "event_type").select("event_type", "user_count", within.alias("within_error"))


def count_distinct(spark, sf):
    e = tb.read(spark, sf, "events")
    return e.groupBy("event_type").agg(aggregates.distinct_count("user_id").alias("user_count"))


def avg_rounded(spark, sf):
    return silver_customers(spark, sf).groupBy("region").agg(F.round(F.avg("age"), 1).alias("avg_age"))


def sum_by_dims(spark, sf):
    o = tb.read(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority")
    return o.agg(F.round(F.sum("o_totalprice"), 2).alias("total_price"))


def conditional_pct(spark, sf):
    labelled = tb.read(spark, sf, "documents").join(tb.read(spark, sf, "labels"), "doc_id")
    return labelled.groupBy("source").agg(
        F.count("*").alias("row_count"),
        aggregates.share_of_rows(F.col("toxic") == 1).alias("toxic_pct"),
        aggregates.share_of_rows(F.col("quality") == 1).alias("quality_pct"),
    )


def label_share(spark, sf):
    return aggregates.label_share(tb.read(spark, sf, "events"), ["user_id"], "event_type")


QUERIES = {
    f.__name__: f
    for f in (
        bronze_customers, bronze_transactions, bronze_accounts, bronze_products, bronze_reviews,
        silver_customers, silver_accounts, silver_products, gold_customer_segments,
        gold_account_summary, gold_daily_revenue, income_tier, credit_tier, hash_email, mask_phone,
        mask_email, mask_email_function, age_from_dob, masked_view, redact_text, pii_columns,
        pii_scan_documents, pii_scan_pages, dq_flag, expect_drop, expect_fail, drift_report,
        label_domain, quality_summary, snake_case_columns, column_order, sample_deterministic,
        conditional_concat, full_name, category_map, min_length_gate, nullable_predicate, retention,
        fk_check, fk_check_bitmap, join_dim_inner, join_dim_hot, group_count, global_count,
        count_distinct, count_distinct_merged,
        avg_rounded, sum_by_dims, conditional_pct, label_share,
    )
}

_P = masking.TEXT_PATTERNS
_KEPT = "event_type IN ('click', 'view', 'purchase') AND value >= 5 AND event_id IS NOT NULL"


def _redact_sql(column: str) -> str:
    for name, pattern in _P.items():
        column = f"regexp_replace({column}, '{pattern}', '[{name}]', 'g')"
    return column


def _scan_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, '{n}' AS pii_class,
            count(*) FILTER (WHERE regexp_matches({c}, '{p}')) AS row_count,
            CAST(coalesce(sum(len(regexp_extract_all({c}, '{p}'))), 0) AS BIGINT) AS match_count
            FROM {table}"""
        for c in columns
        for n, p in _P.items()
    )


def _rate_sql(column: str, pattern: str) -> str:
    return (
        f"round(CAST(count(*) FILTER (WHERE regexp_matches({column}, '{_P[pattern]}')) AS DOUBLE)"
        f" / nullif(count({column}), 0), 4)"
    )


def _pii_sql() -> str:
    # Evidence of every text column for every class a value can prove, plus names.
    named = {
        "first_name": ("NAME", "MEDIUM"), "last_name": ("NAME", "MEDIUM"),
        "date_of_birth": ("DOB", "MEDIUM"), "credit_score": ("FINANCIAL", "HIGH"),
        "annual_income": ("FINANCIAL", "HIGH"), "email": ("EMAIL", "HIGH"), "phone": ("PHONE", "HIGH"),
    }
    proven = {"EMAIL": ("EMAIL", "HIGH"), "PHONE": ("PHONE", "HIGH"), "SSN": ("SSN", "CRITICAL"),
              "CARD": ("PAYMENT", "CRITICAL")}
    lines = []
    for c in ("first_name", "last_name", "email", "phone", "country", "region", "customer_segment"):
        for pattern, (kind, risk) in proven.items():
            by_name = "true" if named.get(c, ("",))[0] == kind else "false"
            lines.append(
                f"SELECT '{c}' AS column_name, '{kind}' AS pii_type, '{risk}' AS risk, "
                f"{_rate_sql(c, pattern)} AS hit_rate, {by_name} AS by_name FROM customers"
            )
    for c, (kind, risk) in named.items():
        if kind not in [k for k, _ in proven.values()]:
            lines.append(
                f"SELECT '{c}', '{kind}', '{risk}', CAST(NULL AS DOUBLE), true FROM customers LIMIT 1"
            )
    found = " UNION ALL ".join(f"({line})" for line in lines)
    return f"""SELECT column_name, pii_type, risk, hit_rate,
        CASE WHEN by_name AND coalesce(hit_rate >= 0.01, false) THEN 'both'
             WHEN by_name THEN 'name' ELSE 'value' END AS evidence
        FROM ({found}) WHERE by_name OR coalesce(hit_rate >= 0.01, false)"""


def _drift_sql() -> str:
    tests = [
        ("known_type", "drop", "event_type IN ('click', 'view', 'purchase')"),
        ("valued", "drop", "value >= 5"),
        ("has_id", "fail", "event_id IS NOT NULL"),
    ]
    return " UNION ALL ".join(
        f"""SELECT '{n}' AS expectation, '{a}' AS action,
            count(*) FILTER (WHERE {p}) AS passed,
            count(*) FILTER (WHERE NOT coalesce({p}, false)) AS failed,
            round(CAST(count(*) FILTER (WHERE NOT coalesce({p}, false)) AS DOUBLE) * 100
                  / count(*), 2) AS failed_pct FROM events"""
        for n, a, p in tests
    )


_ORDERED = [
    "customer_id", "region", "customer_segment", "age", "income_tier", "credit_tier",
    "phone_masked", "email_hash", "data_quality_flag", "audit_timestamp", "source_system",
]

ORACLE = {
    "bronze_customers": with_views(
        f"SELECT * REPLACE (CAST(date_of_birth AS VARCHAR) AS date_of_birth), "
        f"{audit_sql('crm_system')} FROM customers WHERE customer_id IS NOT NULL", "customers"),
    "bronze_transactions":
        f"SELECT *, {audit_sql('pos')} FROM lineitem WHERE l_orderkey IS NOT NULL",
    "bronze_accounts": with_views(
        f"SELECT *, {audit_sql('core_banking')} FROM accounts WHERE account_id IS NOT NULL", "accounts"),
    "bronze_products": with_views(
        f"SELECT *, {audit_sql('catalog')} FROM products WHERE product_id IS NOT NULL", "products"),
    "bronze_reviews": with_views(
        f"SELECT *, {audit_sql('voice_of_customer')} FROM reviews "
        "WHERE review_id IS NOT NULL AND review_text IS NOT NULL", "reviews"),
    "silver_customers": with_views(SILVER_CUSTOMERS_SQL, "customers"),
    "silver_accounts": with_views(
        f"SELECT * FROM ({SILVER_ACCOUNTS_SQL}) WHERE customer_id IS NOT NULL", "accounts"),
    "silver_products": with_views(SILVER_PRODUCTS_SQL, "products"),
    "gold_customer_segments": with_views(
        f"""SELECT region, income_tier, credit_tier, count(DISTINCT customer_id) AS customer_count,
            round(avg(age), 1) AS avg_age, {audit_sql('gold_aggregation')}
            FROM silver GROUP BY region, income_tier, credit_tier""",
        "customers", silver=SILVER_CUSTOMERS_SQL),
    "gold_account_summary": with_views(
        f"""SELECT product_type, region, count(*) AS account_count,
            round(sum(current_balance), 2) AS total_balance, {audit_sql('gold_aggregation')}
            FROM accounts JOIN customers USING (customer_id) JOIN products USING (product_id)
            GROUP BY product_type, region""", "customers", "accounts", "products"),
    "gold_daily_revenue":
        f"""SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS row_count,
            round(sum(o_totalprice), 2) AS revenue, {audit_sql('gold_aggregation')}
            FROM orders GROUP BY 1""",
    "income_tier": with_views(
        f"SELECT customer_id, {INCOME_SQL} AS income_tier FROM customers", "customers"),
    "credit_tier": with_views(
        f"SELECT customer_id, {CREDIT_SQL} AS credit_tier FROM customers", "customers"),
    "hash_email": with_views(f"SELECT customer_id, {EMAIL_SQL} AS email_hash FROM customers", "customers"),
    "mask_phone": with_views(f"SELECT customer_id, {PHONE_SQL} AS phone_masked FROM customers", "customers"),
    "mask_email": with_views(
        """SELECT customer_id, trim(email) AS email_full,
           substr(trim(email), 1, 3) || '***@' || split_part(trim(email), '@', 2) AS email_partial,
           '***@***' AS email_none FROM customers""", "customers"),
    "mask_email_function": with_views(
        """SELECT customer_id,
           substr(trim(email), 1, 3) || '***@' || split_part(trim(email), '@', 2) AS email
           FROM customers""", "customers"),
    "age_from_dob": with_views(f"SELECT customer_id, {AGE_SQL} AS age FROM customers", "customers"),
    "masked_view": with_views(
        f"""SELECT customer_id,
            substr(trim(email), 1, 3) || '***@' || split_part(trim(email), '@', 2) AS email,
            {PHONE_SQL} AS phone, region FROM customers""", "customers"),
    "redact_text": f"SELECT doc_id, {_redact_sql('text')} AS redacted_text FROM documents",
    "pii_columns": with_views(_pii_sql(), "customers"),
    "pii_scan_documents": _scan_sql("documents", ["text"]),
    "pii_scan_pages": _scan_sql("pages", ["url", "html"]),
    "dq_flag": with_views(
        f"SELECT customer_id, {INCOME_FLAG_SQL} AS data_quality_flag FROM customers", "customers"),
    "expect_drop":
        "SELECT event_id, event_type, value FROM events "
        "WHERE event_type IN ('click', 'view', 'purchase') AND value >= 5",
    "expect_fail":
        f"SELECT event_type, count(*) AS row_count FROM events WHERE {_KEPT} GROUP BY event_type",
    "drift_report": _drift_sql(),
    "label_domain":
        "SELECT event_type, count(*) AS row_count FROM events WHERE event_type IS NULL OR "
        "event_type IN ('click', 'view', 'purchase', 'signup') GROUP BY event_type",
    "quality_summary": with_views(
        f"""SELECT 'silver_customers' AS table_name, {INCOME_FLAG_SQL} AS data_quality_flag,
            count(*) AS row_count FROM customers GROUP BY 2""", "customers"),
    "snake_case_columns":
        "SELECT c_custkey AS customer_id, c_name AS customer_name, c_acctbal AS acct_bal, "
        "c_mktsegment AS mkt_segment FROM customer",
    "column_order": with_views(
        " UNION ALL ".join(
            f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS column_name, count({c}) AS filled FROM silver"
            for i, c in enumerate(_ORDERED)
        ), "customers", silver=SILVER_CUSTOMERS_SQL),
    "sample_deterministic":
        "SELECT doc_id, source FROM documents "
        "WHERE substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) < '028f5c28'",
    "conditional_concat":
        """SELECT event_id, CASE WHEN event_type IN ('purchase', 'view')
             AND json_extract_string(props, '$.k') IS NOT NULL
           THEN event_type || ' - ' || json_extract_string(props, '$.k')
           ELSE event_type END AS description FROM events""",
    "full_name": with_views(
        "SELECT customer_id, first_name || ' ' || last_name AS full_name FROM customers", "customers"),
    "category_map":
        """SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'STANDARD', 'PROMO') THEN 'Asset'
           ELSE 'Liability' END AS product_type FROM part""",
    "min_length_gate":
        """SELECT doc_id, CASE WHEN length(trim(text)) >= 5 THEN upper(lang) END AS gated_lang
           FROM documents""",
    "nullable_predicate":
        """SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)
           WHERE toxic IS NULL OR toxic = 0""",
    "retention":
        "SELECT event_id, event_type FROM events WHERE ts >= DATE '2024-01-21'",
    "fk_check": with_views(
        """SELECT 'labels' AS reference, doc_id AS key, count(*) AS row_count FROM labels
           WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en') GROUP BY doc_id
           UNION ALL
           SELECT 'orders', o_custkey, count(*) FROM orders WHERE o_custkey NOT IN
           (SELECT customer_id FROM customers WHERE region <> 'ASIA') GROUP BY o_custkey
           UNION ALL
           SELECT 'lineitem', l_partkey, count(*) FROM lineitem WHERE l_partkey NOT IN
           (SELECT p_partkey FROM part) GROUP BY l_partkey""", "customers"),
    "count_distinct_merged":
        """SELECT event_type, count(DISTINCT user_id) AS user_count, true AS within_error
           FROM events GROUP BY event_type""",
    "join_dim_inner": with_views(
        """SELECT o_orderkey, customer_id, region, customer_segment
           FROM orders JOIN customers ON o_custkey = customer_id""", "customers"),
    "join_dim_hot":
        """SELECT doc_id, n_chars, lang AS key, max(n_chars) OVER (PARTITION BY lang) AS longest
           FROM documents""",
    "group_count": "SELECT event_type, count(*) AS row_count FROM events GROUP BY event_type",
    "global_count": "SELECT count(*) AS row_count FROM lineitem",
    "count_distinct":
        "SELECT event_type, count(DISTINCT user_id) AS user_count FROM events GROUP BY event_type",
    "avg_rounded": with_views(
        "SELECT region, round(avg(age), 1) AS avg_age FROM silver GROUP BY region",
        "customers", silver=SILVER_CUSTOMERS_SQL),
    "sum_by_dims":
        """SELECT o_orderstatus, o_orderpriority, round(sum(o_totalprice), 2) AS total_price
           FROM orders GROUP BY o_orderstatus, o_orderpriority""",
    "conditional_pct":
        """SELECT source, count(*) AS row_count,
           round(CAST(count(*) FILTER (WHERE toxic = 1) AS DOUBLE) * 100 / count(*), 1) AS toxic_pct,
           round(CAST(count(*) FILTER (WHERE quality = 1) AS DOUBLE) * 100 / count(*), 1) AS quality_pct
           FROM documents JOIN labels USING (doc_id) GROUP BY source""",
    "label_share":
        """SELECT user_id, event_type, count(*) AS row_count,
           round(CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER (PARTITION BY user_id), 1)
             AS share_pct FROM events GROUP BY user_id, event_type""",
}
ORACLE["fk_check_bitmap"] = ORACLE["fk_check"]
