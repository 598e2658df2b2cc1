"""The test tables in the roles the standard products expect.

``SQL`` holds the same views for the comparison engine, as common table expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

RUN_TS = "2024-02-01 00:00:00"
AS_OF = "2024-02-01"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with contact data built from their keys."""
    nation = read(spark, sf_dir, "nation").join(
        read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    base = read(spark, sf_dir, "customer")
    placed = base.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return placed.selectExpr(
        "c_custkey AS customer_id",
        "split_part(c_name, '#', 1) AS first_name",
        "split_part(c_name, '#', 2) AS last_name",
        "concat(' User', c_custkey, '@Mail', c_nationkey, '.Example.COM ') AS email",
        """IF(c_mktsegment <> 'HOUSEHOLD', concat('+1 (', c_nationkey + 200, ') 555-',
           lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')), NULL) AS phone""",
        "date_add(DATE '1940-01-01', CAST(c_custkey * 37 % 24000 AS INT)) AS date_of_birth",
        "c_custkey * 13 % 301 + 550 AS credit_score",
        """IF(c_mktsegment = 'MACHINERY' AND c_acctbal < 0, NULL, c_acctbal * 30)
           AS annual_income""",
        "n_name AS country",
        "r_name AS region",
        "c_mktsegment AS customer_segment",
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One account position per order line: the order's customer holds the part."""
    lines, orders = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "orders")
    held = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return held.select(
        F.col("l_orderkey").alias("account_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_orderstatus").alias("status"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("opened_date"),
        F.col("l_extendedprice").alias("current_balance"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("product_category"),
        F.col("p_type").alias("product_type"),
    )


def as_reviews(documents: DataFrame) -> DataFrame:
    """Documents, batch or stream, in the shape of customer reviews."""
    return documents.selectExpr(
        "doc_id AS review_id",
        "doc_id * 7 AS customer_id",
        "source AS franchise_id",
        "lang AS product_id",
        "text AS review_text",
        """date_format(date_add(DATE '2024-01-01', CAST(doc_id % 31 AS INT)), 'yyyy-MM-dd')
           AS review_date""",
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_reviews(read(spark, sf_dir, "documents"))


def franchises(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = read(spark, sf_dir, "documents").select("source").distinct()
    return names.select(
        F.col("source").alias("franchise_id"), F.upper("source").alias("name")
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as sales of twenty franchises."""
    return read(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("src"), F.col("l_suppkey") % 20).alias("franchise_id"),
        F.col("l_extendedprice").alias("amount"),
    )


SQL = {
    "customers": """
        SELECT c_custkey AS customer_id,
               split_part(c_name, '#', 1) AS first_name,
               split_part(c_name, '#', 2) AS last_name,
               ' User' || c_custkey || '@Mail' || c_nationkey || '.Example.COM ' AS email,
               CASE WHEN c_mktsegment <> 'HOUSEHOLD'
                    THEN '+1 (' || (c_nationkey + 200) || ') 555-'
                         || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') END AS phone,
               DATE '1940-01-01' + CAST(c_custkey * 37 % 24000 AS INTEGER) AS date_of_birth,
               c_custkey * 13 % 301 + 550 AS credit_score,
               CASE WHEN NOT (c_mktsegment = 'MACHINERY' AND c_acctbal < 0)
                    THEN c_acctbal * 30 END AS annual_income,
               n_name AS country, r_name AS region, c_mktsegment AS customer_segment
        FROM customer
        LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey""",
    "accounts": """
        SELECT l_orderkey AS account_id, o_custkey AS customer_id, l_partkey AS product_id,
               o_orderstatus AS status, strftime(o_orderdate, '%Y-%m-%d') AS opened_date,
               l_extendedprice AS current_balance
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "products": """
        SELECT p_partkey AS product_id, p_name AS product_name,
               p_brand AS product_category, p_type AS product_type FROM part""",
    "reviews": """
        SELECT doc_id AS review_id, doc_id * 7 AS customer_id, source AS franchise_id,
               lang AS product_id, text AS review_text,
               strftime(DATE '2024-01-01' + CAST(doc_id % 31 AS INTEGER), '%Y-%m-%d') AS review_date
        FROM documents""",
    "franchises": "SELECT DISTINCT source AS franchise_id, upper(source) AS name FROM documents",
    "sales": """
        SELECT 'src' || (l_suppkey % 20) AS franchise_id, l_extendedprice AS amount
        FROM lineitem""",
}


def with_views(query: str, *names: str, **extra: str) -> str:
    """``query`` with the named views, then ``extra`` ones, in front."""
    parts = [f"{n} AS ({SQL[n]})" for n in names] + [f"{n} AS ({q})" for n, q in extra.items()]
    return f"WITH {', '.join(parts)} {query}"


def audit_sql(source: str) -> str:
    return f"TIMESTAMP '{RUN_TS}' AS audit_timestamp, '{source}' AS source_system"
