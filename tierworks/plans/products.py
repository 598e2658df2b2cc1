"""The standard bronze, silver and gold tables, as functions from tables to tables.

Every function takes the tables it needs and the values that would otherwise come
from the clock (``run_ts``, ``as_of``), so a refresh can be repeated exactly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierworks.functions import masking, tiers
from tierworks.operators import aggregates, enrich, joins, quality
from tierworks.operators.shape import add_audit, require

# How aggregates name their source, and the columns bronze reviews keep.
GOLD_SOURCE = "gold_aggregation"
REVIEW_COLUMNS = ("review_id", "customer_id", "franchise_id", "product_id", "review_text", "review_date")

# Our own: what to pull out of review text unless told otherwise.
ENTITY_FIELDS: dict[str, str | Sequence[str]] = {
    "product_name": r"(?:bought|ordered|tried) (?:the |a )?(\p{L}+)",
    "staff_name": r"(?:served by|thanks to) (\p{Lu}\p{L}+)",
}


def bronze(df: DataFrame, keys: Sequence[str], source: str, run_ts=None) -> DataFrame:
    """Raw rows whose keys are filled, with audit columns; nothing else is touched."""
    return add_audit(require(df, *keys), source, run_ts)


def bronze_reviews(reviews: DataFrame, source: str, run_ts=None) -> DataFrame:
    """Text and identifiers only; works on batches and streams."""
    return bronze(reviews.select(*REVIEW_COLUMNS), ["review_id", "review_text"], source, run_ts)


def silver_customers(
    customers: DataFrame, as_of: str, source: str, run_ts=None, keep: Sequence[str] = ()
) -> DataFrame:
    """Customers without raw personal data: hashes, masks, age and tiers instead."""
    today = F.to_date(F.lit(as_of))
    derived = customers.select(
        "customer_id",
        "region",
        "customer_segment",
        *keep,
        masking.hash_normalised(F.col("email")).alias("email_hash"),
        masking.mask_phone(F.col("phone")).alias("phone_masked"),
        masking.age_in_years(F.col("date_of_birth"), today).alias("age"),
        tiers.income_tier(F.col("annual_income")).alias("income_tier"),
        tiers.credit_tier(F.col("credit_score")).alias("credit_tier"),
        quality.flag(
            quality.missing("customer_id"),
            quality.missing("annual_income"),
            quality.negative("annual_income"),
        ),
    )
    return add_audit(derived, source, run_ts)


CUSTOMER_EXPECTATIONS = (quality.expect("valid_customer_id", "customer_id IS NOT NULL", "fail"),)


def silver_accounts(accounts: DataFrame, source: str, run_ts=None) -> DataFrame:
    """Accounts with a balance flag; customers and products stay keys only."""
    derived = accounts.select(
        "account_id",
        "customer_id",
        "product_id",
        "status",
        "opened_date",
        "current_balance",
        quality.flag(
            quality.missing("customer_id"),
            quality.missing("current_balance"),
            quality.negative("current_balance"),
        ),
    )
    return add_audit(derived, source, run_ts)


ACCOUNT_EXPECTATIONS = (
    quality.expect("valid_account_id", "account_id IS NOT NULL", "fail"),
    quality.expect("has_customer", "customer_id IS NOT NULL", "drop"),
)

# Product categories that are assets; all others are liabilities.
PRODUCT_TYPES = {"Asset": ("Savings", "Checking", "Investment")}
PRODUCT_TYPE_ELSE = "Liability"


def product_type(category: Column, groups: Mapping[str, Sequence[str]] = PRODUCT_TYPES) -> Column:
    return tiers.category_map(category, groups, PRODUCT_TYPE_ELSE)


def silver_products(products: DataFrame, source: str, run_ts=None) -> DataFrame:
    """Products with their type derived from the category unless they carry one."""
    typed = products
    if "product_type" not in products.columns:
        typed = products.withColumn("product_type", product_type(F.col("product_category")))
    derived = typed.select(
        "product_id",
        "product_name",
        "product_category",
        "product_type",
        quality.flag(quality.missing("product_id"), quality.missing("product_name")),
    )
    return add_audit(derived, source, run_ts)


PRODUCT_EXPECTATIONS = (quality.expect("valid_product_id", "product_id IS NOT NULL", "fail"),)


def silver_review_sentiment(
    reviews: DataFrame,
    source: str,
    run_ts=None,
    lexicon: enrich.Lexicon = enrich.DEFAULT_LEXICON,
    taxonomy: enrich.Taxonomy | None = None,
    fields: Mapping[str, str | Sequence[str]] = ENTITY_FIELDS,
    summary_words: int | None = None,
) -> DataFrame:
    """Reviews with sentiment, topic and entities, flagged and audited.

    Map-only: every row is enriched where it is read. Staff names leave hashed.
    """
    texts = reviews.select(
        "review_id", "customer_id", "franchise_id", "product_id",
        F.col("review_text").alias("source_text"),
    )
    scored = enrich.sentiment_and_topic(texts, "source_text", lexicon, taxonomy)
    entities = enrich.extract(scored, "source_text", fields, hashed=["staff_name"])
    if summary_words:
        entities = enrich.summarize(entities, "source_text", summary_words)
    flagged = entities.select(
        "*", quality.text_flag(F.col("source_text"), F.col("sentiment_label"))
    )
    return add_audit(flagged, source, run_ts)


def review_expectations(taxonomy: enrich.Taxonomy | None = None) -> tuple[quality.Expectation, ...]:
    labels = (taxonomy or enrich.Taxonomy()).labels
    return (
        quality.expect("valid_review_id", "review_id IS NOT NULL", "fail"),
        quality.expect_sentiment(),
        quality.expect_labels("topic_label", labels),
    )


def gold_customer_segments(customers: DataFrame, run_ts=None) -> DataFrame:
    """Customers and mean age per region, income tier and credit tier."""
    grouped = customers.groupBy("region", "income_tier", "credit_tier").agg(
        F.count_distinct("customer_id").alias("customer_count"),
        F.round(F.avg("age"), 1).alias("avg_age"),
    )
    return add_audit(grouped, GOLD_SOURCE, run_ts)


def gold_account_summary(
    customers: DataFrame,
    accounts: DataFrame,
    products: DataFrame,
    run_ts=None,
    hot_customers: Sequence = (),
) -> DataFrame:
    """Balances by product type and customer region.

    Balances are added up per product and region before products are joined, so a
    product that holds much of the data reaches that join as one row per region.
    """
    regions = customers.select("customer_id", "region")
    held = accounts.select("account_id", "customer_id", "product_id", "current_balance")
    placed = joins.lookup(
        held, regions, "customer_id", hot=hot_customers, spread_by=["account_id", "product_id"]
    )
    per_product = joins.count_then_name(
        placed,
        products.select("product_id", "product_type"),
        "product_id",
        by=["region"],
        names=["product_type"],
        sums=[
            ("account_count", F.count("*")),
            ("total_balance", F.sum("current_balance")),
        ],
    )
    grouped = per_product.groupBy("product_type", "region").agg(
        F.sum("account_count").alias("account_count"),
        F.round(F.sum("total_balance"), 2).alias("total_balance"),
    )
    return add_audit(grouped, GOLD_SOURCE, run_ts)


def _clean_reviews(sentiment: DataFrame, franchises: DataFrame, by: Sequence[str]) -> DataFrame:
    clean = sentiment.filter(F.col("data_quality_flag") == quality.CLEAN)
    named = franchises.select("franchise_id", F.col("name").alias("franchise_name"))
    label = F.col("sentiment_label")
    return joins.count_then_name(
        clean, named, "franchise_id", by=by, names=["franchise_name"],
        sums=[
            ("review_count", F.count("*")),
            ("positive_count", F.count_if(label == "positive")),
            ("negative_count", F.count_if(label == "negative")),
        ],
    )


def gold_review_sentiment_by_franchise(
    sentiment: DataFrame, franchises: DataFrame, run_ts=None
) -> DataFrame:
    """Reviews per franchise, topic and sentiment label, with the label's share."""
    counts = _clean_reviews(sentiment, franchises, ["topic_label", "sentiment_label"])
    topic = Window.partitionBy("franchise_id", "franchise_name", "topic_label")
    share = aggregates.percentage(F.col("review_count"), F.sum("review_count").over(topic))
    named = counts.select(
        "franchise_id", "franchise_name", "topic_label", "sentiment_label", "review_count",
        share.alias("label_pct"),
    )
    return add_audit(named, GOLD_SOURCE, run_ts)


def gold_review_topics_by_franchise(
    sentiment: DataFrame, franchises: DataFrame, run_ts=None
) -> DataFrame:
    """Positive and negative percentage per franchise and topic."""
    counts = _clean_reviews(sentiment, franchises, ["topic_label"])
    named = counts.select(
        "franchise_id", "franchise_name", "topic_label", "review_count",
        aggregates.percentage(F.col("positive_count"), F.col("review_count")).alias("positive_pct"),
        aggregates.percentage(F.col("negative_count"), F.col("review_count")).alias("negative_pct"),
    )
    return add_audit(named, GOLD_SOURCE, run_ts)


def gold_daily_revenue(sales: DataFrame, moment: str, amount: str, run_ts=None) -> DataFrame:
    """Sales and revenue per calendar day."""
    daily = aggregates.daily_total(sales, moment, F.col(amount), "revenue")
    return add_audit(daily, GOLD_SOURCE, run_ts)


def gold_revenue_impact(sentiment: DataFrame, sales: DataFrame, run_ts=None) -> DataFrame:
    """Review mood and mean basket per franchise.

    Both sides are aggregated to the franchise first, so no review meets a sale.
    """
    clean = sentiment.filter(F.col("data_quality_flag") == quality.CLEAN)
    label = F.col("sentiment_label")
    moods = clean.groupBy("franchise_id").agg(
        F.count("*").alias("review_count"),
        aggregates.share_of_rows(label == "negative").alias("negative_pct"),
    )
    baskets = sales.groupBy("franchise_id").agg(
        F.count("*").alias("sale_count"),
        F.round(F.sum("amount"), 2).alias("revenue"),
        F.round(F.avg("amount"), 2).alias("avg_basket"),
    )
    return add_audit(moods.join(baskets, "franchise_id"), GOLD_SOURCE, run_ts)
