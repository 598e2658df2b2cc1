"""Checking published tables against the rules, as data.

Every table costs one aggregate over its rows (plus the distinct count of its key);
the result has a line per rule with the number of offending rows or items.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tierworks.functions.naming import is_snake_case
from tierworks.operators import personal_data
from tierworks.operators.shape import AUDIT_COLUMNS, QUALITY_COLUMN
from tierworks.plans.publish import (
    PII_SUFFIX,
    REQUIRED_PROPERTIES,
    REQUIRED_TAGS,
    read_location,
    read_properties,
)
from tierworks.session import subfolders

FLAG_SHAPE = "^(CLEAN|AI_NULL_RESPONSE|(MISSING|NEGATIVE)_[A-Z0-9_]+)$"


@dataclass(frozen=True)
class Contract:
    """What is expected of one table beyond the general rules."""

    layer: str
    key: Sequence[str] = ()
    labels: Mapping[str, Sequence[str]] | None = None


def _missing_audit(columns: Sequence[str]) -> int:
    return sum(a != b for a, b in zip(AUDIT_COLUMNS, [*columns, "", ""][len(columns) - 2 :]))


def row_checks(df: DataFrame, contract: Contract) -> dict[str, Column]:
    """Counter of offending rows per data rule."""
    checks: dict[str, Column] = {}
    filled = [c for c in AUDIT_COLUMNS if c in df.columns]
    if filled:
        blank = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in filled])
        checks["audit_columns_filled"] = F.count_if(blank)
    if contract.key:
        blank = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in contract.key])
        checks["key_filled"] = F.count_if(blank)
        whole = F.count(F.when(~blank, F.lit(1)))
        checks["key_unique"] = whole - F.count_distinct(*contract.key)
    if QUALITY_COLUMN in df.columns:
        known = F.coalesce(F.col(QUALITY_COLUMN).rlike(FLAG_SHAPE), F.lit(False))
        checks["flag_in_domain"] = F.count_if(~known)
    for column, labels in (contract.labels or {}).items():
        value = F.col(column)
        checks[f"{column}_in_domain"] = F.count_if(~value.isin(*labels) & value.isNotNull())
    return checks


def schema_checks(table: str, columns: Sequence[str], contract: Contract) -> dict[str, int]:
    """Number of offending columns per layout rule."""
    checks = {
        "snake_case_names": sum(not is_snake_case(c) for c in [table, *columns]),
        "layer_prefix": int(not table.startswith(f"{contract.layer}_")),
        "audit_columns_last": _missing_audit(columns),
    }
    if contract.layer == "silver":
        checks["quality_flag_present"] = int(QUALITY_COLUMN not in columns)
    if contract.layer == "gold":
        checks["no_personal_columns"] = len(personal_data.personal_columns(columns))
    return checks


def metadata_checks(
    columns: Sequence[str],
    contract: Contract,
    properties: Mapping[str, str],
    comment: str,
    docs: Mapping[str, str],
    feed: bool = True,
) -> dict[str, int]:
    """Number of missing items per documentation rule; ``feed``: its files are there."""
    personal = personal_data.personal_columns(columns)
    listed = set(filter(None, properties.get("pii_columns", "").split(",")))
    described = [*contract.key, *personal, *AUDIT_COLUMNS]
    described += [QUALITY_COLUMN] if QUALITY_COLUMN in columns else []
    checks = {
        "comment_present": int(not comment.strip()),
        "required_properties": sum(p not in properties for p in REQUIRED_PROPERTIES),
        "quality_matches_layer": int(properties.get("quality") != contract.layer),
        "column_docs": sum(not docs.get(c) for c in described if c in columns),
    }
    tagged_personal = properties.get("tag.pii", str(bool(personal)).lower()) == "true"
    checks["required_tags"] = sum(f"tag.{t}" not in properties for t in REQUIRED_TAGS) + int(
        tagged_personal != bool(personal)
    )
    checks["row_tracking_true"] = int((properties.get("row_tracking") == "true") != ("row_id" in columns))
    if contract.layer in ("silver", "gold"):
        checks["change_feed_enabled"] = int(properties.get("change_feed") != "true" or not feed)
    if personal:
        checks["pii_labelled"] = len(set(personal) - listed) + int(
            properties.get("contains_pii") != "true"
        )
        checks["pii_in_comment"] = int(PII_SUFFIX.strip(" -") not in comment)
    return checks


def check(df: DataFrame, table: str, contract: Contract, fixed: Mapping[str, int]) -> DataFrame:
    """One line per rule: counted data rules and the already known ``fixed`` ones."""
    counted = row_checks(df, contract)
    totals = df.agg(F.count("*").alias("_rows"), *[c.alias(r) for r, c in counted.items()])
    amounts = {r: f"`{r}`" for r in counted} | {r: f"{n}L" for r, n in fixed.items()}
    lines = ", ".join(
        f"struct('{table}' AS table_name, '{rule}' AS rule, {amount} = 0 AS passed, "
        f"{amount} AS failing)"
        for rule, amount in amounts.items()
    )
    return totals.selectExpr(f"inline(array({lines}))")


def check_frame(df: DataFrame, table: str, contract: Contract) -> DataFrame:
    """Data and layout rules for a table that is not published."""
    return check(df, table, contract, schema_checks(table, df.columns, contract))


def audit(spark: SparkSession, database: str, contracts: Mapping[str, Contract]) -> DataFrame:
    """All rules for the published tables named in ``contracts``."""
    parts = []
    for table, contract in contracts.items():
        name = f"{database}.{table}"
        df = spark.table(name)
        described = spark.catalog.getTable(name).description or ""
        docs = {f.name: f.metadata.get("comment", "") for f in df.schema.fields}
        folder = read_location(spark, name).rsplit("/", 1)[0]
        fixed = schema_checks(table, df.columns, contract) | metadata_checks(
            df.columns, contract, read_properties(spark, name), described, docs,
            "feed" in subfolders(spark, folder),
        )
        parts.append(check(df, table, contract, fixed))
    return reduce(DataFrame.unionByName, parts)


# Rows that one task counts exactly before it hands on its distinct values.
EXACT_ROWS = 50_000


def _spread(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly into parts of about ``EXACT_ROWS`` rows, whatever its values."""
    parts = max(1, ceil(df.count() / EXACT_ROWS))
    placed = df.withColumn("_place", F.xxhash64(F.monotonically_increasing_id()))
    return placed.repartition(parts, "_place").drop("_place")


def profile(df: DataFrame, exact: bool = False) -> DataFrame:
    """Filled rows, distinct values, minimum and maximum per column, in one pass.

    Distinct counts are sketches of fixed size unless ``exact`` is asked for, which deals
    rows into small parts and expands every row once per column before the next shuffle:
    a task holds the values of its part, however large a file or the table is.
    """
    df = _spread(df) if exact else df
    simple = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    counters, lines = [F.count("*").alias("_rows")], []
    for c in simple:
        distinct = F.count_distinct(c) if exact else F.approx_count_distinct(c)
        counters += [
            F.count(c).alias(f"{c}__n"),
            distinct.alias(f"{c}__d"),
            F.min(c).cast("string").alias(f"{c}__lo"),
            F.max(c).cast("string").alias(f"{c}__hi"),
        ]
        lines.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.col("_rows").alias("row_count"),
                (F.col("_rows") - F.col(f"{c}__n")).alias("null_count"),
                F.col(f"{c}__d").alias("distinct_count"),
                F.col(f"{c}__lo").alias("min_value"),
                F.col(f"{c}__hi").alias("max_value"),
            )
        )
    return df.agg(*counters).select(F.inline(F.array(*lines)))
