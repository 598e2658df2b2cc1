"""Choosing, renaming, ordering and filtering columns and rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tierworks.functions.naming import snake_case

AUDIT_COLUMNS = ("audit_timestamp", "source_system")  # fixed values
QUALITY_COLUMN = "data_quality_flag"  # fixed value


def add_audit(df: DataFrame, source: str, run_ts: datetime | str | None = None) -> DataFrame:
    """Append the two audit columns last; ``run_ts`` makes a refresh repeatable."""
    if run_ts is None:
        stamp = F.current_timestamp()
    else:
        stamp = F.to_timestamp(F.lit(str(run_ts)))
    return df.select("*", stamp.alias(AUDIT_COLUMNS[0]), F.lit(source).alias(AUDIT_COLUMNS[1]))


def order_columns(
    df: DataFrame,
    ids: Sequence[str] = (),
    dimensions: Sequence[str] = (),
    measures: Sequence[str] = (),
    derived: Sequence[str] = (),
) -> DataFrame:
    """Identifiers, dimensions, measures, derived, quality flag, audit columns.

    Columns without a stated role keep their order and follow the derived ones.
    """
    named = [*ids, *dimensions, *measures, *derived]
    tail = [c for c in (QUALITY_COLUMN, *AUDIT_COLUMNS) if c in df.columns]
    rest = [c for c in df.columns if c not in named and c not in tail]
    return df.select(*named, *rest, *tail)


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Rename every column to snake case; two names that collide are an error."""
    renamed = [snake_case(c) for c in df.columns]
    doubles = sorted({c for c in renamed if renamed.count(c) > 1})
    if doubles:
        raise ValueError(f"columns collide after renaming: {doubles}")
    return df.toDF(*renamed)


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Keep rows in which all ``columns`` are filled; the test reaches the file scan."""
    for name in columns:
        df = df.filter(F.col(name).isNotNull())
    return df


def hash_sample(df: DataFrame, key: str, percent: float = 1.0) -> DataFrame:
    """The same ``percent`` of keys on every run and on every engine with MD5.

    The first eight hex digits of the key's digest are compared with a threshold.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must be in (0, 100]")
    if percent == 100:
        return df
    threshold = format(int(16**8 * percent / 100), "08x")
    return df.filter(F.substring(F.md5(F.col(key).cast("string")), 1, 8) < F.lit(threshold))


def retain(df: DataFrame, day: str, days: int, run_date: str | Column) -> DataFrame:
    """Rows not older than ``days`` before ``run_date``."""
    if days < 0:
        raise ValueError("days must not be negative")
    today = F.to_date(F.lit(run_date)) if isinstance(run_date, str) else run_date
    column = F.col(day)
    # Compare the raw column, not a cast of it, so that file statistics can prune.
    return df.filter(column >= F.date_sub(today, days).cast(df.schema[day].dataType))


def describe_event(kind: Column, detail: Column) -> Column:
    """``kind - detail``, or ``kind`` alone where there is no detail."""
    return F.when(detail.isNull(), kind).otherwise(F.concat_ws(" - ", kind, detail))
