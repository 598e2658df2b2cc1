"""Gold-level measures. All of them combine on the map side before they shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def share_of_rows(condition: Column, digits: int = 1) -> Column:
    """Percentage of a group's rows that meet ``condition``."""
    return percentage(F.count_if(condition), F.count("*"), digits)


def percentage(part: Column, whole: Column, digits: int = 1) -> Column:
    """``part`` of ``whole`` in percent, NULL for an empty whole."""
    return F.round(part.cast("double") * 100 / F.nullif(whole, F.lit(0)), digits)


def label_share(df: DataFrame, by: Sequence[str], label: str) -> DataFrame:
    """Rows per label and the label's share inside each ``by`` group.

    The window runs over label counts, so its partitions hold one row per label.
    """
    counts = df.groupBy(*by, label).agg(F.count("*").alias("row_count"))
    inside = F.sum("row_count").over(Window.partitionBy(*by))
    return counts.select(*by, label, "row_count", percentage(F.col("row_count"), inside).alias("share_pct"))


def daily_total(df: DataFrame, moment: str, amount: Column, name: str) -> DataFrame:
    """Rows and rounded total of ``amount`` per calendar day."""
    per_day = df.groupBy(F.to_date(moment).alias("day"))
    return per_day.agg(F.count("*").alias("row_count"), F.round(F.sum(amount), 2).alias(name))


def distinct_count(column: str, exact: bool = True, error: float = 0.01) -> Column:
    """Exact distinct count, or a sketch of fixed size for very large groups."""
    return F.count_distinct(column) if exact else F.approx_count_distinct(column, error)


# Relative error of a sketch of 2 ** lg registers (one standard deviation): 1.6 percent.
SKETCH_LG = 12


def distinct_sketches(df: DataFrame, by: Sequence[str], column: str, name: str, lg: int = SKETCH_LG) -> DataFrame:
    """One sketch of ``column`` for every ``by`` group, say day and region, to be kept in gold.

    Sketches can be merged: ``merged_distinct`` counts over any of the groups together
    without the rows. NULLs are not counted.
    """
    return df.groupBy(*by).agg(F.hll_sketch_agg(column, F.lit(lg)).alias(name))


def merged_distinct(sketches: DataFrame, by: Sequence[str], name: str, out: str) -> DataFrame:
    """Distinct values over all sketches of each ``by`` group."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg(name)).alias(out))


def sketch_error(lg: int = SKETCH_LG, deviations: float = 3.0) -> float:
    """The relative error that ``deviations`` standard deviations come to."""
    return deviations * 1.04 / 2 ** (lg / 2)
