"""Joins from facts to dimensions.

No side is broadcast by hand: Spark does it from measured sizes (statistics, then
adaptive execution) and falls back to a shuffled join, whose skewed partitions it
splits. Where one key is known to be hot, ``lookup`` spreads that key itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

JOIN_TYPES = ("inner", "left")


def hot_keys(fact: DataFrame, key: str, share: float = 0.05) -> list:
    """Keys that hold at least ``share`` of all rows: never more than ``1 / share`` of them."""
    if not 0 < share <= 1:
        raise ValueError("share must be in (0, 1]")
    sizes = fact.groupBy(key).agg(F.count("*").alias("n"))
    total = fact.count()
    rows = sizes.filter((F.col("n") >= share * total) & F.col(key).isNotNull()).collect()
    return [r[key] for r in rows]


def lookup(
    fact: DataFrame,
    dimension: DataFrame,
    on: str,
    how: str = "inner",
    hot: Sequence = (),
    spread_by: Sequence[str] = (),
    slices: int = 32,
) -> DataFrame:
    """Join ``fact`` to ``dimension`` on the column ``on``.

    Rows of ``hot`` keys are spread over ``slices`` by a hash of ``spread_by`` (their
    identifiers), and only the hot dimension rows are repeated, so the dimension grows
    by at most ``len(hot) * slices`` keys.
    """
    if how not in JOIN_TYPES:
        raise ValueError(f"how must be one of {JOIN_TYPES}")
    if not hot:
        return fact.join(dimension, on, how)
    if not spread_by:
        raise ValueError("spread_by must name the columns that tell hot rows apart")
    is_hot = F.coalesce(F.col(on).isin(*hot), F.lit(False))
    slice_of = F.pmod(F.xxhash64(*spread_by), F.lit(slices)).cast("int")
    every = F.sequence(F.lit(0), F.lit(slices - 1))
    left = fact.withColumn("_slice", F.when(is_hot, slice_of).otherwise(F.lit(0)))
    right = dimension.withColumn(
        "_slice", F.explode(F.when(is_hot, every).otherwise(F.array(F.lit(0))))
    )
    return left.join(right, [on, "_slice"], how).drop("_slice")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child keys without a parent and how many rows carry each.

    Child rows are counted per key first, so the join sees every key once.
    """
    keys = child.filter(F.col(child_key).isNotNull()).groupBy(child_key)
    counted = keys.agg(F.count("*").alias("row_count"))
    known = parent.select(F.col(parent_key).alias(child_key))
    return counted.join(known, child_key, "left_anti")


def orphans_by_bitmap(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """``orphans`` for integer keys, of which only those near an orphan are shuffled.

    Both sides first come to one bitmap for 32,768 neighbouring keys, made where rows are
    read. Where the child adds bits to the parent's bitmap there are orphans; the keys of
    these ranges alone are joined, and without an orphan none is.
    """
    ranges = lambda df, key: df.filter(F.col(key).isNotNull()).select(
        F.expr(f"bitmap_bucket_number(CAST(`{key}` AS BIGINT))").alias("_range"),
        F.expr(f"bitmap_bit_position(CAST(`{key}` AS BIGINT))").alias("_bit"),
    )
    bits = F.bitmap_construct_agg("_bit")
    known = ranges(parent, parent_key).groupBy("_range").agg(bits.alias("known"))
    asked = ranges(child, child_key).groupBy("_range").agg(bits.alias("asked"))
    both = asked.join(known, "_range", "left")
    # The union of both has more bits than the parent alone where the child has others.
    sides = both.select("_range", F.explode(F.array("asked", "known")).alias("bits"), "known")
    counted = sides.filter("bits IS NOT NULL").groupBy("_range").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("all"), F.max(F.coalesce(F.bitmap_count("known"), F.lit(0))).alias("had")
    )
    suspect = counted.filter(F.col("all") > F.col("had")).select("_range")
    near = lambda df, key: df.filter(F.col(key).isNotNull()).withColumn(
        "_range", F.expr(f"bitmap_bucket_number(CAST(`{key}` AS BIGINT))")
    ).join(suspect, "_range", "left_semi").drop("_range")
    return orphans(near(child, child_key), near(parent, parent_key), child_key, parent_key)


def count_then_name(
    fact: DataFrame,
    dimension: DataFrame,
    on: str,
    by: Sequence[str],
    names: Sequence[str],
    sums: Sequence[tuple[str, Column]],
) -> DataFrame:
    """Aggregate to the dimension key first, then attach names and add up again.

    Same totals as joining row by row, but only group totals are shuffled to the
    join, whatever share of the rows one key holds.
    """
    grouped = fact.groupBy(on, *by).agg(*[c.alias(n) for n, c in sums])
    joined = grouped.join(dimension.select(on, *names), on, "inner")
    return joined.groupBy(on, *names, *by).agg(*[F.sum(n).alias(n) for n, _ in sums])
