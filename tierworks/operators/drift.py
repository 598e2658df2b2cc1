"""Drift between two versions of a table: has the set of labels, or a distribution, moved?

``histograms`` counts every value of label columns, and bins of number columns whose edges
stay with the first version. It is one small row a value, kept with each version, so the
versions themselves need not be read again; ``compare`` joins two of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

BINS = 10
# A share of nothing counts as this much, so logarithms stay finite.
LEAST_SHARE = 1e-6
# Fixed value: from here on a population counts as shifted.
PSI_LIMIT = 0.2
NULL_LABEL = "<null>"


def edges(df: DataFrame, columns: Sequence[str], bins: int = BINS) -> dict[str, list[float]]:
    """Edges of about equally filled bins of number columns."""
    shares = [i / bins for i in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares).alias(c) for c in columns]).first()
    return {c: sorted(set(row[c] or [])) for c in columns}


def _binned(column: str, cuts: Sequence[float]) -> Column:
    value = F.col(column).cast("double")
    above = F.lit(0)
    for cut in cuts:
        above = above + F.when(value > F.lit(float(cut)), 1).otherwise(0)
    return F.when(value.isNotNull(), F.concat(F.lit("bin "), above.cast("string")))


def histograms(df: DataFrame, labels: Sequence[str], numbers: Mapping[str, Sequence[float]]) -> DataFrame:
    """(column_name, kind, value, n) of all columns, in one pass."""
    cells = [
        F.struct(F.lit(c).alias("column_name"), F.lit("label").alias("kind"), F.col(c).cast("string").alias("value"))
        for c in labels
    ] + [
        F.struct(F.lit(c).alias("column_name"), F.lit("number").alias("kind"), _binned(c, cuts).alias("value"))
        for c, cuts in numbers.items()
    ]
    long = df.select(F.inline(F.array(*cells)))
    shown = F.coalesce("value", F.lit(NULL_LABEL)).alias("value")
    return long.groupBy("column_name", "kind", shown).agg(F.count(F.lit(1)).alias("n"))


def compare(old: DataFrame, new: DataFrame, limit: float = PSI_LIMIT) -> DataFrame:
    """One row a column: population stability index, Jensen-Shannon distance, labels that
    are new or gone, and whether the column drifted.

    A column drifted if its index reaches ``limit`` or its set of labels changed. Columns
    only one version has are compared with nothing.
    """
    keys = ["column_name", "kind", "value"]
    both = old.withColumnRenamed("n", "a").join(new.withColumnRenamed("n", "b"), keys, "full_outer").fillna(0, ["a", "b"])
    # One row a column is summed up first; no window gathers the values of a column.
    totals = both.groupBy("column_name", "kind").agg(F.sum("a").alias("all_a"), F.sum("b").alias("all_b"))
    met = both.join(totals, ["column_name", "kind"])
    p = F.greatest(F.coalesce(F.col("a") / F.nullif("all_a", F.lit(0)), F.lit(0.0)), F.lit(LEAST_SHARE))
    q = F.greatest(F.coalesce(F.col("b") / F.nullif("all_b", F.lit(0)), F.lit(0.0)), F.lit(LEAST_SHARE))
    shares = met.withColumns({"p": p, "q": q})
    middle = (F.col("p") + F.col("q")) / 2
    js = (F.col("p") * F.log2(F.col("p") / middle) + F.col("q") * F.log2(F.col("q") / middle)) / 2
    label = F.col("kind") == "label"
    found = shares.groupBy("column_name", "kind").agg(
        F.round(F.sum((F.col("q") - F.col("p")) * F.log(F.col("q") / F.col("p"))), 6).alias("psi"),
        F.round(F.sum(js), 6).alias("js"),
        F.count_if(label & (F.col("a") == 0)).alias("new_labels"),
        F.count_if(label & (F.col("b") == 0)).alias("gone_labels"),
    )
    moved = (F.col("psi") >= limit) | (F.col("new_labels") + F.col("gone_labels") > 0)
    return found.withColumn("drifted", moved)


def moved_labels(old: DataFrame, new: DataFrame) -> DataFrame:
    """(column_name, value, change, n): the labels that are new or gone, with their rows."""
    labels = [h.filter("kind = 'label'").drop("kind") for h in (old, new)]
    came = labels[1].join(labels[0], ["column_name", "value"], "left_anti").withColumn("change", F.lit("new"))
    went = labels[0].join(labels[1], ["column_name", "value"], "left_anti").withColumn("change", F.lit("gone"))
    return came.unionByName(went).select("column_name", "value", "change", "n")
