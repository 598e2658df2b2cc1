"""Mixing sources to target weights by exact word budgets.

Every row has a hash-random key made from its id. The keys of a source are cut into
ranges of about ``RANGE_ROWS`` rows and ``STRETCH`` ranges make a stretch. Prefix sums
over stretches find the one that holds the budget's end, those over its ranges find the
range, and only this range is looked at row by row, so no window meets a number of rows
that grows with the source beyond a millionth of it. Rows themselves
are never sorted or shuffled: what a source takes is a number of whole epochs and the
key at which one more epoch is cut, and each row is settled from that where it is read.

Sources count in code point order, null last, with weights ``WEIGHTS`` repeating; their
targets share all words, but stop at ``EPOCHS`` times the words of the source, and the
excess goes to the others by weight until no target is above.

Defined cases: a null text has no words, a null id hashes like an empty one, rows that
share an id have one key and share the words at the cut in proportion to their size
(rounded down). A source without words has target 0. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierworks.llm.common import HASH_RANGE, id_hash, packed, staged, word_count

WEIGHTS = (5, 2, 1)
EPOCHS = 3
RANGE_ROWS = 1000
STRETCH = 1000
SEED = "mix"


def _numbered(sources: DataFrame) -> DataFrame:
    """Sources with their place in code point order, from 0, without one global window."""
    keys = [F.col("source").isNull(), F.col("source")]
    ranged = sources.repartitionByRange(*keys).withColumn("part", F.spark_partition_id())
    ranged = staged(ranged, "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition, so this window stays small.
    starts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    within = Window.partitionBy("part").orderBy(*keys)
    return ranged.join(starts, "part").select(
        "source", "source_size", "n_rows",
        (F.col("start") + F.row_number().over(within) - 1).cast("long").alias("source_no"),
    )


def targets(sources: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, n_rows) with source_no and target.

    The level, words per unit of weight, rises as sources reach their limit; each round
    sums the limits of the full ones and the weights of the others.
    """
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int")
    )
    table = staged(_numbered(sources).withColumn("weight", weight), "weights")
    limit = F.col("source_size") * epochs
    level, full = 0.0, -1
    total = table.agg(F.sum("source_size")).first()[0] or 0
    while True:
        above = F.col("weight") * F.lit(level) > limit
        now, fixed, share = table.agg(
            F.count(F.when(above, 1)),
            F.coalesce(F.sum(F.when(above, limit)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
        ).first()
        if now == full or not share:
            break
        full, level = now, (total - fixed) / share
    target = F.when(F.col("weight") * F.lit(level) > limit, limit.cast("double")).otherwise(
        F.col("weight") * F.lit(level)
    )
    return table.select("source", "source_no", "source_size", "n_rows", target.alias("target"))


def _holding(parts: DataFrame, order: str) -> DataFrame:
    """The part of each source in which ``rest`` words end; ``before``: words ahead of all parts."""
    along = Window.partitionBy("source_no").orderBy(order)
    ahead = F.col("before") + F.sum("words").over(along) - F.col("words")
    return parts.withColumn("before", ahead).filter("before < rest AND rest <= before + words")


def plan(sized: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """Per source: target, whole epochs, and where one more epoch ends.

    Rows with (key, doc_id) before (cut_key, cut_id) are taken once more, those at the
    cut take ``cut_words`` of their ``tied_words``.
    """
    sources = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows")
    )
    wanted = targets(sources, weights, epochs)
    whole = F.when(
        F.col("source_size") > 0, F.floor(F.col("target")).cast("long")
    ).otherwise(F.lit(0))
    wanted = wanted.withColumn("budget", whole).withColumn(
        "epochs",
        F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0)),
    )
    wanted = wanted.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
    wanted = staged(wanted, "targets")
    ranges = F.ceil(F.col("n_rows") / RANGE_ROWS)
    ranged = sized.join(
        wanted.select(F.col("source").alias("of"), "source_no", "rest", ranges.alias("ranges")),
        F.col("source").eqNullSafe(F.col("of")),
    ).withColumn("range", F.floor(F.col("key") / F.lit(HASH_RANGE) * F.col("ranges")))
    sums = ranged.groupBy("source_no", "range").agg(
        F.sum("size").alias("words"), F.first("rest").alias("rest")
    )
    sums = staged(
        sums.withColumn("stretch", F.floor(F.col("range") / STRETCH)), "range-sums"
    )
    stretches = sums.groupBy("source_no", "stretch").agg(
        F.sum("words").alias("words"), F.first("rest").alias("rest")
    ).withColumn("before", F.lit(0).cast("long"))
    found = _holding(stretches, "stretch").select("source_no", "stretch", "before")
    cut = _holding(sums.join(found, ["source_no", "stretch"]), "range").select(
        "source_no", "range", "before"
    )
    cut = staged(cut, "cut-ranges")
    keys = (
        ranged.join(cut, ["source_no", "range"])
        .groupBy("source_no", "key", "doc_id")
        .agg(F.sum("size").alias("words"), F.first("before").alias("before"),
             F.first("rest").alias("rest"))
    )
    by_key = Window.partitionBy("source_no").orderBy("key", F.asc_nulls_last("doc_id"))
    ends = keys.withColumn(
        "before", F.col("before") + F.sum("words").over(by_key) - F.col("words")
    ).filter("before < rest AND rest <= before + words")
    ends = ends.select(
        "source_no",
        F.col("key").alias("cut_key"),
        F.col("doc_id").alias("cut_id"),
        (F.col("rest") - F.col("before")).alias("cut_words"),
        F.col("words").alias("tied_words"),
    )
    return staged(wanted.drop("n_rows", "rest").join(ends, "source_no", "left"), "mix")


def _sized(df: DataFrame, text: str, key: str, source: str, seed: str) -> DataFrame:
    return df.select(
        F.col(key).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(text).alias("size"),
        id_hash(F.col(key), seed).alias("key"),
    )


def _cut_share() -> Column:
    """Words of one more epoch that a row gives; null-safe for ids that are null."""
    at_cut = (F.col("key") == F.col("cut_key")) & F.col("doc_id").eqNullSafe(F.col("cut_id"))
    # Among equal keys smaller ids come first, null last.
    before_cut = (F.col("key") < F.col("cut_key")) | (
        (F.col("key") == F.col("cut_key"))
        & F.col("doc_id").isNotNull()
        & (F.col("cut_id").isNull() | (F.col("doc_id") < F.col("cut_id")))
    )
    return (
        F.when(F.col("cut_key").isNull(), F.lit(0))
        .when(at_cut, F.expr("size * cut_words div greatest(tied_words, 1)"))
        .when(before_cut, F.col("size"))
        .otherwise(F.lit(0))
    )


def taken(
    df: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source",
    weights=WEIGHTS, epochs: int = EPOCHS, seed: str = SEED,
) -> DataFrame:
    """One row per row of ``df``: doc_id, source, size, source_size, target, taken."""
    sized = staged(_sized(df, text, key, source, seed), "sizes")
    mix = plan(sized, weights, epochs).withColumnRenamed("source", "of")
    joined = sized.join(mix, F.col("source").eqNullSafe(F.col("of")))
    return joined.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("size") * F.col("epochs") + _cut_share()).cast("long").alias("taken"),
    )


def mixed_rows(
    df: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source",
    weights=WEIGHTS, epochs: int = EPOCHS, seed: str = SEED,
) -> DataFrame:
    """The rows of ``df``, each as often as the mix takes it, with their columns as they are.

    Texts stay whole: the row at the cut comes once more if the mix takes half of it or
    more. Rows without words come once per whole epoch, once at least.
    """
    sized = _sized(df, text, key, source, seed)
    mix = plan(staged(sized, "sizes"), weights, epochs).withColumnRenamed("source", "of")
    rows = packed(df).select(
        "row",
        F.col(f"row.{key}").alias("doc_id"),
        F.col(f"row.{source}").alias("source"),
        word_count(f"row.{text}").alias("size"),
        id_hash(F.col(f"row.{key}"), seed).alias("key"),
    )
    share = _cut_share()
    copies = F.when(F.col("size") == 0, F.greatest(F.col("epochs"), F.lit(1))).otherwise(
        F.col("epochs") + F.when(share * 2 >= F.col("size"), F.lit(1)).otherwise(F.lit(0))
    )
    joined = rows.join(mix, F.col("source").eqNullSafe(F.col("of")))
    counted = joined.select("row", copies.cast("int").alias("copies")).filter("copies > 0")
    return counted.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
