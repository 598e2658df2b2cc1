"""Exact duplicates with the frequent texts split off.

Texts are equal when they are identical without white space. A Misra-Gries summary finds
the digests that may be frequent, one exact pass verifies them and picks the row of each
that stays, and these few winners are broadcast: rows of frequent digests are settled
where they are read and never shuffled, so a text that fills a third of the table is no
hot key. All other digests go through an ordinary shuffle.

Defined cases: a null text counts as empty; of equal texts the row with the most code
points in the original text stays, then the smallest id, ids that are null last; of rows
that are equal even then exactly one stays. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tierworks.llm.common import WHITESPACE, packed, staged, text_or_empty

# With k counters every digest that fills 2 / (k + 1) of the rows or more is found, and
# at most k candidates can pass, so what is broadcast has at most k rows.
COUNTERS = 1023


def digest(text: str = "text") -> Column:
    """SHA-256 of the text without white space, as lower-case hexadecimal digits."""
    return F.sha2(F.regexp_replace(text_or_empty(text), WHITESPACE, ""), 256)


def misra_gries(counters: int):
    """A function for ``mapInPandas``: (digest) to one summary (digest, seen) per task."""

    def summarise(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = pd.Series(dtype="int64")
        for frame in frames:
            seen = seen.add(frame["digest"].value_counts(), fill_value=0).astype("int64")
            if len(seen) > counters:
                seen = seen - seen.nlargest(counters + 1).iloc[-1]
                seen = seen[seen > 0]
        yield pd.DataFrame({"digest": seen.index.astype(str), "seen": seen.to_numpy()})

    return summarise


def _best() -> Column:
    """Orders rows of one text: longest original, smallest id, first row."""
    return F.min(
        F.struct(
            (-F.col("length")).alias("shortness"),
            F.col("doc_id").isNull().alias("no_id"),
            F.col("doc_id"),
            F.col("row_no"),
        )
    )


def frequent(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The frequent digests: digest, group_size and the best row; at most ``counters`` rows.

    The sum of all counters is at most the number of rows, so fewer than
    ``counters + 1`` digests can have more than a ``counters + 1``-th of it.
    """
    rows = digests.count()
    summaries = digests.select("digest").mapInPandas(
        misra_gries(counters), "digest string, seen long"
    )
    candidates = (
        summaries.groupBy("digest").agg(F.sum("seen").alias("seen"))
        .filter(F.col("seen") > F.lit(rows / (counters + 1)))
        .select("digest")
    )
    candidates = staged(candidates, "frequent-candidates")
    verified = (
        digests.join(F.broadcast(candidates), "digest")
        .groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), _best().alias("best"))
    )
    return staged(verified.filter("group_size > 1"), "frequent-winners")


def _digests(df: DataFrame, text: str, key: str) -> DataFrame:
    table = df.select(
        F.col(key).alias("doc_id"),
        digest(text).alias("digest"),
        F.length(text_or_empty(text)).cast("long").alias("length"),
        F.monotonically_increasing_id().alias("row_no"),
    )
    return staged(table, "digests")


def groups(
    df: DataFrame, text: str = "text", key: str = "doc_id", counters: int = COUNTERS
) -> DataFrame:
    """One row per row of ``df``: doc_id, keep_id, group_size, kept, text_sha256."""
    digests = _digests(df, text, key)
    winners = frequent(digests, counters)
    hot = digests.join(F.broadcast(winners), "digest")
    rest = digests.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    best = rest.groupBy("digest").agg(
        F.count(F.lit(1)).alias("group_size"), _best().alias("best")
    )
    settled = hot.unionByName(rest.join(best, "digest"))
    return settled.select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_no") == F.col("best.row_no")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def _settled_key(digest: str, length: Column, doc_id: Column) -> Column:
    """Names the row of a text that stays; a null id is told from every other one."""
    marked = F.coalesce(F.concat(F.lit("id "), doc_id.cast("string")), F.lit("none"))
    return F.concat_ws(":", F.col(digest), length, marked)


def keep_rows(
    df: DataFrame, text: str = "text", key: str = "doc_id", counters: int = COUNTERS
) -> DataFrame:
    """The rows of ``df`` that stay, with their columns as they are.

    Rows of frequent texts other than the best are removed where they are read. The best
    row of each other text is found over digests alone, so whole rows meet it under keys
    that hold their ids and no group of copies comes together; rows that are equal in all
    of this are combined before they are shuffled.
    """
    digests = _digests(df, text, key)
    winners = frequent(digests, counters)
    rest = digests.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    best = rest.groupBy("digest").agg(_best().alias("best")).unionByName(
        winners.select("digest", "best")
    )
    stays = best.select(
        _settled_key("digest", -F.col("best.shortness"), F.col("best.doc_id")).alias("settled")
    )
    rows = packed(df).withColumn("digest", digest(f"row.{text}"))
    hot = winners.select(
        F.col("digest").alias("hot"),
        _settled_key("digest", -F.col("best.shortness"), F.col("best.doc_id")).alias("hot_best"),
    )
    length = F.length(text_or_empty(f"row.{text}")).cast("long")
    keyed = rows.withColumn("settled", _settled_key("digest", length, F.col(f"row.{key}")))
    left = keyed.join(F.broadcast(hot), F.col("digest") == F.col("hot"), "left").filter(
        F.col("hot").isNull() | (F.col("settled") == F.col("hot_best"))
    )
    found = left.select("row", "settled").join(stays, "settled", "left_semi")
    one = found.groupBy("settled").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return one.select("row.*")
