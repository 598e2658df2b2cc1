"""Small helpers the corpus operators share.

Rows that an operator passes on travel as one struct (``packed``), so columns of the
input can have any name without clashing with columns an operator adds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tierworks.session import fresh_path

WHITESPACE = r"[\x20\x09-\x0D]"
NOT_WHITESPACE = r"[^\x20\x09-\x0D]+"
HASH_RANGE = 2**60


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Later steps read files, so a lost executor costs a read and not the whole lineage,
    and values such as row numbers stay what they were.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def word_count(name: str = "text") -> Column:
    """Number of words between white space; a null text has none."""
    return F.regexp_count(text_or_empty(name), F.lit(NOT_WHITESPACE)).cast("long")


def id_hash(column: Column, seed: str = "") -> Column:
    """A uniform number below ``HASH_RANGE`` made from an id; the same on every run."""
    key = F.concat(F.lit(seed), F.coalesce(column.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long")


def packed(df: DataFrame) -> DataFrame:
    """The rows as one column, ``row``."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def parts_for(rows: int, rows_per_part: int) -> int:
    return max(1, -(-rows // rows_per_part))
