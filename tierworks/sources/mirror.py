"""Copying a set of tables from the first source that can be read."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tierworks.session import fresh_path
from tierworks.sources.sinks import swap

REPORT = "source string, target string, status string, source_rows long, target_rows long"


class MirrorFailed(RuntimeError):
    """No source can be read, or a required table could not be copied."""


def _readable(spark: SparkSession, name: str) -> bool:
    try:
        spark.table(name).limit(1).count()
    except PySparkException:
        return False
    return True


def choose_source(
    spark: SparkSession, candidates: Sequence[str], probe: str
) -> str:
    """First candidate whose ``probe`` table can be read; it may be empty.

    A candidate is a name with ``{table}`` in it, such as ``shop.{table}`` or
    ``parquet.`/data/{table}` ``.
    """
    for candidate in candidates:
        if _readable(spark, candidate.format(table=probe)):
            return candidate
    raise MirrorFailed(f"none of {list(candidates)} can be read")


def tables(
    spark: SparkSession,
    pairs: Sequence[tuple[str, str]],
    candidates: Sequence[str],
    database: str,
    required: Sequence[str] = (),
    probe: str | None = None,
) -> DataFrame:
    """Copy ``(source, target)`` pairs into ``database``; the report has a line for each.

    A copy is written to a new folder and the catalog entry pointed at it afterwards, so
    a copy that fails, for whatever reason, leaves the last good one readable. It is
    reported as skipped, unless ``required`` names its target.
    """
    source = choose_source(spark, candidates, probe or pairs[0][0])
    lines: list[tuple] = []
    for origin, target in pairs:
        try:
            seen = Observation()
            df = spark.table(source.format(table=origin))
            path = fresh_path(spark, f"mirror-{database}-{target}")
            df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
            swap(spark, f"{database}.{target}", path, df.schema)
        except Exception as problem:
            if target in required:
                raise MirrorFailed(f"required table {target} was not copied") from problem
            condition = problem.getCondition() if isinstance(problem, PySparkException) else None
            reason = condition or type(problem).__name__
            lines.append((origin, target, f"skipped: {reason}", None, None))
            continue
        copied = spark.table(f"{database}.{target}").count()
        lines.append((origin, target, "copied", int(seen.get["n"]), copied))
    return spark.createDataFrame(lines, REPORT)


def verify(spark: SparkSession, database: str, names: Sequence[str] | None = None) -> DataFrame:
    """Row count of every table of ``database`` (or of ``names``)."""
    if names is None:
        names = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    counts = [
        spark.table(f"{database}.{n}").agg(F.count("*").alias("row_count"))
        .select(F.lit(n).alias("table_name"), "row_count")
        for n in names
    ]
    if not counts:
        return spark.createDataFrame([], "table_name string, row_count long")
    return reduce(DataFrame.unionByName, counts)
