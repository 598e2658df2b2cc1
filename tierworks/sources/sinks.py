"""Writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, NumericType, StringType, StructType, TimestampType

AUTO = "AUTO"


def csv(df: DataFrame, path: str) -> None:
    """Overwrite ``path`` with CSV files that carry a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def clustered(
    df: DataFrame, columns: Sequence[str], partitions: int | None = None
) -> DataFrame:
    """Lay rows out so that files cover narrow ranges of ``columns``.

    Range partitioning samples the keys, so a key with very many rows would fill one
    partition; a hash of the whole row is the last range column and splits it.
    """
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    ranges = [F.col(c) for c in columns] + [spread]
    laid = df.repartitionByRange(partitions, *ranges) if partitions else df.repartitionByRange(*ranges)
    return laid.sortWithinPartitions(*columns)


# Ranks of a column on the curve are numbers of this many bits.
CURVE_BITS = 6
# Columns of fewer different values than this do not narrow a range.
LEAST_DISTINCT = 8
_PREFIX_BYTES = 6


def _number(df: DataFrame, column: str) -> Column:
    """The column as a number in the same order; of strings the first bytes."""
    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, StringType):
        prefix = F.rpad(F.hex(F.substring(F.encode(value, "UTF-8"), 1, _PREFIX_BYTES)), 2 * _PREFIX_BYTES, "0")
        return F.conv(prefix, 16, 10).cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(value).cast("double")
    return value.cast("double")


def _rank(value: Column, edges: Sequence[float]) -> Column:
    """How many of ``edges`` are below a value; none are below NULL."""
    listed = F.array(*[F.lit(float(x)) for x in edges]).cast("array<double>")
    return F.coalesce(F.size(F.filter(listed, lambda edge: edge < value)), F.lit(0))


def auto_columns(df: DataFrame, candidates: Sequence[str] | None = None, most: int = 3) -> list[str]:
    """The columns to cluster by: those of ``candidates`` (all by default) with most values.

    One pass with a sketch a column. Columns of few values, and types without an order, are
    left out.
    """
    ordered = (StringType, DateType, TimestampType, NumericType)
    fields = [f.name for f in df.schema.fields if isinstance(f.dataType, ordered)]
    names = [c for c in (candidates or fields) if c in fields]
    if not names:
        return []
    counts = df.agg(*[F.approx_count_distinct(c).alias(c) for c in names]).first()
    kept = [c for c in names if counts[c] >= LEAST_DISTINCT]
    return sorted(kept, key=lambda c: (-counts[c], names.index(c)))[:most]


def on_curve(df: DataFrame, columns: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Lay rows out along a space-filling curve (Z-order) over several columns.

    A value's rank is its place among quantiles of its column, so skewed columns count as
    much as even ones; the bits of the ranks are interleaved. A range filter on any of the
    columns then meets few files. As in ``clustered``, the last range column is a hash of
    the row, which splits a place of the curve that very many rows share.
    """
    steps = [i / (1 << CURVE_BITS) for i in range(1, 1 << CURVE_BITS)]
    cuts = df.agg(*[F.percentile_approx(_number(df, c), steps).alias(c) for c in columns]).first()
    curve = F.lit(0).cast("long")
    for place, c in enumerate(columns):
        rank = _rank(_number(df, c), sorted(set(cuts[c] or [])))
        for bit in range(CURVE_BITS):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("long")
            curve = curve + F.shiftleft(one, bit * len(columns) + place)
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    placed = df.withColumns({"_curve": curve, "_spread": spread})
    ranges = ("_curve", "_spread")
    laid = placed.repartitionByRange(partitions, *ranges) if partitions else placed.repartitionByRange(*ranges)
    return laid.sortWithinPartitions("_curve", *columns).drop("_curve", "_spread")


def files_opened(written: DataFrame, columns: Sequence[str], slices: int = 8) -> DataFrame:
    """(column_name, files, opened): how many of all files a filter on one of ``slices``
    equally filled ranges of a column has to open, on average.

    ``written`` is read from files; one row a file is kept, the least and greatest values.
    """
    steps = [i / slices for i in range(1, slices)]
    cuts = written.agg(*[F.percentile_approx(_number(written, c), steps).alias(c) for c in columns]).first()
    bounds = [f(_number(written, c)).alias(f"{c}__{n}") for c in columns for n, f in (("low", F.min), ("high", F.max))]
    files = written.groupBy(F.input_file_name().alias("file")).agg(*bounds)
    lines = []
    for c in columns:
        inner = sorted(set(cuts[c] or []))
        edges = list(zip([float("-inf"), *inner], [*inner, float("inf")], strict=True))
        met = F.lit(0)
        for low, high in edges:
            inside = (F.col(f"{c}__high") >= F.lit(low)) & (F.col(f"{c}__low") <= F.lit(high))
            met = met + F.when(inside, 1).otherwise(0)
        opened = F.round(F.sum(met) / F.lit(len(edges)), 2)
        lines.append(F.struct(F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("files"), opened.alias("opened")))
    return files.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))


def write(
    df: DataFrame, path: str, cluster_by: Sequence[str] | str = (), partitions: int | None = None
) -> None:
    """Write Parquet files to a new ``path``, clustered if asked.

    ``AUTO`` chooses the columns by their number of values and lays rows on a curve.
    """
    if cluster_by == AUTO:
        columns = auto_columns(df)
        laid = on_curve(df, columns, partitions) if columns else df
    else:
        laid = clustered(df, cluster_by, partitions) if cluster_by else df
    laid.write.parquet(path)


def same_columns(left: StructType, right: StructType) -> bool:
    return [(f.name, f.dataType) for f in left.fields] == [(f.name, f.dataType) for f in right.fields]


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def swap(spark: SparkSession, table: str, path: str, schema: StructType) -> None:
    """Point ``table`` at the finished files in ``path``; earlier files stay where they are."""
    if spark.catalog.tableExists(table) and same_columns(spark.table(table).schema, schema):
        spark.sql(f"ALTER TABLE {table} SET LOCATION {quoted(path)}")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE {table} ({listed}) USING parquet LOCATION {quoted(path)}")
    spark.catalog.refreshTable(table)


def write_bucketed(
    df: DataFrame, table: str, path: str, key: str, buckets: int
) -> None:
    """A table whose joins and change feeds on ``key`` need no shuffle.

    Rows are sent to their bucket first, so every bucket becomes one sorted file.
    """
    (
        df.repartition(buckets, key)
        .write.bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(table)
    )
