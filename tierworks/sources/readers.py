"""Batch and incremental readers. Schemas are always given, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A directory of CSV files with a header line."""
    return spark.read.schema(schema).option("header", True).csv(path)


def stream_files(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    file_format: str = "parquet",
    files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """New files of a directory, each exactly once."""
    reader = spark.readStream.format(file_format).schema(schema).options(**options)
    if file_format == "csv":
        reader = reader.option("header", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def stream_table(spark: SparkSession, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """Rows appended to a catalog table."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.table(name)


def file_inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files and megabytes per directory below ``path``.

    File contents are not read: only the listing columns of the source are used, so
    the work grows with the number of files.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", "length")
    )
    folder = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    return files.groupBy(folder.alias("directory")).agg(
        F.count("*").alias("file_count"),
        F.round(F.sum("length") / F.lit(1024 * 1024), 2).alias("total_mb"),
    )
