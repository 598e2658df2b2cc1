"""Keyed rows in hash buckets that split as they grow.

A bucket holds the rows whose key hash ends in its ``depth`` low ``bits``. A directory
names every bucket with the version of its files and its rows. A bucket that would hold
more than a limit is split by further bits when it is next written, alone, so the number
of buckets follows the data and a batch rewrites no more than the buckets it touches.

Files follow the rows, not the buckets: a version is one folder whose files hold many
buckets each, sorted by the column ``_bucket``, so small buckets cost neither a task nor a
file of their own. Rows of buckets that a later version wrote again are passed over.

The driver keeps one entry for each bucket (about a million rows), tasks keep none: rows
find their bucket by a join with the slots of the directory, which is broadcast if there
are few and else if Spark measures them to be small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierworks.session import delete_folder, subfolders

BUCKET_ROWS = 1_000_000
# Rows that a task writes, if buckets are smaller.
FILE_ROWS = 100_000
# Tables of buckets with up to this many lines are broadcast.
BROADCAST_LINES = 1 << 17
# Up to this many buckets are named in a filter, more are joined.
NAMED_BUCKETS = 200
# A bucket has at most this many bits, far more than rows could fill.
MOST_BITS = 40
Bucket = tuple[int, int]  # depth, bits


@dataclass(frozen=True)
class Entry:
    version: int
    rows: int


@dataclass(frozen=True)
class Directory:
    """Buckets that cover every hash once."""

    entries: Mapping[Bucket, Entry] = field(default_factory=lambda: {(0, 0): Entry(-1, 0)})

    @property
    def depth(self) -> int:
        return max(d for d, _ in self.entries)

    @staticmethod
    def of_size(rows: int, limit: int = BUCKET_ROWS, least: int = 1) -> Directory:
        """Empty buckets for about ``rows`` rows, ``least`` buckets or more."""
        depth = min(MOST_BITS, max(_bits(rows, limit), ceil(log2(max(1, least)))))
        return Directory({(depth, b): Entry(-1, 0) for b in range(1 << depth)})

    def split(self, planned: Mapping[Bucket, int], limit: int = BUCKET_ROWS) -> Directory:
        """The directory in which no bucket of ``planned`` (rows to come) is beyond ``limit``."""
        entries = dict(self.entries)
        for (depth, bits), rows in planned.items():
            more = min(_bits(rows, limit), MOST_BITS - depth)
            if more:
                old = entries.pop((depth, bits))
                for j in range(1 << more):
                    entries[depth + more, bits | j << depth] = old
        return Directory(entries)

    def slots(self, spark: SparkSession) -> DataFrame:
        """(slot, bucket): the bucket of every hash of ``depth`` bits."""
        rows = [(d, b, name((d, b))) for d, b in self.entries]
        table = spark.createDataFrame(rows, "depth int, bits long, bucket string")
        each = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"shiftleft(1L, {self.depth} - depth) - 1")))
        return table.select("bits", "depth", "bucket", each.alias("j")).select(
            F.expr("bits + shiftleft(j, depth)").alias("_slot"), F.col("bucket").alias("_bucket")
        )

    def placed(self, df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
        """``df`` with ``_bucket``, the name of each row's bucket."""
        slot = F.xxhash64(*keys).bitwiseAND(F.lit((1 << self.depth) - 1))
        slots = _small(self.slots(df.sparkSession), 1 << self.depth)
        return df.withColumn("_slot", slot).join(slots, "_slot").drop("_slot")


def _bits(rows: int, limit: int) -> int:
    return max(0, ceil(log2(rows / limit))) if rows > limit else 0


def _small(table: DataFrame, lines: int) -> DataFrame:
    return F.broadcast(table) if lines <= BROADCAST_LINES else table


def name(bucket: Bucket) -> str:
    return f"{bucket[0]}-{bucket[1]}"


def bucket_of(text: str) -> Bucket:
    depth, _, bits = text.partition("-")
    return int(depth), int(bits)


def read(spark: SparkSession, path: str, number: int) -> Directory:
    """The directory of a version."""
    if f"manifest={number}" not in subfolders(spark, path):
        raise FileNotFoundError(f"version {number} of {path} is missing")
    rows = spark.read.parquet(f"{path}/manifest={number}").collect()
    return Directory({bucket_of(r["bucket"]): Entry(r["version"], r["rows"]) for r in rows})


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions that have a directory."""
    names = (n for n in subfolders(spark, path) if n.startswith("manifest="))
    return sorted(int(n.partition("=")[2]) for n in names)


def held(path: str, directory: Directory, buckets: Sequence[Bucket] | None = None) -> dict[str, list[str]]:
    """The folders that hold the rows of the named buckets, or of all, with their names in each."""
    found: dict[str, list[str]] = {}
    for b in directory.entries if buckets is None else buckets:
        entry = directory.entries[b]
        if entry.version >= 0 and entry.rows:
            found.setdefault(f"{path}/version={entry.version}", []).append(name(b))
    return found


def named(names: Sequence[str]) -> str:
    """The condition that a row lies in one of the buckets."""
    return f"_bucket IN ({', '.join(map(repr, names))})"


def rows_of(spark: SparkSession, path: str, schema, directory: Directory, buckets=None) -> DataFrame:
    wide = StructType([*schema.fields, StructField("_bucket", StringType())])
    found = spark.createDataFrame([], schema)
    for i, (folder, names) in enumerate(sorted(held(path, directory, buckets).items())):
        rows = spark.read.schema(wide).parquet(folder)
        if len(names) <= NAMED_BUCKETS:
            rows = rows.filter(named(names))
        else:
            wanted = spark.createDataFrame([(n,) for n in names], "_bucket string")
            rows = rows.join(_small(wanted, len(names)), "_bucket", "left_semi")
        rows = rows.select(*schema.names)
        found = found.unionAll(rows) if i else rows
    return found


def touched(df: DataFrame, directory: Directory, keys: Sequence[str]) -> dict[Bucket, int]:
    """Rows of ``df`` for every bucket it has rows for."""
    counted = directory.placed(df.select(*keys), keys).groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"))
    return {bucket_of(r["_bucket"]): r["n"] for r in counted.collect()}


def write(
    df: DataFrame, path: str, number: int, before: Directory, after: Directory,
    rewritten: Sequence[Bucket], keys: Sequence[str], rows: int,
) -> Directory:
    """Write the rows of the ``rewritten`` buckets of ``before`` as version ``number``.

    ``after`` is ``before`` with some of them split, ``rows`` about how many rows there are.
    Returns the directory written; a repeated call with the same input replaces the version.
    """
    spark = df.sparkSession
    target = f"{path}/version={number}"
    old = set(before.entries)
    again = set(rewritten)
    fresh = [b for b in after.entries if b not in old or b in again]
    tasks = max(1, min(len(fresh), ceil(rows / FILE_ROWS)))
    laid = after.placed(df, keys).repartition(tasks, "_bucket").sortWithinPartitions("_bucket")
    laid.write.mode("overwrite").parquet(target)
    counted = spark.read.schema("_bucket string").parquet(target).groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"))
    written = {bucket_of(r["_bucket"]): r["n"] for r in counted.collect()}
    entries = dict(after.entries) | {b: Entry(number, written.get(b, 0)) for b in fresh}
    lines = [(name(b), e.version, e.rows) for b, e in entries.items()]
    spark.createDataFrame(lines, "bucket string, version int, rows long").coalesce(1).write.mode(
        "overwrite").parquet(f"{path}/manifest={number}")
    return Directory(entries)


def forget(spark: SparkSession, path: str, number: int, keep: int) -> None:
    """Remove directories older than the last ``keep`` and versions none of those names."""
    manifests = versions(spark, path)
    kept = [m for m in manifests if m <= number][-keep:]
    living = spark.read.parquet(*[f"{path}/manifest={m}" for m in kept]).select("version").distinct()
    used = {r["version"] for r in living.collect()} | {number}
    for m in manifests:
        if m < kept[0]:
            delete_folder(spark, f"{path}/manifest={m}")
    for n in subfolders(spark, path):
        if n.startswith("version=") and (v := int(n.partition("=")[2])) < number and v not in used:
            delete_folder(spark, f"{path}/version={v}")
