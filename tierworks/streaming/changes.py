"""Applying streams of changes and consuming change feeds."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierworks.operators import changes
from tierworks.session import subfolders
from tierworks.sources import directory as dr


KEEP_VERSIONS = 3


def apply_stream(
    stream: DataFrame,
    initial: DataFrame,
    path: str,
    checkpoint: str,
    key: Sequence[str] | str,
    sequence: Sequence[str] | str,
    kind: str = changes.CHANGE_COLUMN,
    buckets: int = 1,
    bucket_rows: int = dr.BUCKET_ROWS,
    keep: int = KEEP_VERSIONS,
) -> DataFrame:
    """Merge all available changes into a versioned target below ``path``; returns it.

    The target lies in hash buckets of the key, with the sequence of every row and
    tombstones of deleted ones, so the result does not depend on how changes fall into
    batches. Batch ``n`` rewrites the buckets it has changes for, splits those that could
    come to more than ``bucket_rows`` rows, and writes a directory of all buckets; it
    starts with ``buckets`` buckets, or as many as the first rows need. A batch repeated
    after a failure rewrites its own version from the same input. Versions that the last
    ``keep`` directories do not name are removed.
    """
    spark = stream.sparkSession
    keys = [key] if isinstance(key, str) else list(key)
    order = [sequence] if isinstance(sequence, str) else list(sequence)
    sequence_type = stream.select(F.struct(*order).alias("_seq")).schema["_seq"].dataType
    fresh = initial.select(
        "*", F.lit(None).cast(sequence_type).alias("_seq"), F.lit(False).alias("_deleted")
    )
    schema = fresh.schema

    def merge(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        if number:
            before = dr.read(session, path, number - 1)
            changed = dr.touched(batch, before, keys)
            state = dr.rows_of(session, path, schema, before, list(changed))
        else:
            rows = fresh.count() + batch.count()
            before = dr.Directory.of_size(rows, bucket_rows, buckets)
            changed = dict.fromkeys(before.entries, 0)
            state = fresh
        planned = {b: before.entries[b].rows + n for b, n in changed.items()}
        rows = sum(planned.values()) if number else rows
        after = before.split(planned, bucket_rows)
        merged = changes.merge_state(state, batch, keys, order, kind)
        dr.write(merged, path, number, before, after, list(changed), keys, rows)
        dr.forget(session, path, number, keep)

    query = (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    number = last_batch(spark, checkpoint)
    if number < 0:
        return initial
    living = dr.rows_of(spark, path, schema, dr.read(spark, path, number)).filter("NOT _deleted")
    return living.select(*initial.columns)


def last_batch(spark: SparkSession, checkpoint: str) -> int:
    """Number of the newest batch the checkpoint has committed, -1 if there is none."""
    if "commits" not in subfolders(spark, checkpoint):
        return -1
    commits = spark.read.format("binaryFile").load(f"{checkpoint}/commits").select("path")
    number = F.regexp_extract("path", r"/([0-9]+)$", 1).try_cast("int")
    return commits.agg(F.coalesce(F.max(number), F.lit(-1))).first()[0]


def consume(
    feed: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]
) -> None:
    """Hand every change-feed row that is new since the last call to ``handle``."""
    query = (
        feed.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
