"""Append-only bronze tables: each run takes what arrived since the last one."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tierworks.operators.shape import add_audit, require


def prepare(
    stream: DataFrame, keys: Sequence[str], source: str, run_ts: datetime | str | None = None
) -> DataFrame:
    """The bronze contract for a stream: keys filled, audit columns last, nothing else."""
    return add_audit(require(stream, *keys), source, run_ts)


def drop_replays(stream: DataFrame, keys: Sequence[str], moment: str, delay: str) -> DataFrame:
    """Drop rows that arrive again within ``delay``; state is kept no longer than that.

    Watermarks need a zoned timestamp, so one is made where the column has no zone.
    """
    marked = stream.withColumn("_seen_at", F.col(moment).cast("timestamp"))
    deduped = marked.withWatermark("_seen_at", delay).dropDuplicatesWithinWatermark(list(keys))
    return deduped.drop("_seen_at")


def append(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write everything available as Parquet, then stop.

    The sink's commit log makes a retried batch replace its own files, so a restart
    after any failure neither loses nor repeats rows.
    """
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
