"""Best-fit packing of documents into bins of fixed length, under conflicts.

A document longer than a bin is cut into full pieces, each a bin of its own, and a rest.
Rests and short documents are packed in descending length. Bins are ordered by the room
they have left and carry two bitmaps: of the duplicate clusters inside, and of the
sources that have reached ``per_source`` pieces inside. A piece goes to the bin with the
least sufficient room; if that bin holds its cluster or is closed to its source, the
search goes on with its successor until the tightest compatible bin is found, or a new
bin is opened.

Documents are dealt by a hash to shards of about ``SHARD_ROWS`` pieces, packed side by
side, each by one task; copies of one row are numbered, so repeated rows spread over all
shards as well. A shard leaves about one bin part empty.

Defined cases: a document without words needs no room and gets one row with length 0 and
no bin. A null source is a source of its own; a null cluster conflicts with nothing.
Rows that are equal are packed once each. An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tierworks.llm.common import id_hash, parts_for, staged

CAPACITY = 4096
PER_SOURCE = 4
SHARD_ROWS = 8192
# Bins of one shard are numbered from shard * BINS_PER_SHARD.
BINS_PER_SHARD = 2**32

SCHEMA = """doc_id long, has_id boolean, copy long, piece long, start long, length long,
            source string, cluster string, bin_id long, place long"""


def best_fit(lengths, sources, clusters, capacity: int, per_source: int) -> list[int]:
    """The bin of each piece, in the order given. ``clusters``: -1 never conflicts."""
    rooms: list[int] = []  # different amounts of room, ascending
    bins_with: dict[int, list[int]] = defaultdict(list)
    held_clusters: list[int] = []
    closed_sources: list[int] = []
    of_source: list[Counter] = []
    chosen = []
    for length, source, cluster in zip(lengths, sources, clusters, strict=True):
        cluster_bit = 1 << cluster if cluster >= 0 else 0
        source_bit = 1 << source
        found, room = -1, capacity
        for at in range(bisect_left(rooms, length), len(rooms)):
            for b in bins_with[rooms[at]]:
                if not (held_clusters[b] & cluster_bit or closed_sources[b] & source_bit):
                    found, room = b, rooms[at]
                    break
            if found >= 0:
                break
        if found < 0:
            found = len(held_clusters)
            held_clusters.append(0)
            closed_sources.append(0)
            of_source.append(Counter())
        else:
            bins_with[room].remove(found)
            if not bins_with[room]:
                del rooms[bisect_left(rooms, room)]
        held_clusters[found] |= cluster_bit
        of_source[found][source] += 1
        if of_source[found][source] >= per_source:
            closed_sources[found] |= source_bit
        left = room - length
        if left:
            if not bins_with[left]:
                insort(rooms, left)
            bins_with[left].append(found)
        chosen.append(found)
    return chosen


def _pack_shard(capacity: int, per_source: int):
    def pack(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(
            ["length", "has_id", "doc_id", "source", "cluster", "copy", "piece"],
            ascending=[False, False, True, True, True, True, True], na_position="last",
        ).reset_index(drop=True)
        sources = pd.factorize(frame["source"], use_na_sentinel=False)[0]
        # A cluster met once in the shard conflicts with nothing and needs no bit.
        shared = frame["cluster"].notna() & frame["cluster"].duplicated(keep=False)
        clusters = np.full(len(frame), -1)
        clusters[shared] = pd.factorize(frame.loc[shared, "cluster"])[0]
        bins = best_fit(
            frame["length"].tolist(), sources.tolist(), clusters.tolist(), capacity, per_source
        )
        frame["bin_id"] = int(key[0]) * BINS_PER_SHARD + np.array(bins, dtype="int64")
        frame["place"] = frame.groupby("bin_id").cumcount()
        return frame[["doc_id", "has_id", "copy", "piece", "start", "length", "source", "cluster",
                      "bin_id", "place"]]

    return pack


def pack(
    items: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """(doc_id long, size long, source string, cluster string) to one row per piece.

    Rows have doc_id, copy (1 and up among equal rows), piece (from 0), the start and
    length of the piece in words, source, cluster, bin_id and place within the bin.
    """
    counted = items.groupBy("doc_id", "size", "source", "cluster").agg(
        F.count(F.lit(1)).alias("copies")
    )
    numbered = counted.select(
        "doc_id", "size", "source", "cluster",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
    )
    last = F.floor((F.greatest(F.col("size"), F.lit(1)) - 1) / capacity)
    pieces = numbered.select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("piece")
    ).select(
        "doc_id", "copy", "piece",
        (F.col("piece") * capacity).alias("start"),
        F.least(F.lit(capacity).cast("long"), F.col("size") - F.col("piece") * capacity)
        .alias("length"),
        "source", "cluster",
    )
    pieces = staged(pieces, "pieces")
    nothing = pieces.filter("length = 0").select(
        "*", F.lit(None).cast("long").alias("bin_id"), F.lit(None).cast("long").alias("place")
    )
    filled = pieces.filter("length > 0")
    shards = parts_for(filled.count(), shard_rows)
    spread = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                         F.col("copy"), F.col("piece"))
    sharded = filled.withColumn("shard", F.pmod(id_hash(spread, "pack"), F.lit(shards)))
    # pandas turns integers with gaps into floats, so a null id travels as 0 with a mark.
    whole = sharded.withColumn("has_id", F.col("doc_id").isNotNull()).fillna(0, ["doc_id"])
    packed = whole.groupBy("shard").applyInPandas(_pack_shard(capacity, per_source), SCHEMA)
    restored = packed.withColumn("doc_id", F.when(F.col("has_id"), F.col("doc_id"))).drop("has_id")
    return restored.unionByName(nothing)
