"""Approximate nearest neighbours with a permutation index.

A vector is represented by the order of its ``POSTED`` nearest pivots. Vectors are dealt by
id to segments of about ``SEGMENT_ROWS``; a segment is an inverted file: the posting list of
a pivot names the vectors that have it among their nearest, with its place in their order.
A query reads only the lists of its own ``READ`` nearest pivots and adds up how much each
posting takes off the footrule distance of two such orders, in which an absent pivot
stands behind the last place. The nearest ``RERANK`` share of the segment is ranked again by
exact distance; vectors met in no list are the furthest and fill up a share only where too
few were met. The best of all segments are merged.

Queries are cut into blocks; a block meets every segment in one group, so memory is
bounded by a segment and a block whatever the number of rows.

Pivots are ``PIVOTS`` different vectors with the smallest hashes of their ids, looked for
among the first ``8 * PIVOTS`` rows in that order; every row is indexed.

Defined cases: vectors that are null, empty, zero, hold null or non-finite components or
have another length than most vectors take no part. Of rows with one id the smallest
vector counts. Ties go to the smaller id, also where candidates are cut by footrule. A
query with fewer candidates gets all of them, no vector or no query gives no row. Vectors of
any length are read whole; other columns are never read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tierworks.llm.common import id_hash, parts_for, staged

NEAREST = 10
PIVOTS = 256
POSTED = 64
READ = 64
SEGMENT_ROWS = 8192
QUERY_ROWS = 8192
RERANK = 0.15
RERANK_LEAST = 200

SCHEMA = "query_id long, vec_id long, score double"


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def clean(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, vector) of the rows that take part, one per id, written once."""
    rows = df.select(
        F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")
    ).filter(usable(F.col("vector")) & F.col("vec_id").isNotNull())
    one = staged(rows.groupBy("vec_id").agg(F.min("vector").alias("vector")), "vectors")
    most = one.groupBy(F.size("vector").alias("dim")).count().orderBy(
        F.desc("count"), "dim"
    ).first()
    return one.filter(F.size("vector") == (most["dim"] if most else 0))


def choose_pivots(vectors: DataFrame, pivots: int = PIVOTS) -> np.ndarray:
    first = vectors.orderBy(id_hash(F.col("vec_id"), "pivot"), "vec_id").limit(8 * pivots)
    different = list(dict.fromkeys(tuple(r["vector"]) for r in first.collect()))
    return np.array(different[:pivots], dtype=np.float64)


def orders(vectors: np.ndarray, pivots: np.ndarray, depth: int) -> np.ndarray:
    """The numbers of each vector's ``depth`` nearest pivots, nearest first; ties by number."""
    apart = (pivots**2).sum(axis=1) - 2 * (vectors @ pivots.T)
    return np.argsort(apart, axis=1, kind="stable")[:, :depth]


def inverted_file(order: np.ndarray, pivots: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each pivot the rows that have it in their order and its place there."""
    depth = order.shape[1]
    by_pivot = np.argsort(order, axis=None, kind="stable")
    ends = np.cumsum(np.bincount(order.ravel(), minlength=pivots))[:-1]
    rows, at = np.split(by_pivot // depth, ends), np.split(by_pivot % depth, ends)
    return list(zip(rows, at, strict=True))


def closeness(
    lists: list[tuple[np.ndarray, np.ndarray]], order: np.ndarray, rows: int, depth: int
) -> np.ndarray:
    """How far each row's footrule distance is below that of two orders without a common pivot.

    A pivot on places a and b adds ``2 * (depth - max(a, b))``, here without the factor:
    |a - b| takes the place of the two ways behind the last place.
    """
    found = np.zeros(rows, dtype=np.int64)
    for place, pivot in enumerate(order):
        members, at = lists[pivot]
        found[members] += depth - np.maximum(at, place)
    return found


def search_segment(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
    pivots: np.ndarray, nearest: int, share: float,
) -> pd.DataFrame:
    """The nearest of one segment for each query; ``ids`` ascend."""
    posted = min(POSTED, len(pivots))
    lists = inverted_file(orders(vectors, pivots, posted), len(pivots))
    depth = min(len(ids), max(RERANK_LEAST, nearest + 1, int(np.ceil(share * len(ids)))))
    by_id = np.arange(len(ids))
    found = []
    for query_id, query, order in zip(
        query_ids, queries, orders(queries, pivots, min(READ, posted)), strict=True
    ):
        # Equally close: smaller ids first, so ties are cut in the order of the result.
        ranked = by_id - closeness(lists, order, len(ids), posted) * len(ids)
        near = np.argpartition(ranked, depth - 1)[:depth]
        near = near[ids[near] != query_id]
        score = np.sqrt(((vectors[near] - query) ** 2).sum(axis=1))
        best = np.lexsort((ids[near], score))[:nearest]
        found.append(pd.DataFrame(
            {"query_id": query_id, "vec_id": ids[near][best], "score": score[best]}))
    return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def _search(pivots: np.ndarray, nearest: int, share: float):
    def search(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("vec_id")
        query = frame["query"].to_numpy(bool)
        ids, stacked = frame["vec_id"].to_numpy(), np.stack(frame["vector"].to_list())
        if query.all():
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "vec_id": "int64"})
        return search_segment(
            ids[~query], stacked[~query], ids[query], stacked[query], pivots, nearest, share
        )

    return search


def nearest_neighbours(
    vectors: DataFrame, queries: DataFrame, nearest: int = NEAREST, pivots: int = PIVOTS,
    share: float = RERANK,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of cleaned ``queries`` among cleaned ``vectors``."""
    rows, asked = vectors.count(), queries.count()
    chosen = choose_pivots(vectors, pivots)
    segments, blocks = parts_for(rows, SEGMENT_ROWS), parts_for(asked, QUERY_ROWS)
    segment = F.pmod(id_hash(F.col("vec_id"), "segment"), F.lit(segments))
    block = F.pmod(id_hash(F.col("vec_id"), "block"), F.lit(blocks))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    indexed = vectors.select(
        "vec_id", "vector", F.lit(False).alias("query"), segment.alias("segment"),
        each(blocks).alias("block"),
    )
    posed = queries.select(
        "vec_id", "vector", F.lit(True).alias("query"), each(segments).alias("segment"),
        block.alias("block"),
    )
    found = indexed.unionByName(posed).groupBy("segment", "block").applyInPandas(
        lambda key, frame: _search(chosen, nearest, share)(frame), SCHEMA
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= nearest)
    return ranked.select("query_id", "rank", "vec_id", "score")
