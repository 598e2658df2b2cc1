"""Hard negatives by inner product, found with coordinate pruning in length buckets.

Vectors are made of integers (``floor(SCALE * x)``), so scores are exact; they travel as
bytes where their parts are small. Rows are dealt to classes of equal length (within
``WIDTH``), the longest first, and classes by the hash of the id to buckets: ``BUCKETS`` of
them, of ``BUCKET_ROWS`` rows at least and ``BLOCK_VALUES`` values at most. In a bucket every
coordinate of the unit vectors has a sorted list. An anchor that only looks for scores of a
threshold or more skips buckets whose longest vector cannot reach it; elsewhere the angle the
threshold allows gives a feasible range of values for each of the anchor's ``FOCUS`` largest
coordinates, the rows in these ranges of the lists are intersected, and only the rest is
verified by its exact score. Anchors whose best range still holds more than ``DENSE`` of the
bucket are verified together against all of it, as products of small matrices; the best
found so far raise the threshold from one tile to the next.

Positives (the best rows of the anchor's label) are searched first. Each has a window of
scores, and the best rows of other labels in the window are its negatives. Buckets are
visited in rounds, each ``GROWTH`` times as long as the one before, and the best found so
far are the thresholds of the next round. Nothing is left out: a threshold only skips
rows that score less than rows found already. Anchors come in blocks; a task holds one
block and one bucket, whatever the number of rows.

Defined cases: rows with a null id, a null label or a vector that is null or holds null
or non-finite components take no part. Of rows with one id the one with the smallest
label, then vector, counts. Shorter vectors count as if filled up with zeros, so an empty
or a zero vector scores 0. Ties go to the smaller id. An anchor with fewer positives or
negatives gets all there are. A score beyond 64 bits counts as the nearest 64-bit number.
No rows, or no anchor, give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tierworks.llm.common import id_hash, parts_for, staged

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
#: Negatives score between these percentages of their positive's score.
LOW, HIGH = 50, 95
WIDTH = 1.05
BUCKETS = 64
BUCKET_ROWS = 8192
#: Of the vectors in a bucket or a block of anchors, which the longest fills up: 131,072 of 64 parts.
BLOCK_VALUES = 1 << 23
ANCHOR_ROWS = 131_072
#: Early rounds have few buckets; smaller blocks, of so many anchors or more, make so many groups.
GROUPS, LEAST_ANCHORS = 32, 1024
FOCUS = 4
GROWTH = 8
# Of a bucket, the share of rows in the best range from which on all are verified.
MOST = 0.5
# The share from which on a product with all rows takes less time than looking some up.
DENSE = 0.05
# Anchors and rows of one product, scores that wait to be ranked.
TILE_ANCHORS, TILE_ROWS = 256, 2048
WAITING = 1 << 13
MOST_TASKS = 4096
SLACK = 1e-9
NO_THRESHOLD = -(1 << 63)
LARGEST = (1 << 63) - 1

ROWS = "vec_id long, label long, vector binary, length double, width int"
# Kinds of packed vectors by their first byte, with the largest part they hold; the parts of
# others stay as they were before scaling.
SMALL = ((b"b", np.dtype("i1"), 127), (b"h", np.dtype("<i2"), 32767))
AS_IS = b"d"


def whole(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), exact; Python integers where doubles cannot hold it."""
    with np.errstate(over="ignore"):
        found = np.floor(SCALE * x)
    if np.isfinite(found).all():
        return found
    return np.array([int(v) * SCALE if abs(v) >= 2.0**53 else int(np.floor(SCALE * v)) for v in x], dtype=object)


def packed(matrix: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The whole vectors of rows as bytes, and their lengths."""
    with np.errstate(over="ignore"):
        parts = np.floor(SCALE * matrix)
    largest = np.abs(parts).max(axis=1, initial=0.0)
    found, lengths, left = [b""] * len(matrix), np.zeros(len(matrix)), largest >= 0
    for kind, dtype, most in SMALL:
        rows = np.flatnonzero(left & (largest <= most))
        left[rows] = False
        small = parts[rows].astype(dtype)
        lengths[rows] = _lengths(small)[0]
        for row, values in zip(rows.tolist(), small, strict=True):
            found[row] = kind + values.tobytes()
    for row in np.flatnonzero(left).tolist():
        lengths[row] = _lengths(whole(matrix[row])[None])[0][0]
        found[row] = AS_IS + matrix[row].astype("<f8").tobytes()
    return found, lengths


def unpacked(values: np.ndarray) -> np.ndarray:
    """Whole vectors as rows of one matrix, shorter ones filled up with zeros."""
    sizes = np.fromiter(map(len, values), np.int64, len(values))
    kinds = np.fromiter((v[0] for v in values), np.int64, len(values))
    dtypes = {kind[0]: dtype for kind, dtype, _ in SMALL}
    parts = []
    for kind, size in sorted(set(zip(kinds.tolist(), sizes.tolist(), strict=True))):
        rows = np.flatnonzero((kinds == kind) & (sizes == size))
        raw = np.frombuffer(b"".join(v[1:] for v in values[rows]), dtypes.get(kind, np.dtype("<f8")))
        matrix = raw.reshape(len(rows), -1) if size > 1 else np.zeros((len(rows), 0), np.int8)
        if kind not in dtypes:
            each = [whole(x) for x in matrix]
            matrix = np.array(each, dtype=object if any(x.dtype == object for x in each) else np.float64)
        parts.append((rows, matrix))
    matrices = [m for _, m in parts]
    width = max((m.shape[1] for m in matrices), default=0)
    found = np.zeros((len(values), width), np.result_type(np.int8, *(m.dtype for m in matrices)))
    for rows, matrix in parts:
        found[rows, : matrix.shape[1]] = matrix
    return found


def _widened(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, width - matrix.shape[1]))) if width > matrix.shape[1] else matrix


def products(rows: np.ndarray, largest: float, query: np.ndarray) -> np.ndarray:
    """Exact inner products with rows of values up to ``largest``, as 64-bit numbers; from
    Python integers, limited to 64 bits, where 53 bits might not do."""
    if not rows.size:
        return np.zeros(len(rows), np.int64)
    if object not in (rows.dtype, query.dtype):
        query = query.astype(np.float64)
        if largest * float(np.abs(query).max()) * rows.shape[1] < 2.0**53:
            return (rows.astype(np.float64) @ query).astype(np.int64)
    exact = [int(x) for x in query]
    sums = (sum(int(a) * b for a, b in zip(r, exact, strict=True)) for r in rows)
    return np.array([max(-LARGEST - 1, min(LARGEST, x)) for x in sums], dtype=np.int64)


def _unscaled(matrix: np.ndarray) -> np.ndarray:
    if matrix.dtype == object:
        return (matrix / SCALE).astype(np.float64)
    return matrix.astype(np.float64) / SCALE


def _norms(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths before scaling, as products of the largest part and the length relative to it."""
    values = _unscaled(matrix)
    largest = np.abs(values).max(axis=1, initial=0.0)
    largest_or_1 = np.where(largest > 0, largest, 1.0)
    short = np.sqrt(((values / largest_or_1[:, None]) ** 2).sum(axis=1))
    with np.errstate(over="ignore"):
        return short * largest, largest_or_1, np.where(short > 0, short, 1.0)


def _lengths(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths before scaling, and unit vectors; a vector is divided by its largest part first."""
    lengths, largest, short = _norms(matrix)
    return lengths, _unscaled(matrix) / largest[:, None] / short[:, None]


class Bucket:
    """Rows of like length, by id, with a sorted list for every coordinate, made when it is asked for."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.labels, self.vectors = ids, labels, vectors
        norms = [_norms(vectors[k : k + TILE_ROWS]) for k in range(0, len(ids), TILE_ROWS)]
        lengths, self.parts, self.shorts = (
            np.concatenate([n[k] for n in norms]) if norms else np.zeros(0) for k in range(3)
        )
        self.longest = float(lengths.max(initial=0.0))
        numbers = vectors.dtype != object
        self.largest = float(max(vectors.max(initial=0), -float(vectors.min(initial=0)))) if numbers else np.inf
        self.every = np.arange(len(ids))
        self._ends: dict[int, tuple[float, float]] = {}
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self._typed: dict[type, np.ndarray] = {}

    def unit(self, f: int, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Coordinate ``f`` of the unit vectors."""
        return _unscaled(self.vectors[rows, f]) / self.parts[rows] / self.shorts[rows]

    def ends(self, f: int) -> tuple[float, float]:
        """The least and the greatest value of a coordinate."""
        if f not in self._ends:
            values = self.unit(f)
            self._ends[f] = float(values.min()), float(values.max())
        return self._ends[f]

    def sorted(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """The rows by a coordinate, and its values."""
        if f not in self._lists:
            values = self.unit(f)
            order = np.argsort(values, kind="stable")
            self._lists[f] = order.astype(np.int32), values[order]
        return self._lists[f]

    def typed(self, kind: type) -> np.ndarray:
        """The vectors as floating point numbers."""
        if kind not in self._typed:
            self._typed[kind] = self.vectors.astype(kind)
        return self._typed[kind]

    def angles(self, lengths, thresholds) -> tuple[np.ndarray, np.ndarray]:
        """The angle a row can have to an anchor it reaches the threshold with, and where none does."""
        with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
            reach = np.asarray(lengths, dtype=np.float64) * self.longest
            asked = np.asarray(thresholds, dtype=np.float64) / SCALE**2
            none = (asked > 0) & (asked > reach * (1 + SLACK))
            return np.arccos(np.clip(np.where(none | (asked <= 0), 0.0, asked / reach), 0.0, 1.0)), none

    def feasible(self, unit: np.ndarray, length: float, threshold) -> np.ndarray:
        """The rows that can reach ``threshold`` with the anchor of this direction and length."""
        every = self.every
        if threshold <= 0:
            return every
        angle, none = self.angles(length, threshold)
        if none:
            return every[:0]
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        low, high = _ranges(unit[focus], angle)
        spans = [
            (np.searchsorted(values, a, "left"), np.searchsorted(values, b, "right"))
            for values, a, b in zip((self.sorted(int(f))[1] for f in focus), low, high, strict=True)
        ]
        least = min(range(len(spans)), key=lambda k: spans[k][1] - spans[k][0])
        start, end = spans[least]
        if end - start > MOST * len(every):
            return every
        found = self.sorted(int(focus[least]))[0][start:end]
        for k, f in enumerate(focus):
            if k != least:
                values = self.unit(int(f), found)
                found = found[(values >= low[k]) & (values <= high[k])]
        return found

    def reachable(self, units: np.ndarray, lengths: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
        """For every anchor, the number of rows in its best range."""
        found = np.full(len(units), len(self.ids))
        angle, none = self.angles(lengths, thresholds)
        found[none] = 0
        asked = np.flatnonzero((thresholds > 0) & ~none)
        if not len(asked) or not len(self.ids) or not units.shape[1]:
            return found
        width = min(FOCUS, units.shape[1])
        focus = np.argpartition(-np.abs(units[asked]), width - 1, axis=1)[:, :width]
        low, high = _ranges(np.take_along_axis(units[asked], focus, axis=1), angle[asked][:, None])
        for f in np.unique(focus).tolist():
            at, k = np.nonzero(focus == f)
            a, b = low[at, k], high[at, k]
            least, greatest = self.ends(f)
            narrow = np.flatnonzero((a > least) | (b < greatest))
            if len(narrow):
                values = self.sorted(f)[1]
                many = np.searchsorted(values, b[narrow], "right") - np.searchsorted(values, a[narrow], "left")
                found[asked[at[narrow]]] = np.minimum(found[asked[at[narrow]]], np.maximum(many, 0))
        return found


def _ranges(values: np.ndarray, angle) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest value of a coordinate within ``angle`` of a unit vector with ``values``."""
    own = np.arccos(np.clip(values, -1, 1))
    return np.cos(np.minimum(np.pi, own + angle)) - SLACK, np.cos(np.maximum(0.0, own - angle)) + SLACK


class Windows:
    """The best rows in windows of scores, up to ``most`` in each; ties go to the smaller id.

    Rows of one anchor come by ascending id or all at once, so in a full window only a
    higher score counts, which is its floor.
    """

    def __init__(self, lows: np.ndarray, highs: np.ndarray, most: int, ids: np.ndarray) -> None:
        self.lows, self.highs, self.most, self.ids = lows, highs, most, ids
        self.floors = lows.copy()
        none = np.zeros(0, np.int64)
        self.kept, self.waiting = [(none, none, none)], 0

    def add(self, anchors: np.ndarray, rows: np.ndarray, scores: np.ndarray) -> None:
        self.kept.append((anchors, rows, scores))
        self.waiting += len(anchors)
        if self.waiting > WAITING:
            self.ranked()

    def ranked(self) -> list[tuple[np.ndarray, ...]]:
        """(anchor, window, row, score) of the best so far; all others are forgotten."""
        anchors, rows, scores = (np.concatenate(x) for x in zip(*self.kept, strict=True))
        # The complement sorts downwards and, unlike a negative, fits 64 bits.
        order = np.lexsort((self.ids[rows], ~scores, anchors))
        anchors, rows, scores = anchors[order], rows[order], scores[order]
        used, found = np.zeros(len(anchors), bool), []
        for w in range(self.lows.shape[1]):
            inside = np.flatnonzero((scores >= self.lows[anchors, w]) & (scores <= self.highs[anchors, w]))
            owner = anchors[inside]
            rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
            top, last = inside[rank < self.most], inside[rank == self.most - 1]
            self.floors[anchors[last], w] = np.minimum(scores[last], LARGEST - 1) + 1
            used[top] = True
            found.append((anchors[top], np.full(len(top), w), rows[top], scores[top]))
        self.kept, self.waiting = [(anchors[used], rows[used], scores[used])], 0
        return found


def _exact_kind(bucket: Bucket, vectors: np.ndarray, longest: float) -> type | None:
    """Numbers that hold every partial sum of the products, which the lengths bound."""
    if object in (bucket.vectors.dtype, vectors.dtype):
        return None
    parts = vectors.astype(np.float64)
    largest = max(bucket.largest, np.abs(parts).max(initial=0.0))
    with np.errstate(over="ignore", invalid="ignore"):
        bound = max(largest, bucket.longest * longest * SCALE**2 * (1 + SLACK))
    return np.float32 if bound < 2.0**24 else np.float64 if bound < 2.0**53 else None


def _tiles(rows: int) -> list[tuple[int, int]]:
    """Starts and ends of tiles; the first are small, so that thresholds rise before many rows come."""
    ends, end = [0], TILE_ROWS // 8
    while ends[-1] < rows:
        ends.append(min(rows, end))
        end += min(TILE_ROWS, 3 * end)
    return list(zip(ends[:-1], ends[1:], strict=True))


def searched(
    bucket: Bucket, vectors: np.ndarray, lows: np.ndarray, highs: np.ndarray, most: int,
    allowed: Callable[[np.ndarray, np.ndarray], np.ndarray],
) -> tuple[np.ndarray, ...]:
    """(anchor, window, row, score): the best rows in the windows of every anchor, all by place."""
    found = [(np.zeros(0, np.int64),) * 4]
    room = {kind: np.empty(TILE_ANCHORS * TILE_ROWS, kind) for kind in (np.float32, np.float64)}
    marks = np.empty(TILE_ANCHORS * TILE_ROWS, bool)

    def finished(windows: Windows, some: np.ndarray) -> None:
        found.extend((some[a], w, r, s) for a, w, r, s in windows.ranked())

    for first in range(0, len(vectors) if len(bucket.ids) else 0, TILE_ROWS):
        several = np.arange(first, min(first + TILE_ROWS, len(vectors)))
        lengths, units = _lengths(vectors[several])
        reachable = bucket.reachable(units, lengths, lows[several].min(axis=1))
        dense = reachable > DENSE * len(bucket.ids)
        kind = _exact_kind(bucket, vectors[several], float(lengths.max(initial=0.0)))
        if kind is None:
            dense[:] = False
        together, alone = np.flatnonzero(dense), np.flatnonzero(~dense & (reachable > 0))
        for k in range(0, len(together), TILE_ANCHORS):
            some = several[together[k : k + TILE_ANCHORS]]
            windows, asked = Windows(lows[some], highs[some], most, bucket.ids), vectors[some].astype(kind)
            rows = bucket.typed(kind)
            for start, end in _tiles(len(rows)):
                # The same memory each time: fresh pages would take as long as the product.
                scores, high = (x[: len(some) * (end - start)].reshape(len(some), -1) for x in (room[kind], marks))
                np.matmul(asked, rows[start:end].T, out=scores)
                np.greater_equal(scores, windows.floors.min(axis=1).astype(kind)[:, None], out=high)
                near = np.flatnonzero(high)
                a, r = np.divmod(near, end - start)
                r += start
                fits = allowed(some[a], r)
                windows.add(a[fits], r[fits], scores.ravel()[near[fits]].astype(np.int64))
            finished(windows, some)
        for k in range(0, len(alone), TILE_ANCHORS):
            some = several[alone[k : k + TILE_ANCHORS]]
            windows = Windows(lows[some], highs[some], most, bucket.ids)
            for a, anchor in enumerate(some.tolist()):
                least, at = int(lows[anchor].min()), anchor - first
                r = bucket.feasible(units[at], lengths[at], least).astype(np.int64)
                scores = products(bucket.vectors[r], bucket.largest, vectors[anchor])
                near = np.flatnonzero(scores >= least)
                near = near[allowed(np.full(len(near), anchor), r[near])]
                windows.add(np.full(len(near), a), r[near], scores[near])
            finished(windows, some)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _opened(rows: pd.DataFrame, anchors: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    vectors, asked = (unpacked(x["vector"].to_numpy()) for x in (rows, anchors))
    width = max(vectors.shape[1], asked.shape[1])
    return _widened(vectors, width), _widened(asked, width)


def positives_in(rows: pd.DataFrame, anchors: pd.DataFrame, most: int) -> pd.DataFrame:
    """(anchor_id, vec_id, score): the best of one bucket with the anchor's label."""
    columns = ["anchor_id", "vec_id", "score"]
    if rows.empty or anchors.empty:
        return pd.DataFrame({c: np.zeros(0, np.int64) for c in columns})
    rows = rows.sort_values(["label", "vec_id"], ignore_index=True)
    anchors = anchors.sort_values("label", ignore_index=True)
    vectors, asked = _opened(rows, anchors)
    ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
    own, asking = anchors["anchor_id"].to_numpy(), anchors["label"].to_numpy()
    lows = anchors["threshold"].to_numpy()[:, None]
    found = []
    for label in np.unique(asking):
        some, several = (
            slice(np.searchsorted(x, label, "left"), np.searchsorted(x, label, "right")) for x in (labels, asking)
        )
        bucket, theirs = Bucket(ids[some], labels[some], vectors[some]), own[several]
        a, _, r, scores = searched(
            bucket, asked[several], lows[several], np.full_like(lows[several], LARGEST), most,
            lambda a, r, bucket=bucket, theirs=theirs: bucket.ids[r] != theirs[a],
        )
        found.append(pd.DataFrame({"anchor_id": theirs[a], "vec_id": bucket.ids[r], "score": scores}))
    return pd.concat(found, ignore_index=True)


def negatives_in(rows: pd.DataFrame, anchors: pd.DataFrame, most: int, high: int) -> pd.DataFrame:
    """(anchor_id, positive_id, positive_score, vec_id, score): the best of one bucket in each window.

    ``lows`` of an anchor hold the least score each of its positives still asks for.
    """
    columns = ["anchor_id", "positive_id", "positive_score", "vec_id", "score"]
    if rows.empty or anchors.empty:
        return pd.DataFrame({c: np.zeros(0, np.int64) for c in columns})
    rows = rows.sort_values("vec_id", ignore_index=True)
    vectors, asked = _opened(rows, anchors)
    bucket = Bucket(rows["vec_id"].to_numpy(), rows["label"].to_numpy(), vectors)
    many = anchors["lows"].map(len).to_numpy()
    shape = len(anchors), int(many.max())
    real = np.arange(shape[1]) < many[:, None]
    # Windows that an anchor lacks hold no score.
    positive, scored, highs = np.zeros(shape, np.int64), np.zeros(shape, np.int64), np.full(shape, -LARGEST - 1)
    lows = np.full(shape, LARGEST)
    positive[real], scored[real], lows[real] = (
        np.concatenate(anchors[c].tolist()) for c in ("positive_ids", "positive_scores", "lows")
    )
    highs[real] = [s * high // 100 for s in scored[real].tolist()]
    own, labels = anchors["anchor_id"].to_numpy(), anchors["label"].to_numpy()
    a, w, r, scores = searched(
        bucket, asked, lows, highs, most, lambda a, r: bucket.labels[r] != labels[a]
    )
    return pd.DataFrame(dict(zip(columns, (own[a], positive[a, w], scored[a, w], bucket.ids[r], scores), strict=True)))


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & finite


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("vector")
        values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        offsets = column.offsets.to_numpy()
        starts, widths = offsets[:-1] - offsets[0], np.diff(offsets)
        vectors, lengths = np.empty(len(column), object), np.zeros(len(column))
        for width in np.unique(widths):
            rows = np.flatnonzero(widths == width)
            vectors[rows], lengths[rows] = packed(values[starts[rows][:, None] + np.arange(width)])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("vec_id"), batch.column("label"), pa.array(vectors, pa.binary()), pa.array(lengths),
                pa.array(widths.astype(np.int32)),
            ],
            names=["vec_id", "label", "vector", "length", "width"],
        )


def prepared(df: DataFrame, label: Column | None = None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, label, vector, length, width) of the rows that take part, one per id; ``vector``
    as bytes (``packed``), ``length`` and number of parts of the whole vector."""
    wide = F.col(vector).cast("array<double>")
    # Floats compare as the doubles they become, and are half as long on their way.
    if df.schema[vector].dataType in (T.ArrayType(T.FloatType(), c) for c in (True, False)):
        wide = F.col(vector)
    rows = df.select(
        F.col(key).cast("long").alias("vec_id"),
        (F.col("label") if label is None else label).cast("long").alias("label"),
        wide.alias("vector"),
    ).filter(usable(F.col("vector")) & F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
    return staged(one.select("vec_id", "row.*").mapInArrow(_measured, ROWS), "vectors")


def _classed(vectors: DataFrame) -> DataFrame:
    step = F.when(F.col("length") > 0, F.floor(F.log("length") / np.log(WIDTH)).cast("int"))
    return vectors.withColumn("step", F.coalesce(step, F.lit(-(1 << 20))))


def classes_of(vectors: DataFrame) -> list[tuple[int, int, float, int]]:
    """(step, rows, greatest length, greatest width) of every class of lengths, the longest first.

    Lengths are doubles, so there are at most some 30,000 classes.
    """
    sizes = _classed(vectors).groupBy("step").agg(
        F.count(F.lit(1)).alias("n"), F.max("length").alias("upper"), F.max("width").alias("width")
    )
    return sorted(((r["step"], r["n"], r["upper"], r["width"]) for r in sizes.collect()), reverse=True)


def fitting(classes: list[tuple[int, int, float, int]]) -> int:
    """As many vectors as a task can hold of either side, ``BUCKET_ROWS`` at least."""
    return max(BUCKET_ROWS, BLOCK_VALUES // max([1, *(width for _, _, _, width in classes)]))


def rows_in_buckets(classes: list[tuple[int, int, float, int]]) -> int:
    return min(fitting(classes), max(BUCKET_ROWS, parts_for(sum(rows for _, rows, _, _ in classes), BUCKETS)))


def bucketed(
    vectors: DataFrame, classes: list[tuple[int, int, float, int]], bucket_rows: int
) -> tuple[DataFrame, DataFrame, int]:
    """``vectors`` with the number of their bucket, the table (seq, upper) and its size.

    ``upper`` is the greatest length a bucket can hold; longer buckets come first.
    """
    firsts, total = [], 0
    for step, rows, upper, _ in classes:
        parts = parts_for(rows, bucket_rows)
        firsts.append((step, total, parts, upper))
        total += parts
    table = vectors.sparkSession.createDataFrame(firsts, "step int, first long, parts long, upper double")
    part = F.pmod(id_hash(F.col("vec_id"), "bucket"), F.col("parts"))
    placed = _classed(vectors).join(F.broadcast(table), "step").select(
        "vec_id", "label", "vector", (F.col("first") + part).alias("seq")
    )
    each = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("parts") - 1))
    return staged(placed, "buckets"), table.select(each.alias("seq"), "upper"), total


def rounds(buckets: int, growth: int = GROWTH) -> list[tuple[int, int]]:
    """The first and last bucket of every round."""
    found, at, many = [], 0, 1
    while at < buckets:
        found.append((at, min(buckets, at + many) - 1))
        at, many = at + many, many * growth
    return found


def blocks_of(anchors: int, anchor_rows: int, buckets: int) -> int:
    """Blocks of anchors for a round of so many buckets."""
    return max(parts_for(anchors, anchor_rows), min(parts_for(GROUPS, buckets), parts_for(anchors, LEAST_ANCHORS)))


def _visits(
    placed: DataFrame, table: DataFrame, anchors: DataFrame, span: tuple[int, int], blocks_for: Callable[[int], int]
):
    """Rows and anchors of one round, grouped by block of anchors and bucket."""
    first, last = (F.lit(x).cast("long") for x in span)
    buckets = span[1] - span[0] + 1
    blocks = blocks_for(buckets)
    rows = placed.filter(F.col("seq").between(*span)).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    )
    reaches = (F.col("least") <= 0) | (F.col("least") <= F.col("length") * F.col("upper") * (SCALE**2 * (1 + SLACK)))
    block = F.pmod(id_hash(F.col("anchor_id"), "block"), F.lit(blocks))
    going = anchors.withColumn("block", block).withColumn("seq", F.explode(F.sequence(first, last)))
    going = going.join(table, "seq").filter(reaches).drop("upper", "length")
    # A group's work is by far larger than its bytes, so few groups may share a task.
    tasks = min(MOST_TASKS, 4 * blocks * buckets)
    rows, going = (side.repartition(tasks, "block", "seq").groupBy("block", "seq") for side in (rows, going))
    return rows.cogroup(going)


def _top(found: DataFrame, by: list[str], most: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def positives(
    placed: DataFrame, table: DataFrame, buckets: int, anchors: DataFrame, most: int, blocks: Callable[[int], int]
) -> DataFrame:
    """(anchor_id, vec_id, score, rank): the best other rows of each anchor's label."""
    schema, state = "anchor_id long, vec_id long, score long", None
    for span in rounds(buckets):
        asked = anchors
        if state is None:
            asked = asked.withColumn("threshold", F.lit(NO_THRESHOLD).cast("long"))
        else:
            full = state.groupBy("anchor_id").agg(F.min("score").alias("threshold"), F.count(F.lit(1)).alias("n"))
            full = full.filter(F.col("n") == most).drop("n")
            asked = asked.join(full, "anchor_id", "left").fillna({"threshold": NO_THRESHOLD})
        visits = _visits(placed, table, asked.withColumn("least", F.col("threshold")), span, blocks)
        found = visits.applyInPandas(lambda rows, some: positives_in(rows, some, most), schema)
        if state is not None:
            found = found.unionByName(state.drop("rank"))
        state = staged(_top(found, ["anchor_id"], most), "positives")
    return state


def mine(
    vectors: DataFrame, anchors: DataFrame, n_positives: int = POSITIVES, n_negatives: int = NEGATIVES,
    low: int = LOW, high: int = HIGH, bucket_rows: int | None = None, anchor_rows: int | None = None,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` and ``anchors`` come from ``prepared``; anchors are among the vectors. Rows
    in a bucket and anchors in a block follow from the number and size of the vectors, if not given.
    """
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    classes = classes_of(vectors)
    if bucket_rows is None:
        bucket_rows = rows_in_buckets(classes)
    placed, table, buckets = bucketed(vectors, classes, bucket_rows)
    posed = staged(anchors.select(F.col("vec_id").alias("anchor_id"), "label", "vector", "length"), "anchors")
    asked = posed.count()
    if not asked or not buckets:
        return vectors.sparkSession.createDataFrame([], result)
    blocks = partial(blocks_of, asked, anchor_rows or min(fitting(classes), ANCHOR_ROWS))
    pairs = positives(placed, table, buckets, posed, n_positives, blocks).select(
        "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    # Scores below this are outside a window; decimals, since products of long scores are longer.
    share = F.col("positive_score").cast("decimal(20,0)")
    least = F.ceil(share * low / 100).cast("decimal(22,0)")
    greatest = F.floor(share * high / 100).cast("decimal(22,0)")
    pairs = staged(
        pairs.filter(least <= greatest).withColumn("low", least.cast("long")), "positive-pairs"
    )
    schema = "anchor_id long, positive_id long, positive_score long, vec_id long, score long"
    state = None
    for span in rounds(buckets):
        open_pairs = pairs
        if state is not None:
            full = state.groupBy("anchor_id", "positive_id").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("n"))
            full = full.filter(F.col("n") == n_negatives).drop("n")
            open_pairs = pairs.join(full, ["anchor_id", "positive_id"], "left").withColumn(
                "low", F.greatest("low", "kth")
            )
        windows = open_pairs.groupBy("anchor_id").agg(
            F.collect_list(F.struct("positive_id", "positive_score", "low")).alias("windows"),
            F.min("low").alias("least"),
        )
        here = posed.join(windows, "anchor_id").select(
            "anchor_id", "label", "vector", "length", "least",
            F.col("windows.positive_id").alias("positive_ids"),
            F.col("windows.positive_score").alias("positive_scores"),
            F.col("windows.low").alias("lows"),
        )
        visits = _visits(placed, table, here, span, blocks)
        found = visits.applyInPandas(lambda rows, some: negatives_in(rows, some, n_negatives, high), schema)
        if state is not None:
            found = found.unionByName(state.drop("rank"))
        state = staged(_top(found, ["anchor_id", "positive_id"], n_negatives), "negatives")
    return state.select(
        "anchor_id", "positive_id", F.col("rank").cast("int"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
