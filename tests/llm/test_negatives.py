"""Hard negatives against all inner products, in Python integers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierworks.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, anchors, n_positives=5, n_negatives=3):
    one = {}
    for i, v, label in sorted(
        (r for r in rows if r[0] is not None and r[2] is not None and r[1] is not None
         and all(x is not None and math.isfinite(x) for x in r[1])),
        key=lambda r: (r[0], r[2], r[1]),
    ):
        one.setdefault(i, ([math.floor(256 * x) if abs(x) < 1e300 else int(x) * 256 for x in v], label))
    limit = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    product = lambda v, w: limit(sum(x * y for x, y in zip(v, w)))
    found = []
    for a in sorted(i for i in one if anchors(i)):
        vector, label = one[a]
        scored = sorted(
            ((-product(vector, v), i, own) for i, (v, own) in one.items() if i != a)
        )
        for score, p, own in [s for s in scored if s[2] == label][:n_positives]:
            inside = [s for s in scored if s[2] != label and -50 * score <= -100 * s[0] <= -95 * score]
            found += [
                (a, p, k, i, -score, -s) for k, (s, i, _) in enumerate(inside[:n_negatives], 1)
            ]
    return sorted(found)


def mined(spark, rows, every=4, **settings):
    vectors = negatives.prepared(spark.createDataFrame(rows, SCHEMA))
    found = negatives.mine(vectors, vectors.filter(F.col("vec_id") % every == 0), **settings)
    return sorted(tuple(r) for r in found.collect())


def some_rows(n, dims=8, labels=3, seed=1):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(labels)]
    rows = []
    for i in range(n):
        label = rng.randrange(labels)
        size = rng.choice([0.2, 1.0, 1.1, 5.0])
        rows.append((i, [size * (m + rng.gauss(0, 0.7)) for m in middles[label]], label))
    return rows


ODD = [
    (1000, None, 1), (1004, [1.0] * 8, None), (None, [1.0] * 8, 1), (1008, [None] + [1.0] * 7, 1),
    (1012, [float("nan")] * 8, 1), (1016, [float("inf")] * 8, 2), (1020, [0.0] * 8, 1), (1024, [], 2),
    (1028, [0.5, 0.5], 1), (1032, [1.0] * 12, 0), (3, [9.0] * 8, 2),
]


@pytest.mark.parametrize("settings", [{}, {"bucket_rows": 9, "anchor_rows": 5}])
def test_against_all_products(spark, settings):
    rows = some_rows(160) + ODD
    assert mined(spark, rows, **settings) == brute(rows, lambda i: i % 4 == 0)


def test_ties_and_a_very_common_vector(spark):
    rows = some_rows(60) + [(i, [0.25] * 8, i % 2) for i in range(60, 200)]
    assert mined(spark, rows, bucket_rows=20) == brute(rows, lambda i: i % 4 == 0)


def test_repeated_rows_and_few_candidates(spark):
    rows = some_rows(6)
    assert mined(spark, rows * 3) == brute(rows, lambda i: i % 4 == 0)


def test_scores_beyond_doubles(spark):
    rows = [(i, [2.0**40 + i, 1.0, -(2.0**40)], i % 2) for i in range(12)]
    rows += [(20, [1e200, 1.0, 0.0], 0), (24, [1.7e308, 0.0, 1.0], 0), (25, [9e307, 0.0, 0.0], 1)]
    assert mined(spark, rows) == brute(rows, lambda i: i % 4 == 0)


def test_empty_tables_and_clashing_names(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(i, [1.0], 1) for i in (1, 2, 3)]) == []
    rows = some_rows(40)
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("vector", "length", "seq", "block", "score", "anchor_id", "row", "step"):
        frame = frame.withColumn(name, F.lit(1))
    vectors = negatives.prepared(frame)
    found = negatives.mine(vectors, vectors.filter("vec_id % 4 = 0"))
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, lambda i: i % 4 == 0)


def test_pruning_skips_rows_but_never_one_that_reaches_the_threshold():
    rng = np.random.default_rng(2)
    drawn = rng.normal(size=(400, 5))
    drawn /= np.sqrt((drawn**2).sum(axis=1, keepdims=True)) * rng.uniform(1, 1.05, (400, 1))
    vectors = np.floor(256 * drawn)
    bucket = negatives.Bucket(np.arange(400), np.zeros(400, int), vectors)
    fewer = 0
    for query in vectors[:60]:
        length, unit = negatives._lengths(query[None])
        scores = vectors @ query
        for threshold in np.quantile(scores, [0.2, 0.5, 0.9, 0.99, 1.0]):
            near = bucket.feasible(unit[0], float(length[0]), threshold)
            assert set(np.flatnonzero(scores >= threshold)) <= set(near.tolist())
            fewer += len(near) < 200
    assert fewer > 120
    assert len(bucket.feasible(unit[0], float(length[0]), float(length[0]) * bucket.longest * 256**2 * 1.01)) == 0


def test_rounds_cover_every_bucket():
    assert negatives.rounds(0) == []
    assert negatives.rounds(10, 4) == [(0, 0), (1, 4), (5, 9)]


def test_copies_of_rows_and_anchors_grow_with_the_rows():
    # Vectors of 64 parts, every fiftieth an anchor: a row's copies and an anchor's, per row.
    for rows in (50_000, 600_000, 5_000_000, 15_000_000):
        classes = [(0, rows, 1.0, 64)]
        asked, most = rows // 50, negatives.fitting(classes)
        bucket_rows = negatives.rows_in_buckets(classes)
        buckets = negatives.parts_for(rows, bucket_rows)
        spans = [last - first + 1 for first, last in negatives.rounds(buckets)]
        blocks = [negatives.blocks_of(asked, min(most, negatives.ANCHOR_ROWS), n) for n in spans]
        copies = sum(b * n * bucket_rows for b, n in zip(blocks, spans)) + asked * buckets
        assert copies < 8 * rows
        assert bucket_rows * 64 <= negatives.BLOCK_VALUES


def test_small_vectors_travel_in_few_bytes_and_come_back():
    drawn = np.random.default_rng(3).normal(size=(50, 64))
    drawn /= np.sqrt((drawn**2).sum(axis=1, keepdims=True))
    drawn[7] *= 30
    drawn[8] *= 1e6
    found, lengths = negatives.packed(drawn)
    assert [len(found[k]) for k in (0, 7, 8)] == [65, 129, 513]
    assert np.allclose(lengths, np.sqrt((np.floor(256 * drawn) ** 2).sum(axis=1)) / 256)
    mixed = [*found, *negatives.packed(np.array([[1.0, -2.0]]))[0], *negatives.packed(np.zeros((1, 0)))[0]]
    opened = negatives.unpacked(np.array(mixed, dtype=object))
    assert (opened[:50] == np.floor(256 * drawn)).all()
    assert opened[50].tolist() == [256, -512] + [0] * 62
    assert not opened[51].any()
    beyond = negatives.unpacked(np.array(negatives.packed(np.array([[1e308, 0.5]]))[0], dtype=object))
    assert beyond[0].tolist() == [int(1e308) * 256, 128]


@pytest.mark.parametrize("size", [1, 1e4, 1e6])
@pytest.mark.parametrize("copies", [1, 300])
def test_tiles_against_all_products(monkeypatch, size, copies):
    monkeypatch.setattr(negatives, "TILE_ROWS", 64)
    monkeypatch.setattr(negatives, "TILE_ANCHORS", 8)
    monkeypatch.setattr(negatives, "WAITING", 50)
    rng = np.random.default_rng(4)
    vectors = np.floor(256 * size * rng.normal(size=(500, 6)))
    vectors[: copies - 1] = vectors[copies - 1]
    vectors[490:, 0] = 0
    ids = np.sort(rng.choice(5000, 500, replace=False))
    labels = rng.integers(0, 3, 500)
    asked = np.arange(0, 500, 9)
    scores = [[sum(int(x) * int(y) for x, y in zip(vectors[a], v)) for v in vectors] for a in asked]
    ordered = np.sort(np.array(scores, dtype=object), axis=1)
    lows = np.array([[-(1 << 63), r[300], r[480]] for r in ordered], dtype=np.int64)
    highs = np.array([[r[450], r[495], (1 << 63) - 1] for r in ordered], dtype=np.int64)
    for some in (slice(0, 3), slice(1, 3), slice(2, 3)):
        bucket = negatives.Bucket(ids, labels, vectors)
        found = negatives.searched(
            bucket, vectors[asked], lows[:, some], highs[:, some], 4, lambda a, r: labels[r] != labels[asked[a]]
        )
        expected = [
            (a, w, r, scores[a][r])
            for a, k in enumerate(asked)
            for w, (low, high) in enumerate(zip(lows[a, some].tolist(), highs[a, some].tolist()))
            for r in sorted(
                (r for r in range(500) if labels[r] != labels[k] and low <= scores[a][r] <= high),
                key=lambda r: (-scores[a][r], ids[r]),
            )[:4]
        ]
        assert sorted(zip(*(x.tolist() for x in found))) == sorted(expected)


def test_best_ranges_count_every_row_that_reaches_the_threshold():
    rng = np.random.default_rng(5)
    vectors = np.floor(256 * rng.normal(size=(400, 5)) * [20, 1, 1, 1, 1])
    bucket = negatives.Bucket(np.arange(400), np.zeros(400, int), vectors)
    lengths, units = negatives._lengths(vectors[:60])
    scores = vectors[:60] @ vectors.T
    for share in (0.5, 0.9, 0.99, 1.0):
        thresholds = np.quantile(scores, share, axis=1)
        reachable = bucket.reachable(units, lengths, thresholds)
        assert (reachable >= (scores >= thresholds[:, None]).sum(axis=1)).all()
        near = [len(bucket.feasible(*x)) for x in zip(units, lengths.tolist(), thresholds.tolist())]
        assert all(n <= r or n == 400 for n, r in zip(near, reachable))
    assert (reachable < 200).sum() > 20
    assert not bucket.reachable(units, lengths, np.full(60, 1e18)).any()


def test_blocks_of_early_rounds(spark, monkeypatch):
    monkeypatch.setattr(negatives, "LEAST_ANCHORS", 3)
    monkeypatch.setattr(negatives, "BUCKET_ROWS", 20)
    rows = some_rows(160) + ODD
    assert mined(spark, rows) == brute(rows, lambda i: i % 4 == 0)
