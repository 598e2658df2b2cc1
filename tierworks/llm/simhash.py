"""Near duplicates by SimHash, compared exactly in tiles of equal population counts.

A fingerprint is cut into ``blocks``, and a tile holds the fingerprints with the same
population count in every block. Two fingerprints that differ in at most ``radius`` bits
have counts that differ by at most ``radius`` in sum, so only neighbouring tiles meet:
every fingerprint stays in its own tile and visits half of the neighbouring ones. Tiles
beyond ``tile_rows`` are split, and the parts meet pair by pair. In a group numpy takes
the exclusive or and counts bits in pieces, skipping pieces whose counts over every
second bit are too far apart. A group returns a forest of its links, not all pairs.

The work on links is quadratic within neighbouring tiles; ``blocks`` = 3 compares about a
tenth, 4 a twenty-fifth of all pairs of random fingerprints, for 33 or 66 visits each.

Defined cases: a null text is an empty one; without words the fingerprint is zero and
links like any other; fewer words than a shingle count as one shingle. Equal rows have
equal fingerprints. An id that is null takes no part in the smallest id of a component.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tierworks.llm.common import packed, parts_for, staged
from tierworks.llm.components import components

SHINGLE = 3
SEED = 42
RADIUS = 3
BLOCKS = 3
TILE_ROWS = 65_536
# Pairs compared at once by numpy, and shingles hashed at once.
PIECE = 1 << 21
CHUNK = 1 << 16
EVERY_SECOND = np.uint64(0x5555555555555555)


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text in UTF-8 as a signed 64-bit integer."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    total = max(1, len(words) - shingle + 1)
    shifted = (words[i:] for i in range(shingle))
    grams = map(b" ".join, zip(*shifted) if len(words) >= shingle else [words])
    hashed = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    while piece := [hashed(g, SEED) for g in itertools.islice(grams, CHUNK)]:
        octets = np.array(piece, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > total, bitorder="little")
    return int(bits.view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(prints, pa.int64())],
            names=["doc_id", "text_hash", "print"],
        )


def fingerprints(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, text_hash, print) of every row; the whole text is read."""
    narrow = df.select(
        F.col(key).cast("long").alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        F.col(text).alias("text"),
    )
    return narrow.mapInArrow(_fingerprints, "doc_id long, text_hash long, print long")


def masks(blocks: int) -> list[int]:
    """One mask per block of neighbouring bits, as signed integers."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    found = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in itertools.pairwise(edges)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in found]


def offsets(blocks: int, radius: int) -> list[tuple[int, ...]]:
    """Half of the tiles around one: of two opposite offsets one, and the zero offset."""
    cube = itertools.product(range(-radius, radius + 1), repeat=blocks)
    near = [o for o in cube if sum(map(abs, o)) <= radius]
    return sorted(o for o in near if o >= tuple([0] * blocks))


class Forest:
    """Joined sets of row numbers, kept flat so that roots are one lookup."""

    def __init__(self, size: int) -> None:
        self.root = np.arange(size)

    def join(self, left: np.ndarray, right: np.ndarray) -> None:
        a, b = self.root[left], self.root[right]
        apart = a != b
        if not apart.any():
            return
        pairs = np.unique(np.stack([a[apart], b[apart]], axis=1), axis=0)
        for x, y in pairs.tolist():
            while self.root[x] != x:
                x = self.root[x]
            while self.root[y] != y:
                y = self.root[y]
            self.root[max(x, y)] = min(x, y)
        while not np.array_equal(nearer := self.root[self.root], self.root):
            self.root = nearer


def linked(home: np.ndarray, guests: np.ndarray, inner: bool, radius: int) -> np.ndarray:
    """Links (two columns of prints) that join all prints of one group within ``radius``.

    ``home`` prints meet the ``guests``, and each other when ``inner`` is set.
    """
    every = np.concatenate([home, guests]).view(np.uint64)
    forest = Forest(len(every))
    counts = np.bitwise_count(every & EVERY_SECOND)
    others = np.arange(0 if inner else len(home), len(every))
    others = others[np.argsort(counts[others], kind="stable")]
    sorted_counts = counts[others].astype(int)
    own_counts = counts[: len(home)].astype(int)
    for count in np.unique(own_counts):
        rows = np.flatnonzero(own_counts == count)
        low, high = np.searchsorted(sorted_counts, [count - radius, count + radius + 1])
        near = others[low:high]
        step = max(1, PIECE // max(1, len(near)))
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            for to in range(0, len(near), PIECE):
                there = near[to : to + PIECE]
                apart = np.bitwise_count(every[some][:, None] ^ every[there][None, :])
                x, y = np.nonzero(apart <= radius)
                forest.join(some[x], there[y])
    nodes = np.flatnonzero(forest.root != np.arange(len(every)))
    signed = every.view(np.int64)
    return np.stack([signed[forest.root[nodes]], signed[nodes]], axis=1)


def _tiled(prints: DataFrame, blocks: int, radius: int, tile_rows: int) -> DataFrame:
    """Rows (tile, part, guest_part, print, guest) of all groups to compare."""
    spark = prints.sparkSession
    tile = F.array(*[F.bit_count(F.col("print").bitwiseAND(F.lit(m))) for m in masks(blocks)])
    placed = prints.select("print", tile.alias("tile"))
    # At most (64 / blocks + 1) ** blocks tiles exist, however many rows there are.
    sizes = {tuple(r["tile"]): r["n"] for r in placed.groupBy("tile").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    around = offsets(blocks, radius)
    minus = lambda t, o: tuple(x - y for x, y in zip(t, o))
    parts = {t: parts_for(n, tile_rows) for t, n in sizes.items()}
    visits = {t: max(parts.get(minus(t, o), 1) for o in around) for t in parts}
    table = spark.createDataFrame(
        [(list(t), p, visits[t]) for t, p in parts.items()],
        "tile array<int>, parts int, visits int",
    )
    own = placed.join(F.broadcast(table), "tile").withColumn(
        "own_part", F.pmod(F.xxhash64("print"), F.col("parts")).cast("int")
    )
    home = own.select(
        "tile",
        F.col("own_part").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("visits") - 1)).alias("guest_part"),
        "print",
        F.lit(False).alias("guest"),
    )
    shifts = F.array(*[F.array(*[F.lit(x) for x in o]) for o in around])
    target = F.zip_with("tile", "shift", lambda a, b: a + b)
    going = own.select("print", "tile", "own_part", F.explode(shifts).alias("shift")).select(
        target.alias("tile"), "own_part", "print",
        F.exists("shift", lambda x: x != 0).alias("away"),
    )
    guests = (
        going.join(F.broadcast(table.select("tile", "parts")), "tile")
        .select(
            "tile",
            F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
            F.col("own_part").alias("guest_part"),
            "print",
            "away",
        )
        .filter("away OR part < guest_part")
        .select("tile", "part", "guest_part", "print", F.lit(True).alias("guest"))
    )
    return home.union(guests)


def links(
    prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, tile_rows: int = TILE_ROWS
) -> DataFrame:
    """Different prints (column ``print``) to links (a, b) that connect all near ones."""

    def compare(key, frame: pd.DataFrame) -> pd.DataFrame:
        values, guest = frame["print"].to_numpy(np.int64), frame["guest"].to_numpy(bool)
        inner = int(key[2]) == 0
        found = linked(values[~guest], values[guest], inner, radius)
        return pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})

    tiled = _tiled(prints, blocks, radius, tile_rows)
    keyed = tiled.withColumn("tile", F.concat_ws("-", F.col("tile").cast("array<string>")))
    return keyed.groupBy("tile", "part", "guest_part").applyInPandas(compare, "a long, b long")


def near_components(prints: DataFrame, **settings) -> DataFrame:
    """Rows (doc_id, text_hash, print) with their component.

    ``root`` is the smallest print of the component, ``component_id`` the smallest id.
    """
    prints = staged(prints, "prints")
    different = staged(prints.groupBy("print").agg(F.min("doc_id").alias("least")), "different")
    members = components(links(different.select("print"), **settings))
    placed = different.join(members, F.col("print") == F.col("node"), "left").select(
        "print", "least", F.coalesce("root", "print").alias("root")
    )
    placed = staged(placed, "placed")
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    mapped = placed.join(smallest, "root").select("print", "root", "component_id")
    return prints.join(mapped, "print").select(
        "doc_id", "text_hash", "print", "root", "component_id"
    )


def hexadecimal(print_column: str = "print") -> Column:
    return F.lower(F.lpad(F.hex(print_column), 16, "0"))


def keep_rows(df: DataFrame, text: str = "text", key: str = "doc_id", **settings) -> DataFrame:
    """The rows of ``df`` without near duplicates; of a component the smallest id stays.

    Rows without an id stay only where no row of their component has one. Of rows that
    share the staying id in one component, one stays.
    """
    found = near_components(fingerprints(df, text, key), **settings)
    return smallest_rows(df, found, text, key)


def smallest_rows(df: DataFrame, found: DataFrame, text: str, key: str) -> DataFrame:
    """The rows of ``df`` that stay by (doc_id, text_hash, root, component_id) of all rows."""
    kept = (
        found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root", "component_id").agg(F.min("text_hash").alias("hash"))
        .select(F.col("component_id").alias("id"), "hash")
    )
    rows = packed(df).select(
        "row", F.col(f"row.{key}").cast("long").alias("doc_id"),
        F.xxhash64(f"row.{text}").alias("text_hash"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))
    left = rows.join(kept, same, "left_semi")
    order = Window.partitionBy("doc_id", "text_hash").orderBy(F.xxhash64("row"))
    return left.withColumn("place", F.row_number().over(order)).filter("place = 1").select("row.*")
