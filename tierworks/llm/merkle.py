"""A Merkle manifest of documents, with tampered versions made by path copying.

Every row is a leaf. Per source the leaves in order of their ids are cut into aligned
blocks of ``FANOUT ** LEVELS``; a block is one group that builds its part of the tree,
and the roots of blocks are the leaves of the next stage, until one node a source is
left, the subroot. The subroots, in order of their sources, make one more tree in the
same way. Places in the order come from a range sort and the counts of its partitions, so
no source has to fit one task.

Trees are persistent: a tampered leaf makes a new version of its block that copies only
the ancestors of the leaf and shares every other node. The version goes on above its
block with the siblings on the way to the root, which come back down stage by stage, one
short row a block.

Defined cases: null columns count as ``-`` (a null id is before all others and is never
tampered with), empty texts as ``0:``. Rows that share an id are ordered by their leaves;
equal rows are equal leaves beside each other, and each gives a row. A lone row is its
source's subroot. Whole texts are hashed where they are read and never shuffled. An empty
table gives no rows. Other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tierworks.llm.common import staged

FANOUT = 16
LEVELS = 3
TAMPER = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

RESULT = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
    "folded_root string, verified boolean, tampered boolean"
)


def digest(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Node(NamedTuple):
    """A node that is never changed; versions share nodes."""

    digest: str
    children: tuple[Node, ...] = ()


def joined(children: tuple[Node, ...]) -> Node:
    return Node(digest(c.digest for c in children), children)


def grown(leaves: Iterable[str], levels: int) -> Node:
    """The root of ``levels`` levels over the leaves of one block."""
    nodes = [Node(leaf) for leaf in leaves]
    for _ in range(levels):
        nodes = [joined(tuple(nodes[i : i + FANOUT])) for i in range(0, len(nodes), FANOUT)]
    [root] = nodes
    return root


def way(place: int, levels: int) -> list[int]:
    """The child to take at each level from the root of a block to a place in it."""
    return [place // FANOUT**k % FANOUT for k in range(levels - 1, -1, -1)]


def replaced(node: Node, turns: list[int], leaf: str) -> Node:
    """A new version with another leaf; only the nodes on the way are copied."""
    if not turns:
        return Node(leaf)
    at, rest = turns[0], turns[1:]
    changed = replaced(node.children[at], rest, leaf)
    return joined((*node.children[:at], changed, *node.children[at + 1 :]))


def siblings(node: Node, turns: list[int]) -> list[tuple[str, str]]:
    """What stands left and right of the way, from the leaf up to the root."""
    found = []
    for at in turns:
        left, right = node.children[:at], node.children[at + 1 :]
        found.append(("".join(n.digest for n in left), "".join(n.digest for n in right)))
        node = node.children[at]
    return found[::-1]


def depth(total: int) -> int:
    """Levels over ``total`` nodes until one is left."""
    levels = 0
    while total > 1:
        total, levels = -(-total // FANOUT), levels + 1
    return levels


def _field(name: str, value: Column | None = None) -> Column:
    text = F.col(name).cast("string") if value is None else value
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, tree, leaf, changed): ``changed`` is the tampered leaf, null where none is."""
    ahead = [_field(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lower = F.translate(F.col("text"), UPPER, LOWER)
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER == 0
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit(":"), F.col("source").cast("string")), F.lit("-")).alias("tree"),
        F.sha2(F.concat(*ahead, _field("text")), 256).alias("leaf"),
        F.when(chosen, F.sha2(F.concat(*ahead, _field("text", lower)), 256)).alias("changed"),
    )


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with idx, their place from 0 in their ``tree`` by ``order``, and its total."""
    by = [F.asc_nulls_first(c) for c in ("tree", *order)]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    # A place holds the number of the partition and of the row in it; written, it stays.
    placed = staged(ranged.withColumn("place", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("place", 33)
    counts = placed.groupBy("tree", part.alias("part")).agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("n")
    )
    # One row a source and partition it lies in, so windows are as short as partitions are few.
    along = Window.partitionBy("tree").orderBy("part")
    starts = staged(
        counts.select(
            "tree", "part", (F.sum("n").over(along) - F.col("n") - F.col("first")).alias("shift"),
            F.sum("n").over(Window.partitionBy("tree")).alias("total"),
        ),
        "starts",
    )
    return placed.withColumn("part", part).join(starts, ["tree", "part"]).withColumn(
        "idx", F.col("place") + F.col("shift")
    ).drop("part", "place", "shift")


def _block(levels: int) -> Column:
    return F.floor(F.col("idx") / F.lit(FANOUT**levels)).cast("long")


def stages(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """Tables (tree, idx, node, total) from the leaves up to one node a tree."""

    def build(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("idx")
        total = int(frame["total"].iloc[0])
        root = grown(frame["node"], min(levels, depth(total)))
        above = -(-total // FANOUT**levels)
        return pd.DataFrame({"tree": [key[0]], "idx": [key[1]], "node": [root.digest], "total": [above]})

    found = [nodes]
    while (found[-1].agg(F.max("total")).first()[0] or 0) > 1:
        grouped = found[-1].select("tree", "idx", "node", "total").groupBy("tree", _block(levels).alias("block"))
        found.append(staged(grouped.applyInPandas(build, "tree string, idx long, node string, total long"), "stage"))
    return found


def ways(nodes: DataFrame, above: DataFrame, levels: int) -> DataFrame:
    """The siblings from every node to the top: its own block's, then those in ``above``."""

    def descend(key, frame: pd.DataFrame, path: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("idx")
        height = min(levels, depth(int(frame["total"].iloc[0])))
        root = grown(frame["node"], height)
        upper = list(zip(path["lefts"].iloc[0], path["rights"].iloc[0], strict=True))
        rows = []
        for idx in frame["idx"]:
            steps = siblings(root, way(int(idx), height)) + upper
            rows.append((key[0], idx, [s[0] for s in steps], [s[1] for s in steps], path["top"].iloc[0]))
        return pd.DataFrame(rows, columns=["tree", "idx", "lefts", "rights", "top"])

    grouped = nodes.groupBy("tree", _block(levels).alias("block"))
    return staged(
        grouped.cogroup(above.groupBy("tree", "idx")).applyInPandas(
            descend, "tree string, idx long, lefts array<string>, rights array<string>, top string"
        ),
        "ways",
    )


def _folded(levels: int, root: str):
    def fold(key, frame: pd.DataFrame, path: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("idx")
        height = min(levels, depth(int(frame["total"].iloc[0])))
        block = grown(frame["leaf"], height)
        upper = list(zip(path["lefts"].iloc[0], path["rights"].iloc[0], strict=True))
        rest = "".join(left + right for left, right in upper)
        proofs, roots = [], []
        for idx, leaf, changed in zip(frame["idx"], frame["leaf"], frame["changed"], strict=True):
            turns = way(int(idx), height)
            version = replaced(block, turns, leaf if changed is None else changed).digest
            for left, right in upper:
                version = digest((left, version, right))
            proofs.append(digest([left + right for left, right in siblings(block, turns)] + [rest]))
            roots.append(version)
        return pd.DataFrame({
            "doc_id": frame["doc_id"], "leaf": frame["leaf"], "subroot": path["top"].iloc[0],
            "root": root, "proof_sha256": proofs, "folded_root": roots,
            "verified": [r == root for r in roots], "tampered": frame["changed"].notna(),
        })

    return fold


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """One row per document: leaf, subroot, root, proof_sha256, folded_root, verified, tampered."""
    rows = staged(leaves(docs), "leaves")
    own = staged(numbered(rows, ["doc_id", "leaf"]), "numbered-leaves")
    per_source = stages(own.withColumn("node", F.col("leaf")), levels)
    subroots = per_source[-1].select(
        F.lit("").alias("tree"), F.col("tree").alias("source"), F.col("node")
    )
    sources = staged(numbered(staged(subroots, "subroots"), ["source"]), "numbered-subroots")
    over = stages(sources, levels)
    top = over[-1].first()
    if top is None:
        return docs.sparkSession.createDataFrame([], RESULT)
    none = F.array().cast("array<string>")
    path = over[-1].select("tree", "idx", none.alias("lefts"), none.alias("rights"), F.lit("").alias("top"))
    for nodes in over[-2::-1]:
        path = ways(nodes, path, levels)
    path = path.join(sources.select("tree", "idx", "source", "node"), ["tree", "idx"])
    path = path.select(
        F.col("source").alias("tree"), F.lit(0).cast("long").alias("idx"), "lefts", "rights",
        F.col("node").alias("top"),
    )
    for nodes in per_source[-2:0:-1]:
        path = ways(nodes, path, levels)
    # As text, since a column of numbers and nulls would become doubles on its way.
    own = own.withColumn("doc_id", F.col("doc_id").cast("string"))
    grouped = own.groupBy("tree", _block(levels).alias("block"))
    found = grouped.cogroup(path.groupBy("tree", "idx")).applyInPandas(
        _folded(levels, top["node"]), RESULT.replace("doc_id long", "doc_id string")
    )
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))
