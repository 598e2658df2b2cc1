"""The Merkle manifest against a plain tree over all rows."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tierworks.llm import merkle

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    return sha(*map(field, (doc_id, source, lang, n_chars, text)))


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        last = found[-1]
        found.append([sha(*last[i : i + 16]) for i in range(0, len(last), 16)])
    return found


def brute(rows):
    by = {}
    for row in rows:
        by.setdefault(row[3], []).append((row[0], leaf(row, row[1]), row))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        by[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = levels([x[1] for x in by[s]])
    top = levels([trees[s][-1][0] for s in sources])
    root = top[-1][0]
    expected = []
    for k, s in enumerate(sources):
        for i, (doc_id, own, row) in enumerate(by[s]):
            hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
            node, proof = leaf(row, lowered(row[1])) if hit else own, ""
            for tree, place in ((trees[s], i), (top, k)):
                for level in tree[:-1]:
                    first = place // 16 * 16
                    run = level[first : first + 16]
                    left, right = "".join(run[: place - first]), "".join(run[place - first + 1 :])
                    proof += left + right
                    node = sha(left, node, right)
                    place //= 16
            expected.append((doc_id, own, trees[s][-1][0], root, sha(proof), node, node == root, hit))
    return sorted(expected, key=repr)


def found(spark, rows, **settings):
    frame = spark.createDataFrame(rows, DOC)
    return sorted((tuple(r) for r in merkle.manifest(frame, **settings).collect()), key=repr)


ROWS = [
    (i, f"Text {i} " + "AbÉ" * (i % 5), ["en", "de", None][i % 3], f"s{'x' * (i % 2)}", i) for i in range(300)
] + [
    (1000, None, None, None, None), (1001, "", "", "", 0), (1002, "X" * 200_000, "en", "é", 200_000),
    (None, "No Id", "en", "s", 5), (None, None, None, None, None),
    (2**62 + 1, "Large", "en", "s", 5), (7, "twice", "en", "s", 5), (7, "twice", "en", "s", 5),
    (7, "another", "en", "s", 7),
]


@pytest.mark.parametrize("levels", [1, 3])
def test_manifest(spark, levels):
    assert found(spark, ROWS, levels=levels) == brute(ROWS)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 257])
def test_sizes_of_one_source(spark, n):
    rows = [(i, "Tamper Me", "en", "s", 9) for i in range(n)]
    assert found(spark, rows, levels=2) == brute(rows)


def test_every_source_has_one_row(spark):
    rows = [(i, "A", None, f"s{i}", 1) for i in range(20)]
    assert found(spark, rows) == brute(rows)


def test_empty_table_and_clashing_names(spark):
    assert merkle.manifest(spark.createDataFrame([], DOC)).collect() == []
    frame = spark.createDataFrame(ROWS[:40], DOC)
    for name in ("leaf", "tree", "idx", "place", "part", "total", "node", "block", "root"):
        frame = frame.withColumn(name, F.lit("x"))
    assert sorted((tuple(r) for r in merkle.manifest(frame).collect()), key=repr) == brute(ROWS[:40])


def test_versions_share_untouched_nodes():
    block = merkle.grown([sha(str(i)) for i in range(256)], 2)
    turns = merkle.way(37, 2)
    version = merkle.replaced(block, turns, sha("tampered"))
    assert version.digest != block.digest
    copied = [k for k in range(16) if version.children[k] is not block.children[k]]
    assert copied == [37 // 16]
    inner = [k for k in range(16) if version.children[2].children[k] is not block.children[2].children[k]]
    assert inner == [37 % 16]
    again = merkle.replaced(version, turns, sha("37"))
    assert again.digest == block.digest
