"""The factorization machine against plain sums over pairs, and on held-out documents."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierworks.llm import linear, toxicity

DOC = "doc_id long, text string"
LABEL = "doc_id long, toxic int"


def brute_score(machine, text):
    import re

    kept = {int(b): i for i, b in enumerate(machine.buckets)}
    places = sorted({
        kept[b] for w in set(re.findall(r"[^\W_]+", (text or "").lower())) for b in toxicity.buckets_of(w) if b in kept
    })
    total = machine.bias
    for i, a in enumerate(places):
        total += machine.weights[a]
        for b in places[i + 1 :]:
            total += float(machine.factors[a] @ machine.factors[b])
    return 1 / (1 + math.exp(-total))


def planted(n, rng):
    """Toxic where an insult and a group stand together; either alone is clean."""
    words = ["tree", "river", "stone", "walk", "light", "green", "table", "cloud", "paper", "seven"]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(30)]
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        if insult:
            text[rng.randrange(10)] = rng.choice(["grubby", "foul", "vile"])
        if group:
            text[10 + rng.randrange(10)] = rng.choice(["northerners", "southerners"])
        rows.append((i, " ".join(text), int(insult and group)))
    return rows


@pytest.fixture(scope="module")
def trained(spark):
    rows = planted(3000, random.Random(4))
    docs = spark.createDataFrame([r[:2] for r in rows], DOC)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], LABEL)
    return rows, docs, labels, toxicity.train(docs, labels)


def test_interactions_are_learned(trained):
    rows, docs, _, machine = trained
    held = {i: (t, y) for i, t, y in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    found = {r["doc_id"]: r for r in toxicity.scores(docs, machine).collect()}
    assert {i for i, r in found.items() if r["held_out"]} == set(held)
    right = sum(found[i]["predicted"] == y for i, (_, y) in held.items())
    assert right >= 0.97 * len(held)
    # Additive weights over the same terms cannot tell the pair from its parts.
    seen = [toxicity.Scorer(machine) for _ in range(1)][0]
    x = np.zeros((len(rows), len(machine.buckets)))
    for r, (_, text, _) in enumerate(rows):
        for w in toxicity.words_of(text):
            x[r, list(seen._places(w))] = 1
    y = np.array([r[2] for r in rows], float)
    weights = linear.fit(x, y)
    assert weights.shape[0] == len(machine.buckets) + 1
    alone = machine._replace(factors=np.zeros_like(machine.factors), weights=weights[:-1], bias=weights[-1])
    for text in ("grubby " * 3, "northerners of the hills"):
        assert toxicity.Scorer(machine).score(text) < 0.3
        assert toxicity.Scorer(alone).score(text) <= 0.5


def test_scores_equal_plain_sums_over_pairs(trained):
    rows, _, _, machine = trained
    scorer = toxicity.Scorer(machine)
    texts = [r[1] for r in rows[:50]] + [None, "", "...", "Grubby NORTHERNERS", "vile_southerners é"]
    for text in texts:
        assert scorer.score(text) == pytest.approx(brute_score(machine, text), abs=1e-9)


def test_whole_texts_count(trained, monkeypatch):
    machine = trained[3]
    late = "tree river " * 400_000 + "grubby northerners"
    assert toxicity.Scorer(machine).score(late) >= 0.3
    assert toxicity.Scorer(machine).score("tree river " * 400_000) < 0.3
    text = "ab cde " * 50 + "x" * 90 + " é. f" * 20
    expected = set(text.lower().replace(".", " ").split())
    monkeypatch.setattr(toxicity, "PIECE", 16)
    assert toxicity.words_of(text) == expected


def test_held_out_labels_are_never_read(spark, trained):
    rows, docs, _, machine = trained
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, _, y in rows]
    again = toxicity.train(docs, spark.createDataFrame(turned, LABEL))
    assert np.array_equal(again.weights, machine.weights) and np.array_equal(again.buckets, machine.buckets)


def test_odd_rows_and_clashing_names(spark, trained):
    machine = trained[3]
    texts = [(None, "grubby northerners"), (1, None), (2, ""), (2, ""), (3, "grubby northerners"), (3, "tree")]
    frame = spark.createDataFrame(texts, DOC)
    for name in ("score", "toxic", "held_out", "predicted", "id", "bucket", "lang"):
        frame = frame.withColumn(name, F.lit("x"))
    found = toxicity.scores(frame, machine).collect()
    assert [r["doc_id"] for r in found] == [None, 1, 2, 2, 3, 3]
    assert found[0]["score"] == found[4]["score"] >= 0.3
    assert found[1]["score"] == found[2]["score"] == found[3]["score"]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found)
    labels = [(None, 1), (1, None), (2, 0), (2, 1), (3, 1), (3, 0), (99, 1)]
    some = toxicity.train(frame, spark.createDataFrame(labels, LABEL).withColumn("text", F.lit(1)))
    assert len(some.buckets) == 0


def test_nothing_to_learn_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a"), (5, "b")], DOC)
    empty = spark.createDataFrame([], LABEL)
    assert [r["score"] for r in toxicity.scores(docs, toxicity.train(docs, empty)).collect()] == pytest.approx([0, 0], abs=1e-9)
    ones = spark.createDataFrame([(1, 1), (5, 1)], LABEL)
    assert [r["predicted"] for r in toxicity.scores(docs, toxicity.train(docs, ones)).collect()] == [1, 1]
    none = spark.createDataFrame([], DOC)
    assert toxicity.scores(none, toxicity.train(none, ones)).collect() == []
    both = spark.createDataFrame([(1, 1), (5, 0)], LABEL)
    assert toxicity.scores(none, toxicity.train(none, both)).collect() == []


def test_the_bound_on_training_rows(spark, trained):
    _, docs, labels, _ = trained
    few = toxicity.train(docs, labels, per_class=40)
    assert np.isfinite(few.weights).all()
