"""Learned labels and summaries against plain Python."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from tierworks.operators import learned

DOC = "doc_id long, text string, label string"


def words(text):
    return re.findall(r"[^\W\d_]+", (text or "").lower())


def brute_bayes(train, texts, least=1):
    counts, totals, docs = defaultdict(Counter), Counter(), Counter()
    for _, text, label in train:
        if label is not None and len((text or "").strip()) >= 5:
            docs[label] += 1
            for w in words(text):
                counts[w][label] += 1
    counts = {w: c for w, c in counts.items() if sum(c.values()) >= least}
    for c in counts.values():
        totals.update(c)
    found = {}
    for i, text, _ in texts:
        if len((text or "").strip()) < 5 or not docs:
            found[i] = None
            continue
        scored = []
        for label, n in docs.items():
            score = math.log(n / sum(docs.values()))
            for w in words(text):
                if w in counts:
                    score += math.log((counts[w][label] + 1) / (totals[label] + len(counts)))
            scored.append((-round(score, 6), label))
        found[i] = min(scored)[1]
    return found


def rows(rng, n):
    vocabulary = {"a": "red blue stone river".split(), "b": "tax bill price red".split(), "c": "été île blue".split()}
    found = []
    for i in range(n):
        label = rng.choice("abc")
        text = " ".join(rng.choice(vocabulary[label] + ["the", "of", f"x{i % 7}"]) for _ in range(rng.randint(1, 12)))
        found.append((i, text, rng.choice([label, label, label, None])))
    return found


@pytest.mark.parametrize("least", [1, 3])
def test_predictions_equal_plain_counts(spark, least):
    given = rows(random.Random(2), 300) + [
        (900, None, "a"), (901, "", "b"), (902, "   x ", "a"), (903, "unheard words only", None),
        (904, "red " * 50_000, None), (905, "RED Blue river", None), (906, "RED Blue river", None),
    ]
    train = given[:200] + given[300:303]
    model = learned.train(spark.createDataFrame(train, DOC), "text", "label", least=least)
    found = learned.predict(spark.createDataFrame(given, DOC), "doc_id", "text", model, "out").collect()
    assert {r["doc_id"]: r["out"] for r in found} == brute_bayes(train, given, least)
    assert len(found) == len(given)


def test_ties_nothing_to_learn_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "even text here", "b"), (2, "even text here", "a"), (3, "short", None)], DOC)
    model = learned.train(df, "text", "label")
    assert [r["out"] for r in learned.predict(df, "doc_id", "text", model, "out").collect()] == ["a", "a", "a"]
    none = learned.train(df.filter("label IS NULL"), "text", "label")
    assert [r["out"] for r in learned.predict(df, "doc_id", "text", none, "out").collect()] == [None] * 3
    assert learned.predict(df.limit(0), "doc_id", "text", model, "out").count() == 0


def brute_summary(texts, most):
    long = [t for t in texts.values() if len((t or "").strip()) >= 5]
    seen = Counter(w for t in long for w in set(words(t)))
    found = {}
    for i, text in texts.items():
        if text is None or len(re.split(r"\s+", text.strip(" "))) <= most:
            found[i] = None
            continue
        pieces = [s.strip(" ") for s in re.split(r"[.!?\n]+", text) if s.strip(" ")]
        best = None
        for at, s in enumerate(pieces):
            if own := words(s):
                mean = round(sum(math.log(len(long) / seen[w]) for w in own) / len(own), 6)
                if best is None or mean > best[0]:
                    best = (mean, at)
        chosen = pieces[best[1]] if best else pieces[0] if pieces else None
        found[i] = chosen and " ".join(re.split(r"\s+", chosen)[:most])
    return found


def test_summaries_equal_plain_python(spark):
    rng = random.Random(4)
    texts = {i: ". ".join(" ".join(rng.choice("the of red blue rare zebra quince été".split()) for _ in range(rng.randint(1, 9)))
                          for _ in range(rng.randint(1, 8))) for i in range(60)}
    texts |= {100: None, 101: "", 102: "1 2 3 4 5 6 7 8 9. 10 11", 103: "the of. " * 5000 + "quince zebra.", 104: texts[3], 105: "one two"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    frequencies = learned.document_frequencies(df, "text")
    found = {r["doc_id"]: r["summary"] for r in learned.summarize(df, "doc_id", "text", 5, frequencies).collect()}
    assert found == brute_summary(texts, 5)
    empty = df.limit(0)
    assert learned.summarize(empty, "doc_id", "text", 5, learned.document_frequencies(empty, "text")).count() == 0
