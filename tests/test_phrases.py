"""The phrase dictionary against a plain walk over words."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tierworks.operators import phrases

TEXT = "doc_id long, text string"


def brute(text, entries):
    """Leftmost-longest over the words of a text, place by place."""
    words = [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[^\W_]+", text or "")]
    found, at = [], 0
    while at < len(words):
        for n in range(len(words) - at, 0, -1):
            name = " ".join(w for _, _, w in words[at : at + n])
            if name in entries:
                found.append((words[at][0], words[at + n - 1][1], name, entries[name]))
                at += n - 1
                break
        at += 1
    return found


def table(spark, rows):
    return phrases.dictionary(spark.createDataFrame(rows, "phrase string, kind string"), "phrase", "kind")


NAMES = [
    ("Anna  Smith", "PERSON"), ("anna smith jones", "PERSON"), ("Smith, Jones & Co", "FIRM"), ("co", "FIRM"),
    ("Ýrsa Über-Weg", "PERSON"), ("  ", "PERSON"), (None, "PERSON"), ("Anna Smith", "STAFF"),
    ("a a b", "X"), ("a b", "Y"),
]
ENTRIES = {
    "anna smith": "PERSON", "anna smith jones": "PERSON", "smith jones co": "FIRM", "co": "FIRM",
    "ýrsa über weg": "PERSON", "a a b": "X", "a b": "Y",
}
TEXTS = [
    "Yesterday ANNA\nSMITH met Ýrsa über weg.", "anna smith jones co", "Anna Smith, Jones & Co.", None, "",
    "...", "co", "annasmith anna_smith", "Anna Smith" * 3, "a a a b a b", "é🙂 anna smith 🙂 co",
]


def spans_of(df):
    return {
        r["doc_id"]: [tuple(s) for s in r["spans"]]
        for r in df.collect()
    }


def joined(df, entries):
    found = {}
    for r in phrases.find(df, "text", entries, "doc_id").collect():
        found.setdefault(r["doc_id"], []).append((r["start"], r["end"], r["phrase"], r["kind"]))
    return {k: sorted(v) for k, v in found.items()}


def test_both_ways_agree_with_a_plain_walk(spark):
    rng = random.Random(3)
    texts = TEXTS + [" ".join(rng.choice(["a", "b", "anna", "smith", "jones", "co", "x"]) for _ in range(60)) for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), TEXT)
    entries = table(spark, NAMES * 2)
    expected = {i: brute(t, ENTRIES) for i, t in enumerate(texts)}
    assert spans_of(phrases.with_spans(df, "text", entries)) == expected
    assert joined(df, entries) == {k: v for k, v in expected.items() if v}


def test_spans_are_code_points(spark):
    [row] = phrases.with_spans(spark.createDataFrame([(1, TEXTS[-1])], TEXT), "text", table(spark, NAMES)).collect()
    assert [TEXTS[-1][s["start"] : s["end"]] for s in row["spans"]] == ["anna smith", "co"]


def test_redaction_and_extraction(spark):
    df = phrases.with_spans(spark.createDataFrame(list(enumerate(TEXTS)), TEXT), "text", table(spark, NAMES))
    shown = df.select(
        phrases.redacted(F.col("text"), F.col("spans")).alias("shown"),
        phrases.first_of(F.col("spans"), "PERSON").alias("who"),
        phrases.first_of(F.col("spans"), "PERSON", hashed=True).alias("hash"),
    ).collect()
    assert [r["shown"] for r in shown[:5]] == [
        "Yesterday [PERSON] met [PERSON].", "[PERSON] [FIRM]", "[PERSON] & [FIRM].", None, "",
    ]
    assert shown[0]["who"] == "anna smith" and shown[3]["who"] is None
    assert len(shown[0]["hash"]) == 64 and shown[4]["hash"] is None


def test_scan_counts_rows_and_matches(spark):
    df = spark.createDataFrame([("co co", "co"), (None, "x"), ("anna smith", "co")], "a string, b string")
    found = {tuple(r) for r in phrases.scan(df, ["a", "b"], table(spark, NAMES)).collect()}
    assert found == {("a", "FIRM", 1, 2), ("a", "PERSON", 1, 1), ("b", "FIRM", 2, 2)}


def test_dictionaries_of_any_size(spark, monkeypatch):
    many = spark.range(50_000).selectExpr("concat('name ', id, ' of ', id % 7) AS phrase")
    entries = phrases.dictionary(many)
    with pytest.raises(ValueError, match="more than 20000"):
        phrases.with_spans(spark.createDataFrame([(1, "x")], TEXT), "text", entries)
    df = spark.createDataFrame([(1, "Name 41 of 6, name 41 of 5, NAME 49999 OF 5"), (2, "name"), (2, "name 7 of 0")], TEXT)
    assert joined(df, entries) == {1: [(0, 12, "name 41 of 6", "NAME"), (28, 43, "name 49999 of 5", "NAME")],
                                   2: [(0, 11, "name 7 of 0", "NAME")]}
    # A full map lets every place through; the join still settles it.
    monkeypatch.setattr(phrases, "_bit_map", lambda _: b"\xff" * (phrases.MAP_BITS // 8))
    assert joined(df, entries)[2] == [(0, 11, "name 7 of 0", "NAME")]


def test_no_phrases_no_texts_and_too_long_a_phrase(spark):
    df = spark.createDataFrame([(1, "anna smith")], TEXT)
    empty = table(spark, [])
    assert spans_of(phrases.with_spans(df, "text", empty)) == {1: []}
    assert joined(df, empty) == {}
    assert joined(df.limit(0), table(spark, NAMES)) == {}
    with pytest.raises(ValueError, match="40 words"):
        phrases.find(df, "text", table(spark, [("w " * 40, "X")]), "doc_id")


def test_a_very_long_text_is_read_once(spark):
    text = "x " * 400_000 + "anna smith"
    entries = table(spark, NAMES)
    df = spark.createDataFrame([(1, text)], TEXT)
    assert joined(df, entries) == {1: [(800_000, 800_010, "anna smith", "PERSON")]}
    many = "anna smith " * 20_000
    assert len(spans_of(phrases.with_spans(spark.createDataFrame([(1, many)], TEXT), "text", entries))[1]) == 20_000
