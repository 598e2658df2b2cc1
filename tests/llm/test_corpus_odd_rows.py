"""Very long texts, repeated rows and columns with clashing names, operator by operator."""

import pytest
from pyspark.sql import functions as F

from tierworks.llm import ann, langid, mixing, packing, pii, quality, urls

DOC = "doc_id long, text string, lang string, source string, n_chars long"
LANGS = {"en": "the house on the hill was quiet and old ", "fr": "la maison sur la colline était très calme "}


def documents(spark, n=120):
    rows = []
    for i in range(n):
        lang = ["en", "fr"][i % 2]
        text = LANGS[lang] * (1 + i % 5) if i % 3 else "!!! ### $$$ " * 12
        rows.append((i, text, lang, f"s{i % 3}", len(text)))
    return spark.createDataFrame(rows, DOC)


def with_clashes(df):
    for name in ("row", "score", "stats", "keep", "key", "size", "bin", "cluster", "order", "found", "token", "tokens",
                 "host", "path", "target", "vector", "segment", "block", "query", "window", "share", "held_out", "spans"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="module")
def labelled(spark):
    return documents(spark).select("doc_id", (F.col("doc_id") % 3 != 0).cast("int").alias("quality"))


@pytest.fixture(scope="module")
def field():
    return pii.fit(pii.labelled_rows())


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_quality_of_long_texts_repeated_rows_and_clashing_names(spark, labelled):
    docs = documents(spark)
    model = quality.train(docs, labelled)
    odd = spark.createDataFrame(
        [(500, LANGS["en"] * 100_000, "en", "s1", 4_000_000), (501, "!!! ### $$$ " * 300_000, "en", "s1", 3_600_000)]
        + [(7, LANGS["fr"] * 3, "fr", "s1", 120)] * 3, DOC)
    columns = [F.col(c) for c in ("text", "lang", "source", "n_chars")]
    found = plain(odd.select("doc_id", quality.score(model, *columns).alias("score")))
    assert [r[0] for r in found] == [500, 501, 7, 7, 7] and found[2] == found[3] == found[4]
    assert all(0 <= r[1] <= 1 for r in found) and found[0][1] > found[1][1]
    clashing = with_clashes(docs).withColumn("quality", F.lit("clash"))
    kept = quality.keep_rows(clashing, labelled)
    assert kept.columns == clashing.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in quality.keep_rows(docs, labelled).collect()}


def test_language_of_long_texts_repeated_rows_and_clashing_names(spark):
    docs = documents(spark)
    net = langid.train(docs)
    odd = spark.createDataFrame(
        [(500, LANGS["en"] * 50_000, None, "s", 0), (501, "1 " * 500_000 + "é", None, "s", 0)]
        + [(7, LANGS["fr"] * 3, "xx", "s", 0)] * 3, DOC)
    found = plain(langid.identify(odd, net))
    by_id = {r[0]: r for r in found}
    assert by_id[500][2] == "en" and by_id[7][2] == "fr" and by_id[501][2] in ("en", "fr")
    assert len(found) == 5 and found.count(by_id[7]) == 3
    assert plain(langid.identify(with_clashes(docs), langid.train(with_clashes(docs)))) == plain(langid.identify(docs, net))


def test_personal_data_of_long_texts_repeated_rows_and_clashing_names(spark, field):
    text = "mail anna.smith@example.org or call +1 (555) 010-2345 "
    odd = spark.createDataFrame([(7, text), (7, text), (8, "word " * 300_000 + text)], "doc_id long, text string")
    found = plain(pii.find(with_clashes(odd), field))
    assert len(found) == 3 and found[0] == found[1] and found[0][1] == found[2][1] == 1
    assert found == plain(pii.find(odd, field))


def test_urls_mixing_packing_and_vectors_with_clashing_names(spark):
    pages = spark.createDataFrame([(1, "http://a.net/es/1"), (2, None), (2, "http://x.org/cart")], "page_id long, url string")
    rules = urls.rule_table(spark, urls.production_rules())
    assert plain(urls.judged(with_clashes(pages), rules)) == plain(urls.judged(pages, rules))
    docs = documents(spark)
    assert plain(mixing.taken(with_clashes(docs))) == plain(mixing.taken(docs))
    items = docs.select("doc_id", (F.length("text") % 50).cast("long").alias("size"), "source", F.lit("c").alias("cluster"))
    clashing = items.withColumns({"bin": F.lit("x"), "row": F.lit("x"), "shard": F.lit("x"), "length": F.lit("x")})
    assert len(plain(packing.pack(clashing))) == len(plain(packing.pack(items)))
    vectors = spark.createDataFrame([(i, [float(i % 7), 1.0, i / 9]) for i in range(60)], "vec_id long, embedding array<double>")
    one, two = ann.clean(vectors), ann.clean(with_clashes(vectors))
    assert plain(ann.nearest_neighbours(two, two.filter("vec_id % 10 = 0"))) == plain(
        ann.nearest_neighbours(one, one.filter("vec_id % 10 = 0")))
