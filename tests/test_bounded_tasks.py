"""Tasks, files and joins that follow the rows, not one large part of them."""

import random

from pyspark.sql import functions as F

from conftest import rows
from test_learned import DOC, brute_bayes, brute_summary, rows as texts
from tierworks.operators import changes, learned
from tierworks.plans import audit
from tierworks.sources import directory as dr


def test_small_buckets_share_files(spark, folder):
    df = spark.range(2000).selectExpr("id AS k", "id * 2 AS v")
    before = dr.Directory.of_size(2000, 4)
    written = dr.write(df, folder, 0, before, before, list(before.entries), ["k"], 2000)
    assert len(written.entries) == 512 and sum(e.rows for e in written.entries.values()) == 2000
    assert len(spark.read.parquet(f"{folder}/version=0").inputFiles()) == 1
    assert rows(dr.rows_of(spark, folder, df.schema, written)) == rows(df)
    # A later version of some buckets hides their older rows.
    some = [(9, 5), (9, 300)]
    part = dr.rows_of(spark, folder, df.schema, written, some).withColumn("v", F.lit(-1).cast("long"))
    later = dr.write(part, folder, 1, written, written, some, ["k"], 10)
    found = dr.rows_of(spark, folder, df.schema, later)
    assert found.count() == 2000 and found.filter("v = -1").count() == sum(written.entries[b].rows for b in some)


def test_exact_profiles_deal_even_parts(spark, monkeypatch):
    monkeypatch.setattr(audit, "EXACT_ROWS", 100)
    df = spark.range(1000).selectExpr("CAST(NULL AS STRING) AS a", "id % 7 AS b").coalesce(1)
    sizes = [len(p) for p in audit._spread(df).rdd.glom().collect()]
    assert len(sizes) == 10 and max(sizes) < 200
    found = {r["column_name"]: tuple(r)[1:] for r in audit.profile(df, exact=True).collect()}
    assert found == {"a": (1000, 1000, 0, None, None), "b": (1000, 0, 7, "0", "6")}


def test_ids_are_made_again_behind_the_join(spark):
    tracked = changes.track_rows(spark.range(3).selectExpr("id AS k", "'x' AS v"), "k")
    odd = tracked.withColumn("row_id", F.expr("CASE k WHEN 0 THEN row_id WHEN 1 THEN '=' END"))
    short = changes.short_ids(odd, "k")
    assert [r["row_id"] for r in short.orderBy("k").collect()] == ["=", "!=", None]
    assert rows(changes.long_ids(short, "k")) == rows(odd)


def test_frequent_and_rare_words_weigh_as_before(spark, monkeypatch):
    monkeypatch.setattr(learned, "FREQUENT", 4)
    monkeypatch.setattr(learned, "TASK_BYTES", 500)
    given = texts(random.Random(3), 200) + [(900, None, "a"), (901, "red " * 5000 + "unheard", None)]
    df = spark.createDataFrame(given, DOC)
    model = learned.train(df.limit(150), "text", "label")
    found = learned.predict(df, "doc_id", "text", model, "out").collect()
    assert {r["doc_id"]: r["out"] for r in found} == brute_bayes(given[:150], given)
    short = {i: text and text.replace(" of ", ". ") for i, text, _ in given}
    df = spark.createDataFrame(list(short.items()), "doc_id long, text string")
    frequencies = learned.document_frequencies(df, "text")
    often, rest = learned._by_frequency(frequencies, F.col("texts"))
    assert often.count() <= 4 and often.count() + rest.count() == frequencies.count() > 4
    summaries = learned.summarize(df, "doc_id", "text", 5, frequencies).collect()
    assert {r["doc_id"]: r["summary"] for r in summaries} == brute_summary(short, 5)
