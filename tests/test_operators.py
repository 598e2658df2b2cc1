import pytest
from pyspark.sql import functions as F

from conftest import rows
from tierworks.operators import aggregates, changes, enrich, joins, personal_data, quality, shape
from tierworks.session import fresh_path


# --- shape -----------------------------------------------------------------

def test_audit_columns_are_last(spark):
    df = shape.add_audit(spark.range(1), "crm", "2024-01-01 00:00:00")
    assert df.columns == ["id", "audit_timestamp", "source_system"]
    ordered = shape.order_columns(df.withColumn("data_quality_flag", F.lit("CLEAN")), ids=["id"])
    assert ordered.columns == ["id", "data_quality_flag", "audit_timestamp", "source_system"]


def test_colliding_names_are_refused(spark):
    with pytest.raises(ValueError):
        shape.snake_case_columns(spark.createDataFrame([(1, 2)], "`userId` int, `user_id2` int").toDF("userId", "User ID"))


def test_hash_sample_is_stable_and_near_its_share(spark):
    df = spark.range(20000)
    first, second = (rows(shape.hash_sample(df.repartition(n), "id", 5)) for n in (2, 7))
    assert first == second and 800 < len(first) < 1200


def test_retention_keeps_the_border_day(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-02",)], "d string").select(F.to_date("d").alias("d"))
    assert shape.retain(df, "d", 9, "2024-01-11").count() == 1
    assert shape.retain(df, "d", 10, "2024-01-11").count() == 2


# --- quality ---------------------------------------------------------------

AMOUNTS = [(1, 5.0), (2, -1.0), (3, None), (None, -2.0)]


def test_first_flag_wins(spark):
    df = spark.createDataFrame(AMOUNTS, "k int, v double")
    flags = df.select("k", quality.flag(quality.missing("k"), quality.missing("v"), quality.negative("v")))
    assert rows(flags) == sorted(
        [(1, "CLEAN"), (2, "NEGATIVE_V"), (3, "MISSING_V"), (None, "MISSING_K")], key=repr
    )


def test_null_fails_an_expectation(spark):
    df = spark.createDataFrame(AMOUNTS, "k int, v double")
    kept = quality.dropped(df, [quality.expect("positive", "v > 0")])
    assert rows(kept) == [(1, 5.0)]
    [line] = quality.report(df, [quality.expect("positive", "v > 0")]).collect()
    assert (line["passed"], line["failed"], line["failed_pct"]) == (1, 3, 75.0)


def test_enforce_stops_on_a_failing_row(spark):
    df = spark.createDataFrame(AMOUNTS, "k int, v double")
    checks = [quality.expect("has_key", "k IS NOT NULL", "fail"), quality.expect("positive", "v > 0")]
    with pytest.raises(Exception, match="has_key"):
        quality.enforce(df, checks).collect()
    assert rows(quality.enforce(df.filter("k IS NOT NULL"), checks)) == [(1, 5.0)]


def test_label_domain_lets_null_through(spark):
    df = spark.createDataFrame([("positive",), (None,), ("great",)], "sentiment_label string")
    assert rows(quality.dropped(df, [quality.expect_sentiment()])) == [("positive",), (None,)]


def test_text_flag(spark):
    df = spark.createDataFrame([(None, None), ("    ", "x"), ("long text", None), ("long text", "x")], "t string, a string")
    flags = [r[0] for r in df.select(quality.text_flag(F.col("t"), F.col("a"))).collect()]
    assert flags == ["MISSING_TEXT", "MISSING_TEXT", "AI_NULL_RESPONSE", "CLEAN"]


def test_unknown_action_is_refused():
    with pytest.raises(ValueError):
        quality.expect("x", "true", "ignore")


# --- personal data -----------------------------------------------------------

@pytest.mark.parametrize(
    "column, kind",
    [("phone_number", "PHONE"), ("annual_income", "FINANCIAL"), ("street_address", "ADDRESS"),
     ("email_hash", None), ("emailed_count", None), ("manager_name", None), ("phone_masked", None),
     ("income_tier", None), ("source_text", "FREEFORM"), ("card_number", "PAYMENT"), ("Email", "EMAIL")],
)
def test_names_of_personal_columns(column, kind):
    hit = personal_data.classify_name(column)
    assert (hit[0] if hit else None) == kind


def test_values_give_a_hidden_column_away(spark):
    df = spark.createDataFrame([(1, "a@b.co", "x"), (2, "c@d.co", "y"), (3, None, "z")], "id int, note string, email string")
    found = {(r["column_name"], r["pii_type"]): r for r in personal_data.columns_report(df).collect()}
    assert found[("note", "EMAIL")]["evidence"] == "value"
    assert found[("note", "EMAIL")]["hit_rate"] == 1.0
    assert found[("email", "EMAIL")]["evidence"] == "name"
    assert len(found) == 2


def test_masked_rows_never_show_the_raw_value(spark):
    from tierworks.functions import masking

    df = spark.createDataFrame([("anna@mail.org", "+1 555 123 4567")], "email string, phone string")
    policy = {"email": {a: masking.mask_email(F.col("email"), a) for a in masking.ACCESS_LEVELS},
              "phone": {"none": masking.mask_phone(F.col("phone"))}}
    shown = personal_data.masked(df, policy, "partial").withColumn("raw", F.lit("anna@mail.org"))
    assert personal_data.leaks(shown, "raw", ["email", "phone"]).count() == 0
    with pytest.raises(ValueError):
        personal_data.masked(df, {"absent": {"none": F.lit("")}}, "none")


def test_gold_guard():
    personal_data.check_gold(["region", "customer_count", "avg_age"])
    with pytest.raises(ValueError):
        personal_data.check_gold(["region", "email"])
    with pytest.raises(ValueError):
        personal_data.check_gold(["source_text"])


def test_small_groups_can_be_hidden(spark):
    df = spark.createDataFrame([("a", 2), ("b", 5)], "g string, n int")
    assert rows(personal_data.suppress_small_groups(df, "n", 3)) == [("b", 5)]


# --- joins and aggregates ------------------------------------------------------

def test_spreading_a_hot_key_changes_nothing(spark):
    fact = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("int").alias("k"))
    dimension = spark.range(2500).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"))
    assert joins.hot_keys(fact, "k", 0.2) == [7]
    for how in joins.JOIN_TYPES:
        plain = joins.lookup(fact, dimension, "k", how)
        spread = joins.lookup(fact, dimension, "k", how, hot=[7], spread_by=["id"], slices=8)
        assert rows(plain) == rows(spread)


def test_spreading_needs_identifiers(spark):
    df = spark.range(1).withColumnRenamed("id", "k")
    with pytest.raises(ValueError):
        joins.lookup(df, df, "k", hot=[0])


def test_count_then_name_equals_join_then_count(spark):
    fact = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a"), (9, "a")], "k int, t string")
    names = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k int, name string")
    early = joins.count_then_name(fact, names, "k", ["t"], ["name"], [("n", F.count("*"))])
    late = fact.join(names, "k").groupBy("k", "name", "t").agg(F.count("*").alias("n"))
    assert rows(early) == rows(late.select(early.columns))


def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    assert rows(joins.orphans(child, child.filter("k = 1"), "k", "k")) == [(2, 2)]


def test_shares_add_up(spark):
    df = spark.createDataFrame([("a", x) for x in "xxyz"] + [("b", None)], "g string, label string")
    share = aggregates.label_share(df, ["g"], "label")
    sums = rows(share.groupBy("g").agg(F.sum("share_pct")))
    assert sums == [("a", 100.0), ("b", 100.0)]


# --- changes -------------------------------------------------------------------

OLD = [(1, "a"), (2, "b"), (3, None), (4, "d")]
NEW = [(1, "a"), (2, "B"), (3, None), (5, None)]


def test_feed_turns_old_into_new(spark):
    old, new = (spark.createDataFrame(x, "k int, v string") for x in (OLD, NEW))
    feed = changes.diff(old, new, "k")
    assert rows(feed) == sorted(
        [(2, "b", "update_preimage"), (2, "B", "update_postimage"), (4, "d", "delete"), (5, None, "insert")],
        key=repr,
    )
    assert rows(changes.replay(old, feed, "k")) == rows(new)
    assert changes.diff(new, new, "k").count() == 0


def test_ignored_columns_make_no_change(spark):
    old = spark.createDataFrame([(1, "a", 1)], "k int, v string, ts int")
    new = spark.createDataFrame([(1, "a", 2)], "k int, v string, ts int")
    assert changes.diff(old, new, "k", ignore=["ts"]).count() == 0
    assert changes.diff(old, new, "k").count() == 2


def test_last_change_per_key_wins(spark):
    target = spark.createDataFrame([(1, "old"), (2, "old"), (3, "old")], "k int, v string")
    log = spark.createDataFrame(
        [(1, "x", 1, "insert"), (1, "y", 2, "update_postimage"), (2, None, 3, "delete"),
         (3, None, 1, "delete"), (3, "back", 2, "insert"), (4, "new", 1, "insert")],
        "k int, v string, seq int, _change_type string",
    )
    applied = changes.apply(target, log, "k", "seq")
    assert rows(applied) == [(1, "y"), (3, "back"), (4, "new")]
    assert rows(changes.apply(applied, log, "k", "seq")) == rows(applied)


def test_older_changes_do_not_overwrite(spark):
    target = spark.createDataFrame([(1, "new", 5)], "k int, v string, seq int")
    log = spark.createDataFrame([(1, "late", 4, "insert"), (2, "x", 1, "insert")], "k int, v string, seq int, _change_type string")
    assert rows(changes.apply(target, log, "k", "seq")) == [(1, "new", 5), (2, "x", 1)]


def test_tracked_rows_keep_id_and_version(spark):
    first = changes.track_rows(spark.createDataFrame(OLD, "k int, v string"), "k")
    second = changes.track_merge(first, spark.createDataFrame(NEW, "k int, v string"), "k", 2)
    versions = {r["k"]: r["row_version"] for r in second.collect()}
    assert versions == {1: 1, 2: 2, 3: 1, 5: 2}
    ids = first.join(second.select("k", F.col("row_id").alias("again")), "k")
    assert ids.filter("row_id <> again").count() == 0


def test_composite_keys_are_not_confused(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c")], "x string, y string")
    assert changes.track_rows(df, ["x", "y"]).select("row_id").distinct().count() == 2


# --- enrichment ------------------------------------------------------------------

REVIEWS = [
    (1, "Great bread, friendly staff and a lovely place!"),
    (2, "Terrible. The waiter was rude and the cake stale"),
    (3, "Good bread but slow service"),
    (4, "The bread is bread"),
    (5, "bad!"),
    (6, None),
    (7, "!!!!!!"),
    (8, "     "),
]


def test_sentiment(spark):
    df = spark.createDataFrame(REVIEWS, "id int, text string")
    labels = {r["id"]: r["sentiment_label"] for r in enrich.sentiment(df, "text").collect()}
    assert labels == {1: "positive", 2: "negative", 3: "mixed", 4: "neutral", 5: None, 6: None,
                      7: "neutral", 8: None}


def test_lexicon_table_gives_the_same_labels(spark):
    df = spark.createDataFrame([*REVIEWS, *REVIEWS], "id int, text string")
    pairs = [(w, "positive") for w in enrich.DEFAULT_LEXICON.positive]
    pairs += [(w.upper(), "negative") for w in enrich.DEFAULT_LEXICON.negative]
    lexicon = spark.createDataFrame(pairs * 3, "term string, polarity string")
    found = enrich.sentiment_by_table(df, "text", lexicon)
    assert found.columns == [*df.columns, "sentiment_label"]
    assert rows(found) == rows(enrich.sentiment(df, "text"))


def test_taxonomy_and_names_as_tables(spark):
    df = spark.createDataFrame(REVIEWS, "id int, text string")
    entries = [(t, label, i) for i, (label, terms) in enumerate(enrich.TOPIC_TERMS.items()) for t in terms]
    taxonomy = spark.createDataFrame(entries, "term string, label string, precedence int")
    assert rows(enrich.classify_by_table(df, "text", taxonomy)) == rows(enrich.classify(df, "text"))
    names = spark.createDataFrame([("staff",), ("cake",)], "term string")
    inline = enrich.extract(df, "text", {"n": ["staff", "cake"]}).select("id", "extracted_entities.n")
    table = enrich.extract_by_table(df, "text", names, "n").select("id", "n")
    assert rows(table) == rows(inline)


def test_classify(spark):
    df = spark.createDataFrame(REVIEWS, "id int, text string")
    labels = {r["id"]: r["topic_label"] for r in enrich.classify(df, "text").collect()}
    assert labels == {1: "service", 2: "product_quality", 3: "product_quality", 4: "product_quality",
                      5: None, 6: None, 7: "other", 8: None}


def test_combined_pass_equals_single_ones(spark):
    df = spark.createDataFrame(REVIEWS, "id int, text string")
    both = enrich.sentiment_and_topic(df, "text")
    assert rows(both) == rows(enrich.classify(enrich.sentiment(df, "text"), "text"))


def test_extract_hashes_named_fields(spark):
    df = spark.createDataFrame([("We met Anna and bought the croissant",), ("nothing",)], "text string")
    fields = {"product": r"bought the (\w+)", "staff_name": r"met (\w+)", "verb": ["bought", "met"]}
    found = [r["extracted_entities"] for r in enrich.extract(df, "text", fields, hashed=["staff_name"]).collect()]
    assert found[0]["product"] == "croissant" and found[0]["verb"] == "met"
    assert len(found[0]["staff_name"]) == 64
    assert tuple(found[1]) == (None, None, None)


def test_summary_takes_the_best_sentence_of_long_texts_only(spark):
    # Shared words: the, baker, bread. Scores: 0, 9 / 5, 9 / 6, 0.
    long = "Rain fell. The baker baked some bread. The bread of the baker sold well. Nobody came"
    df = spark.createDataFrame([(1, long), (2, "Too short. To matter"), (3, None)], "id int, text string")
    found = {r["id"]: r["summary"] for r in enrich.summarize(df, "text", 5).collect()}
    assert found == {1: "The baker baked some bread", 2: None, 3: None}


def brute_summary(text, max_words):
    import re

    if len(re.split(r"\s+", text.strip(" "))) <= max_words:
        return None
    parts = [p for p in (s.strip(" ") for s in re.split(r"[.!?\n]+", text)) if p]
    sets = [set(re.findall(r"[^\W\d_]+", p.lower())) for p in parts]
    best, winner = 0.0, 0
    for i, terms in enumerate(sets):
        hits = sum(any(t in other for j, other in enumerate(sets) if j != i) for t in terms)
        if terms and hits * hits / len(terms) > best:
            best, winner = hits * hits / len(terms), i
    return " ".join(re.split(r"\s+", parts[winner])[:max_words]) if parts else None


def test_summary_against_brute_force(spark):
    import random

    source = random.Random(3)
    texts = [
        "".join(source.choice(["ant ", "bee ", "cat ", "dog ", "eel. ", "fox! ", "\n"]) for _ in range(n))
        for n in range(3, 60)
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    found = {r["id"]: r["summary"] for r in enrich.summarize(df, "text", 8).collect()}
    for i, t in enumerate(texts):
        expected = brute_summary(t, 8)
        assert (found[i] or None) == (expected or None), t


def test_learned_lexicon(spark):
    data = [(f"spam offer {i}", 1) for i in range(6)] + [(f"hello friend {i}", 0) for i in range(12)]
    lexicon = enrich.learn_lexicon(spark.createDataFrame(data, "text string, bad int"), "text", "bad")
    found = {r["term"]: r["polarity"] for r in lexicon.collect()}
    assert found == {"spam": "negative", "offer": "negative", "hello": "positive", "friend": "positive"}


def test_model_runs_once_per_text(spark):
    cache = fresh_path(spark, "answers")
    df = spark.createDataFrame([(1, "same text"), (2, "same text"), (3, "other text"), (4, "abc"), (5, None)], "id int, text string")

    def lengths():
        def scorer(texts):
            return texts.str.len()
        return scorer

    scored = enrich.batch_infer(df, "text", lengths(), "ai_length", "int", cache=cache)
    assert rows(scored.select("id", "ai_length")) == sorted(
        [(1, 9), (2, 9), (3, 10), (4, None), (5, None)], key=repr
    )
    assert spark.read.parquet(f"{cache}/run=*").count() == 2
    more = df.union(spark.createDataFrame([(6, "a third text")], "id int, text string"))
    again = enrich.batch_infer(more, "text", lengths(), "ai_length", "int", cache=cache)
    assert again.filter("id = 6").first()["ai_length"] == 12
    assert spark.read.parquet(f"{cache}/run=*").count() == 3
