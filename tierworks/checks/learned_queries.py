"""Labels and summaries learned from the shared test texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierworks.checks import tables as tb
from tierworks.operators import learned

MAX_WORDS = 25


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return tb.read(spark, sf, "documents").select("doc_id", "text", "lang")


def _moods(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with the mood their toxic label stands for."""
    mood = F.when(F.col("toxic") == 1, F.lit("negative")).otherwise(F.lit("neutral"))
    labels = tb.read(spark, sf, "labels").filter("toxic IS NOT NULL").select("doc_id", mood.alias("mood"))
    return _documents(spark, sf).join(labels, "doc_id", "left")


def learned_topic(spark, sf):
    """Every document's language as a topic, learned from two thirds of them."""
    docs = _documents(spark, sf)
    model = learned.train(docs.filter("doc_id % 3 <> 0"), "text", "lang")
    return learned.predict(docs, "doc_id", "text", model, "topic_label").select("doc_id", "topic_label")


def learned_sentiment(spark, sf):
    docs = _moods(spark, sf)
    model = learned.train(docs.filter("doc_id % 3 <> 0"), "text", "mood", least=3)
    return learned.predict(docs, "doc_id", "text", model, "sentiment_label").select("doc_id", "sentiment_label")


def learned_accuracy(spark, sf):
    """How many held-out labels both get right."""
    docs = _moods(spark, sf)
    parts = []
    for name, label, least in (("topic", "lang", 1), ("sentiment", "mood", 3)):
        model = learned.train(docs.filter("doc_id % 3 <> 0"), "text", label, least=least)
        held = docs.filter((F.col("doc_id") % 3 == 0) & F.col(label).isNotNull())
        found = learned.predict(held, "doc_id", "text", model, "found").filter("found IS NOT NULL")
        parts.append(found.groupBy(F.lit(name).alias("task"), F.col(label).alias("label")).agg(
            F.count(F.lit(1)).alias("texts"), F.count_if(F.col("found") == F.col(label)).alias("right_ones")))
    return parts[0].unionByName(parts[1])


def summarize_by_idf(spark, sf):
    docs = _documents(spark, sf)
    frequencies = learned.document_frequencies(docs, "text")
    short = learned.summarize(docs, "doc_id", "text", MAX_WORDS, frequencies)
    return short.select("doc_id", "summary")


QUERIES = {
    f.__name__: f for f in (learned_topic, learned_sentiment, learned_accuracy, summarize_by_idf)
}

_MOODS = """
    docs AS (SELECT doc_id, text, lang, CASE toxic WHEN 1 THEN 'negative' WHEN 0 THEN 'neutral' END AS mood
             FROM documents LEFT JOIN labels USING (doc_id)),
    words AS (SELECT doc_id, lang, mood, unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS term
              FROM docs WHERE length(trim(text)) >= 5)"""


def _bayes(name: str, label: str, least: int) -> str:
    """Common table expressions that end with ``{name}`` (doc_id, found)."""
    return f"""
    {name}_kept AS (SELECT term FROM words WHERE doc_id % 3 <> 0 AND {label} IS NOT NULL
                    GROUP BY term HAVING count(*) >= {least}),
    {name}_counts AS (SELECT term, {label} AS label, count(*) AS n FROM words JOIN {name}_kept USING (term)
                      WHERE doc_id % 3 <> 0 AND {label} IS NOT NULL GROUP BY ALL),
    {name}_texts AS (SELECT {label} AS label, count(*) AS texts FROM docs
                     WHERE doc_id % 3 <> 0 AND {label} IS NOT NULL AND length(trim(text)) >= 5 GROUP BY ALL),
    {name}_labels AS (
        SELECT t.label, ln(texts / sum(texts) OVER ()) AS prior,
               -ln(coalesce((SELECT sum(n) FROM {name}_counts c WHERE c.label = t.label), 0)
                   + (SELECT count(*) FROM {name}_kept)) AS unseen
        FROM {name}_texts t),
    {name}_known AS (SELECT doc_id, count(*) AS words FROM words JOIN {name}_kept USING (term) GROUP BY 1),
    {name}_sums AS (SELECT doc_id, c.label, sum(ln(n + 1.0)) AS weight
                    FROM words JOIN {name}_counts c USING (term) GROUP BY ALL),
    {name} AS (
        SELECT d.doc_id, first(l.label ORDER BY
                   round(prior + coalesce(words, 0) * unseen + coalesce(weight, 0), 6) DESC, l.label) AS found
        FROM docs d CROSS JOIN {name}_labels l
        LEFT JOIN {name}_known k ON k.doc_id = d.doc_id
        LEFT JOIN {name}_sums s ON s.doc_id = d.doc_id AND s.label = l.label
        WHERE length(trim(text)) >= 5 GROUP BY 1)"""


ORACLE = {
    "learned_topic": f"""WITH {_MOODS}, {_bayes('topic', 'lang', 1)}
        SELECT doc_id, found AS topic_label FROM documents LEFT JOIN topic USING (doc_id)""",
    "learned_sentiment": f"""WITH {_MOODS}, {_bayes('feeling', 'mood', 3)}
        SELECT doc_id, found AS sentiment_label FROM documents LEFT JOIN feeling USING (doc_id)""",
    "learned_accuracy": f"""WITH {_MOODS}, {_bayes('topic', 'lang', 1)}, {_bayes('feeling', 'mood', 3)},
        tried AS (
            SELECT 'topic' AS task, lang AS label, found FROM docs JOIN topic USING (doc_id) WHERE doc_id % 3 = 0
            UNION ALL
            SELECT 'sentiment', mood, found FROM docs JOIN feeling USING (doc_id) WHERE doc_id % 3 = 0)
        SELECT task, label, count(*) AS texts, count(*) FILTER (found = label) AS right_ones
        FROM tried WHERE label IS NOT NULL GROUP BY ALL""",
    "summarize_by_idf": rf"""
        WITH long AS (SELECT * FROM documents WHERE length(trim(text)) >= 5),
        freq AS (SELECT term, ln((SELECT count(*) FROM long) / count(*)) AS idf
                 FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS term FROM long)
                 GROUP BY term),
        split AS (
            SELECT doc_id, list_filter(list_transform(string_split_regex(text, '[.!?\n]+'), lambda s: trim(s, ' ')),
                                       lambda s: s <> '') AS sentences
            FROM documents WHERE len(string_split_regex(trim(text, ' '), '\s+')) > {MAX_WORDS}),
        placed AS (SELECT doc_id, unnest(sentences) AS sentence, unnest(range(len(sentences))) AS pos FROM split),
        means AS (SELECT doc_id, pos, sentence, round(avg(idf), 6) AS mean
                  FROM (SELECT doc_id, pos, sentence, unnest(regexp_extract_all(lower(sentence), '\p{{L}}+')) AS term
                        FROM placed) JOIN freq USING (term) GROUP BY ALL),
        best AS (SELECT doc_id, first(sentence ORDER BY mean DESC, pos) AS sentence FROM means GROUP BY 1),
        chosen AS (SELECT doc_id, coalesce(b.sentence, s.sentences[1]) AS sentence FROM split s LEFT JOIN best b USING (doc_id))
        SELECT doc_id, array_to_string(string_split_regex(sentence, '\s+')[:{MAX_WORDS}], ' ') AS summary
        FROM documents LEFT JOIN chosen USING (doc_id)""",
}
