"""Text enrichment on the shared test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierworks.checks import tables as tb
from tierworks.checks.tables import RUN_TS, audit_sql, with_views
from tierworks.functions import text as tx
from tierworks.operators import enrich, quality
from tierworks.plans import products as pr
from tierworks.session import fresh_path

# The test prose is invented: insults are its only loaded words, so common function
# words stand in for the positive side and for the topics.
LEXICON = enrich.Lexicon(
    positive=("with", "avec", "mit", "con", "für", "pour", "bien"),
    negative=("clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid",
              "trash", "worthless"),
)
TAXONOMY = enrich.Taxonomy(
    {
        "product_quality": ("that", "this", "was", "which", "from"),
        "service": ("der", "die", "und", "nicht", "von"),
        "price": ("les", "des", "est", "pas", "sur"),
        "ambiance": ("que", "los", "las", "una", "por"),
    }
)
FIELDS = {
    "product_name": r"@(mail[0-9]+)\.example",
    "staff_name": r"([a-z]+)\.[0-9]+@",
}
GLOSSARY = {"der": "the", "die": "the", "und": "and", "les": "the", "que": "that", "con": "with"}
SUMMARY_WORDS = 25


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return tb.read(spark, sf, "documents").select("doc_id", "text", "lang", "source")


def sentiment(spark, sf):
    scored = enrich.sentiment(documents(spark, sf), "text", LEXICON)
    return scored.select("doc_id", "sentiment_label")


def conversation_sentiment(spark, sf):
    """Mood of every speaker's turns."""
    turns = enrich.sentiment(tb.read(spark, sf, "conversations"), "text", LEXICON)
    return turns.groupBy("role", "sentiment_label").agg(F.count("*").alias("row_count"))


def _labelled(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    return docs.join(tb.read(spark, sf, "labels").select("doc_id", "toxic"), "doc_id")


def learn_lexicon(spark, sf):
    return enrich.learn_lexicon(_labelled(spark, sf), "text", "toxic")


def sentiment_learned(spark, sf):
    """Every document scored with the lexicon learned from the labelled ones."""
    lexicon = enrich.learn_lexicon(_labelled(spark, sf), "text", "toxic")
    scored = enrich.sentiment_by_table(documents(spark, sf), "text", lexicon)
    return scored.select("doc_id", "sentiment_label")


def sentiment_joined(spark, sf):
    """The same with a lexicon of mixed case and repeated entries."""
    learned = enrich.learn_lexicon(_labelled(spark, sf), "text", "toxic").select("term", "polarity")
    messy = learned.union(learned.select(F.initcap("term"), "polarity")).union(learned)
    scored = enrich.sentiment_by_table(documents(spark, sf), "text", messy)
    return scored.select("doc_id", "sentiment_label")


def classify_table(spark, sf):
    """``classify`` with the taxonomy as a table."""
    entries = [(t.upper(), label, i) for i, (label, terms) in enumerate(TAXONOMY.terms.items())
               for t in terms]
    table = spark.createDataFrame(entries * 2, "term string, label string, precedence int")
    found = enrich.classify_by_table(documents(spark, sf), "text", table, TAXONOMY.fallback)
    return found.select("doc_id", "topic_label")


def extract_table(spark, sf):
    names = spark.createDataFrame([(t,) for t in LEXICON.negative], "term string")
    found = enrich.extract_by_table(documents(spark, sf), "text", names, "insult")
    return found.select("doc_id", "insult")


def classify(spark, sf):
    return enrich.classify(documents(spark, sf), "text", TAXONOMY).select("doc_id", "topic_label")


def extract(spark, sf):
    fields = FIELDS | {"insult": LEXICON.negative}
    found = enrich.extract(documents(spark, sf), "text", fields)
    return found.select("doc_id", "extracted_entities.*")


def summarize(spark, sf):
    short = enrich.summarize(documents(spark, sf), "text", SUMMARY_WORDS)
    return short.select("doc_id", "summary")


def letter_counter():
    """A stand-in model: the number of ASCII letters of each text.

    Models are built by a function, so they travel to the executors by value.
    """

    def count(texts):
        return texts.str.count("[A-Za-z]")

    return count


def batch_infer(spark, sf):
    scored = enrich.batch_infer(documents(spark, sf), "text", letter_counter(), "ai_letters", "long")
    return scored.select("doc_id", "ai_letters")


def glossary_translator(glossary):
    """A stand-in translator: known words into English, everything else as it is."""

    def translator(texts, language):
        if language != "en":
            raise ValueError("the glossary only knows English")
        return texts.map(lambda t: " ".join(glossary.get(w, w) for w in t.split(" ")))

    return translator


def translate(spark, sf):
    out = enrich.translate(documents(spark, sf), "text", "en", glossary_translator(GLOSSARY))
    return out.select("doc_id", "ai_translation")


def reuse_outputs(spark, sf):
    """English texts are scored first; a later run over all texts scores only new ones."""
    cache = fresh_path(spark, "reuse")
    docs = documents(spark, sf)
    first = docs.filter("lang = 'en'")
    enrich.batch_infer(first, "text", letter_counter(), "ai_letters", "long", cache=cache)
    scored = enrich.batch_infer(docs, "text", letter_counter(), "ai_letters", "long", cache=cache)
    runs = spark.read.parquet(f"{cache}/run=*").select("_text_key")
    calls = runs.groupBy("_text_key").agg(F.count("*").alias("model_calls"))
    keyed = scored.withColumn("_text_key", F.sha2("text", 256))
    return keyed.join(calls, "_text_key", "left").select("doc_id", "ai_letters", "model_calls")


def dq_flag_text(spark, sf):
    answer = F.when(F.col("lang") != "es", F.col("lang"))
    return documents(spark, sf).select("doc_id", quality.text_flag(F.col("text"), answer))


def _silver(spark, sf) -> DataFrame:
    bronze = pr.bronze_reviews(tb.reviews(spark, sf), "voice_of_customer", RUN_TS)
    silver = pr.silver_review_sentiment(
        bronze, "voice_of_customer", RUN_TS, LEXICON, TAXONOMY, FIELDS, SUMMARY_WORDS
    )
    return quality.enforce(silver, pr.review_expectations(TAXONOMY))


def silver_review_sentiment(spark, sf):
    silver = _silver(spark, sf)
    names = silver.columns
    at = names.index("extracted_entities")
    return silver.select(*names[:at], "extracted_entities.*", *names[at + 1 :])


def gold_review_sentiment_by_franchise(spark, sf):
    return pr.gold_review_sentiment_by_franchise(
        _silver(spark, sf), tb.franchises(spark, sf), RUN_TS
    )


def gold_review_topics_by_franchise(spark, sf):
    return pr.gold_review_topics_by_franchise(
        _silver(spark, sf), tb.franchises(spark, sf), RUN_TS
    )


def gold_revenue_impact(spark, sf):
    return pr.gold_revenue_impact(_silver(spark, sf), tb.sales(spark, sf), RUN_TS)


QUERIES = {
    f.__name__: f
    for f in (
        sentiment, conversation_sentiment, learn_lexicon, sentiment_learned, sentiment_joined, classify_table,
        extract_table,
        classify, extract, summarize, batch_infer, translate, reuse_outputs, dq_flag_text,
        silver_review_sentiment, gold_review_sentiment_by_franchise,
        gold_review_topics_by_franchise, gold_revenue_impact,
    )
}

def _words(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '{tx.WORD}')"


def _in(terms) -> str:
    return "(" + ", ".join(f"'{t}'" for t in terms) + ")"


def _hits(text: str, terms) -> str:
    return f"len(list_distinct(list_filter({_words(text)}, lambda w: w IN {_in(terms)})))"


def _rule(positive: str, negative: str) -> str:
    return f"""CASE WHEN {positive} = 0 AND {negative} = 0 THEN 'neutral'
        WHEN least({positive}, {negative}) * 2 >= greatest({positive}, {negative}) THEN 'mixed'
        WHEN {positive} > {negative} THEN 'positive' ELSE 'negative' END"""


def _sentiment_sql(text: str) -> str:
    rule = _rule(_hits(text, LEXICON.positive), _hits(text, LEXICON.negative))
    return f"CASE WHEN length(trim({text})) >= 5 THEN {rule} END"


def _topic_sql(text: str) -> str:
    counts = {label: _hits(text, terms) for label, terms in TAXONOMY.terms.items()}
    most = f"greatest({', '.join(counts.values())})"
    arms = " ".join(f"WHEN {n} = {most} THEN '{label}'" for label, n in counts.items())
    return f"""CASE WHEN length(trim({text})) >= 5 THEN
        CASE WHEN {most} = 0 THEN 'other' {arms} END END"""


def _field_sql(text: str, pattern: str) -> str:
    return f"CASE WHEN length(trim({text})) >= 5 THEN nullif(regexp_extract({text}, '{pattern}', 1), '') END"


_LEXICON_SQL = rf"""
    SELECT term, bad_rows, good_rows,
           CASE WHEN bad_rows >= 5 AND bad_rows * n_good >= good_rows * n_bad * 4.0 THEN 'negative'
                WHEN good_rows * n_bad >= n_good * 5 AND good_rows * n_bad >= bad_rows * n_good * 4.0
                THEN 'positive' END AS polarity
    FROM (SELECT term, count(*) FILTER (WHERE toxic = 1) AS bad_rows,
                 count(*) FILTER (WHERE toxic = 0) AS good_rows
          FROM (SELECT toxic, unnest(list_distinct({_words('text')})) AS term
                FROM documents JOIN labels USING (doc_id)) GROUP BY term),
         (SELECT count(*) FILTER (WHERE toxic = 1) AS n_bad,
                 count(*) FILTER (WHERE toxic = 0) AS n_good
          FROM documents JOIN labels USING (doc_id))"""
_LEARNED = f"SELECT * FROM ({_LEXICON_SQL}) WHERE polarity IS NOT NULL"
_LEARNED_SENTIMENT = f"""
    WITH lexicon AS ({_LEARNED}),
    found AS (SELECT doc_id, count(*) FILTER (WHERE polarity = 'positive') AS pos,
                     count(*) FILTER (WHERE polarity = 'negative') AS neg
              FROM (SELECT doc_id, unnest(list_distinct({_words('text')})) AS term
                    FROM documents) JOIN lexicon USING (term) GROUP BY doc_id)
    SELECT doc_id, CASE WHEN length(trim(text)) >= 5 THEN
           {_rule('coalesce(pos, 0)', 'coalesce(neg, 0)')} END AS sentiment_label
    FROM documents LEFT JOIN found USING (doc_id)"""


def _summary_sql(source: str, key: str, text: str) -> str:
    """(key, summary) for every row of ``source``; its text column is ``text``."""
    return rf"""
    SELECT k.{key}, array_to_string(list_slice(regexp_split_to_array(sentence, '\s+'), 1, {SUMMARY_WORDS}), ' ')
           AS summary
    FROM {source} k LEFT JOIN (
        SELECT {key}, arg_min(sentence, (-score, place)) AS sentence FROM (
            SELECT {key}, place, any_value(sentence) AS sentence,
                   coalesce(CAST(sum(CAST(n > 1 AS INTEGER)) * sum(CAST(n > 1 AS INTEGER)) AS DOUBLE)
                            / nullif(count(term), 0), 0) AS score
            FROM (
                SELECT *, CASE WHEN term IS NOT NULL
                          THEN count(*) OVER (PARTITION BY {key}, term) END AS n FROM (
                    SELECT s.{key}, s.place, s.sentence, t.term
                    FROM (SELECT {key}, unnest(sentences) AS sentence,
                                 unnest(range(len(sentences))) AS place
                          FROM (SELECT {key}, list_filter(
                                    list_transform(regexp_split_to_array({text}, '{tx.SENTENCE_END}'),
                                                   lambda s: trim(s)), lambda s: s <> '') AS sentences
                                FROM {source}
                                WHERE len(regexp_split_to_array(trim({text}), '\s+')) > {SUMMARY_WORDS})) s
                    LEFT JOIN LATERAL (
                        SELECT unnest(list_distinct({_words('s.sentence')})) AS term) t ON true))
            GROUP BY {key}, place)
        GROUP BY {key}) b ON k.{key} = b.{key}"""


_SILVER_SQL = rf"""
    SELECT review_id, customer_id, franchise_id, product_id, review_text AS source_text,
           {_sentiment_sql('review_text')} AS sentiment_label,
           {_topic_sql('review_text')} AS topic_label,
           {_field_sql('review_text', FIELDS['product_name'])} AS product_name,
           sha256(lower(trim({_field_sql('review_text', FIELDS['staff_name'])}))) AS staff_name,
           summary,
           CASE WHEN review_text IS NULL OR length(trim(review_text)) < 5 THEN 'MISSING_TEXT'
                WHEN {_sentiment_sql('review_text')} IS NULL THEN 'AI_NULL_RESPONSE'
                ELSE 'CLEAN' END AS data_quality_flag, {audit_sql('voice_of_customer')}
    FROM reviews JOIN ({_summary_sql('reviews', 'review_id', 'review_text')}) USING (review_id)
    WHERE review_text IS NOT NULL"""
# The gold tables need neither entities nor summaries.
_MOOD_SQL = f"""
    SELECT franchise_id, {_sentiment_sql('review_text')} AS sentiment_label,
           {_topic_sql('review_text')} AS topic_label FROM reviews
    WHERE length(trim(review_text)) >= 5"""


def _pct(condition: str) -> str:
    return f"round(CAST(count(*) FILTER (WHERE {condition}) AS DOUBLE) * 100 / count(*), 1)"


_LETTERS = "CASE WHEN length(trim(text)) >= 5 THEN length(regexp_replace(text, '[^A-Za-z]', '', 'g')) END"
_GLOSS = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in GLOSSARY.items())

ORACLE = {
    "sentiment": f"SELECT doc_id, {_sentiment_sql('text')} AS sentiment_label FROM documents",
    "conversation_sentiment":
        f"""SELECT role, sentiment_label, count(*) AS row_count
            FROM (SELECT role, {_sentiment_sql('text')} AS sentiment_label FROM conversations)
            GROUP BY role, sentiment_label""",
    "learn_lexicon": _LEARNED,
    "sentiment_learned": _LEARNED_SENTIMENT,
    "sentiment_joined": _LEARNED_SENTIMENT,
    "classify": f"SELECT doc_id, {_topic_sql('text')} AS topic_label FROM documents",
    "classify_table": f"SELECT doc_id, {_topic_sql('text')} AS topic_label FROM documents",
    "extract_table":
        f"""SELECT doc_id, CASE WHEN length(trim(text)) >= 5 THEN
              list_filter({_words('text')}, lambda w: w IN {_in(LEXICON.negative)})[1] END
              AS insult FROM documents""",
    "extract":
        f"""SELECT doc_id, {_field_sql('text', FIELDS['product_name'])} AS product_name,
            {_field_sql('text', FIELDS['staff_name'])} AS staff_name,
            CASE WHEN length(trim(text)) >= 5 THEN
              list_filter({_words('text')}, lambda w: w IN {_in(LEXICON.negative)})[1] END
              AS insult FROM documents""",
    "summarize": _summary_sql("documents", "doc_id", "text"),
    "batch_infer": f"SELECT doc_id, {_LETTERS} AS ai_letters FROM documents",
    "translate":
        f"""SELECT doc_id, CASE WHEN length(trim(text)) >= 5 THEN array_to_string(
              list_transform(string_split(text, ' '), lambda w: CASE w {_GLOSS} ELSE w END), ' ') END
              AS ai_translation FROM documents""",
    "reuse_outputs":
        f"""SELECT doc_id, {_LETTERS} AS ai_letters,
            CASE WHEN length(trim(text)) >= 5 THEN 1 END AS model_calls FROM documents""",
    "dq_flag_text":
        """SELECT doc_id, CASE WHEN text IS NULL OR length(trim(text)) < 5 THEN 'MISSING_TEXT'
           WHEN lang = 'es' THEN 'AI_NULL_RESPONSE' ELSE 'CLEAN' END AS data_quality_flag
           FROM documents""",
    "silver_review_sentiment": with_views(_SILVER_SQL, "reviews"),
    "gold_review_sentiment_by_franchise": with_views(
        f"""SELECT franchise_id, name AS franchise_name, topic_label, sentiment_label,
            count(*) AS review_count,
            round(CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER
                  (PARTITION BY franchise_id, name, topic_label), 1) AS label_pct,
            {audit_sql('gold_aggregation')}
            FROM moods JOIN franchises USING (franchise_id)
            GROUP BY franchise_id, name, topic_label, sentiment_label""",
        "reviews", "franchises", moods=_MOOD_SQL),
    "gold_review_topics_by_franchise": with_views(
        f"""SELECT franchise_id, name AS franchise_name, topic_label, count(*) AS review_count,
            {_pct("sentiment_label = 'positive'")} AS positive_pct,
            {_pct("sentiment_label = 'negative'")} AS negative_pct, {audit_sql('gold_aggregation')}
            FROM moods JOIN franchises USING (franchise_id)
            GROUP BY franchise_id, name, topic_label""",
        "reviews", "franchises", moods=_MOOD_SQL),
    "gold_revenue_impact": with_views(
        f"""SELECT franchise_id, review_count, negative_pct, sale_count, revenue, avg_basket,
            {audit_sql('gold_aggregation')}
            FROM (SELECT franchise_id, count(*) AS review_count,
                         {_pct("sentiment_label = 'negative'")} AS negative_pct
                  FROM moods GROUP BY franchise_id)
            JOIN (SELECT franchise_id, count(*) AS sale_count, round(sum(amount), 2) AS revenue,
                         round(avg(amount), 2) AS avg_basket FROM sales GROUP BY franchise_id)
            USING (franchise_id)""",
        "reviews", "sales", moods=_MOOD_SQL),
}
