"""Sentiment, topic, entities and summaries as distributed Spark jobs.

Word lists are data: pass your own, or learn one from labelled text. Everything
except ``batch_infer`` is native; whole texts are read, and a row is scored where
it lies, so neither long texts nor repeated ones cause a shuffle.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tierworks.functions import text as tx
from tierworks.functions.masking import hash_normalised
from tierworks.session import fresh_path


@dataclass(frozen=True)
class Lexicon:
    """Positive and negative words."""

    positive: tuple[str, ...]
    negative: tuple[str, ...]

    @property
    def terms(self) -> list[str]:
        return tx.check_inline([*self.positive, *self.negative])


# A small general-purpose English list; real projects pass or learn their own.
DEFAULT_LEXICON = Lexicon(
    positive=(
        "amazing", "best", "brilliant", "charming", "delicious", "delightful", "enjoyed",
        "excellent", "fantastic", "fresh", "friendly", "good", "great", "happy", "helpful",
        "kind", "love", "loved", "lovely", "nice", "perfect", "pleasant", "recommend",
        "superb", "tasty", "thanks", "welcoming", "wonderful",
    ),
    negative=(
        "angry", "awful", "bad", "bland", "broken", "cold", "dirty", "disappointed",
        "disappointing", "disgusting", "hate", "horrible", "idiot", "late", "loser", "moron",
        "overpriced", "pathetic", "poor", "refund", "rude", "scum", "slow", "stale", "stupid",
        "terrible", "trash", "unfriendly", "worst", "worthless",
    ),
)

# The topic labels, in order of precedence, and the fallback.
TOPIC_LABELS = ("product_quality", "service", "price", "ambiance", "other")
# Our own key words for the four topics; projects pass theirs.
TOPIC_TERMS: dict[str, tuple[str, ...]] = {
    "product_quality": ("bread", "cake", "fresh", "quality", "stale", "taste", "tasty"),
    "service": ("friendly", "helpful", "rude", "server", "service", "staff", "waiter"),
    "price": ("cheap", "cost", "expensive", "overpriced", "price", "value"),
    "ambiance": ("atmosphere", "clean", "cosy", "decor", "music", "noise", "seating"),
}


@dataclass(frozen=True)
class Taxonomy:
    """Topic labels with the words that speak for each."""

    terms: Mapping[str, Sequence[str]] = field(default_factory=lambda: TOPIC_TERMS)
    fallback: str = TOPIC_LABELS[-1]

    @property
    def labels(self) -> list[str]:
        return [*self.terms, self.fallback]

    @property
    def all_terms(self) -> list[str]:
        return tx.check_inline([t for terms in self.terms.values() for t in terms])


def _distinct_hits(df: DataFrame, text: str, terms: Sequence[str], out: str) -> DataFrame:
    # Two steps on purpose: the word array is made once and read from a column.
    worded = df.withColumn("_words", tx.words(F.col(text)))
    hits = F.array_distinct(tx.keep_terms(F.col("_words"), terms))
    return worded.withColumn(out, hits).drop("_words")


def _count(hits: str, terms: Sequence[str]) -> Column:
    return F.size(tx.keep_terms(F.col(hits), [t.lower() for t in terms]))


def _sentiment_of(df: DataFrame, text: str, lexicon: Lexicon, out: str, min_chars: int) -> DataFrame:
    """Sentiment from the distinct hits in ``_hits``."""
    counted = df.withColumns(
        {
            "_positive": _count("_hits", lexicon.positive),
            "_negative": _count("_hits", lexicon.negative),
        }
    )
    rule = tx.sentiment_rule(F.col("_positive"), F.col("_negative"))
    gated = F.when(tx.long_enough(F.col(text), min_chars), rule)
    return counted.withColumn(out, gated).drop("_positive", "_negative")


def _topic_of(df: DataFrame, text: str, taxonomy: Taxonomy, out: str, min_chars: int) -> DataFrame:
    """Topic from the distinct hits in ``_hits``."""
    votes = {label: _count("_hits", terms) for label, terms in taxonomy.terms.items()}
    label = tx.best_label(votes, taxonomy.fallback)
    return df.withColumn(out, F.when(tx.long_enough(F.col(text), min_chars), label))


def sentiment(
    df: DataFrame,
    text: str,
    lexicon: Lexicon = DEFAULT_LEXICON,
    out: str = "sentiment_label",
    min_chars: int = tx.MIN_CHARS,
) -> DataFrame:
    """Label each row by how many different positive and negative words it holds."""
    found = _distinct_hits(df, text, lexicon.terms, "_hits")
    return _sentiment_of(found, text, lexicon, out, min_chars).drop("_hits")


def sentiment_and_topic(
    df: DataFrame,
    text: str,
    lexicon: Lexicon = DEFAULT_LEXICON,
    taxonomy: Taxonomy | None = None,
    min_chars: int = tx.MIN_CHARS,
) -> DataFrame:
    """``sentiment`` and ``classify`` from one pass over the words of each text."""
    taxonomy = taxonomy or Taxonomy()
    terms = tx.check_inline([*lexicon.terms, *taxonomy.all_terms])
    found = _distinct_hits(df, text, terms, "_hits")
    scored = _sentiment_of(found, text, lexicon, "sentiment_label", min_chars)
    return _topic_of(scored, text, taxonomy, "topic_label", min_chars).drop("_hits")


def learn_lexicon(
    labelled: DataFrame, text: str, bad: str, min_rows: int = 5, ratio: float = 4.0
) -> DataFrame:
    """Words that tell rows with ``bad = 1`` from rows with ``bad = 0``.

    A word is negative if its share among bad rows is at least ``ratio`` times its
    share among good rows, positive the other way round. A negative word must be in
    ``min_rows`` bad rows; a positive one must be so frequent that as many bad rows
    would be expected by chance. Counts are combined per task before the shuffle,
    and only the two class totals (one row) come to the driver.
    """
    totals = labelled.agg(
        F.count_if(F.col(bad) == 1).alias("bad"), F.count_if(F.col(bad) == 0).alias("good")
    ).first()
    n_bad, n_good = F.lit(totals["bad"]), F.lit(totals["good"])
    worded = labelled.select(bad, F.explode(F.array_distinct(tx.words(F.col(text)))).alias("term"))
    counted = worded.groupBy("term").agg(
        F.count_if(F.col(bad) == 1).alias("bad_rows"),
        F.count_if(F.col(bad) == 0).alias("good_rows"),
    )
    in_bad, in_good = F.col("bad_rows") * n_good, F.col("good_rows") * n_bad
    is_negative = (F.col("bad_rows") >= min_rows) & (in_bad >= in_good * F.lit(ratio))
    is_positive = (in_good >= n_good * F.lit(min_rows)) & (in_good >= in_bad * F.lit(ratio))
    polarity = F.when(is_negative, F.lit("negative")).when(is_positive, F.lit("positive"))
    return counted.withColumn("polarity", polarity).filter(F.col("polarity").isNotNull())


def _table_hits(df: DataFrame, text: str, terms: DataFrame) -> DataFrame:
    """Words of ``_text_key`` texts that are in ``terms`` (``term`` and more columns).

    One row per different text, word and entry, with the word's first place ``_at``.
    Spark broadcasts a list it has measured to be small and joins a large one by shuffle;
    the result is the same.
    """
    worded = df.filter(F.col("_text_key").isNotNull()).select(
        "_text_key", F.posexplode(F.array_distinct(tx.words(F.col(text)))).alias("_at", "term")
    )
    extra = [c for c in terms.columns if c != "term"]
    entries = terms.select(F.lower("term").alias("term"), *extra).distinct()
    return worded.join(entries, "term").distinct()


def _text_keyed(df: DataFrame, text: str, min_chars: int) -> DataFrame:
    """``_text_key`` is the same for equal texts and NULL for short and missing ones."""
    long = tx.long_enough(F.col(text), min_chars)
    return df.withColumn("_text_key", F.when(long, F.sha2(F.col(text), 256)))


def _attached(keyed: DataFrame, found: DataFrame, out: str, value: Column) -> DataFrame:
    """``value`` over ``found`` for rows with a text; rows without one stay out of the join."""
    columns = [c for c in keyed.columns if c != "_text_key"]
    usable = keyed.filter(F.col("_text_key").isNotNull()).join(found, "_text_key", "left")
    scored = usable.select(*columns, value.alias(out))
    nothing = keyed.filter(F.col("_text_key").isNull()).select(
        *columns, F.lit(None).cast(scored.schema[out].dataType).alias(out)
    )
    return scored.unionByName(nothing)


def sentiment_by_table(
    df: DataFrame,
    text: str,
    lexicon: DataFrame,
    out: str = "sentiment_label",
    min_chars: int = tx.MIN_CHARS,
) -> DataFrame:
    """``sentiment`` with a lexicon table (``term``, ``polarity``) of any size.

    Terms count once however often and in whatever case they are listed; a term listed
    on both sides counts for both. No key is needed: equal texts share their hits.
    """
    keyed = _text_keyed(df, text, min_chars)
    found = _table_hits(keyed, text, lexicon.select("term", "polarity")).groupBy("_text_key").agg(
        F.count_if(F.col("polarity") == "positive").alias("_positive"),
        F.count_if(F.col("polarity") == "negative").alias("_negative"),
    )
    counts = [F.coalesce(F.col(c), F.lit(0)) for c in ("_positive", "_negative")]
    return _attached(keyed, found, out, tx.sentiment_rule(*counts))


def classify_by_table(
    df: DataFrame,
    text: str,
    taxonomy: DataFrame,
    fallback: str = TOPIC_LABELS[-1],
    out: str = "topic_label",
    min_chars: int = tx.MIN_CHARS,
) -> DataFrame:
    """``classify`` with a table (``term``, ``label``, ``precedence``; lower wins a tie)."""
    keyed = _text_keyed(df, text, min_chars)
    hits = _table_hits(keyed, text, taxonomy.select("term", "label", "precedence"))
    votes = hits.groupBy("_text_key", "label", "precedence").agg(F.count("*").alias("n"))
    best = F.max(F.struct(F.col("n"), (-F.col("precedence")).alias("order"), F.col("label")))
    found = votes.groupBy("_text_key").agg(best.alias("_best"))
    return _attached(keyed, found, out, F.coalesce("_best.label", F.lit(fallback)))


def extract_by_table(
    df: DataFrame, text: str, names: DataFrame, out: str, min_chars: int = tx.MIN_CHARS
) -> DataFrame:
    """The first word of each text that a table (``term``) lists."""
    keyed = _text_keyed(df, text, min_chars)
    hits = _table_hits(keyed, text, names.select("term"))
    found = hits.groupBy("_text_key").agg(F.min_by("term", "_at").alias("_first"))
    return _attached(keyed, found, out, F.col("_first"))


def classify(
    df: DataFrame,
    text: str,
    taxonomy: Taxonomy | None = None,
    out: str = "topic_label",
    min_chars: int = tx.MIN_CHARS,
) -> DataFrame:
    """One label per row: most different key words, earlier label first, else the fallback."""
    taxonomy = taxonomy or Taxonomy()
    found = _distinct_hits(df, text, taxonomy.all_terms, "_hits")
    return _topic_of(found, text, taxonomy, out, min_chars).drop("_hits")


def extract(
    df: DataFrame,
    text: str,
    fields: Mapping[str, str | Sequence[str]],
    out: str = "extracted_entities",
    min_chars: int = tx.MIN_CHARS,
    hashed: Sequence[str] = (),
) -> DataFrame:
    """A struct with one string per field; those in ``hashed`` leave as SHA-256.

    A field is either a pattern whose first group is taken, or a list of known names
    (lower case) of which the first in the text is taken.
    """
    lists = [v for v in fields.values() if not isinstance(v, str)]
    for names in lists:
        tx.check_inline(names)
    worded = df.withColumn("_words", tx.words(F.col(text))) if lists else df
    members = []
    for name, spec in fields.items():
        if isinstance(spec, str):
            value = tx.pattern_field(F.col(text), spec)
        else:
            value = tx.first_term(F.col("_words"), [n.lower() for n in spec])
        members.append((hash_normalised(value) if name in hashed else value).alias(name))
    gated = F.when(tx.long_enough(F.col(text), min_chars), F.struct(*members))
    return worded.withColumn(out, gated).drop("_words")


def summarize(
    df: DataFrame, text: str, max_words: int, out: str = "summary"
) -> DataFrame:
    """The most significant sentence of texts longer than ``max_words`` words.

    After Luhn (1958): words found in more than one sentence are significant, and a
    sentence scores (its significant words)^2 / (its words), each word counted once.
    The earliest best sentence is cut to ``max_words``; short texts get NULL.

    The score comes from one sort and one fold over the words of a row, so the cost
    of a text grows with its length only, up to the sort.
    """
    is_long = F.size(F.split(F.trim(F.col(text)), r"\s+")) > F.lit(max_words)
    split = df.withColumn("_sentences", F.when(is_long, tx.sentences(F.col(text))))
    termed = split.withColumn(
        "_terms", F.transform("_sentences", lambda s: F.array_distinct(tx.words(s)))
    )
    placed = F.transform(
        "_terms",
        lambda terms, i: F.transform(
            terms,
            lambda t: F.struct(t.alias("term"), i.alias("at"), F.size(terms).alias("of")),
        ),
    )
    ordered = termed.withColumn("_placed", F.sort_array(F.flatten(placed)))
    term_at = lambda i: F.get(F.col("_placed"), i)["term"]
    shared = F.filter(
        F.col("_placed"),
        lambda w, i: (
            F.coalesce((i > 0) & (w["term"] == term_at(i - 1)), F.lit(False))
            | F.coalesce(w["term"] == term_at(i + 1), F.lit(False))
        ),
    )
    places = F.sort_array(
        F.transform(shared, lambda w: F.struct(w["at"].alias("at"), w["of"].alias("of")))
    )
    start = F.struct(
        F.lit(-1).alias("at"), F.lit(0).alias("hits"),
        F.lit(0.0).alias("best"), F.lit(0).alias("winner"),
    )

    def step(state: Column, word: Column) -> Column:
        hits = F.when(state["at"] == word["at"], state["hits"] + 1).otherwise(F.lit(1))
        score = (hits * hits).cast("double") / word["of"]
        better = score > state["best"]
        return F.struct(
            word["at"].alias("at"),
            hits.alias("hits"),
            F.when(better, score).otherwise(state["best"]).alias("best"),
            F.when(better, word["at"]).otherwise(state["winner"]).alias("winner"),
        )

    winner = F.aggregate(places, start, step, lambda state: state["winner"])
    sentence = F.get(F.col("_sentences"), winner)
    cut = tx.first_words(sentence, max_words)
    return ordered.withColumn(out, cut).drop("_sentences", "_terms", "_placed")


def batch_infer(
    df: DataFrame,
    text: str,
    scorer: Callable,
    out: str,
    out_type: str,
    cache: str | None = None,
    min_chars: int = tx.MIN_CHARS,
    partitions: int | None = None,
    retry_null: bool = False,
) -> DataFrame:
    """Run a user's model over every different text once and attach its answers.

    ``scorer`` maps a pandas Series of texts to a Series of answers, on executors,
    in Arrow batches. Texts below ``min_chars`` never reach it. Answers are written
    below ``cache`` (a shared path) and texts found there are not scored again;
    without ``cache`` a fresh folder of the shared checkpoint area is used, so that
    even then a re-computed plan never calls the model twice. ``retry_null`` asks again
    for texts whose answer was NULL.
    """
    spark = df.sparkSession
    schema = T.StructType(
        [T.StructField("_text_key", T.StringType())]
        + T._parse_datatype_string(f"answer {out_type}").fields
    )
    cache = cache or fresh_path(spark, "answers")
    keyed = _text_keyed(df, text, min_chars)
    distinct = (
        keyed.filter(F.col("_text_key").isNotNull())
        .select("_text_key", F.col(text).alias("_text"))
        .dropDuplicates(["_text_key"])
    )
    known = read_answers(spark, cache, schema)
    if known is not None:
        if retry_null:
            known = known.filter(F.col("answer").isNotNull())
        distinct = distinct.join(known, "_text_key", "left_anti")
    # Models are slow: spread the few texts left over many tasks, whatever their size.
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct = distinct.repartition(count, "_text_key")

    def run(batches):
        for batch in batches:
            answers = scorer(batch["_text"])
            yield batch[["_text_key"]].assign(answer=answers)

    distinct.mapInPandas(run, schema).write.parquet(f"{cache}/run={uuid.uuid4().hex}")
    answers = read_answers(spark, cache, schema)
    return _attached(keyed, answers, out, F.col("answer"))


def read_answers(spark, cache: str, schema: T.StructType) -> DataFrame | None:
    """All cached answers, one per text; None before the first run."""
    try:
        stored = spark.read.schema(schema).parquet(f"{cache}/run=*")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    # Two writers may have answered the same text: keep one answer, always the same.
    return stored.groupBy("_text_key").agg(F.min("answer").alias("answer"))


def translate(
    df: DataFrame, text: str, language: str, translator: Callable, out: str = "ai_translation",
    cache: str | None = None,
) -> DataFrame:
    """``batch_infer`` with a user's ``translator(texts, language)``; no model is shipped."""
    return batch_infer(
        df, text, lambda texts: translator(texts, language), out, "string", cache
    )
