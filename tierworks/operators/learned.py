"""Labels and summaries that learn their weights from the texts themselves.

``train`` counts words by label (multinomial naive Bayes), ``predict`` adds up the weights
of a text's words; ``document_frequencies`` and ``summarize`` pick the sentence whose words
are rarest in the corpus. All of it is counting. Texts are dealt into tasks of about
``TASK_BYTES`` by their key, which meet the most frequent words (``FREQUENT`` at most, a
broadcast) where they are and add up; only rarer words travel to the rest of the model, once
for each text or sentence. So no word is a hot group and no task grows with the input.

``key`` names each text. Rows that share a key are read as one text. Texts below
``min_chars`` characters, or NULL, get NULL, as with the word lists of ``enrich``.
"""

from __future__ import annotations

from math import ceil
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierworks.functions import text as tx
from tierworks.session import fresh_path

# Scores are compared to this many decimals, so ties do not depend on the order of sums.
DECIMALS = 6
# Bytes of text that a task takes.
TASK_BYTES = 8 * 1024**2
# Rows of a model that are broadcast, those of the most frequent words.
FREQUENT = 65_536


class Bayes(NamedTuple):
    """``words``: (term, weights), the weight of each label the term was seen with;
    ``labels``: (label, prior, unseen), one row a label, ``unseen`` for each known word."""

    words: DataFrame
    labels: DataFrame


def _written(df: DataFrame, label: str) -> DataFrame:
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _terms(df: DataFrame, text: str, *keep: str | Column) -> DataFrame:
    return df.select(*keep, F.explode(tx.words(F.col(text))).alias("term"))


def _parts(df: DataFrame, text: str) -> int:
    """Into how many parts texts are dealt, of about ``TASK_BYTES`` each."""
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(1, ceil(size / TASK_BYTES))


def _by_frequency(table: DataFrame, frequency: Column) -> tuple[DataFrame, DataFrame]:
    """The rows of the most frequent words, ``FREQUENT`` at most, and all others.

    Whole levels of ``frequency`` (quarters of its binary logarithm) go to one side.
    """
    level = F.floor(F.log2(frequency) * 4)
    counted = table.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()
    least, room = float("inf"), FREQUENT
    for r in sorted((r for r in counted if r["level"] is not None), key=lambda r: -r["level"]):
        room -= r["n"]
        if room < 0:
            break
        least = float(r["level"])
    often = F.coalesce(level >= F.lit(least), F.lit(False))
    return table.filter(often), table.filter(~often)


def train(
    df: DataFrame, text: str, label: str, least: int = 1, min_chars: int = tx.MIN_CHARS
) -> Bayes:
    """Word weights by label from labelled texts, with one added to every count.

    Words seen fewer than ``least`` times are left out. NULL labels are no label.
    """
    known = df.filter(F.col(label).isNotNull() & tx.long_enough(F.col(text), min_chars))
    known = known.select(F.col(label).alias("label"), F.col(text).alias("text"))
    counts = _terms(known, "text", "label").groupBy("term", "label").agg(F.count(F.lit(1)).alias("n"))
    listed = counts.groupBy("term").agg(
        F.collect_list(F.struct("label", "n")).alias("counts"), F.sum("n").alias("total")
    )
    kept = _written(listed.filter(F.col("total") >= least), "word-counts")
    size = kept.count()
    seen = kept.select(F.inline("counts")).groupBy("label").agg(F.sum("n").alias("words"))
    texts = known.groupBy("label").agg(F.count(F.lit(1)).alias("texts"))
    every = F.sum("texts").over(Window.partitionBy())  # one row a label
    labels = texts.join(seen, "label", "left").select(
        "label",
        F.log(F.col("texts") / every).alias("prior"),
        (-F.log(F.coalesce("words", F.lit(0)) + F.lit(size))).alias("unseen"),
    )
    weights = F.transform("counts", lambda c: F.struct(c["label"], F.log(c["n"] + 1.0).alias("weight")))
    return Bayes(kept.select("term", weights.alias("weights")), _written(labels, "label-weights"))


def predict(
    df: DataFrame, key: str, text: str, model: Bayes, out: str = "label", min_chars: int = tx.MIN_CHARS
) -> DataFrame:
    """``df`` with the likeliest label of each text; the smaller label wins a tie.

    A text without a known word gets the most frequent label. A model without labels gives
    NULL.
    """
    usable = tx.long_enough(F.col(text), min_chars) & F.col(key).isNotNull()
    long = df.filter(usable).select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    parts = _parts(long, "_text")
    words = _terms(long.repartition(parts, "_key"), "_text", "_key")
    often, rest = _by_frequency(model.words, F.exp(F.array_max(F.transform("weights", lambda w: w["weight"]))))
    no_label = F.lit(None).cast(model.labels.schema["label"].dataType).alias("label")
    known, open_word = (F.array(F.struct(no_label, F.lit(x).alias("weight"))) for x in (1.0, 0.0))
    weighed = F.concat(known, "weights")
    # A row for each label of a word, and one without a label that counts the known words;
    # ``rare`` is a word still to be looked up.
    met = words.join(F.broadcast(often), "term", "left").select(
        "_key", F.when(F.col("weights").isNull(), F.col("term")).alias("rare"),
        F.inline(F.when(F.col("weights").isNull(), open_word).otherwise(weighed)),
    )
    here = met.groupBy("_key", "label", "rare").agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n"))
    here = _written(here, "word-weights")
    rare = here.filter("rare IS NOT NULL").select("_key", "n", F.col("rare").alias("term")).repartition(parts, "term")
    there = rare.join(rest, "term").select("_key", "n", F.inline(weighed)).select(
        "_key", "label", (F.col("weight") * F.col("n")).alias("weight"))
    lines = here.filter("rare IS NULL").select("_key", "label", "weight").unionByName(there).repartition(parts, "_key")
    sums = lines.groupBy("_key", "label").agg(F.sum("weight").alias("weight"))
    by_text = sums.groupBy("_key").agg(
        F.max(F.when(F.col("label").isNull(), F.col("weight"))).alias("words"),
        F.collect_list(F.when(F.col("label").isNotNull(), F.struct("label", "weight"))).alias("found"),
    )
    table = F.array_sort(F.collect_list(F.struct("label", "prior", "unseen")))
    # One row; a label is short and there is one weight for each.
    labels = model.labels.agg(table.alias("_labels")).first()["_labels"]
    listed = F.array(*[F.struct(F.lit(r["label"]).alias("label"), F.lit(r["prior"]).alias("prior"),
                                F.lit(r["unseen"]).alias("unseen")) for r in labels])
    if not labels:
        return df.withColumn(out, F.lit(None).cast(model.labels.schema["label"].dataType))

    def scored(row: Column) -> Column:
        own = F.aggregate(
            F.filter(F.coalesce("found", F.array().cast(found_type)), lambda f: f["label"] == row["label"]),
            F.lit(0.0), lambda total, f: total + f["weight"])
        score = row["prior"] + F.coalesce("words", F.lit(0.0)) * row["unseen"] + own
        return F.struct((-F.round(score, DECIMALS)).alias("score"), row["label"].alias("label"))

    found_type = by_text.schema["found"].dataType
    rows = df.withColumn("_usable", usable).join(by_text, F.col(key) == F.col("_key"), "left")
    best = F.array_min(F.transform(listed, scored))["label"]
    return rows.withColumn(out, F.when(F.col("_usable"), best)).select(*df.columns, out)


def document_frequencies(df: DataFrame, text: str, min_chars: int = tx.MIN_CHARS) -> DataFrame:
    """(term, texts, corpus): in how many texts a word stands, of how many there are."""
    long = df.filter(tx.long_enough(F.col(text), min_chars))
    found = long.select(F.explode(F.array_distinct(tx.words(F.col(text)))).alias("term"))
    counts = found.groupBy("term").agg(F.count(F.lit(1)).alias("texts"))
    return _written(counts.withColumn("corpus", F.lit(long.count())), "document-frequencies")


def summarize(
    df: DataFrame, key: str, text: str, max_words: int, frequencies: DataFrame, out: str = "summary"
) -> DataFrame:
    """The sentence with the highest mean IDF of texts longer than ``max_words`` words.

    IDF is ln(corpus / texts) of a word; every word of a sentence counts, unknown ones as if
    one text had them. The earliest best sentence is cut to ``max_words``; short texts get
    NULL. Sentences travel as numbers: only the winner's text is cut out, where the row is.
    """
    is_long = F.size(F.split(F.trim(F.col(text)), r"\s+")) > F.lit(max_words)
    long = df.filter(is_long & F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    parts = _parts(long, "_text")
    split = long.repartition(parts, "_key").select(
        "_key", F.posexplode(tx.sentences(F.col("_text"))).alias("_at", "sentence")
    )
    corpus = frequencies.agg(F.max("corpus")).first()[0] or 1
    words = _terms(split, "sentence", "_key", "_at")
    idf = F.log(F.col("corpus") / F.col("texts")).alias("idf")
    often, rest = (side.select("term", idf) for side in _by_frequency(frequencies, F.col("texts")))
    # ``rare`` is a word still to be looked up.
    met = words.join(F.broadcast(often), "term", "left").withColumn(
        "rare", F.when(F.col("idf").isNull(), F.col("term")))
    here = met.groupBy("_key", "_at", "rare").agg(F.sum("idf").alias("idf"), F.count(F.lit(1)).alias("n"))
    here = _written(here, "word-idf")
    rare = here.filter("rare IS NOT NULL").select("_key", "_at", "n", F.col("rare").alias("term"))
    one = F.coalesce("idf", F.log(F.lit(float(corpus))))
    there = rare.repartition(parts, "term").join(rest, "term", "left").select("_key", "_at", (one * F.col("n")).alias("idf"), "n")
    met = here.filter("rare IS NULL").select("_key", "_at", "idf", "n").unionByName(there).repartition(parts, "_key")
    means = met.groupBy("_key", "_at").agg(
        F.round(F.sum("idf") / F.sum("n"), DECIMALS).alias("mean")
    )
    best = means.groupBy("_key").agg(F.min(F.struct((-F.col("mean")).alias("rank"), "_at")).alias("_best"))
    rows = df.repartition(parts, key).join(best, F.col(key) == F.col("_key"), "left")
    # A text without a word keeps its first sentence.
    sentence = F.get(tx.sentences(F.col(text)), F.coalesce("_best._at", F.lit(0)))
    cut = F.when(is_long & F.col(key).isNotNull(), tx.first_words(sentence, max_words))
    return rows.withColumn(out, cut).select(*df.columns, out)
