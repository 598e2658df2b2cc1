"""Native text expressions: every one works on a row alone, without a shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

WORD = r"\p{L}+"
SENTENCE_END = r"[.!?\n]+"
MIN_CHARS = 5  # fixed value: shorter text counts as missing
# Word lists written into the plan are checked against this size; larger ones come as
# a table (``enrich.sentiment_by_table``, ``classify_by_table``, ``extract_by_table``).
MAX_INLINE_TERMS = 10_000

SENTIMENTS = ("positive", "negative", "neutral", "mixed")  # fixed values


def words(text: Column) -> Column:
    """Lower-case letter runs in order of appearance."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def sentences(text: Column) -> Column:
    """Trimmed, non-blank pieces between sentence ends."""
    pieces = F.transform(F.split(text, SENTENCE_END, -1), lambda s: F.trim(s))
    return F.filter(pieces, lambda s: s != F.lit(""))


def long_enough(text: Column, minimum: int = MIN_CHARS) -> Column:
    return F.length(F.trim(text)) >= F.lit(minimum)


def check_inline(terms: Sequence[str]) -> list[str]:
    """Word lists inside expressions must stay small; bigger ones belong in a join."""
    unique = list(dict.fromkeys(t.lower() for t in terms))
    if len(unique) > MAX_INLINE_TERMS:
        raise ValueError(
            f"{len(unique)} terms exceed {MAX_INLINE_TERMS}; use the *_by_table functions"
        )
    return unique


def keep_terms(word_array: Column, terms: Sequence[str]) -> Column:
    """The words that belong to ``terms`` (a hash-set test once there are over ten)."""
    if not terms:
        return F.filter(word_array, lambda w: F.lit(False))
    return F.filter(word_array, lambda w: w.isin(*terms))


def sentiment_rule(positive: Column, negative: Column) -> Column:
    """One label from two hit counts; ``mixed`` needs both sides within a factor of two."""
    close = F.least(positive, negative) * 2 >= F.greatest(positive, negative)
    return (
        F.when((positive == 0) & (negative == 0), F.lit("neutral"))
        .when(close, F.lit("mixed"))
        .when(positive > negative, F.lit("positive"))
        .otherwise(F.lit("negative"))
    )


def best_label(hits: Mapping[str, Column], fallback: str) -> Column:
    """Label with most hits; the earlier label wins a tie, no hit gives ``fallback``."""
    ranked = F.array_max(
        F.array(
            *[
                F.struct(n.alias("hits"), F.lit(-i).alias("order"), F.lit(label).alias("label"))
                for i, (label, n) in enumerate(hits.items())
            ]
        )
    )
    return F.when(ranked["hits"] > 0, ranked["label"]).otherwise(F.lit(fallback))


def pattern_field(text: Column, pattern: str, group: int = 1) -> Column:
    """First match of ``pattern``, NULL where there is none."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def first_term(word_array: Column, terms: Sequence[str]) -> Column:
    """First word of the text that is in ``terms``."""
    return F.get(keep_terms(word_array, terms), F.lit(0))


def first_words(text: Column, limit: int) -> Column:
    """At most ``limit`` blank-separated words."""
    return F.array_join(F.slice(F.split(text, r"\s+"), 1, limit), " ")
