"""Row quality: flags, expectations and their reports.

A row passes an expectation only when the predicate is true; NULL fails.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tierworks.functions.text import SENTIMENTS, long_enough
from tierworks.operators.shape import QUALITY_COLUMN

ACTIONS = ("drop", "fail")
CLEAN = "CLEAN"  # fixed values: flags a row can carry
MISSING_TEXT = "MISSING_TEXT"
NO_ANSWER = "AI_NULL_RESPONSE"


class ExpectationFailed(RuntimeError):
    """A refresh was stopped by rows that break a ``fail`` expectation."""


@dataclass(frozen=True)
class Rule:
    """A condition and the flag given to rows that meet it."""

    condition: Column
    flag: str


def missing(column: str) -> Rule:
    return Rule(F.col(column).isNull(), f"MISSING_{column.upper()}")


def negative(column: str) -> Rule:
    return Rule(F.col(column) < 0, f"NEGATIVE_{column.upper()}")


def flag(*rules: Rule) -> Column:
    """The flag of the first rule that applies, else ``CLEAN``."""
    branches = F
    for rule in rules:
        branches = branches.when(rule.condition, F.lit(rule.flag))
    return (branches.otherwise(F.lit(CLEAN)) if rules else F.lit(CLEAN)).alias(QUALITY_COLUMN)


def text_flag(text: Column, answer: Column) -> Column:
    """Missing text, a scorer that gave no answer, or clean; uses the label already made."""
    usable = F.coalesce(long_enough(text), F.lit(False))
    return (
        F.when(~usable, F.lit(MISSING_TEXT))
        .when(answer.isNull(), F.lit(NO_ANSWER))
        .otherwise(F.lit(CLEAN))
        .alias(QUALITY_COLUMN)
    )


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str | Column
    action: str = "drop"

    def __post_init__(self) -> None:
        if self.action not in ACTIONS:
            raise ValueError(f"action must be one of {ACTIONS}, not {self.action!r}")

    @property
    def condition(self) -> Column:
        return F.expr(self.predicate) if isinstance(self.predicate, str) else self.predicate

    @property
    def holds(self) -> Column:
        """True or false, never NULL."""
        return F.coalesce(self.condition, F.lit(False))


def expect(name: str, predicate: str | Column, action: str = "drop") -> Expectation:
    return Expectation(name, predicate, action)


def expect_labels(column: str, labels: Sequence[str], action: str = "drop") -> Expectation:
    """The label is one of ``labels`` or absent."""
    value = F.col(column)
    return Expectation(f"valid_{column}", value.isin(*labels) | value.isNull(), action)


def expect_sentiment(column: str = "sentiment_label") -> Expectation:
    return expect_labels(column, SENTIMENTS)


def dropped(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """Rows left after the ``drop`` expectations.

    A filter drops NULL by itself; the bare condition can reach the file scan.
    """
    for e in expectations:
        if e.action == "drop":
            df = df.filter(e.condition)
    return df


def enforce(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """Lazy form of both actions: drop filters, and a row that must not exist ends the job.

    The violations are observed as well, under a name of their own; this also keeps
    the filters above costly columns, which would otherwise be computed twice.
    """
    if expectations:
        df = df.observe(f"expectations-{uuid.uuid4().hex}", *violation_counts(expectations))
    for e in expectations:
        if e.action == "fail":
            stop = F.raise_error(F.lit(f"expectation {e.name} failed")).cast("boolean")
            df = df.filter(F.when(e.holds, F.lit(True)).otherwise(stop))
    return dropped(df, expectations)


def violation_counts(expectations: Sequence[Expectation]) -> list[Column]:
    """One failure counter per expectation, for ``agg`` or ``observe``."""
    return [F.count_if(~e.holds).alias(e.name) for e in expectations]


def report(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """Passed and failed rows per expectation, counted in a single pass."""
    totals = df.agg(F.count("*").alias("_rows"), *violation_counts(expectations))
    rows = F.col("_rows")
    lines = [
        F.struct(
            F.lit(e.name).alias("expectation"),
            F.lit(e.action).alias("action"),
            (rows - F.col(e.name)).alias("passed"),
            F.col(e.name).alias("failed"),
            F.round(F.col(e.name).cast("double") * 100 / F.nullif(rows, F.lit(0)), 2).alias(
                "failed_pct"
            ),
        )
        for e in expectations
    ]
    return totals.select(F.inline(F.array(*lines)))


def summary(df: DataFrame, table: str) -> DataFrame:
    """Rows per quality flag."""
    counted = df.groupBy(QUALITY_COLUMN).agg(F.count("*").alias("row_count"))
    return counted.select(F.lit(table).alias("table_name"), QUALITY_COLUMN, "row_count")
