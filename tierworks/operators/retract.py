"""Aggregates that take rows back, so that changes alone keep them up to date.

Every change-feed row has a weight: 1 for a row that came, -1 for one that went. Counts,
sums and averages are sums of weighted values and follow from the changes. A minimum or a
maximum follows from rows that came; where a row that went may have been the extreme one,
its group has to be read again.

Sums are kept as decimals of a stated scale, so that taking a value back leaves exactly
what was there before; sums of doubles would drift. NULLs count as in SQL: a group's sum,
average and extremes are NULL without a value, and a NULL group is a group.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tierworks.operators.changes import CHANGE_COLUMN, DELETE, UPDATE_BEFORE

ROWS = "_rows"


class Measure(NamedTuple):
    """``kind``: count, sum, avg, min or max; ``of`` is an SQL expression, none counts rows."""

    name: str
    kind: str
    of: str | None = None
    scale: int = 2


KINDS = ("count", "sum", "avg", "min", "max")


def check(measures: Sequence[Measure]) -> None:
    for m in measures:
        if m.kind not in KINDS:
            raise ValueError(f"{m.name}: kind must be one of {KINDS}, not {m.kind!r}")
        if m.kind != "count" and m.of is None:
            raise ValueError(f"{m.name}: {m.kind} needs an expression")


def _exact(m: Measure) -> Column:
    return F.expr(m.of).cast(f"decimal(38,{m.scale})")


def weight() -> Column:
    gone = F.col(CHANGE_COLUMN).isin(DELETE, UPDATE_BEFORE)
    return F.when(gone, F.lit(-1)).otherwise(F.lit(1)).cast("long")


def state_of(df: DataFrame, by: Sequence[str], measures: Sequence[Measure], weights: Column | None = None) -> DataFrame:
    """The state of every group: rows, and for each measure what it is made from.

    With ``weights`` it is what the rows of a feed add to the state; then the extremes are
    those of rows that came, and ``_gone`` ones those of rows that went.
    """
    check(measures)
    one = F.lit(1).cast("long") if weights is None else weights
    rows = df.withColumn("_w", one)
    came, went = F.col("_w") > 0, F.col("_w") < 0
    parts = [F.sum("_w").alias(ROWS)]
    for i, m in enumerate(measures):
        if m.kind == "count" and m.of is not None or m.kind in ("sum", "avg"):
            parts.append(F.sum(F.when(F.expr(m.of).isNotNull(), F.col("_w")).otherwise(0)).alias(f"_n{i}"))
        if m.kind in ("sum", "avg"):
            parts.append(F.coalesce(F.sum(_exact(m) * F.col("_w")), F.lit(0)).cast(f"decimal(38,{m.scale})").alias(f"_s{i}"))
        if m.kind in ("min", "max"):
            best = F.min if m.kind == "min" else F.max
            parts.append(best(F.when(came, F.expr(m.of))).alias(f"_x{i}"))
            parts.append(best(F.when(went, F.expr(m.of))).alias(f"_gone{i}"))
    return rows.groupBy(*by).agg(*parts)


def merged(state: DataFrame, delta: DataFrame, by: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """The state after ``delta``, with ``_again``: whether the group has to be read again.

    Groups without a row are gone.
    """
    parts, again = [F.sum(ROWS).alias(ROWS)], F.lit(False)
    for i, m in enumerate(measures):
        for c in (f"_n{i}", f"_s{i}"):
            if c in state.columns:
                parts.append(F.sum(c).cast(state.schema[c].dataType).alias(c))
        if m.kind in ("min", "max"):
            best = F.min if m.kind == "min" else F.max
            parts += [best(c).alias(c) for c in (f"_x{i}", f"_gone{i}")]
            beyond = F.col(f"_gone{i}") <= F.col(f"_x{i}") if m.kind == "min" else F.col(f"_gone{i}") >= F.col(f"_x{i}")
            again = again | F.coalesce(beyond, F.col(f"_gone{i}").isNotNull())
    rows = state.unionByName(delta).groupBy(*by).agg(*parts).filter(F.col(ROWS) > 0)
    judged = rows.withColumn("_again", again)
    gone = {f"_gone{i}": F.lit(None).cast(state.schema[f"_gone{i}"].dataType)
            for i, m in enumerate(measures) if m.kind in ("min", "max")}
    return judged.withColumns(gone) if gone else judged


def read_again(rows: DataFrame, source: DataFrame, by: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """``rows`` (from ``merged``) with the extremes of marked groups taken from ``source``."""
    extremes = [i for i, m in enumerate(measures) if m.kind in ("min", "max")]
    marked = rows.filter("_again").select(*[F.col(c).alias(f"_by_{c}") for c in by])
    same = _on([(F.col(c), F.col(f"_by_{c}")) for c in by])
    fresh = state_of(source.join(marked, same, "left_semi"), by, measures)
    fresh = fresh.select(*[F.col(c).alias(f"_by_{c}") for c in by], *[F.col(f"_x{i}").alias(f"_new{i}") for i in extremes])
    found = rows.join(fresh, same & F.col("_again"), "left")
    picked = {f"_x{i}": F.when(F.col("_again"), F.col(f"_new{i}")).otherwise(F.col(f"_x{i}")) for i in extremes}
    return found.withColumns(picked).select(*rows.columns)


def _on(pairs: Sequence[tuple[Column, Column]]) -> Column:
    condition = F.lit(True)
    for left, right in pairs:
        condition = condition & left.eqNullSafe(right)
    return condition


def value_sql(measures: Sequence[Measure]) -> list[str]:
    """The measures themselves as SQL over the state."""
    shown = []
    for i, m in enumerate(measures):
        total = f"CASE WHEN _n{i} > 0 THEN CAST(_s{i} AS DOUBLE) END"
        value = {
            "count": ROWS if m.of is None else f"_n{i}", "sum": total, "avg": f"{total} / _n{i}",
            "min": f"_x{i}", "max": f"_x{i}",
        }[m.kind]
        shown.append(f"{value} AS `{m.name}`")
    return shown


def values(state: DataFrame, by: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    return state.selectExpr(*[f"`{c}`" for c in by], *value_sql(measures))
