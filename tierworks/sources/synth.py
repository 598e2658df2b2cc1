"""Synthetic tables, computed from a row number alone.

Every value is a function of (seed, column name, row number), so a partition that is
computed again after a lost executor gives the same rows, and no row depends on
another. The random numbers are polynomial hashes over the prime 2^31 - 1 (Carter
and Wegman): integer arithmetic that stays in generated code.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierworks.functions import calendar

PRIME = 2**31 - 1
LETTERS = "abcdefghijklmnopqrstuvwxyz"
BASE_26 = "0123456789ABCDEFGHIJKLMNOP"
DIGITS_PER_DRAW = 8
LETTERS_PER_DRAW = 6
WORD_LETTERS = 6
# Odd and not a multiple of five: multiplying by it permutes the numbers below 10^k.
KEY_STEP = 48271

# A maker turns (seed, column name) into SQL text over the row number ``id``. Text is
# parsed once per column, which plans wide tables much faster than nested objects.
Maker = Callable[[int, str], str]


def coefficients(seed: int, name: str) -> list[int]:
    """Five numbers below the prime, from the seed and the column's name."""
    digest = hashlib.sha256(f"{seed}:{name}".encode()).digest()
    return [int.from_bytes(digest[i * 6 : i * 6 + 6], "big") % PRIME for i in range(5)]


def draw(seed: int, name: str) -> str:
    """A pseudo-random integer in [0, 2^31 - 1) for each row number."""
    a, b, c, d, e = (f"{v}L" for v in coefficients(seed, name))
    p = f"{PRIME}L"
    low, block = f"pmod(id, {p})", f"(id div {p})"
    inner = f"pmod(pmod({a} * {low} + {b}, {p}) * {low} + {c}, {p})"
    return f"pmod({inner} * {low} + pmod({e} * {block}, {p}) + {d}, {p})"


def draw_for(seed: int, name: str, width: int) -> str:
    """A draw that reaches every number below ``width``; two are combined for a wide range."""
    if width <= PRIME:
        return draw(seed, name)
    if width > PRIME**2:
        raise ValueError(f"{width} values cannot all be drawn")
    return f"({draw(seed, name + '#high')} * {PRIME}L + {draw(seed, name)})"


def unit(seed: int, name: str) -> str:
    """A pseudo-random double in [0, 1)."""
    return f"(CAST({draw(seed, name)} AS DOUBLE) / {PRIME}D)"


def literal(value) -> str:
    """``value`` as SQL text."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else str(value)


@dataclass(frozen=True)
class Field:
    """One generated column."""

    make: Maker
    dtype: str = "string"
    null_share: float = 0.0

    def nulls(self, share: float) -> Field:
        if not 0 <= share <= 1:
            raise ValueError("share must be in [0, 1]")
        return Field(self.make, self.dtype, share)

    def sql(self, seed: int, name: str) -> str:
        value = f"CAST({self.make(seed, name)} AS {self.dtype})"
        if self.null_share:
            value = f"IF({unit(seed, name + '#null')} >= {literal(float(self.null_share))}, {value}, NULL)"
        return value


def choice(values: Sequence, weights: Sequence[float] | None = None, dtype: str = "string") -> Field:
    """One of ``values``; a value listed twice is twice as likely, ``weights`` are relative."""
    if weights is not None and len(weights) != len(values):
        raise ValueError("values and weights differ in length")

    def make(seed: int, name: str) -> str:
        if len(values) == 1:
            return literal(values[0])
        number = draw(seed, name)
        if weights is None:
            options = ", ".join(literal(v) for v in values)
            return f"get(array({options}), CAST(pmod({number}, {len(values)}) AS INT))"
        # Thresholds on the integer draw, so no rounding decides a value.
        total, seen, arms = sum(weights), 0.0, []
        for value, weight in list(zip(values, weights))[:-1]:
            seen += weight
            arms.append(f"WHEN {number} < {int(PRIME * seen / total)} THEN {literal(value)}")
        return f"CASE {' '.join(arms)} ELSE {literal(values[-1])} END" if arms else literal(values[-1])

    return Field(make, dtype)


def positional(values: Sequence, dtype: str = "string") -> Field:
    """Values in order, round and round: lists of equal length stay in step."""
    options = ", ".join(literal(v) for v in values)
    return Field(lambda s, c: f"get(array({options}), CAST(pmod(id, {len(values)}) AS INT))", dtype)


def uniform(low: float, high: float, dtype: str, digits: int = 2) -> Field:
    """Whole numbers from ``low`` to ``high``, or decimals rounded to ``digits``."""
    if dtype == "int":
        width = int(high) - int(low) + 1
        return Field(lambda s, c: f"pmod({draw_for(s, c, width)}, {width}L) + {int(low)}", dtype)
    start, span = literal(float(low)), literal(float(high) - float(low))
    return Field(lambda s, c: f"round({unit(s, c)} * {span} + {start}, {digits})", dtype)


def random_date(start: str, days: int) -> Field:
    """A day from ``start`` on, fewer than ``days`` later."""
    return Field(
        lambda s, c: f"date_add(DATE '{start}', CAST(pmod({draw(s, c)}, {days}) AS INT))", "date"
    )


def date_sequence(start: str) -> Field:
    """``start`` plus the row number in days."""
    return Field(lambda s, c: f"date_add(DATE '{start}', CAST(id AS INT))", "date")


def time_of_day() -> Field:
    """``HH:mm:ss`` text."""

    def make(seed: int, name: str) -> str:
        second = f"pmod({draw(seed, name)}, 86400L)"
        parts = [f"{second} div 3600", f"pmod({second} div 60, 60L)", f"pmod({second}, 60L)"]
        return "concat_ws(':', " + ", ".join(f"lpad(CAST({p} AS STRING), 2, '0')" for p in parts) + ")"

    return Field(make)


def expression(sql: str, dtype: str = "string") -> Field:
    """SQL over the row number ``id`` and nothing else."""
    return Field(lambda s, c: sql, dtype)


def _pieces(pattern: str) -> list[tuple[str, str, int]]:
    """(kind, text, length) runs of a template."""
    pieces: list[tuple[str, str, int]] = []
    for token in re.finditer(r"(\\d)+|\\w\+|(\\w)+(?!\+)|(?:(?!\\[dw]).)+", pattern, re.S):
        run = token.group(0)
        if run.startswith("\\d"):
            pieces.append(("digits", run, len(run) // 2))
        elif run == "\\w+":
            pieces.append(("letters", run, WORD_LETTERS))
        elif run.startswith("\\w"):
            pieces.append(("letters", run, len(run) // 2))
        else:
            pieces.append(("literal", run, len(run)))
    return pieces


def template(pattern: str) -> Field:
    r"""Text with ``\d`` for a digit, ``\w`` for a letter, ``\w+`` for a word."""
    pieces = _pieces(pattern)

    def make(seed: int, name: str) -> str:
        parts: list[str] = []
        for i, (kind, text, length) in enumerate(pieces):
            if kind == "literal":
                parts.append(literal(text))
                continue
            base, step = (10, DIGITS_PER_DRAW) if kind == "digits" else (26, LETTERS_PER_DRAW)
            for start in range(0, length, step):
                size = min(step, length - start)
                number = f"CAST(pmod({draw(seed, f'{name}#{i}.{start}')}, {base**size}L) AS STRING)"
                if kind == "digits":
                    parts.append(f"lpad({number}, {size}, '0')")
                else:
                    # The number in base 26, its digits written as letters.
                    digits = f"lpad(conv({number}, 10, 26), {size}, '0')"
                    parts.append(f"translate({digits}, '{BASE_26}', '{LETTERS}')")
        return f"concat({', '.join(parts)})"

    return Field(make)


@dataclass(frozen=True)
class Key:
    """Unique keys: a prefix and ``digits`` digits that permute the row numbers."""

    prefix: str
    digits: int

    def of(self, number: str = "id") -> str:
        mixed = f"pmod({number} * {KEY_STEP}L + 7L, {10**self.digits}L)"
        return f"concat({literal(self.prefix)}, lpad(CAST({mixed} AS STRING), {self.digits}, '0'))"

    def field(self) -> Field:
        return Field(lambda s, c: self.of())

    def check(self, rows: int) -> None:
        if rows > 10**self.digits:
            raise ValueError(f"{rows} rows need more than {self.digits} digits")


def foreign_key(parent: Key, parent_rows: int) -> Field:
    """A key of one of the parent's rows, so every child has a parent."""
    return Field(lambda s, c: parent.of(f"pmod({draw_for(s, c, parent_rows)}, {parent_rows}L)"))


Spec = Mapping[str, Field]


def columns(df: DataFrame, number: str, spec: Spec, seed: int = 0, label: str = "") -> DataFrame:
    """Generate ``spec`` for the row numbers in the column ``number``.

    ``label``, a table's name, keeps equally named columns of two tables apart.
    """
    keyed = df.select(F.col(number).cast("long").alias("id"))
    return keyed.selectExpr(*[f"{f.sql(seed, f'{label}.{c}')} AS {c}" for c, f in spec.items()])


def table(
    spark: SparkSession, spec: Spec, rows: int, partitions: int, seed: int = 0, label: str = ""
) -> DataFrame:
    """``rows`` rows of ``spec`` in ``partitions`` partitions, without a shuffle."""
    return columns(spark.range(0, rows, 1, partitions), "id", spec, seed, label)


def date_dimension(spark: SparkSession, start: str, days: int, partitions: int = 2) -> DataFrame:
    """``days`` calendar days from ``start`` with their attributes."""
    spec = {"full_date": date_sequence(start)}
    day = table(spark, spec, days, partitions)
    return day.select("full_date", *calendar.attributes(F.col("full_date")))
