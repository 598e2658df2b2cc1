"""Finding personal data by column name and by value, and hiding it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tierworks.functions.masking import ACCESS_LEVELS, TEXT_PATTERNS, count_matches, has_match

# Name patterns, class and risk of personal columns.
NAME_CLASSES: list[tuple[str, tuple[str, ...], str]] = [
    ("EMAIL", ("email", "email_address"), "HIGH"),
    ("PHONE", ("phone", "mobile", "telephone"), "HIGH"),
    ("NAME", ("first_name", "last_name", "full_name"), "MEDIUM"),
    ("DOB", ("date_of_birth", "dob"), "MEDIUM"),
    ("ADDRESS", ("address", "street", "postal_code"), "MEDIUM"),
    ("SSN", ("ssn", "national_id", "tax_id"), "CRITICAL"),
    ("ACCOUNT", ("account_number", "iban", "sort_code"), "HIGH"),
    ("FINANCIAL", ("credit_score", "income", "salary"), "HIGH"),
    ("PAYMENT", ("card_number", "cvv"), "CRITICAL"),
]
FREE_TEXT = ("source_text", "FREEFORM", "HIGH")  # fixed value
# Columns whose name ends like this hold a masked or banded value.
DERIVED_ENDINGS = ("_hash", "_masked", "_tier")
# Personal classes a value pattern can prove, with the risk of each.
VALUE_CLASSES = {"EMAIL": ("EMAIL", "HIGH"), "PHONE": ("PHONE", "HIGH"),
                 "SSN": ("SSN", "CRITICAL"), "CARD": ("PAYMENT", "CRITICAL")}


def classify_name(column: str) -> tuple[str, str] | None:
    """(class, risk) if the column's name contains a pattern as whole ``_`` parts."""
    if column.endswith(DERIVED_ENDINGS):
        return None
    if column == FREE_TEXT[0]:
        return FREE_TEXT[1:]
    padded = f"_{column.lower()}_"
    for name, patterns, risk in NAME_CLASSES:
        if any(f"_{p}_" in padded for p in patterns):
            return name, risk
    return None


def personal_columns(names: Sequence[str]) -> dict[str, tuple[str, str]]:
    """Personal columns by name alone, in table order."""
    found = {c: classify_name(c) for c in names}
    return {c: hit for c, hit in found.items() if hit}


def columns_report(df: DataFrame, threshold: float = 0.01) -> DataFrame:
    """Personal columns of ``df`` with the evidence for each, from one pass over the rows.

    Evidence is ``name`` (the column is called so), ``value`` (at least ``threshold``
    of its filled values look so) or ``both``.
    """
    fields = df.schema.fields
    texts = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    named = personal_columns(df.columns)
    counters = [F.count(F.col(c)).alias(f"{c}__filled") for c in df.columns]
    lines: list[str] = []
    for column in df.columns:
        kinds: dict[str, tuple[str, str]] = {}
        for pattern, (kind, risk) in VALUE_CLASSES.items() if column in texts else ():
            counter = f"{column}__{kind}"
            counters.append(F.count_if(has_match(F.col(column), pattern)).alias(counter))
            rate = f"round(CAST(`{counter}` AS DOUBLE) / nullif(`{column}__filled`, 0), 4)"
            kinds[kind] = (risk, rate)
        if column in named:
            kinds.setdefault(named[column][0], (named[column][1], "CAST(NULL AS DOUBLE)"))
        for kind, (risk, rate) in kinds.items():
            by_name = column in named and named[column][0] == kind
            lines.append(
                f"struct('{column}' AS column_name, '{kind}' AS pii_type, '{risk}' AS risk, "
                f"{rate} AS hit_rate, {str(by_name).lower()} AS by_name)"
            )
    if not lines:
        empty = "column_name string, pii_type string, risk string, hit_rate double, evidence string"
        return df.sparkSession.createDataFrame([], empty)
    found = df.agg(*counters).selectExpr(f"inline(array({', '.join(lines)}))")
    by_value = F.coalesce(F.col("hit_rate") >= F.lit(threshold), F.lit(False))
    evidence = (
        F.when(F.col("by_name") & by_value, F.lit("both"))
        .when(F.col("by_name"), F.lit("name"))
        .when(by_value, F.lit("value"))
    )
    judged = found.withColumn("evidence", evidence).drop("by_name")
    return judged.filter(F.col("evidence").isNotNull())


def scan_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows touched and matches found per text column and class, in one pass."""
    pairs = [(c, name) for c in columns for name in TEXT_PATTERNS]
    # Counted in a step of its own, so that each pattern runs once per text.
    counted = df.select(*[count_matches(F.col(c), n).alias(f"{c}__{n}") for c, n in pairs])
    totals: list[Column] = []
    for c, n in pairs:
        found = F.col(f"{c}__{n}")
        totals += [
            F.coalesce(F.sum(found), F.lit(0)).cast("long").alias(f"{c}__{n}__sum"),
            F.count_if(found > 0).alias(f"{c}__{n}__rows"),
        ]
    lines = ", ".join(
        f"struct('{c}' AS column_name, '{n}' AS pii_class, `{c}__{n}__rows` AS row_count, "
        f"`{c}__{n}__sum` AS match_count)"
        for c, n in pairs
    )
    return counted.agg(*totals).selectExpr(f"inline(array({lines}))")


def masked(df: DataFrame, policy: Mapping[str, Mapping[str, Column]], access: str) -> DataFrame:
    """``df`` as readers with ``access`` see it.

    ``policy`` maps a column to its expression per access level; a level that is
    not listed sees the value of level ``none``.
    """
    unknown = [c for c in policy if c not in df.columns]
    if unknown:
        raise ValueError(f"policy names columns that do not exist: {unknown}")
    shown = [
        (policy[c].get(access, policy[c]["none"]).alias(c) if c in policy else F.col(c))
        for c in df.columns
    ]
    return df.select(*shown)


def granted_view(
    spark: SparkSession, view: str, table: str, policy: Mapping[str, Mapping[str, str]], grants: str
) -> None:
    """Create ``view``: ``table`` as the person who queries it may see it.

    ``policy`` maps a column to SQL for each access level, ``grants`` names a table
    (user_name, table_name, level). The level is looked up when the view is read, for
    ``current_user()``: a changed grant changes what the same view shows. The highest of
    several grants counts, unknown levels and users without a grant see level ``none``, which
    every column needs.
    """
    columns = spark.table(table).columns
    unknown = [c for c in policy if c not in columns]
    if unknown:
        raise ValueError(f"policy names columns that do not exist: {unknown}")
    open_ended = [c for c, shown in policy.items() if "none" not in shown]
    if open_ended:
        raise ValueError(f"policy has no level none for {open_ended}")
    ranks = " ".join(f"WHEN '{level}' THEN {len(ACCESS_LEVELS) - i}" for i, level in enumerate(ACCESS_LEVELS))
    rank = f"CASE level {ranks} ELSE 0 END"
    # A scalar subquery is evaluated once a query, whatever the number of masked columns.
    level = (
        f"coalesce((SELECT max_by(level, {rank}) FROM {grants} WHERE user_name = current_user() "
        f"AND table_name = '{table}' AND {rank} > 0), 'none')"
    )
    shown = []
    for c in columns:
        levels = policy.get(c)
        if levels is None:
            shown.append(f"`{c}`")
            continue
        cases = " ".join(f"WHEN '{a}' THEN {levels[a]}" for a in ACCESS_LEVELS if a in levels and a != "none")
        shown.append(f"CASE {level} {cases} ELSE {levels['none']} END AS `{c}`" if cases else f"{levels['none']} AS `{c}`")
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {', '.join(shown)} FROM {table}")


def annotation(column: str) -> str | None:
    """The note a personal column's description carries."""
    hit = classify_name(column)
    return f"[PII: {hit[0]} - {hit[1]}]" if hit else None


def derived_columns(names: Sequence[str]) -> list[str]:
    """Columns that hold one person's value in a masked form; bands (``_tier``) group many."""
    endings = ("_hash", "_masked")
    stems = {c: c[: -len(e)] for c in names for e in endings if c.endswith(e)}
    return [c for c, stem in stems.items() if classify_name(stem)]


def gold_findings(columns: Sequence[str]) -> dict[str, str]:
    """Columns a gold table must not have: personal ones, source text, masked values."""
    found = {c: kind for c, (kind, _) in personal_columns(columns).items()}
    return found | {c: "DERIVED" for c in derived_columns(columns)}


def value_counters(df: DataFrame) -> dict[str, Column]:
    """A counter of personal-looking values per text column and class, for ``observe``."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return {
        f"{c}__{kind}": F.count_if(has_match(F.col(c), pattern)).alias(f"{c}__{kind}")
        for c in texts for pattern, (kind, _) in VALUE_CLASSES.items()
    }


def gold_report(df: DataFrame, threshold: float = 0.01) -> DataFrame:
    """What the guard holds against a gold table: column, class and whether name or value."""
    named = gold_findings(df.columns)
    by_name = df.sparkSession.createDataFrame(
        [(c, k, "name") for c, k in named.items()],
        "column_name string, pii_type string, evidence string",
    )
    # A column held by its name is listed once, whatever its values look like.
    shown = (F.col("hit_rate") >= threshold) & ~F.col("column_name").isin(list(named))
    by_value = columns_report(df, threshold).filter(shown).select(
        "column_name", "pii_type", F.lit("value").alias("evidence")
    )
    return by_name.unionByName(by_value)


def check_gold(columns: Sequence[str]) -> None:
    """Gold tables hold neither personal columns, masked values nor source text."""
    found = gold_findings(columns)
    if found:
        raise ValueError(f"gold table must not contain personal columns: {sorted(found)}")


def suppress_small_groups(df: DataFrame, count_column: str, minimum: int) -> DataFrame:
    """Optional guard for published aggregates: hide groups below ``minimum``."""
    return df.filter(F.col(count_column) >= F.lit(minimum))


def leaks(masked_df: DataFrame, raw: str, shown: Sequence[str]) -> DataFrame:
    """Rows in which a shown column still contains the raw value."""
    tests = [F.contains(F.col(c), F.col(raw)) for c in shown]
    return masked_df.filter(reduce(lambda a, b: a | b, tests))
