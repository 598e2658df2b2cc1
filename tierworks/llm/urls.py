"""URL filters: pattern rules found by their rarest literal token.

A rule is a regular expression over ``host/path``, put together from literals and gaps; the
tokens any match must contain are taken from its literals. Tokens are counted over all urls, every rule is filed under its rarest token,
and a url fetches only the rules filed under one of its own tokens; only those run their
regular expression. Everything is DataFrame functions.

Equal urls are judged once, rows are counted first and given back at the end, so a hot
url or host is combined before any shuffle.

Base rules have priority 1; the patterns (priority 0) decide only where none of them fits.

Defined cases: a null url, or one without ``://``, has an empty host and path and fits no
rule. Of fitting rules the one with the highest priority wins, then the longest name,
then the smallest name. ``rule`` names a base rule, ``pattern_rule`` any other; where no
rule fits, both are null and the verdict is ``allow``. Equal rows each
give a row; an empty table gives none.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierworks.llm.common import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[^a-z0-9]+"


class Rule(NamedTuple):
    """``tokens``: runs of a-z and 0-9 bounded by other characters in every match."""

    name: str
    verdict: str
    pattern: str
    tokens: list[str]
    priority: int


class Gap(NamedTuple):
    """A part of a pattern that is no literal.

    ``bounds``: in every match it ends beside its literals with a character that is
    neither letter nor digit, or with the edge of the url.
    """

    pattern: str
    bounds: bool


HOST_START = Gap(r"(?s)^([^/]*\.)?", True)
SITE_START = Gap(r"^([^/]*[.-])?", True)
SITE_END = Gap(r"([.-]|/|\z)", True)
PAGE_END = Gap(r"(/|[.]|\z)", True)
SEGMENT = Gap(r"[^/]*", False)
END = Gap(r"\z", True)


def _quoted(literal: str) -> str:
    return "".join(c if c.isalnum() or not c.isascii() else "\\" + c for c in literal)


def _literal_tokens(literal: str, bound_left: bool, bound_right: bool) -> list[str]:
    """Runs at an open edge are left out: they may go on in the url."""
    runs = "".join(c.lower() if c.isascii() and c.isalnum() else " " for c in literal).split(" ")
    inner = runs[0 if bound_left else 1 :]
    return [r for r in (inner if bound_right else inner[:-1]) if r]


def pattern_rule(name: str, verdict: str, *parts: str | Gap, priority: int = 0) -> Rule:
    """A rule of literals and gaps, taking turns; its tokens come from the literals.

    Without a gap at an edge the pattern may begin or end anywhere in the url.
    """
    bounds = [False, *(isinstance(p, Gap) and p.bounds for p in parts), False]
    tokens: list[str] = []
    for i, part in enumerate(parts, 1):
        if isinstance(part, str):
            tokens += _literal_tokens(part, bounds[i - 1], bounds[i + 1])
    pattern = "".join(p.pattern if isinstance(p, Gap) else _quoted(p) for p in parts)
    return Rule(name, verdict, pattern, list(dict.fromkeys(tokens)), priority)


def host_path_rule(name: str, verdict: str, priority: int = 1) -> Rule:
    """``host/path``: fits the host and its subdomains, and paths that start so."""
    return pattern_rule(name, verdict, HOST_START, name, priority=priority)


#: Host and path rules with their verdicts, as (rule, verdict); fixed values.
BASE_RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]

#: Sites whose host has one of these words as a part, tried where no base rule fits.
BLOCKED_WORDS = ["casino", "poker", "spam", "porn", "xxx", "warez"]
#: The same for several words in a row; each is filed under its rarest.
BLOCKED_PHRASES = ["adult-dating", "cheap-pills", "free-bets", "payday-loans"]
#: Pages and files that hold no text to learn from.
BLOCKED_PAGES = ["login", "signin", "logout", "cart"]
BLOCKED_FILES = ["exe", "msi", "apk", "zip"]
#: Folders of site machinery, and listings such as ``/tag/<any>/page/``.
BLOCKED_FOLDERS = ["cgi-bin", "wp-admin", "wp-json"]
BLOCKED_LISTINGS = ["author", "tag"]


def production_rules() -> list[Rule]:
    """The base rules and, at priority 0, one pattern rule for each blocked entry."""
    rules = [host_path_rule(n, v) for n, v in BASE_RULES]
    sites = [*BLOCKED_WORDS, *BLOCKED_PHRASES]
    rules += [pattern_rule(f"site:{w}", "block", SITE_START, w, SITE_END) for w in sites]
    rules += [pattern_rule(f"page:{w}", "block", f"/{w}", PAGE_END) for w in BLOCKED_PAGES]
    rules += [pattern_rule(f"file:{w}", "block", f".{w}", END) for w in BLOCKED_FILES]
    rules += [pattern_rule(f"folder:{w}", "block", f"/{w}/") for w in BLOCKED_FOLDERS]
    rules += [
        pattern_rule(f"listing:{w}", "block", f"/{w}/", SEGMENT, "/page/") for w in BLOCKED_LISTINGS
    ]
    return rules


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    for rule in rules:
        if not rule.tokens:
            raise ValueError(f"rule {rule.name} has no literal token")
    return spark.createDataFrame(
        [tuple(r) for r in rules],
        "name string, verdict string, pattern string, tokens array<string>, priority int",
    )


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    pattern = r"(?s)^.*?://[^/?#]*([^?#]*)"
    return F.regexp_extract(F.coalesce(url, F.lit("")), pattern, 1)


def judged(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict.

    ``rules`` has the columns of ``rule_table``; Spark broadcasts it if it measures it
    to be small and joins by shuffle otherwise.
    """
    counted = pages.groupBy(F.col(key).alias("page_id"), F.col(url).alias("url")).agg(
        F.count(F.lit(1)).alias("copies")
    )
    parts = counted.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    parts = parts.withColumn("target", F.concat("host", "path"))
    # A-Z only, as in the rules: other letters are separators, whatever their lower case.
    words = F.array_distinct(F.split(F.translate("target", UPPER, LOWER), SEPARATORS))
    tokens = staged(parts.withColumn("tokens", words), "url-tokens")

    # Combined where it is read, so that a token in every url is no hot key of the join.
    seen = (
        tokens.select("copies", F.explode("tokens").alias("token"))
        .groupBy("token").agg(F.sum("copies").alias("seen"))
    )
    rarest = (
        rules.select("name", F.explode("tokens").alias("token"))
        .join(seen, "token", "left")
        .groupBy("name")
        .agg(F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "token")).alias("of"))
        .select("name", F.col("of.token").alias("token"))
    )
    index = staged(
        rules.join(rarest, "name").select("token", "name", "verdict", "pattern", "priority"),
        "rule-index",
    )
    candidates = tokens.select(
        "page_id", "url", "copies", "host", "path", "target", F.explode("tokens").alias("token")
    ).join(index, "token", "left")
    fits = F.col("pattern").isNotNull() & F.expr("regexp_like(target, pattern)")
    # The smallest struct wins, so priority and length are negated.
    fitting = F.when(
        fits,
        F.struct(
            (-F.col("priority")).alias("priority"),
            (-F.length("name")).alias("length"),
            F.col("name"),
            F.col("verdict"),
        ),
    )
    best = candidates.groupBy("page_id", "url", "host", "path", "copies").agg(
        F.min(fitting).alias("best")
    )
    is_base = F.col("best.priority") < 0
    return best.select(
        "page_id", "host", "path",
        F.when(is_base, F.col("best.name")).alias("rule"),
        F.coalesce("best.verdict", F.lit("allow")).alias("verdict"),
        F.when(~is_base, F.col("best.name")).alias("pattern_rule"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
    ).drop("copy")
