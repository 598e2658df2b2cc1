"""Static and access-dependent masks for personal data."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

ACCESS_LEVELS = ("full", "partial", "none")

# What stands in for hidden parts of an e-mail or a phone number.
HIDDEN_EMAIL = "***@***"
HIDDEN_LOCAL_PART = "***@"
PHONE_PREFIX = "***-***-"
DAYS_PER_YEAR = 365

# Personal data inside free text. Order matters for redaction: long digit runs
# (cards, account codes) go before the looser phone shape.
TEXT_PATTERNS: dict[str, str] = {
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "CARD": r"[0-9]{16}",
    "IP": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
    "SSN": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "PHONE": r"\+[0-9]{1,3} ?\(?[0-9]{3}\)?[ -]?[0-9]{3}[ -]?[0-9]{4}",
    "ORDER_ID": r"(?:ORDER|Order|order)[ #:-]+[0-9]{3,}",
}


# A character every match of a class contains: most texts lack it and need no pattern
# search. Only worth it where the search itself is slow.
MARKERS = {"EMAIL": "@"}


def count_matches(text: Column, name: str) -> Column:
    """How often personal data of class ``name`` occurs in ``text``."""
    found = F.regexp_count(text, F.lit(TEXT_PATTERNS[name]))
    if name not in MARKERS:
        return found
    return F.when(F.contains(text, F.lit(MARKERS[name])), found).otherwise(F.lit(0))


def has_match(text: Column, name: str) -> Column:
    """Whether personal data of class ``name`` occurs in ``text``."""
    found = text.rlike(TEXT_PATTERNS[name])
    return F.contains(text, F.lit(MARKERS[name])) & found if name in MARKERS else found


def hash_normalised(value: Column) -> Column:
    """SHA-256 of the trimmed, lower-case value: joins work, the value is hidden."""
    return F.sha2(F.lower(F.trim(value)), 256)


def mask_phone(phone: Column) -> Column:
    """Only the last four digits stay readable."""
    digits = F.regexp_replace(phone, "[^0-9]", "")
    return F.concat(F.lit(PHONE_PREFIX), F.right(digits, F.lit(4)))


def mask_email(email: Column, access: str) -> Column:
    """The e-mail as a reader with ``access`` (full, partial or none) may see it."""
    if access not in ACCESS_LEVELS:
        raise ValueError(f"access must be one of {ACCESS_LEVELS}, not {access!r}")
    if access == "full":
        return email
    if access == "none":
        return F.lit(HIDDEN_EMAIL)
    return F.concat(
        F.substring(email, 1, 3),
        F.lit(HIDDEN_LOCAL_PART),
        F.split_part(email, F.lit("@"), F.lit(2)),
    )


def register_mask_email(spark: SparkSession, access: str, name: str = "mask_email") -> None:
    """Offer the e-mail mask to SQL users of this session under ``name``."""
    if access not in ACCESS_LEVELS:
        raise ValueError(f"access must be one of {ACCESS_LEVELS}, not {access!r}")
    body = {
        "full": "email",
        "partial": f"substr(email, 1, 3) || '{HIDDEN_LOCAL_PART}' || split_part(email, '@', 2)",
        "none": f"'{HIDDEN_EMAIL}'",
    }[access]
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(email STRING) RETURNS STRING RETURN {body}"
    )


def age_in_years(birth_date: Column, as_of: Column) -> Column:
    """Whole 365-day years between ``birth_date`` and ``as_of``."""
    days = F.datediff(as_of, birth_date.cast("date"))
    return F.floor(days / F.lit(DAYS_PER_YEAR)).cast("long")


def redact(text: Column, classes: tuple[str, ...] = tuple(TEXT_PATTERNS)) -> Column:
    """Replace personal data in free text by its class name in brackets."""
    for name, pattern in TEXT_PATTERNS.items():
        if name not in classes:
            continue
        replaced = F.regexp_replace(text, pattern, f"[{name}]")
        if name in MARKERS:  # comes first, so ``text`` is still a plain column
            replaced = F.when(F.contains(text, F.lit(MARKERS[name])), replaced).otherwise(text)
        text = replaced
    return text
