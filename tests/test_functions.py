import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tierworks.functions import calendar, masking, naming, text, tiers


def one(spark, value, dtype, expression):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expression).first()[0]


@pytest.mark.parametrize(
    "income, tier",
    [(49999.99, "Lower Middle"), (50000.0, "Middle"), (99999.0, "Middle"), (100000.0, "Upper Middle"),
     (249999.0, "Upper Middle"), (250000.0, "High Income"), (None, "Lower Middle"), (-5.0, "Lower Middle")],
)
def test_income_tier(spark, income, tier):
    assert one(spark, income, "double", tiers.income_tier(F.col("v"))) == tier


@pytest.mark.parametrize(
    "score, tier",
    [(649, "Poor"), (650, "Fair"), (699, "Fair"), (700, "Good"), (749, "Good"), (750, "Excellent"),
     (None, "Poor")],
)
def test_credit_tier(spark, score, tier):
    assert one(spark, score, "int", tiers.credit_tier(F.col("v"))) == tier


def test_tier_orders_bounds_itself(spark):
    banded = tiers.tier(F.col("v"), [(1, "low"), (10, "high")], "none")
    assert one(spark, 11, "int", banded) == "high"
    with pytest.raises(ValueError):
        tiers.tier(F.col("v"), [], "none")


def test_hash_ignores_case_and_outer_blanks(spark):
    same = [one(spark, v, "string", masking.hash_normalised(F.col("v"))) for v in (" A@B.c ", "a@b.C")]
    assert same[0] == same[1] and len(same[0]) == 64
    assert one(spark, None, "string", masking.hash_normalised(F.col("v"))) is None


@pytest.mark.parametrize(
    "phone, shown",
    [("+1 555-123-4567", "***-***-4567"), ("12", "***-***-12"), ("", "***-***-"), (None, None)],
)
def test_mask_phone(spark, phone, shown):
    assert one(spark, phone, "string", masking.mask_phone(F.col("v"))) == shown


@pytest.mark.parametrize(
    "access, shown",
    [("full", "jo@mail.org"), ("partial", "jo@***@mail.org"), ("none", "***@***")],
)
def test_mask_email_two_letter_name(spark, access, shown):
    assert one(spark, "jo@mail.org", "string", masking.mask_email(F.col("v"), access)) == shown


def test_mask_email_needs_a_known_access():
    with pytest.raises(ValueError):
        masking.mask_email(F.col("v"), "admin")


def test_age_counts_365_day_years(spark):
    as_of = F.lit("2024-01-01").cast("date")
    for birth, age in [("2023-01-01", 1), ("2023-01-02", 0), (None, None)]:
        assert one(spark, birth, "string", masking.age_in_years(F.col("v"), as_of)) == age


def test_redact_every_class(spark):
    source = "a.b@c.org 4111111111111111 10.0.0.1 123-45-6789 +1 (743) 555-3824 order #1234 end"
    shown = one(spark, source, "string", masking.redact(F.col("v")))
    assert shown == "[EMAIL] [CARD] [IP] [SSN] [PHONE] [ORDER_ID] end"
    assert one(spark, None, "string", masking.redact(F.col("v"))) is None


def test_counts_see_every_occurrence(spark):
    count = masking.count_matches(F.col("v"), "EMAIL")
    assert one(spark, "a@b.c, d@e.f and g@h.i.", "string", count) == 3
    assert one(spark, "none here", "string", count) == 0


@pytest.mark.parametrize("value, usable", [("    ", False), ("abcd", False), ("abcde", True), (" abcd ", False)])
def test_long_enough(spark, value, usable):
    assert one(spark, value, "string", text.long_enough(F.col("v"))) is usable


def test_words_and_sentences(spark):
    assert one(spark, "Élan, 2 vital!", "string", text.words(F.col("v"))) == ["élan", "vital"]
    assert one(spark, "One. Two?\n\n Three ", "string", text.sentences(F.col("v"))) == ["One", "Two", "Three"]


def test_inline_lists_are_bounded():
    with pytest.raises(ValueError):
        text.check_inline([f"w{i}" for i in range(text.MAX_INLINE_TERMS + 1)])


@pytest.mark.parametrize(
    "name, snake",
    [("CustomerID", "customer_id"), ("customer-id", "customer_id"), ("Customer Id", "customer_id"),
     ("HTTPStatus", "http_status"), ("plain", "plain"), ("1st", "c_1st")],
)
def test_snake_case(name, snake):
    assert naming.snake_case(name) == snake
    assert naming.is_snake_case(snake)


@pytest.mark.parametrize("name", ["Customers", "customers", "silver_Customers", "bronze_x", "silver-x"])
def test_table_names_need_their_layer(name):
    with pytest.raises(ValueError):
        naming.check_table_name(name, "silver")


def test_calendar_edges(spark):
    days = [(datetime.date(2024, 2, 29),), (datetime.date(2023, 12, 31),), (datetime.date(2024, 3, 31),),
            (datetime.date(2024, 4, 1),)]
    df = spark.createDataFrame(days, "d date").select("d", *calendar.attributes(F.col("d")))
    got = {r["d"].isoformat(): r for r in df.collect()}
    assert len(df.columns) == 19
    assert got["2024-02-29"]["is_month_end"] == "Y"
    assert got["2023-12-31"]["is_year_end"] == "Y" and got["2023-12-31"]["day_of_week_number"] == 1
    assert (got["2024-03-31"]["fiscal_year"], got["2024-03-31"]["fiscal_quarter"]) == (2023, 4)
    assert (got["2024-04-01"]["fiscal_year"], got["2024-04-01"]["fiscal_quarter"]) == (2024, 1)
    assert got["2024-04-01"]["calendar_quarter_name"] == "Q2 2024"


def test_sql_function(spark):
    masking.register_mask_email(spark, "none", "hide")
    assert rows(spark.sql("SELECT hide('a@b.c') AS e")) == [("***@***",)]
