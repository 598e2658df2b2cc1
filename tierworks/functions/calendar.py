"""Calendar attributes of a date."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the month the fiscal year starts in.
FISCAL_START = 4


def yes_no(condition: Column) -> Column:
    return F.when(condition, F.lit("Y")).otherwise(F.lit("N"))


def attributes(day: Column) -> list[Column]:
    """Eighteen named calendar columns for ``day``."""
    month, year, quarter = F.month(day), F.year(day), F.quarter(day)
    before_fiscal_start = (month < FISCAL_START).cast("int")
    fiscal_month = F.pmod(month - F.lit(FISCAL_START), F.lit(12))
    weekday = F.dayofweek(day)
    return [
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        year.alias("calendar_year"),
        quarter.alias("calendar_quarter"),
        F.format_string("Q%d %d", quarter, year).alias("calendar_quarter_name"),
        month.alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM").alias("month_short"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofmonth(day).alias("day_of_month"),
        weekday.alias("day_of_week_number"),
        F.date_format(day, "EEEE").alias("day_of_week_name"),
        F.date_format(day, "EEE").alias("day_of_week_short"),
        (year - before_fiscal_start).alias("fiscal_year"),
        (F.floor(fiscal_month / F.lit(3)) + F.lit(1)).cast("int").alias("fiscal_quarter"),
        yes_no(weekday.isin(1, 7)).alias("is_weekend"),
        yes_no(day == F.last_day(day)).alias("is_month_end"),
        yes_no(F.date_format(day, "MMdd") == "1231").alias("is_year_end"),
    ]
