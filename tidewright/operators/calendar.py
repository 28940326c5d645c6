"""Calendar dimension (G9, S11): generated from a date sequence, no cross join and no global window."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.scalars import date_key, quarter_name
from tidewright.operators.upsert import replace_range

# The default range of the calendar.
DEFAULT_START = dt.date(2000, 1, 1)
DEFAULT_END = dt.date(2100, 12, 31)


def calendar(spark: SparkSession, start: dt.date = DEFAULT_START, end: dt.date = DEFAULT_END) -> DataFrame:
    """One row per day in [start, end]; any length of range, empty if end lies before start.

    Years are exploded first and each year explodes its own days, so the rows are made in parallel.
    """
    if end < start:
        years = spark.range(0)
    else:
        years = spark.range(start.year, end.year + 1)
    first = F.greatest(F.make_date("id", F.lit(1), F.lit(1)), F.lit(start))
    last = F.least(F.make_date("id", F.lit(12), F.lit(31)), F.lit(end))
    days = years.select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date"))

    d = F.col("date")
    iso_week, iso_year = F.weekofyear(d), F.expr("extract(YEAROFWEEK FROM date)")
    roman = quarter_name(d)
    quarter_start = F.trunc(d, "quarter")
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.dayofmonth(d).alias("day"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_of_week_name"),
        F.date_format(d, "EEE").alias("day_of_week_short_name"),
        F.left(F.date_format(d, "EEEE"), F.lit(1)).alias("day_of_week_first_letter"),
        F.dayofyear(d).alias("day_of_year"),
        iso_week.alias("iso_week"),
        iso_year.cast("int").alias("iso_year"),
        F.concat_ws("-", iso_year.cast("string"), iso_week.cast("string")).alias("iso_year_week"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short_name"),
        F.quarter(d).alias("quarter"),
        roman.alias("quarter_name"),
        F.year(d).alias("year"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.concat_ws("-", F.year(d).cast("string"), roman).alias("year_quarter"),
        F.trunc(d, "month").alias("first_date_of_month"),
        F.last_day(d).alias("last_date_of_month"),
        quarter_start.alias("first_date_of_quarter"),
        F.date_sub(F.add_months(quarter_start, 3), 1).alias("last_date_of_quarter"),
        F.trunc(d, "year").alias("first_date_of_year"),
        F.make_date(F.year(d), F.lit(12), F.lit(31)).alias("last_date_of_year"),
        F.dayofmonth(F.last_day(d)).alias("nb_days_of_month"),
        (F.dayofmonth(F.last_day(F.make_date(F.year(d), F.lit(2), F.lit(1)))) == 29).alias("is_leap_year"),
    )


def refreshed_calendar(current: DataFrame, start: dt.date = DEFAULT_START, end: dt.date = DEFAULT_END) -> DataFrame:
    """The stored calendar with [start, end] generated anew (M6)."""
    fresh = calendar(current.sparkSession, start, end)
    return replace_range(current, fresh, "date", start, end)
