"""Generated dimensions: the calendar and the quarter hours of a day. Their size is fixed by construction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from layerloom.functions import calendar as cal

# The calendar's range.
FIRST_DAY, LAST_DAY = "2018-01-01", "2030-12-31"
SLOTS_PER_DAY = 96


def date_spine(spark: SparkSession, first: str = FIRST_DAY, last: str = LAST_DAY) -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return spark.range(1).select(F.explode(days).alias("full_date"))


def dim_date(spark: SparkSession, as_of: str, first: str = FIRST_DAY, last: str = LAST_DAY) -> DataFrame:
    """Calendar with key, parts, names and the columns relative to ``as_of``; rebuilt daily.

    ``iso_year`` goes with ``week``: the two name a week without a break at the turn of the year.
    """
    date = F.col("full_date")
    weekday = cal.iso_weekday(date)
    return date_spine(spark, first, last).select(
        cal.date_id(date).alias("date_id"),
        date,
        F.year(date).alias("year"),
        F.quarter(date).alias("quarter"),
        F.month(date).alias("month"),
        F.date_format(date, "MMMM").alias("month_name"),
        F.weekofyear(date).alias("week"),
        cal.iso_year(date).alias("iso_year"),
        F.dayofmonth(date).alias("day"),
        weekday.alias("weekday_num"),
        F.date_format(date, "EEEE").alias("weekday_name"),
        (weekday >= 6).alias("is_weekend"),
        *[column.alias(name) for name, column in cal.relative_flags(date, as_of).items()],
    )


def dim_time(spark: SparkSession) -> DataFrame:
    """The 96 quarter hours of a day with label, part of the day and peak flag."""
    slots = spark.range(SLOTS_PER_DAY).select(F.col("id").cast("int").alias("time_id"))
    hour = F.expr("int(time_id div 4)")
    minute = F.col("time_id") % 4 * 15
    return slots.select(
        "time_id",
        hour.alias("hour"),
        minute.alias("minute_of_hour"),
        F.format_string("%02d:%02d", hour, minute).alias("label"),
        cal.part_of_day(hour).alias("period"),
        cal.is_peak(hour).alias("is_peak"),
    ).orderBy("time_id")
