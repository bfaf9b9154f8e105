"""Date and time parts, period labels and the calendar columns that depend on an as-of date."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"

# Names of the parts of a day and the hours they start at, and the peak hours.
NIGHT, MORNING, DAY, EVENING = "Nacht", "Morgen", "Tag", "Abend"
PEAK_HOURS = ((7, 9), (17, 21))


def epoch_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds as UTC wall time without zone, whatever the session zone is."""
    return F.timestamp_add("SECOND", seconds.cast("bigint"), F.expr(EPOCH))


def date_id(date: Column) -> Column:
    """yyyymmdd as an integer."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def iso_year(date: Column) -> Column:
    """The year an ISO week belongs to (2018-12-31 is in week 1 of 2019)."""
    return F.extract(F.lit("YEAROFWEEK"), date)


def iso_weekday(date: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(date) + 1


def quarter_hour_slot(timestamp: Column) -> Column:
    """Quarter hour of the day, 0-95."""
    return F.hour(timestamp) * 4 + F.floor(F.minute(timestamp) / 15).cast("int")


def week_label(year: Column, week: Column) -> Column:
    """2024-W05"""
    return F.concat(year.cast("string"), F.lit("-W"), F.lpad(week.cast("string"), 2, "0"))


def month_label(year: Column, month: Column) -> Column:
    """2024-01"""
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


def month_title(month_name: Column, year: Column) -> Column:
    """January 2024"""
    return F.concat(month_name, F.lit(" "), year.cast("string"))


def part_of_day(hour: Column) -> Column:
    return (
        F.when(hour.between(6, 9), MORNING)
        .when(hour.between(10, 16), DAY)
        .when(hour.between(17, 21), EVENING)
        .otherwise(NIGHT)
    )


def is_peak(hour: Column) -> Column:
    (first_from, first_to), (second_from, second_to) = PEAK_HOURS
    return hour.between(first_from, first_to) | hour.between(second_from, second_to)


def relative_flags(date: Column, as_of: str) -> dict[str, Column]:
    """is_today ... is_last_year and days_ago against a given day.

    "Current" periods end with the as-of day's own period: later dates are not flagged.
    """
    today = F.lit(as_of).cast("date")

    def period(unit: str, start_of_previous: Column, start_of_next: Column) -> tuple[Column, Column]:
        start = F.trunc(today, unit)
        current = (date >= start) & (date < start_of_next)
        last = (date >= start_of_previous) & (date < start)
        return current, last

    week = F.trunc(today, "week")
    month = F.trunc(today, "month")
    year = F.trunc(today, "year")
    current_week, last_week = period("week", F.date_sub(week, 7), F.date_add(week, 7))
    current_month, last_month = period("month", F.add_months(month, -1), F.add_months(month, 1))
    current_year, last_year = period("year", F.add_months(year, -12), F.add_months(year, 12))
    return {
        "is_today": date == today,
        "is_yesterday": date == F.date_sub(today, 1),
        "is_current_week": current_week,
        "is_last_week": last_week,
        "is_current_month": current_month,
        "is_last_month": last_month,
        "is_current_year": current_year,
        "is_last_year": last_year,
        "days_ago": F.datediff(today, date),
    }
