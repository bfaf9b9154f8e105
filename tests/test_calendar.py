from pyspark.sql import functions as F

from layerloom.operators.calendar import date_spine, dim_date, dim_time


def test_spine_has_every_day(spark):
    days = date_spine(spark)
    assert days.count() == 4748 == days.distinct().count()


def test_relative_columns_have_two_bounds(spark, rows):
    calendar = dim_date(spark, "2024-01-31")

    def days(flag):
        found = calendar.where(flag).agg(F.min("full_date"), F.max("full_date"), F.count("*")).first()
        return str(found[0]), str(found[1]), found[2]

    assert days("is_today") == ("2024-01-31", "2024-01-31", 1)
    assert days("is_yesterday") == ("2024-01-30", "2024-01-30", 1)
    assert days("is_current_week") == ("2024-01-29", "2024-02-04", 7)
    assert days("is_last_week") == ("2024-01-22", "2024-01-28", 7)
    assert days("is_current_month") == ("2024-01-01", "2024-01-31", 31)
    assert days("is_last_month") == ("2023-12-01", "2023-12-31", 31)
    assert days("is_current_year") == ("2024-01-01", "2024-12-31", 366)
    assert days("is_last_year") == ("2023-01-01", "2023-12-31", 365)
    assert days("days_ago between 0 and 90") == ("2023-11-02", "2024-01-31", 91)


def test_quarter_hours(spark, rows):
    slots = dim_time(spark)
    assert slots.count() == 96
    assert rows(slots.where("time_id in (0, 31, 95)"), "time_id", "hour", "minute_of_hour", "label", "period", "is_peak") == [
        (0, 0, 0, "00:00", "Nacht", False),
        (31, 7, 45, "07:45", "Morgen", True),
        (95, 23, 45, "23:45", "Nacht", False),
    ]
    periods = {row["period"]: row["count"] for row in slots.groupBy("period").count().collect()}
    assert periods == {"Nacht": 32, "Morgen": 16, "Tag": 28, "Abend": 20}
    assert slots.where("is_peak").count() == 32
