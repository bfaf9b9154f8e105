"""Facts: watermark reads, surrogate-key lookup, daily and monthly aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from layerloom.functions import calendar as cal
from layerloom.functions.values import stable_round
from layerloom.operators.matching import null_safe_join
from layerloom.operators.sinks import only_values


def since_watermark(
    source: DataFrame, target: DataFrame | None, column: str, *, lookback: str | None = None
) -> DataFrame:
    """Source rows above the target's highest value of a column.

    The mark is one value, read first and used as a literal, so the filter reaches the scan and prunes partitions and
    row groups. No target, or an empty one, means all rows. ``lookback`` (such as "2 days") also takes the rows from
    that far below the mark, mark included; pair it with a slice replace, as those slices are loaded again.
    """
    if target is None:
        return source
    mark = target.agg(F.max(column).alias("mark")).first()["mark"]
    if mark is None:
        return source
    bound = F.lit(mark).cast(source.schema[column].dataType)
    if lookback is None:
        return source.where(F.col(column) > bound)
    bound = (bound - F.expr(f"interval {lookback}")).cast(source.schema[column].dataType)
    return source.where(F.col(column) >= bound)


def lookup_keys(facts: DataFrame, dimension: DataFrame, sk: str, hk: str) -> DataFrame:
    """Inner join that resolves the surrogate key at load time; only the two key columns of the dimension are read.

    No hint: Spark broadcasts the dimension while it is below the threshold. Beyond it the join is shuffled and a hot
    key's partition is split.
    """
    return facts.join(dimension.select(sk, hk), hk)


def reading_fact(
    satellite: DataFrame, dimension: DataFrame, sk: str, hk: str, measures: Sequence[str]
) -> DataFrame:
    """Readings with surrogate key, date_id and time_id (quarter hour, the same for every domain)."""
    rows = lookup_keys(satellite, dimension, sk, hk)
    return rows.select(
        sk,
        hk,
        cal.date_id(F.col("date_key")).alias("date_id"),
        cal.quarter_hour_slot(F.col("measured_at")).alias("time_id"),
        "measured_at",
        "date_key",
        *measures,
        "load_date",
        "_source_file",
    )


def entry_fact(
    satellite: DataFrame, dimension: DataFrame, sk: str, hk: str, key: str, date: str, columns: Sequence[str]
) -> DataFrame:
    """Dated entries with surrogate key and date_id; the descriptive columns stay in the fact."""
    rows = lookup_keys(satellite, dimension, sk, hk)
    return rows.select(
        key, sk, hk, cal.date_id(F.col(date)).alias("date_id"), *columns, "load_date", "_source_file"
    )


def aggregate_fact(rows: DataFrame, grain: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Group to a grain; ``measures`` maps output columns to aggregates. load_date is the newest one."""
    return rows.groupBy(*grain).agg(
        *[column.alias(name) for name, column in measures.items()], F.max("load_date").alias("load_date")
    )


def newest(sk: str) -> Column:
    """The surrogate key of the newest reading. It is an attribute: an entity that changes gets another one, and must not fall apart
    into two rows on that day."""
    return F.max_by(sk, F.struct("load_date", sk))


def weather_daily(hourly: DataFrame) -> DataFrame:
    return aggregate_fact(
        hourly,
        ["location_hk", "date_id", "date_key"],
        {
            "location_sk": newest("location_sk"),
            "temperature_min": F.min("temperature_2m"),
            "temperature_max": F.max("temperature_2m"),
            "temperature_avg": F.avg("temperature_2m"),
            "apparent_temp_min": F.min("apparent_temperature"),
            "apparent_temp_max": F.max("apparent_temperature"),
            "precipitation_sum": F.sum("precipitation"),
            "precipitation_hours": F.count_if(F.col("precipitation") > 0),
            "windspeed_avg": F.avg("windspeed_10m"),
            "windspeed_max": F.max("windspeed_10m"),
            "humidity_avg": F.avg("relative_humidity_2m"),
        },
    )


def energy_price_daily(hourly: DataFrame) -> DataFrame:
    return aggregate_fact(
        hourly,
        ["price_zone_hk", "date_id", "date_key"],
        {
            "price_zone_sk": newest("price_zone_sk"),
            "price_min": F.min("price_eur_mwh"),
            "price_max": F.max("price_eur_mwh"),
            "price_avg": stable_round(F.avg("price_eur_mwh"), 4),
            "price_stddev": stable_round(F.stddev_pop("price_eur_mwh"), 4),
            "negative_price_hours": F.count_if(F.col("price_eur_mwh") < 0),
        },
    )


def energy_price_monthly(daily: DataFrame) -> DataFrame:
    """One row per zone and month, keyed by the month's first day: aggregates of the daily figures. The average is
    one of daily averages, not weighted by the number of readings."""
    month = daily.withColumn("date_key", F.trunc("date_key", "month")).withColumn(
        "date_id", cal.date_id(F.col("date_key"))
    )
    return aggregate_fact(
        month,
        ["price_zone_hk", "date_id", "date_key"],
        {
            "price_zone_sk": newest("price_zone_sk"),
            "price_min": F.min("price_min"),
            "price_max": F.max("price_max"),
            "price_avg": stable_round(F.avg("price_avg"), 4),
            "price_stddev": stable_round(F.stddev_pop("price_avg"), 4),
            "negative_price_hours": F.sum("negative_price_hours"),
        },
    )


def touched_slices(rows: DataFrame, changed: DataFrame, period: str) -> DataFrame:
    """All rows of the periods in which something changed, to aggregate them again as a whole. ``period`` is a column
    of both; its changed values are filtered on as literals, which prunes a table partitioned by the date it is from."""
    periods = changed.select(period).distinct()
    return null_safe_join(only_values(rows, changed, period), periods, [period], "left_semi")
