"""Trend marts: one fact at several time grains, labelled for display, technical keys left out."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from layerloom.functions import calendar as cal
from layerloom.functions.values import stable_round
from layerloom.operators.matching import null_safe_join

DAILY, WEEKLY, MONTHLY = "daily", "weekly", "monthly"


@dataclass(frozen=True)
class Measure:
    """A mart column: the fact column it takes at daily grain and how days are combined beyond that."""

    source: str
    combine: str  # avg, min, max, sum
    digits: int | None = None

    def aggregate(self) -> Column:
        return getattr(F, self.combine)(self.source)

    def shown(self, value: Column, is_day: Column) -> Column:
        """Days show the fact's own value, longer periods the rounded aggregate."""
        return value if self.digits is None else F.when(is_day, value).otherwise(stable_round(value, self.digits))


@dataclass(frozen=True)
class TrendMart:
    """Configuration of a trend mart.

    ``labels`` is "number" (2024-W05, 2024-01) or "name" (first day of the week, "January 2024"). ``iso_weeks`` names
    weeks by their ISO year; False keeps the calendar year, which splits the week at the turn of the year.
    """

    entity_hk: str
    entity_name: str
    date: str
    measures: Mapping[str, Measure]
    labels: str = "number"
    recent_days: int = 90
    iso_weeks: bool = True


def _year_of_week(iso_weeks: bool) -> str:
    return "iso_year" if iso_weeks else "year"


def _period(granularity: str, year: str, month: str | None, week: str | None, day: str | None) -> Column:
    def part(name: str | None, data_type: str) -> Column:
        return F.col(name) if name else F.lit(None).cast(data_type)

    return F.struct(
        F.lit(granularity).alias("granularity"),
        F.col(year).alias("year"),
        part(month, "int").alias("month"),
        part(week, "int").alias("week"),
        part(day, "date").alias("day"),
    )


def trend_mart(
    fact: DataFrame, calendar: DataFrame, entity: DataFrame, as_of: str, config: TrendMart
) -> DataFrame:
    """The days up to ``recent_days`` before the as-of day, all weeks and all months of a daily fact.

    One pass over the fact and one shuffle: each row goes into its week, its month and, if recent, its day. The fact
    holds one row per entity and day, so a day's aggregate is that row. The entity's display name joins the
    aggregated rows, not the fact, by the hub key: it stays when the entity gets a new surrogate key.
    """
    # The calendar has a fixed size (a row per day of a few years), so broadcasting it is bounded.
    days = F.broadcast(calendar.select("date_id", "year", "iso_year", "month", "month_name", "week"))
    hk, date = config.entity_hk, config.date
    today = F.lit(as_of).cast("date")
    recent = F.col(date).between(F.date_sub(today, config.recent_days), today)
    periods = F.array(
        F.when(recent, _period(DAILY, "year", "month", "week", date)),
        _period(WEEKLY, _year_of_week(config.iso_weeks), None, "week", None),
        _period(MONTHLY, "year", "month", None, None),
    )
    rows = fact.join(days, "date_id").select(
        hk,
        date,
        "month_name",
        *dict.fromkeys(measure.source for measure in config.measures.values()),
        F.explode(periods).alias("period"),
    )
    grouped = (
        rows.where(F.col("period").isNotNull())
        .groupBy(hk, "period.granularity", "period.year", "period.month", "period.week", "period.day")
        .agg(
            F.min(date).alias("_first_day"),
            F.min("month_name").alias("_month_name"),
            *[measure.aggregate().alias(name) for name, measure in config.measures.items()],
        )
    )
    year, month = F.col("year"), F.col("month")
    if config.labels == "number":
        month_text, week_text = cal.month_label(year, month), cal.week_label(year, F.col("week"))
    else:
        month_text, week_text = cal.month_title(F.col("_month_name"), year), F.col("_first_day").cast("string")
    is_day = F.col("granularity") == DAILY
    label = (
        F.when(is_day, F.col("day").cast("string"))
        .when(F.col("granularity") == WEEKLY, week_text)
        .otherwise(month_text)
    )
    shown = [measure.shown(F.col(name), is_day).alias(name) for name, measure in config.measures.items()]
    return grouped.join(entity.select(hk, config.entity_name), hk).select(
        config.entity_name, "granularity", label.alias("period_label"), "year", "month", "week", *shown
    )


WEATHER_TRENDS = TrendMart(
    entity_hk="location_hk",
    entity_name="location_key",
    date="date_key",
    labels="name",
    measures={
        "temp_avg": Measure("temperature_avg", "avg", 1),
        "temp_min": Measure("temperature_min", "min", 1),
        "temp_max": Measure("temperature_max", "max", 1),
        "precipitation_total": Measure("precipitation_sum", "sum", 1),
        "windspeed_avg": Measure("windspeed_avg", "avg", 1),
    },
)

ENERGY_PRICE_TRENDS = TrendMart(
    entity_hk="price_zone_hk",
    entity_name="bidding_zone",
    date="date_key",
    labels="number",
    measures={
        "price_avg": Measure("price_avg", "avg", 2),
        "price_min": Measure("price_min", "min", 2),
        "price_max": Measure("price_max", "max", 2),
        "price_stddev": Measure("price_stddev", "avg", 2),
        "negative_price_hours": Measure("negative_price_hours", "sum"),
    },
)


@dataclass(frozen=True)
class PerformanceMart:
    """Configuration of a ranking mart over dated entries."""

    entity: str
    filters: Mapping[str, str] = field(default_factory=dict)
    position: str = "position"
    amount: str = "streams"
    distinct: Mapping[str, str] = field(default_factory=dict)
    iso_weeks: bool = True


ARTIST_CHART_PERFORMANCE = PerformanceMart(
    entity="artist_name",
    filters={"chart_type": "top200"},
    distinct={"distinct_tracks": "track_name", "distinct_regions": "region"},
)


def performance_mart(fact: DataFrame, calendar: DataFrame, config: PerformanceMart) -> DataFrame:
    """Entries, best position, total amount and distinct counts per entity, by week and by month.

    The entries are first reduced to one row per entity, week, month and combination of the counted columns. That
    shuffle is spread over the combinations, so an entity with a third of all entries does not meet in one task. Per grain
    and counted column the reduced rows (one exchange, used again) are grouped once more and the groups counted, so no row is multiplied.
    """
    days = F.broadcast(calendar.select("date_id", "year", "iso_year", "month", "week"))
    kept = fact
    for name, value in config.filters.items():
        kept = kept.where(F.col(name) == value)
    entity, counted = config.entity, list(config.distinct.values())
    week_year = _year_of_week(config.iso_weeks)
    reduced = (
        kept.select(entity, "date_id", config.position, config.amount, *counted)
        .join(days, "date_id")
        .groupBy(entity, *dict.fromkeys([week_year, "week", "year", "month"]), *counted)
        .agg(
            F.count("*").alias("chart_entries"),
            F.min(config.position).alias("best_position"),
            F.sum(config.amount).alias("total_streams"),
        )
    )
    weekly = reduced.withColumn("period", _period(WEEKLY, week_year, None, "week", None))
    monthly = reduced.withColumn("period", _period(MONTHLY, "year", "month", None, None))

    def at_grain(rows: DataFrame) -> DataFrame:
        rows = rows.select(entity, "period.*", *counted, "chart_entries", "best_position", "total_streams")
        grain = [entity, "granularity", "year", "month", "week"]
        result = rows.groupBy(*grain).agg(
            F.sum("chart_entries").alias("chart_entries"),
            F.min("best_position").alias("best_position"),
            F.sum("total_streams").alias("total_streams"),
        )
        for name, column in config.distinct.items():
            groups = rows.groupBy(*grain, column).agg(F.lit(1).alias("_one")).groupBy(*grain).agg(F.count(column).alias(name))
            result = null_safe_join(result, groups, grain, "inner")
        return result

    grouped = at_grain(weekly).unionByName(at_grain(monthly))
    year, is_week = F.col("year"), F.col("granularity") == WEEKLY
    label = F.when(is_week, cal.week_label(year, F.col("week"))).otherwise(cal.month_label(year, F.col("month")))
    return grouped.select(
        entity,
        "granularity",
        label.alias("period_label"),
        "year",
        "month",
        "week",
        "chart_entries",
        "best_position",
        "total_streams",
        *config.distinct,
    )
