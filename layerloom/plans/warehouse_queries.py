"""The incremental warehouse on the driver's tables, each build of several steps held against the definition from scratch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from layerloom.operators import sinks
from layerloom.plans import bindings as b, warehouse
from layerloom.plans.catalog import query
from layerloom.plans.model_queries import fact_chart_entry
from layerloom.plans.oracle import rounded
from layerloom.session import scratch_path
from layerloom.sources.schemas import RAW_PARTITIONS, RAW_SLICES
from layerloom.sources.tables import read_table, table_path


def _built_in_steps(spark: SparkSession, sf_dir: str, label: str, raw: dict[str, DataFrame], steps: list[str], **options) -> str:
    """Load the rows of each step into the raw tables and build, step by step; the last step is built twice."""
    root = scratch_path(spark, label)
    for step in [*steps, None]:
        for name, rows in raw.items():
            if step is not None:
                sinks.replace_slices(spark, rows.where(step), table_path(root, "raw", name), RAW_PARTITIONS[name], RAW_SLICES[name])
        warehouse.build(spark, root, b.EVENTS_AS_OF, **options)
    return root


# The middle of the month, its end (every location has moved), then the beginning, whose load times are the oldest.
_STEPS = ["day(timestamp) between 8 and 20", "day(timestamp) > 20", "day(timestamp) < 8"]
_SHOWN = ["temperature_min", "temperature_max", "precipitation_hours", "windspeed_max"]


@query(
    "K1 K4 W1 W7 W9 P5",
    f"""select location_bk, date_key, {', '.join(_SHOWN)} from fact_weather_daily f join h_location h on f.location_hk = h.location_hk""",
)
def daily_weather_in_three_builds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late days with old load times and moved locations: as many rows, with the same values, as in one build."""
    raw = b.raw_weather(spark, sf_dir).where("location_key is not null")
    root = _built_in_steps(spark, sf_dir, "three-builds", {"weather_hourly": raw}, _STEPS)
    daily = read_table(spark, root, "business_vault", "fact_weather_daily")
    hub = read_table(spark, root, "data_vault", "h_location").select("location_hk", "location_bk")
    return daily.join(hub, "location_hk").select("location_bk", "date_key", *_SHOWN)


@query(
    "M1 M4 D3 J4",
    """select location_key, granularity, period_label, year, month, week, temp_min, temp_max from weather_trends""",
)
def weather_trends_in_three_builds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart at the end of the three builds: no location's history is lost when it gets another surrogate key."""
    raw = b.raw_weather(spark, sf_dir).where("location_key is not null")
    root = _built_in_steps(spark, sf_dir, "three-marts", {"weather_hourly": raw}, _STEPS)
    mart = read_table(spark, root, "marts", "weather_trends")
    return mart.select("location_key", "granularity", "period_label", "year", "month", "week", "temp_min", "temp_max")


def _prices_of_builds(spark: SparkSession, sf_dir: str, label: str, added: list[int]) -> DataFrame:
    """Daily prices after a build of all readings and one more for each number added to the readings of the 12th, 40 days apart."""
    raw = b.raw_energy_price(spark, sf_dir).where("bidding_zone is not null")
    raw = raw.groupBy("bidding_zone", "timestamp", "date_key", "hour", "_source_file", "_loaded_at").agg(
        F.min_by("price_eur_mwh", F.struct(F.col("price_eur_mwh").isNull(), "price_eur_mwh")).alias("price_eur_mwh")
    )
    raw = raw.select("timestamp", "date_key", "hour", "bidding_zone", "price_eur_mwh", "_source_file", "_loaded_at")
    root = scratch_path(spark, label)
    loads = [raw]
    for number, more in enumerate(added, 1):
        corrected = raw.where(F.dayofmonth("date_key") == 12).withColumn("price_eur_mwh", F.col("price_eur_mwh") + more)
        loads.append(corrected.withColumn("_loaded_at", F.col("_loaded_at") + F.expr(f"interval {40 * number} days")))
    for rows in loads:
        path = table_path(root, "raw", "energy_price_hourly")
        sinks.replace_slices(spark, rows, path, RAW_PARTITIONS["energy_price_hourly"], RAW_SLICES["energy_price_hourly"])
        warehouse.build(spark, root, b.EVENTS_AS_OF, correctable=True)
    daily = read_table(spark, root, "business_vault", "fact_energy_price_daily")
    hub = read_table(spark, root, "data_vault", "h_price_zone").select("price_zone_hk", F.col("zone_bk").alias("bidding_zone"))
    return daily.join(hub, "price_zone_hk").select("bidding_zone", "date_key", "price_min", "price_max", "price_avg")


@query(
    "W1 K2 K5 V17",
    f"""select bidding_zone, date_key, min(price) as price_min, max(price) as price_max, {rounded('avg(price)', 4)} as price_avg
    from (select bidding_zone, date_key, price_eur_mwh + case when day(date_key) = 12 then 1000 else 0 end as price,
              row_number() over (partition by bidding_zone, "timestamp" order by price_eur_mwh) as copy
          from raw_energy_price where bidding_zone is not null)
    where copy = 1 group by bidding_zone, date_key""",
)
def corrected_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day is loaded again with other prices: the satellite keeps both readings, the fact shows the new ones."""
    return _prices_of_builds(spark, sf_dir, "corrected", [1000])


@query(
    "W1 K2 K5 V17",
    f"""select bidding_zone, date_key, min(price_eur_mwh) as price_min, max(price_eur_mwh) as price_max, {rounded('avg(price_eur_mwh)', 4)} as price_avg
    from (select bidding_zone, date_key, price_eur_mwh, row_number() over (partition by bidding_zone, "timestamp" order by price_eur_mwh) as copy
          from raw_energy_price where bidding_zone is not null)
    where copy = 1 group by bidding_zone, date_key""",
)
def prices_corrected_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day is loaded with other prices and then with the first ones again: the fact shows the first ones."""
    return _prices_of_builds(spark, sf_dir, "corrected-back", [1000, 0])


@query(
    "V18 K3",
    """select chart_type, count(*) as entries from (select distinct chart_date, position, track_name, artist_name, streams, region,
        chart_type, trend, url from raw_charts) group by chart_type""",
)
def entries_per_chart_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every different row of the raw charts is an entry of the fact."""
    return fact_chart_entry(spark, sf_dir).groupBy("chart_type").agg(F.count("*").alias("entries"))


_ENTRY = "chart_date, position, track_name, artist_name, {} as streams, region, chart_type, trend, url from raw_charts where chart_date >= date '1995-03-01' and chart_date < date '1995-04-01'"


@query(
    "V18 K3",
    f"""select chart_type, count(*) as entries from (select {_ENTRY.format('streams')} union select {_ENTRY.format('streams + 1')}) group by chart_type""",
)
def chart_entries_in_two_builds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second file brings a month's entries with other streams: every different row is an entry, whichever build it came in."""
    root = scratch_path(spark, "two-chart-builds")
    month = F.trunc("chart_date", "month") == F.lit("1995-03-01").cast("date")
    first = b.raw_charts(spark, sf_dir).where(month).withColumn("_source_file", F.lit("first.csv"))
    second = first.withColumns({"streams": F.col("streams") + 1, "_source_file": F.lit("second.csv")})
    for rows in (first, second):
        path = table_path(root, "raw", "spotify_charts")
        sinks.replace_slices(spark, rows, path, RAW_PARTITIONS["spotify_charts"], RAW_SLICES["spotify_charts"])
        warehouse.build(spark, root, b.EVENTS_AS_OF)
    entries = read_table(spark, root, "business_vault", "fact_chart_entry")
    return entries.groupBy("chart_type").agg(F.count("*").alias("entries"))
