"""Landing documents written from the driver's tables, for the queries and tests that read them back.

A document holds one entity and day, cut by blocks of ids: at most BLOCK readings, however many rows a day or an entity
has. Every array is therefore bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from layerloom.plans import bindings as b
from layerloom.session import scratch_path

BLOCK = 100
LOADED_AT = "2024-02-01 00:00:00"


def _sorted(rows: str, field: str) -> Column:
    return F.transform(rows, lambda row: row[field])


def _block(column: str) -> Column:
    return F.floor(F.col(column) / BLOCK)


def weather_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column-oriented documents per user and day. Every fifth user's documents lack the apparent temperature."""
    day = F.col("ts").cast("date")
    minute = F.replace(F.substring(F.col("ts").cast("string"), 1, 16), F.lit(" "), F.lit("T"))
    readings = b.table(spark, sf_dir, "events").select(
        "user_id",
        day.cast("string").alias("day"),
        _block("event_id").alias("block"),
        F.struct(
            "event_id",
            minute.alias("time"),
            (F.col("value") - 30).alias("temperature_2m"),
            (F.col("value") * 0.5).alias("apparent_temperature"),
            F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("precipitation"),
            (F.col("value") * 0.25).alias("windspeed_10m"),
            (F.col("event_id") % 100).alias("weathercode"),
            (F.col("event_id") % 110).cast("double").alias("relative_humidity_2m"),
        ).alias("reading"),
    )
    grouped = readings.groupBy("user_id", "day", "block").agg(F.sort_array(F.collect_list("reading")).alias("rows"))
    measures = ["temperature_2m", "precipitation", "windspeed_10m", "weathercode", "relative_humidity_2m"]
    apparent = F.when(F.col("user_id") % 5 != 0, _sorted("rows", "apparent_temperature"))
    return grouped.select(
        (F.col("user_id") % 90 / 2).alias("latitude"),
        (F.col("user_id") % 180 / 4).alias("longitude"),
        F.struct(
            _sorted("rows", "time").alias("time"),
            apparent.alias("apparent_temperature"),
            *[_sorted("rows", name).alias(name) for name in measures],
        ).alias("hourly"),
        F.struct(
            F.concat(F.lit("L"), F.col("user_id").cast("string")).alias("location_key"),
            F.col("day").alias("fetch_date"),
            F.lit("open-meteo").alias("source"),
        ).alias("_meta"),
    )


def price_documents(spark: SparkSession, sf_dir: str, add: float = 0.0) -> DataFrame:
    """Epoch/value documents per event type, day and block; the zone carries the block, so a document is a slice.

    Documents of even blocks lack their last price.
    """
    day = F.col("ts").cast("date")
    readings = b.table(spark, sf_dir, "events").select(
        F.concat("event_type", F.lit("-"), _block("event_id").cast("string")).alias("zone"),
        day.cast("string").alias("day"),
        _block("event_id").alias("block"),
        F.struct(
            "event_id",
            F.unix_seconds(F.col("ts").cast("timestamp")).alias("unix_seconds"),
            F.when(F.col("event_id") % 50 != 0, F.col("value") - 30 + add).alias("price"),
        ).alias("reading"),
    )
    grouped = readings.groupBy("zone", "day", "block").agg(F.sort_array(F.collect_list("reading")).alias("rows"))
    prices = _sorted("rows", "price")
    short = F.slice(prices, 1, F.size(prices) - 1)
    return grouped.select(
        _sorted("rows", "unix_seconds").alias("unix_seconds"),
        F.when(F.col("block") % 2 == 0, short).otherwise(prices).alias("price"),
        F.lit("open").alias("license_info"),
        F.struct(
            F.col("zone").alias("bidding_zone"),
            F.col("day").alias("fetch_date"),
            F.lit("energy-charts").alias("source"),
            F.lit("open").alias("license"),
        ).alias("_meta"),
    )


def artist_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot documents per day and block of orders, with genre lists as the service returns them, joined on landing."""
    from layerloom.sources.landing import artist_from_service

    customer = F.col("o_custkey")
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    item = F.struct(
        F.concat(F.lit("C"), customer.cast("string")).alias("id"),
        F.concat(F.lit("Artist "), customer.cast("string")).alias("name"),
        F.when(urgent, F.array(F.lit("pop"), F.lit("rock"))).otherwise(F.array()).alias("genres"),
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).alias("popularity"),
        F.struct((customer * 10).alias("total")).alias("followers"),
    )
    day = F.col("o_orderdate").cast("date").cast("string")
    rows = b.table(spark, sf_dir, "orders").select(
        day.alias("day"),
        _block("o_orderkey").alias("block"),
        F.struct("o_orderkey", artist_from_service(item).alias("artist")).alias("row"),
    )
    grouped = rows.groupBy("day", "block").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    return grouped.select(
        _sorted("rows", "artist").alias("artists"),
        F.struct(
            F.col("day").alias("snapshot_date"),
            F.lit("spotify-api").alias("source"),
            F.size("rows").cast("bigint").alias("total_found"),
        ).alias("_meta"),
    )


def land(spark: SparkSession, documents: DataFrame, label: str) -> str:
    """Write documents as JSON lines to a fresh folder of the shared scratch space."""
    path = scratch_path(spark, label)
    documents.write.json(path)
    return path
