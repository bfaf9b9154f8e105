"""The driver's tables bound to the raw tables of the three domains, so that every model runs on them.

events -> weather readings and energy prices; part -> tracks (three loads, some with changed attributes); lineitem with
part, supplier and nation -> chart entries; orders -> artist snapshots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from layerloom.session import scratch_path

# The day the relative columns refer to, and the calendar range for the tables with dates in the nineties.
EVENTS_AS_OF = "2024-01-31"
ORDERS_AS_OF = "2001-06-30"
ORDERS_CALENDAR = ("1992-01-01", "2002-12-31")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """A dimension as the table it is in a warehouse: written once to the shared folder and read back.

    Facts look keys up in tables. Spark then knows the dimension's size and broadcasts it, or does not, by that size;
    of a derived frame it only has a guess, and would shuffle the fact.
    """
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _event_lineage() -> list[Column]:
    day = F.col("ts").cast("date")
    return [
        F.concat(F.lit("landing/"), day.cast("string"), F.lit(".json")).alias("_source_file"),
        F.date_add(day, 1).cast("timestamp_ntz").alias("_loaded_at"),
    ]


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A location per user; it moves by half a degree in the middle of the month. Some readings lack a location."""
    user = F.col("user_id")
    moved = F.when(F.dayofmonth("ts") >= 16, 0.5).otherwise(0.0)
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("timestamp"),
        F.col("ts").cast("date").alias("date_key"),
        F.hour("ts").alias("hour"),
        F.when(F.col("event_id") % 97 != 0, F.concat(F.lit("L"), user.cast("string"))).alias("location_key"),
        ((user % 90) / 2 + moved).alias("latitude"),
        ((user % 180) / 4).alias("longitude"),
        (F.col("value") - 30).alias("temperature_2m"),
        (F.col("value") * 0.5 - 30).alias("apparent_temperature"),
        F.when(F.col("event_type") == "error", F.col("value")).otherwise(0.0).alias("precipitation"),
        (F.col("value") * 0.25).alias("windspeed_10m"),
        (F.col("event_id") % 100).cast("int").alias("weathercode"),
        (F.col("event_id") % 110).cast("double").alias("relative_humidity_2m"),
        *_event_lineage(),
    )


def raw_energy_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A price zone per event type; some prices are missing, many are negative."""
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("timestamp"),
        F.col("ts").cast("date").alias("date_key"),
        F.hour("ts").alias("hour"),
        F.when(F.col("event_id") % 97 != 0, F.col("event_type")).alias("bidding_zone"),
        F.when(F.col("event_id") % 50 != 0, F.col("value") - 30).alias("price_eur_mwh"),
        *_event_lineage(),
    )


def raw_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part landed three times; every third one is more popular from the second load on, every seventh one
    changes its time signature in the third."""
    key, size = F.col("p_partkey"), F.col("p_size")
    second = (F.col("load") >= 1) & (key % 3 == 0)
    third = (F.col("load") == 2) & (key % 7 == 0)
    unit = size / 50
    return (
        table(spark, sf_dir, "part")
        .withColumn("load", F.explode(F.array(*[F.lit(number) for number in range(3)])))
        .select(
            F.concat(F.lit("T"), key.cast("string")).alias("track_id"),
            F.col("p_name").alias("track_name"),
            F.concat(F.lit(" "), "p_brand", F.lit(" ")).alias("artist_name"),
            F.col("p_type").alias("album_name"),
            (size + second.cast("int")).alias("popularity"),
            F.round(F.col("p_retailprice") * 100).cast("int").alias("duration_ms"),
            (key % 2 == 0).alias("explicit"),
            unit.alias("danceability"),
            (1 - unit).alias("energy"),
            (key % 12).cast("int").alias("musical_key"),
            (0 - unit * 2).alias("loudness"),
            (key % 2).cast("int").alias("musical_mode"),
            (unit / 2).alias("speechiness"),
            (unit / 4).alias("acousticness"),
            F.lit(0.0).alias("instrumentalness"),
            F.lit(0.5).alias("liveness"),
            unit.alias("valence"),
            (size + 100).cast("double").alias("tempo"),
            F.when(third, 3).otherwise(4).alias("time_signature"),
            F.element_at(F.split("p_name", " "), -1).alias("track_genre"),
            F.concat(F.lit("tracks-"), F.col("load").cast("string"), F.lit(".csv")).alias("_source_file"),
            F.date_add(F.lit("2024-01-01").cast("date"), F.col("load")).cast("timestamp_ntz").alias("_loaded_at"),
        )
    )


def raw_charts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chart entry per order line: brand as artist, part as track, the supplier's nation as region (three nations
    under a known region code)."""
    code = F.when(F.col("n_nationkey") == 0, "de").when(F.col("n_nationkey") == 1, "at")
    region = code.when(F.col("n_nationkey") == 2, "global").otherwise(F.lower("n_name"))
    supplier = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    lines = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    day = F.col("l_shipdate").cast("date")
    return (
        lines.join(part.select("p_partkey", "p_name", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier.select("s_suppkey", region.alias("region")), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            day.alias("chart_date"),
            F.col("l_quantity").cast("int").alias("position"),
            F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string")).alias("track_name"),
            F.col("p_brand").alias("artist_name"),
            F.when(F.col("l_linenumber") > 1, F.round("l_extendedprice").cast("bigint")).alias("streams"),
            "region",
            F.when(F.col("l_returnflag") == "R", "viral50").otherwise("top200").alias("chart_type"),
            F.col("l_linestatus").alias("trend"),
            F.concat(F.lit("/entry/"), F.col("l_orderkey").cast("string")).alias("url"),
            F.concat(F.lit("charts-"), F.year(day).cast("string"), F.lit(".csv")).alias("_source_file"),
            F.date_add(day, 1).cast("timestamp_ntz").alias("_loaded_at"),
        )
    )


def raw_artist_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot per order: the customer is the artist, the order's status and urgency its profile."""
    customer = F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("C"), customer.cast("string")).alias("artist_id"),
        F.concat(F.lit("Artist "), customer.cast("string")).alias("artist_name"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "pop, rock").otherwise("jazz").alias("genres"),
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).alias("popularity"),
        (customer * 10).alias("followers"),
        F.col("o_orderdate").cast("date").alias("snapshot_date"),
        F.concat(F.lit("snapshot-"), F.col("o_orderdate").cast("date").cast("string")).alias("_source_file"),
        F.col("o_orderdate").alias("_loaded_at"),
    )
