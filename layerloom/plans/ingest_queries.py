"""Landing to raw on the driver's tables: documents and CSV files are written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from layerloom.operators import quality, sinks
from layerloom.operators.matching import null_safe_join
from layerloom.plans import bindings as b, documents as docs
from layerloom.plans.catalog import query
from layerloom.session import scratch_path
from layerloom.sources import delimited, landing, schemas, tables
from layerloom.sources.schemas import RAW_SCHEMAS
from layerloom.streaming.ingest import document_stream, ingest_available

_LOADED = f"timestamp '{docs.LOADED_AT}' as _loaded_at"

# --- JSON documents ---------------------------------------------------------------------------------------------------


@query(
    "S1 S3 S12 S15 T3 F24 F27",
    f"""select date_trunc('minute', ts) as "timestamp", cast(ts as date) as date_key, cast(hour(ts) as integer) as hour,
        'L' || user_id as location_key, (user_id % 90) / 2.0::double as latitude,
        (user_id % 180) / 4.0::double as longitude, value - 30 as temperature_2m,
        case when user_id % 5 <> 0 then value * 0.5::double end as apparent_temperature,
        case when event_id % 4 <> 0 then value end as precipitation, value * 0.25::double as windspeed_10m,
        cast(event_id % 100 as integer) as weathercode, cast(event_id % 110 as double) as relative_humidity_2m,
        {_LOADED}
    from events""",
)
def weather_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parallel arrays to rows; a missing array is all NULL."""
    path = docs.land(spark, docs.weather_documents(spark, sf_dir), "weather")
    read = landing.read_documents(spark, path, schemas.WEATHER_DOCUMENT, pretty=False)
    return landing.weather_rows(read, docs.LOADED_AT).drop("_source_file")


_PRICES = """
select date_trunc('second', ts) as "timestamp", cast(ts as date) as date_key, cast(hour(ts) as integer) as hour,
    event_type || '-' || event_id // 100 as bidding_zone,
    case when event_id % 50 <> 0 and not (event_id // 100 % 2 = 0 and row_number() over (
        partition by event_type, cast(ts as date), event_id // 100 order by event_id desc) = 1)
    then value - 30 end as price_eur_mwh
from events"""


@query("S2 S3 S12 F24", f"select *, {_LOADED} from ({_PRICES})")
def prices_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epoch seconds and prices to rows; a price array that is too short leaves NULLs at its end."""
    path = docs.land(spark, docs.price_documents(spark, sf_dir), "prices")
    read = landing.read_documents(spark, path, schemas.PRICE_DOCUMENT, pretty=False)
    return landing.price_rows(read, docs.LOADED_AT).drop("_source_file")


@query(
    "S7",
    f"""select 'C' || o_custkey as artist_id, 'Artist ' || o_custkey as artist_name,
        case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'pop, rock' else '' end as genres,
        case o_orderstatus when 'F' then 1 when 'O' then 2 end as popularity, o_custkey * 10 as followers,
        cast(o_orderdate as date) as snapshot_date, {_LOADED}
    from orders""",
)
def artists_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = docs.land(spark, docs.artist_documents(spark, sf_dir), "artists")
    read = landing.read_documents(spark, path, schemas.ARTIST_DOCUMENT, pretty=False)
    return landing.artist_rows(read, docs.LOADED_AT).drop("_source_file")


@query(
    "S11 L2",
    """select date '2024-02-01' as query_date, o_custkey as source_id, count(*) as orders
    from orders group by o_custkey""",
)
def order_counts_from_query_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query result landed as documents of bounded size and read back."""
    counts = b.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("source_id")).agg(
        F.count("*").alias("orders")
    )
    path = scratch_path(spark, "counts")
    sinks.write_query_document(spark, counts, path, "2024-02-01", "orders", rows_per_document=500)
    read = landing.read_documents(spark, path, schemas.query_document(counts.schema), pretty=False)
    return landing.query_rows(read)


@query(
    "W11",
    """select 'orders' as source, count(*) as total_queried, count(o_custkey) as total_found,
        count(*) - count(o_custkey) as total_skipped
    from customer left join (select distinct o_custkey from orders where o_totalprice > 300000)
    on c_custkey = o_custkey""",
)
def audit_of_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    queried = b.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"))
    found = b.table(spark, sf_dir, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("key"))
    return sinks.audit_counters(queried, found, ["key"], source="orders")


@query(
    "W11 S7",
    """select snapshot_date, 'spotify-api' as source, total_queried, total_found, total_queried - total_found as total_skipped,
        checkpoints, total_found as artists
    from (select strftime(o_orderdate, '%Y-%m') as snapshot_date, count(distinct o_custkey) as total_queried,
              count(distinct case when o_totalprice > 150000 then o_custkey end) as total_found,
              cast(ceil(count(distinct case when o_totalprice > 150000 then o_custkey end) / 50) as bigint) as checkpoints
          from orders group by 1)""",
)
def counters_in_artist_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot documents with the run's counters in their head, landed and read back: customers of a month as the names asked for."""
    orders = b.table(spark, sf_dir, "orders").withColumn("snapshot_date", F.date_format("o_orderdate", "yyyy-MM"))
    asked = orders.select("snapshot_date", F.col("o_custkey").cast("string").alias("artist_name")).distinct()
    found = orders.where("o_totalprice > 150000").groupBy("snapshot_date", F.col("o_custkey").cast("string").alias("artist_name")).agg(
        F.max("o_orderkey").cast("string").alias("artist_id")
    )
    nothing = {"genres": F.lit(""), "popularity": F.lit(None).cast("int"), "followers": F.lit(None).cast("bigint")}
    path = scratch_path(spark, "artist-documents")
    sinks.write_artist_documents(asked, found.withColumns(nothing), path)
    read = landing.read_documents(spark, path, schemas.ARTIST_DOCUMENT, pretty=False)
    return read.groupBy(*[f"_meta.{name}" for name in ("snapshot_date", "source", *sinks.COUNTERS, "checkpoints")]).agg(
        F.sum(F.size("artists")).alias("artists")
    )


# --- CSV files --------------------------------------------------------------------------------------------------------

_CHART_HEADER = list(delimited.CHART_COLUMNS)


def _charts_csv(spark: SparkSession, sf_dir: str) -> str:
    """Chart entries as a bulk CSV file set; missing amounts are blank or the text NULL."""
    sources = {target: source for source, target in delimited.CHART_COLUMNS.items()}
    raw = b.raw_charts(spark, sf_dir)
    amount = F.coalesce(F.col("streams").cast("string"), F.when(F.col("position") % 2 == 0, "NULL").otherwise(""))
    path = scratch_path(spark, "charts-csv")
    raw.withColumn("streams", amount).select(
        *[F.col(target).cast("string").alias(source) for target, source in sources.items()]
    ).select(*_CHART_HEADER).write.option("header", True).option("emptyValue", "").csv(path)
    return path


_CHART_VALUES = "chart_date, position, track_name, artist_name, streams, region, chart_type, trend, url"


@query("S4 W5", f"select {_CHART_VALUES}, {_LOADED} from raw_charts")
def charts_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bulk load: all regions, strict types, written to a table partitioned by region and read back."""
    text = delimited.read_text_columns(spark, _charts_csv(spark, sf_dir), columns=_CHART_HEADER)
    path = scratch_path(spark, "charts")
    sinks.overwrite_table(delimited.chart_rows(text, docs.LOADED_AT), path, ["region"])
    return spark.read.schema(RAW_SCHEMAS["spotify_charts"]).parquet(path).drop("_source_file")


@query("S5 P8", f"select {_CHART_VALUES}, {_LOADED} from raw_charts where region in ('de', 'at', 'nation_7')")
def charts_of_regions_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filtered load: listed regions only, lenient types."""
    text = delimited.read_text_columns(spark, _charts_csv(spark, sf_dir), columns=_CHART_HEADER)
    rows = delimited.chart_rows_of_regions(text, docs.LOADED_AT, ["de", "at", "nation_7"])
    return rows.drop("_source_file")


@query("S6 T1", f"select * exclude (_source_file, _loaded_at), {_LOADED} from raw_tracks")
def tracks_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The track load: columns found by name in the header, three of them renamed."""
    path = scratch_path(spark, "tracks-csv")
    raw = b.raw_tracks(spark, sf_dir).drop("_source_file", "_loaded_at")
    named = raw.withColumnsRenamed({target: source for source, target in delimited.TRACK_RENAMES.items()})
    writer = named.select(F.monotonically_increasing_id().alias("row"), "*").write.option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return delimited.track_rows(delimited.read_text_columns(spark, path), docs.LOADED_AT).drop("_source_file")


@query(
    "S6 S4",
    """select o_orderkey as order_key, o_orderpriority || chr(10) || '"' || o_orderstatus || '", ' || chr(10) || o_orderdate::date as note
    from orders""",
)
def notes_with_line_breaks_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quoted line breaks, read in splits: a record may span them."""
    path = scratch_path(spark, "notes-csv")
    parts = [F.col("o_orderpriority"), F.lit('\n"'), F.col("o_orderstatus"), F.lit('", \n'), F.to_date("o_orderdate").cast("string")]
    orders = b.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"), F.concat(*parts).alias("note"))
    orders.write.options(header=True, quoteAll=True, escape='"').csv(path)
    text = delimited.read_text_columns(spark, path, columns=["order_key", "note"], multiline=True)
    return text.select(F.col("order_key").cast("bigint").alias("order_key"), "note")


# --- slices -----------------------------------------------------------------------------------------------------------

_SLICE_COLUMNS = '"timestamp", date_key, hour, bidding_zone, price_eur_mwh'
_RELOADED = "(date_key >= date '2024-01-20' or date_key is null) and (bidding_zone = 'click' or bidding_zone is null)"
_PRICE_ROWS = f"""(select {_SLICE_COLUMNS} from raw_energy_price
    union all select "timestamp", null, hour, bidding_zone, price_eur_mwh from raw_energy_price where hour = 0)"""


def _price_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readings, those without a zone too; some without a day are added."""
    raw = b.raw_energy_price(spark, sf_dir).select("timestamp", "date_key", "hour", "bidding_zone", "price_eur_mwh")
    dateless = raw.where("hour = 0").withColumn("date_key", F.lit(None).cast("date"))
    return raw.unionByName(dateless)


def _prices_loaded_twice(spark: SparkSession, sf_dir: str, partition_by: list[str]) -> DataFrame:
    rows = _price_rows(spark, sf_dir)
    path = scratch_path(spark, "price-slices")
    keys = ["date_key", "bidding_zone"]
    sinks.replace_slices(spark, rows, path, partition_by, keys)
    corrected = rows.where(_RELOADED).withColumn("price_eur_mwh", F.col("price_eur_mwh") + 1)
    sinks.replace_slices(spark, corrected, path, partition_by, keys)
    return spark.read.schema(rows.schema).parquet(path).select(*rows.columns)


_LOADED_TWICE = f"""
select "timestamp", date_key, hour, bidding_zone,
    case when {_RELOADED} then price_eur_mwh + 1 else price_eur_mwh end as price_eur_mwh
from {_PRICE_ROWS}"""


@query("W1 W4 W10", _LOADED_TWICE)
def price_slices_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days loaded, then some days of one zone again with other values: those slices are replaced, in a table
    partitioned by day and zone."""
    return _prices_loaded_twice(spark, sf_dir, ["date_key", "bidding_zone"])


@query("W1 W4 W10", _LOADED_TWICE)
def price_slices_within_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in a table partitioned by day only, where a slice is part of a partition."""
    return _prices_loaded_twice(spark, sf_dir, ["date_key"])


@query(
    "W2 Q9",
    f"select date_key, count(*) as rows_before, count(*) as rows_after from {_PRICE_ROWS} group by 1",
)
def days_that_grew_on_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows per day of a table that was loaded once and of one that was loaded twice: equal, and those of the source."""
    rows = _price_rows(spark, sf_dir)
    loaded = []
    for loads in (1, 2):
        path = scratch_path(spark, "price-days")
        for _ in range(loads):
            sinks.replace_partitions(rows, path, ["date_key"])
        loaded.append(spark.read.schema(rows.schema).parquet(path))
    once, twice = (df.groupBy("date_key").agg(F.count("*").alias(name)) for df, name in zip(loaded, ("rows_before", "rows_after")))
    if not quality.slices_that_grew(*loaded, ["date_key"]).isEmpty():
        raise ValueError("a day grew on reload")
    return null_safe_join(once, twice, ["date_key"], "inner").select("date_key", "rows_before", "rows_after")


@query(
    "W3",
    """select event_id, 'part-' || event_id % 3 as _source_file,
        case when event_id % 3 = 1 then value + 1 else value end as value
    from events""",
)
def events_by_source_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one source file replaced by a new load of that file."""
    part = F.concat(F.lit("part-"), (F.col("event_id") % 3).cast("string"))
    rows = b.table(spark, sf_dir, "events").select("event_id", part.alias("_source_file"), "value")
    path = scratch_path(spark, "file-slices")
    sinks.replace_source_files(spark, rows, path)
    again = rows.where("_source_file = 'part-1'").withColumn("value", F.col("value") + 1)
    sinks.replace_source_files(spark, again, path)
    return spark.read.schema(sinks.with_file_key(rows).schema).parquet(path).drop("file_key")


@query(
    "W9 X12",
    """select distinct cast(ts as date) as date_key, event_type as bidding_zone from events
    where not (ts < timestamp '2024-01-20' and event_type <> 'click')""",
)
def slices_still_to_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days are skipped per entity: a day that is loaded for other zones is still loaded for this one."""
    rows = b.table(spark, sf_dir, "events").select(
        F.col("ts").cast("date").alias("date_key"), F.col("event_type").alias("bidding_zone"), "ts"
    )
    loaded = rows.where((F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")) & (F.col("bidding_zone") != "click"))
    available = rows.select("date_key", "bidding_zone").distinct()
    return sinks.slices_to_load(available, loaded, ["date_key", "bidding_zone"])


@query(
    "W6 W7 W8",
    """select o_orderkey, o_custkey, o_totalprice from orders""",
)
def orders_appended_in_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appends behind the schema and key guards: the second load takes only what the first did not."""
    orders = b.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    path = scratch_path(spark, "orders-appended")
    sinks.append_rows(spark, orders.where("o_orderkey % 2 = 0"), path, unique_key=["o_orderkey"])
    fresh = sinks.new_rows(orders, spark.read.parquet(path), ["o_orderkey"])
    sinks.append_rows(spark, fresh, path, unique_key=["o_orderkey"])
    return spark.read.parquet(path)


@query("W12 W8 S13", "select o_orderkey, o_custkey, o_totalprice from orders")
def orders_by_layer_and_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written to its layer's folder and read back by layer and name."""
    root = scratch_path(spark, "lake")
    rows = b.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    sinks.overwrite_table(rows, tables.table_path(root, " marts ", "all_orders"))
    return tables.read_table(spark, root, "marts", "all_orders")


@query(
    "J10",
    """select c_mktsegment, count(*) as orders, max(o_totalprice) as largest
    from orders join customer on o_custkey = c_custkey group by 1""",
)
def orders_by_segment_across_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lake table joined with a table of another kind of source (delimited text), each read with its own reader."""
    path = scratch_path(spark, "customer-csv")
    b.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment").write.option("header", True).csv(path)
    text = delimited.read_text_columns(spark, path, columns=["c_custkey", "c_mktsegment"])
    customers = text.select(F.col("c_custkey").cast("bigint").alias("o_custkey"), "c_mktsegment")
    orders = b.table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice")
    return (
        orders.join(customers, "o_custkey")
        .groupBy("c_mktsegment")
        .agg(F.count("*").alias("orders"), F.max("o_totalprice").alias("largest"))
    )


# --- stream -----------------------------------------------------------------------------------------------------------


@query("ST1 S12 W9", f"select *, {_LOADED} from ({_PRICES})")
def prices_from_document_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as a stream that loads what has arrived and stops; run twice, the second run finds nothing new."""
    path = docs.land(spark, docs.price_documents(spark, sf_dir), "price-stream")
    table, checkpoint = scratch_path(spark, "price-table"), scratch_path(spark, "price-checkpoint")
    for _ in range(2):
        ingest_available(
            document_stream(spark, path, schemas.PRICE_DOCUMENT, pretty=False),
            lambda documents: landing.price_rows(documents, docs.LOADED_AT),
            table,
            partition_by=["date_key"],
            slice_keys=["date_key", "bidding_zone"],
            checkpoint=checkpoint,
        ).awaitTermination()
    return spark.read.schema(RAW_SCHEMAS["energy_price_hourly"]).parquet(table).drop("_source_file")
