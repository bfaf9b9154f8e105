"""Every model of the three domains on the driver's tables: staging, vault, star, marts, full and incremental."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from layerloom.functions.values import stable_round
from layerloom.operators import calendar, facts, history, marts, sinks, staging, vault
from layerloom.plans import bindings as b, domains as d
from layerloom.plans.catalog import Query, model, query
from layerloom.plans.oracle import hashed, rounded, trend_sql

def _stored_dimension(spark: SparkSession, sf_dir: str, dimension: Query) -> DataFrame:
    return b.stored(spark, dimension(spark, sf_dir), dimension.__name__)


# --- staging ----------------------------------------------------------------------------------------------------------


@model("V1 T2 T6 T7 F2 P1 P2 S13", "stg_weather")
def stg_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.weather(b.raw_weather(spark, sf_dir))


@model("V2 T2 T6 T7 F2", "stg_energy_price")
def stg_energy_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.energy_price(b.raw_energy_price(spark, sf_dir))


@model("V3 T2 T4 T6 F2 F4", "stg_track")
def stg_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.track(b.raw_tracks(spark, sf_dir))


@model("V4 T2 T6 F2", "stg_chart")
def stg_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.chart(b.raw_charts(spark, sf_dir))


@model("V5 T2 T6 F2", "stg_artist_snapshot")
def stg_artist_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.artist_snapshot(b.raw_artist_snapshots(spark, sf_dir))


@query(
    "V3 X7",
    f"""select {hashed('track_id', 'track_name', 'album_name', 'duration_ms', 'explicit')} as track_hashdiff,
        count(*) as copies, count(distinct popularity) as states
    from raw_tracks group by 1""",
)
def track_hashdiff_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The narrow hashdiff: several states share one value."""
    rows = staging.track(b.raw_tracks(spark, sf_dir), full_hashdiff=False)
    return rows.groupBy("track_hashdiff").agg(
        F.count("*").alias("copies"), F.count_distinct("popularity").alias("states")
    )


@query(
    "V13 X7",
    f"""select {hashed('track_id')} as track_hk,
        {hashed('track_id', 'track_name', 'album_name', 'duration_ms', 'explicit')} as track_hashdiff, track_name,
        album_name, duration_ms, explicit, popularity, track_genre, min(_loaded_at) as load_date,
        'spotify-kaggle' as record_source
    from raw_tracks group by all""",
)
def s_track_details_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The satellite with the narrow hashdiff: one row per state, several per hashdiff."""
    return d.s_track_details(staging.track(b.raw_tracks(spark, sf_dir), full_hashdiff=False), full_hashdiff=False)


# --- hubs, link, satellites -------------------------------------------------------------------------------------------


@model("V6 A1", "h_location")
def h_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.h_location(stg_weather(spark, sf_dir))


@model("V7 A1", "h_price_zone")
def h_price_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.h_price_zone(stg_energy_price(spark, sf_dir))


@model("V8 A1", "h_track")
def h_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.h_track(stg_track(spark, sf_dir))


@model("V9 A1", "h_country")
def h_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.h_country(stg_chart(spark, sf_dir))


@model("V10 U1 A6 F7", "h_artist")
def h_artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.h_artist(stg_track(spark, sf_dir), stg_artist_snapshot(spark, sf_dir))


@query(
    "V10 U1 A6 F7",
    f"""select nation_hk, coalesce(max(case when source = 'customers' then bk end), min(bk)) as nation_bk,
        min(loaded) as load_date, max(source) as record_source
    from (select {hashed('c_nationkey')} as nation_hk, c_mktsegment as bk,
              timestamp '2024-01-02' as loaded, 'customers' as source from customer
          union all
          select {hashed('s_nationkey')}, s_name, timestamp '2024-01-01', 'suppliers' from supplier)
    group by nation_hk""",
)
def shared_hub_of_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One hub from two sources that share keys: the preferred source's business key wins."""

    def source(name: str, key: str, bk: str, loaded: str) -> DataFrame:
        rows = b.table(spark, sf_dir, name).select(key, bk)
        return rows.withColumn("_loaded_at", F.lit(loaded).cast("timestamp_ntz"))

    customers = source("customer", "c_nationkey", "c_mktsegment", "2024-01-02 00:00:00")
    suppliers = source("supplier", "s_nationkey", "s_name", "2024-01-01 00:00:00")
    return vault.load_shared_hub(
        [
            (customers, ["c_nationkey"], "c_mktsegment", "customers"),
            (suppliers, ["s_nationkey"], "s_name", "suppliers"),
        ],
        "nation_hk", "nation_bk", preferred="customers",
    )


@model("V11 A1", "l_track_artist")
def l_track_artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.l_track_artist(stg_track(spark, sf_dir))


@query(
    "V11",
    f"""select {hashed('l_partkey', 'l_suppkey')} as part_supplier_hk, {hashed('l_partkey')} as part_hk,
        {hashed('l_suppkey')} as supplier_hk, min(l_shipdate) as load_date, 'lineitem' as record_source
    from lineitem group by l_partkey, l_suppkey""",
)
def link_part_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = b.table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", F.col("l_shipdate").alias("_loaded_at")
    )
    hubs = {"part_hk": ["l_partkey"], "supplier_hk": ["l_suppkey"]}
    return vault.load_link(lines, "part_supplier_hk", ["l_partkey", "l_suppkey"], hubs, "lineitem")


@model("V12 A1", "s_location_details")
def s_location_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.s_location_details(stg_weather(spark, sf_dir))


@model("V13 A1", "s_track_details")
def s_track_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.s_track_details(stg_track(spark, sf_dir))


@model("V14 A1", "s_track_audio_features")
def s_track_audio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.s_track_audio_features(stg_track(spark, sf_dir))


def _hot_artists(spark: SparkSession, sf_dir: str, **limits) -> history.HotKeys:
    """Artists with too many snapshots for one task, counted on the raw table's own column."""
    snapshots = b.raw_artist_snapshots(spark, sf_dir).select("artist_id")
    return history.find_hot_keys(vault.with_keys(snapshots, {"artist_hk": ["artist_id"]}), ["artist_hk"], **limits)


@model("V15 X8", "s_artist_profile")
def s_artist_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.s_artist_profile(stg_artist_snapshot(spark, sf_dir), hot=_hot_artists(spark, sf_dir))


@model("V16", "s_weather_hourly")
def s_weather_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.s_weather_hourly(stg_weather(spark, sf_dir))


@model("V17", "s_energy_price_hourly")
def s_energy_price_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.s_energy_price_hourly(stg_energy_price(spark, sf_dir))


@model("V18", "s_chart_entry")
def s_chart_entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.s_chart_entry(stg_chart(spark, sf_dir))


# --- the same loads on top of an existing target ----------------------------------------------------------------------

EVENT_CUT = "2024-01-10"
ORDER_CUT = "1998-01-01"


def _before(staged: DataFrame, cut: str) -> DataFrame:
    """What a target would hold that was loaded up to a day."""
    return staged.where(F.col("_loaded_at") < F.lit(cut).cast("timestamp_ntz"))


@query(
    "V6 P7 J6 W7",
    f"""select * from h_location where location_hk not in
        (select location_hk from stg_weather where _loaded_at < timestamp '2024-01-02 12:00:00')""",
)
def h_location_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = stg_weather(spark, sf_dir)
    target = d.h_location(staged.where(F.col("_loaded_at") < F.lit("2024-01-02 12:00:00").cast("timestamp_ntz")))
    return d.h_location(staged, target)


@query(
    "V11 P7 J6",
    """select * from l_track_artist where track_artist_hk not in
        (select track_artist_hk from l_track_artist l join stg_track s on l.track_hk = s.track_hk
         where s.popularity < 25)""",
)
def l_track_artist_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = stg_track(spark, sf_dir)
    target = d.l_track_artist(staged.where("popularity < 25"))
    return d.l_track_artist(staged, target)


@query(
    "V12 P7 J6",
    f"""select * from s_location_details where location_hashdiff not in
        (select location_hashdiff from stg_weather where _loaded_at < timestamp '{EVENT_CUT}')""",
)
def s_location_details_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = stg_weather(spark, sf_dir)
    return d.s_location_details(staged, d.s_location_details(_before(staged, EVENT_CUT)))


@query(
    "V15 X8 N1",
    f"select * from s_artist_profile where load_date >= timestamp '{ORDER_CUT}'",
)
def s_artist_profile_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All snapshots again on top of a target that holds the older versions: only later versions are new."""
    staged, hot = stg_artist_snapshot(spark, sf_dir), _hot_artists(spark, sf_dir)
    target = d.s_artist_profile(_before(staged, ORDER_CUT), hot=hot)
    return d.s_artist_profile(staged, target, hot=hot)


@query(
    "V15 X8",
    f"""select {', '.join(d.PROFILE_COLUMNS)}, _source_file, _loaded_at as load_date, record_source
    from stg_artist_snapshot where artist_profile_hashdiff not in
        (select artist_profile_hashdiff from stg_artist_snapshot where _loaded_at < timestamp '{ORDER_CUT}')""",
)
def s_artist_profile_unseen_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The literal insert rule: a state the target has held before is never inserted again."""
    staged = stg_artist_snapshot(spark, sf_dir)
    target = vault.load_unseen_satellite(_before(staged, ORDER_CUT), d.PROFILE_COLUMNS, "artist_profile_hashdiff")
    return vault.load_unseen_satellite(staged, d.PROFILE_COLUMNS, "artist_profile_hashdiff", target)


@query(
    "V17 P7 J6",
    f"select * from s_energy_price_hourly where load_date >= timestamp '{EVENT_CUT}'",
)
def s_energy_price_hourly_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target is read only between the batch's first and last reading: equal keys mean equal times."""
    staged = stg_energy_price(spark, sf_dir)
    target = d.s_energy_price_hourly(_before(staged, EVENT_CUT))
    return d.s_energy_price_hourly(staged, sinks.only_between(target, staged, "measured_at"))


# --- dimensions -------------------------------------------------------------------------------------------------------


@model("D3 J2 N3 F1", "dim_location")
def dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.dim_location(h_location(spark, sf_dir), s_location_details(spark, sf_dir))


@model("D4 F1", "dim_price_zone")
def dim_price_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.dim_price_zone(h_price_zone(spark, sf_dir))


@model("D5 F1 F8 X6", "dim_country")
def dim_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.dim_country(h_country(spark, sf_dir))


@model("D6 N3 J3 F1", "dim_track")
def dim_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.dim_track(
        h_track(spark, sf_dir), s_track_details(spark, sf_dir), s_track_audio_features(spark, sf_dir)
    )


@model("D7 J2 N1 N2 F1 F23 X16", "dim_artist")
def dim_artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    hot = _hot_artists(spark, sf_dir)
    profile = d.s_artist_profile(stg_artist_snapshot(spark, sf_dir), hot=hot)
    return d.dim_artist(h_artist(spark, sf_dir), profile, hot=hot)


@query("D7 N1 N2 X8", "select * from dim_artist")
def dim_artist_in_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_artist with the history of every busy artist cut into months, so that the plan for hot keys runs on small
    data too; same result."""
    hot = _hot_artists(spark, sf_dir, min_rows=8)
    profile = d.s_artist_profile(stg_artist_snapshot(spark, sf_dir), hot=hot)
    return d.dim_artist(h_artist(spark, sf_dir), profile, hot=hot)


@query("P10 N1 N2", "select * from dim_artist where not is_current and artist_bk like '%7%'")
def artist_versions_of_the_past(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_artist(spark, sf_dir).where(~F.col("is_current") & F.col("artist_bk").like("%7%"))


_STATE = "v.artist_bk, v.genres, v.popularity, v.version_number"


def _shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = b.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = b.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    artist = F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_shipdate", artist.alias("artist_bk")
    )


_STATE_AT_SHIPMENT = f"""
select l.l_orderkey, l.l_linenumber, l.l_shipdate, {_STATE}
from (select l_orderkey, l_linenumber, l_shipdate, 'C' || o_custkey as artist_bk
      from lineitem join orders on l_orderkey = o_orderkey) l
asof join dim_artist v on l.artist_bk = v.artist_bk and l.l_shipdate >= v.valid_from"""


@query("J5 P11", _STATE_AT_SHIPMENT)
def state_at_shipment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the state their customer had at shipment; the planner's size estimate picks the plan."""
    return history.point_in_time_join(
        _shipments(spark, sf_dir), _stored_dimension(spark, sf_dir, dim_artist), ["artist_bk"], "l_shipdate",
        attributes=["genres", "popularity", "version_number"],
    )


@query("J5 P11", _STATE_AT_SHIPMENT)
def state_at_shipment_in_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan for large version tables, with busy customers cut into months."""
    shipments = _shipments(spark, sf_dir)
    hot = history.find_hot_keys(shipments, ["artist_bk"], min_rows=30)
    return history.carry_forward_join(
        shipments, _stored_dimension(spark, sf_dir, dim_artist), ["artist_bk"], "l_shipdate",
        attributes=["genres", "popularity", "version_number"], hot=hot,
    )


@query(
    "J5",
    f"""select l.l_orderkey, l.l_linenumber, l.l_shipdate, {_STATE}
    from lineitem l join orders o on l.l_orderkey = o.o_orderkey
    join dim_artist v on v.artist_bk = 'C' || o.o_custkey and v.is_current""",
)
def current_state_of_shipment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.current_join(
        _shipments(spark, sf_dir), _stored_dimension(spark, sf_dir, dim_artist), ["artist_bk"],
        attributes=["genres", "popularity", "version_number"],
    ).select("l_orderkey", "l_linenumber", "l_shipdate", "artist_bk", "genres", "popularity", "version_number")


# --- facts ------------------------------------------------------------------------------------------------------------


@model("K1 J1 F13 F20 X2", "fact_weather_hourly")
def fact_weather_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.fact_weather_hourly(s_weather_hourly(spark, sf_dir), _stored_dimension(spark, sf_dir, dim_location))


@model("K2 J1 F19 F20", "fact_energy_price_hourly")
def fact_energy_price_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.fact_energy_price_hourly(s_energy_price_hourly(spark, sf_dir), _stored_dimension(spark, sf_dir, dim_price_zone))


@model("K3 J1", "fact_chart_entry")
def fact_chart_entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.fact_chart_entry(s_chart_entry(spark, sf_dir), _stored_dimension(spark, sf_dir, dim_country))


_DAILY_AVERAGES = ["temperature_avg", "precipitation_sum", "windspeed_avg", "humidity_avg"]


def _rounded(df: DataFrame, names: list[str], digits: int = 6) -> DataFrame:
    """Sums of doubles differ in their last bits between engines; compare them rounded."""
    return df.withColumns({name: stable_round(F.col(name), digits) for name in names})


@query(
    "K4 A2 A4 A10",
    f"""select location_sk, location_hk, date_id, date_key, temperature_min, temperature_max, apparent_temp_min,
        apparent_temp_max, precipitation_hours, windspeed_max, load_date,
        {', '.join(f'{rounded(name, 6)} as {name}' for name in _DAILY_AVERAGES)}
    from fact_weather_daily""",
)
def fact_weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(d.fact_weather_daily(fact_weather_hourly(spark, sf_dir)), _DAILY_AVERAGES)


@model("K5 A2 A4 A5", "fact_energy_price_daily")
def fact_energy_price_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.fact_energy_price_daily(fact_energy_price_hourly(spark, sf_dir))


@model("K6 A9 X1", "fact_energy_price_monthly")
def fact_energy_price_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.fact_energy_price_monthly(fact_energy_price_daily(spark, sf_dir))


@query(
    "K2 P5 X9",
    f"select * from fact_energy_price_hourly where load_date >= timestamp '{EVENT_CUT}'",
)
def fact_energy_price_hourly_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    satellite, zones = s_energy_price_hourly(spark, sf_dir), _stored_dimension(spark, sf_dir, dim_price_zone)
    loaded = satellite.where(F.col("load_date") < F.lit(EVENT_CUT).cast("timestamp_ntz"))
    return d.fact_energy_price_hourly(satellite, zones, target=loaded)


@query(
    "K5 P6 X9",
    """select * from fact_energy_price_daily where date_key >=
        (select max(date_key) - interval 2 day from fact_energy_price_daily where date_key < date '2024-01-20')""",
)
def fact_energy_price_daily_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest two days of the target are aggregated again, so late rows count."""
    hourly = fact_energy_price_hourly(spark, sf_dir)
    loaded = hourly.where("date_key < date'2024-01-20'").select("date_key")
    return d.fact_energy_price_daily(hourly, loaded, lookback="2 days")


# --- marts ------------------------------------------------------------------------------------------------------------

_WEATHER_MEASURES = list(marts.WEATHER_TRENDS.measures)


@query(
    "M1 M4 J4 U2 P4 X3 X5 X14",
    f"""select location_key, granularity, period_label, year, month, week,
        {', '.join(f'{rounded(name, 6)} as {name}' for name in _WEATHER_MEASURES)} from weather_trends""",
)
def weather_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    locations = _stored_dimension(spark, sf_dir, dim_location)
    daily = d.fact_weather_daily(d.fact_weather_hourly(s_weather_hourly(spark, sf_dir), locations))
    mart = d.weather_trends(daily, calendar.dim_date(spark, b.EVENTS_AS_OF), locations, b.EVENTS_AS_OF)
    return _rounded(mart, _WEATHER_MEASURES)


@model("M2 M4 J4 A9 U2 P4 F3 F5 F6 X3 X5 X14", "energy_price_trends")
def energy_price_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = _stored_dimension(spark, sf_dir, dim_price_zone)
    daily = d.fact_energy_price_daily(d.fact_energy_price_hourly(s_energy_price_hourly(spark, sf_dir), zones))
    return d.energy_price_trends(daily, calendar.dim_date(spark, b.EVENTS_AS_OF), zones, b.EVENTS_AS_OF)


def _orders_calendar(spark: SparkSession) -> DataFrame:
    return calendar.dim_date(spark, b.ORDERS_AS_OF, *b.ORDERS_CALENDAR)


@model("M3 P3 A3 A7 U3 J4 X3", "artist_chart_performance")
def artist_chart_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.artist_chart_performance(fact_chart_entry(spark, sf_dir), _orders_calendar(spark))


@query(
    "M3 X3",
    """select artist_name, cast(year(chart_date) as integer) as year, cast(week(chart_date) as integer) as week,
        count(*) as chart_entries, min(position) as best_position, sum(streams)::bigint as total_streams,
        count(distinct track_name) as distinct_tracks, count(distinct region) as distinct_regions
    from fact_chart_entry where chart_type = 'top200' group by artist_name, year(chart_date), week(chart_date)""",
)
def artist_weeks_by_calendar_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The literal week key: ISO week with the calendar's year."""
    config = marts.PerformanceMart(
        entity="artist_name",
        filters={"chart_type": "top200"},
        distinct={"distinct_tracks": "track_name", "distinct_regions": "region"},
        iso_weeks=False,
    )
    mart = marts.performance_mart(fact_chart_entry(spark, sf_dir), _orders_calendar(spark), config)
    return mart.where("granularity = 'weekly'").drop("granularity", "period_label", "month")


_SEGMENT_DAILY = f"""
select c_mktsegment as segment_sk, cast(o_orderdate as date) as date_key, {rounded('avg(o_totalprice)', 4)} as price_avg,
    min(o_totalprice) as price_min, max(o_totalprice) as price_max, count(*) as orders
from orders join customer on o_custkey = c_custkey group by 1, 2"""
_SEGMENTS = "select distinct c_mktsegment as segment_sk, lower(c_mktsegment) as segment from customer"


@query(
    "M4 A9 X3 X5",
    trend_sql(
        f"({_SEGMENT_DAILY})", f"({_SEGMENTS})", "segment_sk", "segment", "2001-06-30", "number",
        {
            "price_avg": ("price_avg", rounded("avg(price_avg)", 2)),
            "price_min": ("price_min", rounded("min(price_min)", 2)),
            "price_max": ("price_max", rounded("max(price_max)", 2)),
            "orders": ("orders", "sum(orders)::bigint"),
        },
    ),
)
def order_value_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generic trend mart on other tables: order values per market segment over several years."""
    customer = b.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment_sk"))
    orders = b.table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    dated = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).withColumn(
        "date_key", F.col("o_orderdate").cast("date")
    )
    daily = (
        dated.groupBy("segment_sk", "date_key")
        .agg(
            stable_round(F.avg("o_totalprice"), 4).alias("price_avg"),
            F.min("o_totalprice").alias("price_min"),
            F.max("o_totalprice").alias("price_max"),
            F.count("*").alias("orders"),
        )
        .withColumn("date_id", facts.cal.date_id(F.col("date_key")))
    )
    segments = customer.select("segment_sk", F.lower("segment_sk").alias("segment")).distinct()
    config = marts.TrendMart(
        entity_hk="segment_sk",
        entity_name="segment",
        date="date_key",
        measures={
            "price_avg": marts.Measure("price_avg", "avg", 2),
            "price_min": marts.Measure("price_min", "min", 2),
            "price_max": marts.Measure("price_max", "max", 2),
            "orders": marts.Measure("orders", "sum"),
        },
    )
    return marts.trend_mart(daily, _orders_calendar(spark), segments, b.ORDERS_AS_OF, config)
