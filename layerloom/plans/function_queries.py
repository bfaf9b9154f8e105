"""Functions, calendar and relational operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from layerloom.functions import calendar as cal, keys, values
from layerloom.operators import calendar, facts, history, sinks
from layerloom.plans import bindings as b
from layerloom.plans.catalog import query
from layerloom.plans.oracle import MONTH_LABEL, WEEK_LABEL, date_id, hashed, rounded, stamp
from layerloom.sources import jdbc, landing, tables

# --- keys -------------------------------------------------------------------------------------------------------------


@query(
    "F1 F2 F3",
    f"""select o_orderkey, {hashed('o_custkey', stamp('o_orderdate'))} as order_hk,
        {hashed("nullif(o_orderstatus, 'P')", 'cast(o_orderdate as date)', "o_orderstatus = 'F'")} as state_hashdiff,
        md5(cast(o_custkey as varchar) || '|' || {stamp('o_orderdate')}) as customer_sk,
        md5(nullif(o_orderstatus, 'P') || '|' || cast(cast(o_orderdate as date) as varchar)) as status_sk
    from orders""",
)
def keys_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys over numbers, timestamps, dates, booleans and NULLs."""
    orders = b.table(spark, sf_dir, "orders").withColumns(
        {
            "status": F.nullif(F.col("o_orderstatus"), F.lit("P")),
            "day": F.col("o_orderdate").cast("date"),
            "finished": F.col("o_orderstatus") == "F",
        }
    )
    return orders.select(
        "o_orderkey",
        keys.surrogate_key(orders, ["o_custkey", "o_orderdate"]).alias("order_hk"),
        keys.surrogate_key(orders, ["status", "day", "finished"]).alias("state_hashdiff"),
        keys.dimension_sk(orders, ["o_custkey", "o_orderdate"]).alias("customer_sk"),
        keys.dimension_sk(orders, ["status", "day"]).alias("status_sk"),
    )


# --- typing and cleaning ----------------------------------------------------------------------------------------------

_DIRTY_SQL = """
select l_orderkey, l_linenumber, case (l_orderkey + l_linenumber) % 8
    when 0 then '' when 1 then '   ' when 2 then 'x' when 3 then cast(cast(l_quantity as integer) as varchar)
    when 4 then ' ' || cast(l_quantity as varchar) || ' ' when 5 then '-' || cast(l_extendedprice as varchar)
    when 6 then '1.5d' else 'Yes' end as dirty, l_returnflag, l_linestatus
from lineitem"""
_NUMBER = r"'^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$'"


def _dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = (F.col("l_orderkey") + F.col("l_linenumber")) % 8
    text = (
        F.when(kind == 0, "")
        .when(kind == 1, "   ")
        .when(kind == 2, "x")
        .when(kind == 3, F.col("l_quantity").cast("int").cast("string"))
        .when(kind == 4, F.concat(F.lit(" "), F.col("l_quantity").cast("string"), F.lit(" ")))
        .when(kind == 5, F.concat(F.lit("-"), F.col("l_extendedprice").cast("string")))
        .when(kind == 6, "1.5d")
        .otherwise("Yes")
    )
    return b.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text.alias("dirty"))


@query(
    "T1",
    f"""select l_orderkey, l_linenumber, case when trim(dirty) <> '' then dirty end as text_value,
        case when regexp_full_match(dirty, {_NUMBER}) then cast(trim(dirty) as double) end as double_value,
        case when regexp_full_match(dirty, {_NUMBER}) then cast(trunc(cast(trim(dirty) as double)) as integer) end
            as int_value,
        case when trim(dirty) <> '' then lower(dirty) in ('true', '1', 'yes') end as boolean_value,
        case when dirty not in ('', 'NULL') then dirty end as marked_value
    from ({_DIRTY_SQL})""",
)
def typed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Safe conversion of text that is blank, numeric, fractional, padded, or no number at all."""
    dirty = F.col("dirty")
    return _dirty_lines(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        values.blank_to_null(dirty).alias("text_value"),
        values.safe_double(dirty).alias("double_value"),
        values.safe_int(dirty).alias("int_value"),
        values.safe_boolean(dirty).alias("boolean_value"),
        values.marker_to_null(dirty).alias("marked_value"),
    )


_NAMES_SQL = """
select case p_partkey % 4 when 0 then p_brand || ';' || p_type || ', x' when 1 then p_brand || ' , ' || p_type || ','
    when 2 then ' ' || p_name || ' ' else '; ;' || p_name end as names
from part"""


@query(
    "T5 F25 A11 L1",
    f"""select distinct trim(name) as artist_name
    from (select unnest(case when names like '%;%' then string_split(names, ';')
                             when names like '%,%' then string_split(names, ',') else [names] end) as name
          from ({_NAMES_SQL}))
    where trim(name) <> '' """,
)
def distinct_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-valued names taken apart: each row's own separator, trimmed, blank parts dropped, distinct, sorted."""
    kind = F.col("p_partkey") % 4
    names = (
        F.when(kind == 0, F.concat("p_brand", F.lit(";"), "p_type", F.lit(", x")))
        .when(kind == 1, F.concat("p_brand", F.lit(" , "), "p_type", F.lit(",")))
        .when(kind == 2, F.concat(F.lit(" "), "p_name", F.lit(" ")))
        .otherwise(F.concat(F.lit("; ;"), "p_name"))
    )
    parts = b.table(spark, sf_dir, "part").select(F.explode(values.split_names(names)).alias("artist_name"))
    return parts.distinct().orderBy("artist_name")


@query(
    "T4 F4 F6",
    """select lower(trim('  ' || p_brand || ' ')) as artist_bk, upper(trim(p_type)) as genre, count(*) as n
    from part group by 1, 2""",
)
def normalised_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("  "), "p_brand", F.lit(" "))
    return (
        b.table(spark, sf_dir, "part")
        .groupBy(values.business_name(name).alias("artist_bk"), F.upper(F.trim("p_type")).alias("genre"))
        .agg(F.count("*").alias("n"))
    )


@query(
    "F27 S3",
    """select event_type, cast(json_extract(props, '$.k') as bigint) as k, count(*) as n
    from events group by 1, 2""",
)
def fields_of_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field inside JSON text."""
    props = F.from_json("props", "k bigint")
    return b.table(spark, sf_dir, "events").groupBy("event_type", props["k"].alias("k")).agg(F.count("*").alias("n"))


@query(
    "F21 F22 F7",
    f"""select l_orderkey, l_linenumber, {rounded('l_extendedprice * (1 - l_discount)', 1)} as net_1,
        {rounded('l_extendedprice * (1 - l_discount)', 2)} as net_2, {rounded('abs(l_tax - l_discount)', 4)} as gap,
        coalesce(nullif(l_returnflag, 'R'), l_linestatus) as flag
    from lineitem""",
)
def rounded_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return b.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        values.stable_round(net, 1).alias("net_1"),
        values.stable_round(net, 2).alias("net_2"),
        values.stable_round(F.abs(F.col("l_tax") - F.col("l_discount")), 4).alias("gap"),
        F.coalesce(F.nullif("l_returnflag", F.lit("R")), "l_linestatus").alias("flag"),
    )


@query(
    "F24 F26 T3 S15",
    """select event_id, date_trunc('second', ts) as from_epoch, cast(hour(ts) as integer) as hour,
        strftime(ts, '%Y-%m-%d %H:%M:%S') as written, date_trunc('second', ts) as from_text,
        'landing/events.parquet' as _source_file, timestamp '2024-02-01 00:00:00' as _loaded_at
    from events""",
)
def times_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epoch seconds and ISO text as timestamps without zone, whatever the session's zone."""
    written = F.substring(F.col("ts").cast("string"), 1, 19)
    events = b.table(spark, sf_dir, "events").select(
        "event_id",
        cal.epoch_to_timestamp(F.unix_seconds(F.col("ts").cast("timestamp"))).alias("from_epoch"),
        F.hour("ts").alias("hour"),
        written.alias("written"),
        F.replace(written, F.lit(" "), F.lit("T")).cast("timestamp_ntz").alias("from_text"),
    )
    return landing.with_lineage(events, "2024-02-01 00:00:00", F.lit("landing/events.parquet"))


@query(
    "S12",
    """select cast(ts as date) as day, count(*) as events from events group by 1""",
)
def days_of_landing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day that names a landing file, from the file's path."""
    rows = b.raw_weather(spark, sf_dir)
    day = landing.day_in_file_name(F.concat(F.lit("/shared/2023-12-31/"), "_source_file"))
    return rows.groupBy(day.alias("day")).agg(F.count("*").alias("events"))


# --- calendar ---------------------------------------------------------------------------------------------------------


@query(
    "D1 G1 F10 F11 F12 F13 F14 F15 F16 F17 F18 X4",
    f"""select c.*, coalesce(o.orders, 0) as orders
    from dim_date_orders c left join (
        select {date_id('o_orderdate')} as date_id, count(*) as orders from orders group by 1) o
    on c.date_id = o.date_id""",
)
def calendar_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day of the calendar with all its columns and the number of orders on it."""
    days = calendar.dim_date(spark, b.ORDERS_AS_OF, *b.ORDERS_CALENDAR)
    per_day = (
        b.table(spark, sf_dir, "orders")
        .groupBy(cal.date_id(F.col("o_orderdate").cast("date")).alias("date_id"))
        .agg(F.count("*").alias("orders"))
    )
    return days.join(per_day, "date_id", "left").fillna(0, ["orders"])


@query(
    "D1 J4 X15",
    f"""select c.*, e.events, e.value_avg
    from dim_date c join (select {date_id('ts')} as date_id, count(*) as events,
        {rounded('avg(value)', 4)} as value_avg from events group by 1) e on c.date_id = e.date_id""",
)
def calendar_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_day = (
        b.table(spark, sf_dir, "events")
        .groupBy(cal.date_id(F.col("ts").cast("date")).alias("date_id"))
        .agg(F.count("*").alias("events"), values.stable_round(F.avg("value"), 4).alias("value_avg"))
    )
    return calendar.dim_date(spark, b.EVENTS_AS_OF).join(per_day, "date_id")


@query(
    "D2 G2 F9 F14 F19 F20 L1",
    """select t.time_id, t.hour, t.minute_of_hour, t.label, t.period, t.is_peak, count(*) as events
    from events join dim_time t on hour(ts) * 4 + minute(ts) // 15 = t.time_id group by all""",
)
def events_by_quarter_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_slot = (
        b.table(spark, sf_dir, "events")
        .groupBy(cal.quarter_hour_slot(F.col("ts")).alias("time_id"))
        .agg(F.count("*").alias("events"))
    )
    # dim_time has 96 rows by construction.
    return per_slot.join(F.broadcast(calendar.dim_time(spark)), "time_id").orderBy("time_id")


@query(
    "F5 F6 F11 X3 X14",
    f"""select {WEEK_LABEL.format('o_orderdate')} as week_label, {MONTH_LABEL.format('o_orderdate')} as month_label,
        monthname(o_orderdate) || ' ' || cast(year(o_orderdate) as varchar) as month_title, count(*) as orders
    from orders group by 1, 2, 3""",
)
def orders_by_period_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return (
        b.table(spark, sf_dir, "orders")
        .groupBy(
            cal.week_label(cal.iso_year(day), F.weekofyear(day)).alias("week_label"),
            cal.month_label(F.year(day), F.month(day)).alias("month_label"),
            cal.month_title(F.date_format(day, "MMMM"), F.year(day)).alias("month_title"),
        )
        .agg(F.count("*").alias("orders"))
    )


# --- filters, watermarks ----------------------------------------------------------------------------------------------


@query(
    "P1 P3 P8 P9 P10",
    """select o_orderkey as order_id, o_totalprice as amount, 'orders' as record_source
    from orders where o_orderstatus = 'F' and o_orderpriority not in ('1-URGENT', '5-LOW')
        and (o_totalprice < 50000 or o_totalprice between 200000 and 300000) and o_orderpriority like '%I%'""",
)
def selected_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice")
    return (
        b.table(spark, sf_dir, "orders")
        .where(
            (F.col("o_orderstatus") == "F")
            & ~F.col("o_orderpriority").isin("1-URGENT", "5-LOW")
            & ((price < 50000) | price.between(200000, 300000))
            & F.col("o_orderpriority").like("%I%")
        )
        .select(F.col("o_orderkey").alias("order_id"), price.alias("amount"), F.lit("orders").alias("record_source"))
    )


@query(
    "P4 F15",
    """select event_id, event_type, cast(date_diff('day', cast(ts as date), date '2024-01-31') as integer) as days_ago
    from events where date_diff('day', cast(ts as date), date '2024-01-31') <= 10""",
)
def events_of_the_last_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range against an as-of day; the bound on the timestamp itself reaches the scan."""
    as_of = F.lit(b.EVENTS_AS_OF).cast("date")
    day = F.col("ts").cast("date")
    return (
        b.table(spark, sf_dir, "events")
        .where(F.col("ts") >= F.date_sub(as_of, 10).cast("timestamp_ntz"))
        .select("event_id", "event_type", F.datediff(as_of, day).alias("days_ago"))
    )


@query(
    "P5",
    """select event_id, ts from events
    where ts > (select max(ts) from events where event_type = 'signup' and ts < timestamp '2024-01-20')""",
)
def events_since_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = b.table(spark, sf_dir, "events")
    loaded = events.where((F.col("event_type") == "signup") & (F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")))
    return facts.since_watermark(events, loaded, "ts").select("event_id", "ts")


@query(
    "P6",
    """select event_id, ts from events
    where ts >= (select max(ts) - interval 2 day from events where ts < timestamp '2024-01-20')""",
)
def events_since_watermark_with_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = b.table(spark, sf_dir, "events")
    loaded = events.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    return facts.since_watermark(events, loaded, "ts", lookback="2 days").select("event_id", "ts")


# --- joins, windows, top-k --------------------------------------------------------------------------------------------


@query(
    "J6 P7",
    """select c_custkey, c_name from customer
    where c_custkey not in (select o_custkey from orders where o_totalprice > 300000)""",
)
def customers_without_large_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = b.table(spark, sf_dir, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return sinks.new_rows(b.table(spark, sf_dir, "customer").select("c_custkey", "c_name"), large, ["c_custkey"])


@query(
    "J3 N3 X7",
    """select p.p_partkey, p.p_name, l.l_orderkey, l.l_linenumber, l.l_shipdate
    from part p left join (select *, row_number() over (
            partition by l_partkey order by l_shipdate desc, l_orderkey desc, l_linenumber desc) as newest
        from lineitem where l_returnflag = 'A') l on p.p_partkey = l.l_partkey and l.newest = 1""",
)
def parts_with_latest_shipment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left join with the latest row of the other side. Each task keeps one row per part before the shuffle."""
    lines = b.table(spark, sf_dir, "lineitem").where("l_returnflag = 'A'")
    latest = history.latest_per_key(
        lines.select("l_partkey", "l_orderkey", "l_linenumber", "l_shipdate"),
        ["l_partkey"], "l_shipdate", ["l_orderkey", "l_linenumber"],
    )
    parts = b.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return parts.join(latest, F.col("p_partkey") == F.col("l_partkey"), "left").drop("l_partkey")


@query(
    "J8 S8 A3 L2 P3",
    """select n_name as source_database, count(distinct l_partkey) as sequence_count,
        cast(min(p_size) as integer) as min_length, cast(max(p_size) as integer) as max_length,
        cast(round(avg(p_size)) as integer) as avg_length
    from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
        join part on l_partkey = p_partkey
    where l_returnflag = 'N' group by n_name order by sequence_count desc, n_name limit 10""",
)
def parts_per_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shape of the first database report: three tables, distinct count, top ten with a total order."""
    nation = b.table(spark, sf_dir, "nation")
    sources = (
        b.table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("s_suppkey").alias("source_id"), F.col("n_name").alias("source_database"))
    )
    references = b.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("source_id"), F.col("l_partkey").alias("item_id"), F.col("l_returnflag").alias("deleted")
    )
    items = b.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_size").alias("length"))
    return jdbc.source_statistics(references, sources, items)


@query(
    "S9 L3 P8 F21 F26 X13",
    f"""select c_mktsegment as owner, c_name as table_name, 'S' || c_nationkey as tablespace_name,
        case when c_custkey % 5 <> 0 then c_custkey % 50 end as num_rows, cast(c_nationkey as integer) as blocks,
        {rounded('c_acctbal / 1024', 2)} as avg_row_kb,
        strftime(timestamp '2024-01-01' + to_seconds(c_custkey), '%Y-%m-%d %H:%M:%S') as last_analyzed
    from customer where c_mktsegment not in ('BUILDING', 'MACHINERY')
    order by owner, num_rows desc nulls last, table_name limit 50""",
)
def largest_tables_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shape of the second database report: excluded owners, unknown sizes last, first fifty. Zeros stay zeros."""
    key = F.col("c_custkey")
    catalog = b.table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("owner"),
        F.col("c_name").alias("table_name"),
        F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("tablespace_name"),
        F.when(key % 5 != 0, key % 50).alias("num_rows"),
        F.col("c_nationkey").alias("blocks"),
        F.col("c_acctbal").alias("avg_row_len"),
        F.timestamp_add("SECOND", key, F.expr("timestamp_ntz'2024-01-01 00:00:00'")).alias("last_analyzed"),
    )
    return jdbc.largest_tables(catalog, excluded=("BUILDING", "MACHINERY"))


@query(
    "S10 L4 P8 F4 F7",
    """select trim(' ' || s_nationkey || ' ') as schema_name, s_name as table_name, s_suppkey % 3 || '' as table_type,
        s_suppkey as estimated_rows, cast(s_nationkey as integer) as data_pages,
        trim(coalesce(case when s_suppkey % 2 = 0 then ' even ' end, '')) as remarks
    from supplier where s_suppkey % 3 in (0, 1) and s_nationkey not in (3, 4)
    order by schema_name, table_name limit 50""",
)
def first_tables_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shape of the third database report: padded texts, missing remarks, first fifty by name."""
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    catalog = b.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit(" "), nation.cast("string"), F.lit(" ")).alias("creator"),
        F.col("s_name").alias("name"),
        (key % 3).cast("string").alias("type"),
        key.alias("card"),
        nation.alias("npages"),
        F.when(key % 2 == 0, " even ").alias("remarks"),
    )
    return jdbc.first_tables(catalog, types=("0", "1"), excluded=("3", "4"))


@query("L5 L1", "select * from orders order by o_totalprice desc, o_orderkey limit 10")
def preview_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.table(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query(
    "U1 A11",
    """select distinct n_name, role from (
        select n_name, 'customer' as role from customer join nation on c_nationkey = n_nationkey
        union all select n_name, 'supplier' from supplier join nation on s_nationkey = n_nationkey)""",
)
def roles_of_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = b.table(spark, sf_dir, "nation")

    def role(name: str, key: str) -> DataFrame:
        keys_only = b.table(spark, sf_dir, name).select(F.col(key).alias("n_nationkey")).distinct()
        return keys_only.join(nation, "n_nationkey").select("n_name", F.lit(name).alias("role"))

    return role("customer", "c_nationkey").unionByName(role("supplier", "s_nationkey")).distinct()


@query(
    "S13 S14",
    """select 'raw__' || name as table_name, n as rows from (select 'orders' as name, count(*) as n from orders
        union all select 'customer', count(*) from customer union all select 'events', count(*) from events)""",
)
def rows_of_listed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables by reference: register a layer, list it, read each by name."""
    names = ["orders", "customer", "events"]
    for name in names:
        b.table(spark, sf_dir, name).createOrReplaceTempView(f"raw__{name}")
    listed = [name for name in tables.list_tables(spark, "raw") if name.removeprefix("raw__") in names]
    parts = [
        spark.table(name).agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name in listed
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
