"""Data-quality rules and star queries on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from layerloom.operators import quality as q, semantic as sem
from layerloom.plans import bindings as b, model_queries as m
from layerloom.plans.catalog import query
from layerloom.plans.oracle import rounded

# --- rules ------------------------------------------------------------------------------------------------------------


@query("Q1", "select event_id, event_type from events where event_id % 50 = 0 and event_type is not null")
def readings_without_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = b.table(spark, sf_dir, "events").withColumn("price", F.when(F.col("event_id") % 50 != 0, F.col("value")))
    return q.null_rows(raw, "price").select("event_id", "event_type")


@query(
    "Q2 B3",
    "select l_orderkey, l_partkey, count(*) as n_records from lineitem group by all having count(*) > 1",
)
def repeated_order_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.repeated_values(b.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey"), ["l_orderkey", "l_partkey"])


@query(
    "Q3 J7",
    """select o_orderkey, o_custkey from orders
    where o_custkey is not null and o_custkey not in (select c_custkey from customer where c_acctbal > 0)""",
)
def orders_of_unlisted_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = b.table(spark, sf_dir, "customer").where("c_acctbal > 0")
    orders = b.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return q.orphans(orders, "o_custkey", listed, "c_custkey")


@query(
    "Q3 J7",
    """select o_custkey, count(*) as n_records from orders
    where o_custkey not in (select c_custkey from customer where c_acctbal > 0) group by o_custkey""",
)
def unlisted_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = b.table(spark, sf_dir, "customer").where("c_acctbal > 0")
    return q.orphan_keys(b.table(spark, sf_dir, "orders"), "o_custkey", listed, "c_custkey")


@query(
    "Q4 P8",
    """select event_type, count(*) as n_records from events
    where event_type not in ('view', 'click', 'purchase') group by 1""",
)
def unexpected_event_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.unaccepted_values(b.table(spark, sf_dir, "events"), "event_type", ["view", "click", "purchase"])


@query(
    "Q5 A8",
    """select location_hk, date_key, count(*) as hour_count from fact_weather_hourly
    group by location_hk, date_key having count(*) <> 24""",
)
def incomplete_weather_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = m.fact_weather_hourly(spark, sf_dir)
    return q.incomplete_groups(fact, ["location_hk", "date_key"], q.HOURS_PER_DAY, "hour_count")


@query(
    "Q6 A8 P8",
    """select price_zone_hk, date_key, count(*) as interval_count from fact_energy_price_hourly
    group by price_zone_hk, date_key having count(*) not in (23, 24, 25, 92, 96, 100)""",
)
def incomplete_price_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = m.fact_energy_price_hourly(spark, sf_dir)
    return q.incomplete_groups(fact, ["price_zone_hk", "date_key"], q.PRICE_INTERVALS_PER_DAY, "interval_count")


@query(
    "Q7 P9",
    """select location_hk, measured_at, temperature_2m from fact_weather_hourly
    where temperature_2m < -40 or temperature_2m > 50""",
)
def implausible_temperatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = m.fact_weather_hourly(spark, sf_dir)
    return q.out_of_range(fact, "temperature_2m", *q.TEMPERATURE_RANGE, keep=["location_hk", "measured_at"])


@query(
    "Q7 P9",
    """select location_hk, measured_at, relative_humidity_2m from fact_weather_hourly
    where relative_humidity_2m < 0 or relative_humidity_2m > 100""",
)
def implausible_humidity(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = m.fact_weather_hourly(spark, sf_dir)
    return q.out_of_range(fact, "relative_humidity_2m", *q.HUMIDITY_RANGE, keep=["location_hk", "measured_at"])


@query(
    "Q7 P2",
    """select price_zone_hk, measured_at, price_eur_mwh from fact_energy_price_hourly
    where price_eur_mwh is not null and (price_eur_mwh < -20 or price_eur_mwh > 200)""",
)
def implausible_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = m.fact_energy_price_hourly(spark, sf_dir)
    return q.out_of_range(fact, "price_eur_mwh", -20, 200, keep=["price_zone_hk", "measured_at"])


@query(
    "Q8 F22",
    f"""select location_hk, measured_at, temperature_2m, apparent_temperature,
        {rounded('abs(temperature_2m - apparent_temperature)', 4)} as delta
    from fact_weather_hourly where abs(apparent_temperature - temperature_2m) > 20""",
)
def deviating_temperatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = q.deviating_rows(
        m.fact_weather_hourly(spark, sf_dir), "apparent_temperature", "temperature_2m", q.MAX_APPARENT_DEVIATION,
        keep=["location_hk", "measured_at"],
    )
    return rows.withColumn("delta", q.F.round(q.F.round("delta", 10), 4))


@query(
    "Q10 G1",
    """select cast(d as date) as missing_day from generate_series(
        (select min(cast(o_orderdate as date)) from orders), (select max(cast(o_orderdate as date)) from orders),
        interval 1 day) as days(d)
    where cast(d as date) not in (select cast(o_orderdate as date) from orders)""",
)
def days_without_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.missing_days(b.table(spark, sf_dir, "orders"), "o_orderdate")


@query(
    "Q10 G1",
    """select cast(d as date) as missing_day from generate_series(
        (select min(cast(o_orderdate as date)) from orders), (select max(cast(o_orderdate as date)) from orders),
        interval 1 day) as days(d)
    where cast(d as date) not in (select cast(o_orderdate as date) from orders where o_orderpriority = '1-URGENT'
        and o_totalprice > 200000) and cast(d as date) between
        (select min(cast(o_orderdate as date)) from orders where o_orderpriority = '1-URGENT' and o_totalprice > 200000)
        and (select max(cast(o_orderdate as date)) from orders where o_orderpriority = '1-URGENT'
             and o_totalprice > 200000)""",
)
def days_without_large_urgent_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = b.table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT' and o_totalprice > 200000")
    return q.missing_days(large, "o_orderdate")


@query(
    "Q10 A9",
    f"""select o_orderkey as order_key, {rounded('sum(l_extendedprice)', 2)} as detail_sum,
        {rounded('max(o_totalprice)', 2)} as stored_total
    from orders join lineitem on l_orderkey = o_orderkey
    group by o_orderkey having abs(sum(l_extendedprice) - max(o_totalprice)) > 100000
    union all
    select o_orderkey, null, {rounded('o_totalprice', 2)} from orders
    where o_orderkey not in (select l_orderkey from lineitem)""",
)
def orders_that_do_not_add_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals that differ from the sum of their details by more than a tolerance, or have none."""
    detail = b.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_key"), "l_extendedprice")
    total = b.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"), "o_totalprice")
    found = q.unequal_sums(detail, total, ["order_key"], "l_extendedprice", "o_totalprice", 100000)
    return found.select("order_key", *[F.round(F.round(name, 8), 2).alias(name) for name in ("detail_sum", "stored_total")])


def _report_line(rule: str, table: str, column: str, failures: str) -> str:
    return f"select '{rule}' as rule, '{table}' as table_name, '{column}' as column_name, ({failures})::bigint as failures"


@query(
    "Q11 Q1 Q2 Q3 Q4 Q5 Q7 Q10 J7",
    " union all ".join(
        [
            _report_line("not_null", "orders", "o_custkey", "select count(*) from orders where o_custkey is null"),
            _report_line(
                "accepted_values", "orders", "o_orderstatus",
                "select count(*) from orders where o_orderstatus not in (''F'', ''O'')".replace("''", "'"),
            ),
            _report_line(
                "in_range", "orders", "o_totalprice",
                "select count(*) from orders where o_totalprice < 1000 or o_totalprice > 400000",
            ),
            _report_line("unique", "orders", "o_orderkey", "select count(*) - count(distinct o_orderkey) from orders"),
            _report_line(
                "relationships", "orders", "o_custkey",
                "select count(*) from orders "
                "where o_custkey not in (select c_custkey from customer where c_acctbal > 0)",
            ),
            _report_line("row_count_between", "orders", "*", "select cast(count(*) < 1 as integer) from orders"),
            _report_line(
                "min_not_above_max", "lineitem", "l_discount",
                "select count(*) from lineitem where l_discount > l_tax",
            ),
            _report_line(
                "complete", "lineitem", "l_orderkey",
                "select count(*) from (select l_orderkey from lineitem group by 1 "
                "having count(*) not in (1, 2, 3, 4))",
            ),
            _report_line(
                "mean_between", "lineitem", "l_quantity",
                "select cast(avg(l_quantity) not between 20 and 30 as integer) from lineitem",
            ),
            _report_line(
                "same_row_count", "lineitem", "*",
                "select cast((select count(*) from lineitem) <> (select count(*) from orders) as integer)",
            ),
        ]
    ),
)
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule set over two tables: one pass per table for the row rules, one row per rule."""
    orders, lines = b.table(spark, sf_dir, "orders"), b.table(spark, sf_dir, "lineitem")
    listed = b.table(spark, sf_dir, "customer").where("c_acctbal > 0")
    return q.report(
        {
            "orders": (
                orders,
                [
                    q.not_null("o_custkey"),
                    q.accepted_values("o_orderstatus", ["F", "O"]),
                    q.in_range("o_totalprice", 1000, 400000),
                    q.unique(orders, "o_orderkey"),
                    q.relationship(orders, "o_custkey", listed, "c_custkey"),
                    q.row_count_between(orders, 1, 10**15),
                ],
            ),
            "lineitem": (
                lines,
                [
                    q.holds("min_not_above_max", "l_discount", F.col("l_discount") <= F.col("l_tax")),
                    q.complete(lines, ["l_orderkey"], [1, 2, 3, 4]),
                    q.mean_between(lines, "l_quantity", 20, 30),
                    q.same_row_count(lines, orders),
                ],
            ),
        }
    )


_MONTHLY_LINES = "(select *, cast(date_trunc('month', l_shipdate) as date) as ship_month from lineitem)"


@query(
    "Q11 Q2 Q3 Q6",
    " union all ".join(
        [
            _report_line("not_above_tax", "lineitem", "l_discount", "select count(*) from lineitem where l_discount > l_tax"),
            _report_line("in_range", "lineitem", "l_quantity", "select count(*) from lineitem where l_quantity < 2 or l_quantity > 48"),
            _report_line(
                "unique", "lineitem", "part_and_month",
                f"select count(*) from (select l_partkey, ship_month from {_MONTHLY_LINES} group by 1, 2 having count(*) > 1)",
            ),
            _report_line(
                "relationships", "lineitem", "l_partkey",
                "select count(*) from lineitem where l_partkey is not null and l_partkey not in (select p_partkey from part where p_size <= 25)",
            ),
            _report_line(
                "complete", "lineitem", "ship_month, l_suppkey",
                f"select count(*) from (select ship_month, l_suppkey from {_MONTHLY_LINES} group by 1, 2 having count(*) not in (1, 2, 3))",
            ),
        ]
    ),
)
def rules_of_lines_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules counted per month of shipment, as they are kept for later checks, and added up; parts are looked up once per part."""
    month = F.trunc(F.col("l_shipdate").cast("date"), "month")
    lines = b.table(spark, sf_dir, "lineitem").withColumn("ship_month", month)
    lines = lines.withColumn("part_and_month", F.when(F.col("l_partkey").isNotNull(), F.concat("l_partkey", F.lit(" "), "ship_month")))
    small = b.table(spark, sf_dir, "part").where("p_size <= 25")
    rules = [
        q.holds("not_above_tax", "l_discount", F.col("l_discount") <= F.col("l_tax")),
        q.in_range("l_quantity", 2, 48),
        q.unique(lines, "part_and_month"),
        q.relationship(lines, "l_partkey", small, "p_partkey"),
        q.complete(lines, ["ship_month", "l_suppkey"], [1, 2, 3]),
    ]
    counts = q.counts_of_partitions(lines, "ship_month", rules)
    return q.kept_failures(counts, rules).select("rule", F.lit("lineitem").alias("table_name"), "column_name", "failures")


# --- star queries -----------------------------------------------------------------------------------------------------


def _star(spark: SparkSession, sf_dir: str) -> sem.Star:
    lines = b.table(spark, sf_dir, "lineitem").withColumn("ship_day", F.col("l_shipdate").cast("date"))
    orders = b.table(spark, sf_dir, "orders").withColumns(
        {"order_year": F.year("o_orderdate"), "order_month": F.month("o_orderdate"), "order_day": F.col("o_orderdate").cast("date")}
    )
    return sem.Star(
        fact="lineitem",
        tables={
            "lineitem": lines,
            "orders": orders,
            "customer": b.table(spark, sf_dir, "customer"),
            "nation": b.table(spark, sf_dir, "nation"),
            "region": b.table(spark, sf_dir, "region"),
            "part": b.table(spark, sf_dir, "part").where("p_size <= 25"),
        },
        relationships=[
            sem.Relationship("orders", "lineitem", [("o_orderkey", "l_orderkey", "equalTo")]),
            sem.Relationship("customer", "orders", [("c_custkey", "o_custkey", "equalTo")]),
            sem.Relationship("nation", "customer", [("n_nationkey", "c_nationkey", "equalTo")]),
            sem.Relationship("region", "nation", [("r_regionkey", "n_regionkey", "equalTo")]),
            sem.Relationship("part", "lineitem", [("p_partkey", "l_partkey", "equalTo")], join_type="outerRightBody"),
        ],
    )


@query(
    "B1 A12 J9 J4",
    f"""select n_name as nation, c_mktsegment as segment, sum(l_quantity) as quantity,
        {rounded('avg(l_discount)', 4)} as discount, max(l_extendedprice) as highest, min(l_extendedprice) as lowest,
        count(l_linenumber) as lines, count(distinct l_partkey) as parts
    from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
        join nation on c_nationkey = n_nationkey
    group by 1, 2""",
)
def sales_by_nation_and_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joins found from the declared relationships, default aggregates from the columns' roles."""
    fact = lambda column, aggregate, alias: sem.Item("lineitem", column, sem.FACT, aggregate, alias)
    result = sem.star_query(
        _star(spark, sf_dir),
        [
            sem.Item("nation", "n_name", alias="nation"),
            sem.Item("customer", "c_mktsegment", alias="segment"),
            fact("l_quantity", "total", "quantity"),
            fact("l_discount", "average", "discount"),
            fact("l_extendedprice", "maximum", "highest"),
            fact("l_extendedprice", "minimum", "lowest"),
            fact("l_linenumber", "count", "lines"),
            fact("l_partkey", "countDistinct", "parts"),
        ],
    )
    return result.withColumn("discount", F.round(F.round("discount", 10), 4))


@query(
    "B1 J9",
    """select p_brand as brand, sum(l_quantity) as quantity
    from lineitem left join (select * from part where p_size <= 25) on l_partkey = p_partkey group by 1""",
)
def sales_by_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An outer join declared in the model: lines of unlisted parts stay, without a brand."""
    return sem.star_query(
        _star(spark, sf_dir),
        [sem.Item("part", "p_brand", alias="brand"), sem.Item("lineitem", "l_quantity", sem.FACT, "total", "quantity")],
    )


@query(
    "J9 B1",
    """select o_orderpriority as priority, l_orderkey as order_key, l_linenumber as line
    from lineitem join orders on l_orderkey = o_orderkey and l_shipdate > o_orderdate
        and l_extendedprice >= o_totalprice""",
)
def lines_dearer_than_their_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Composite links with comparison operators; rows are listed, not summarised."""
    base = _star(spark, sf_dir)
    links = [
        ("o_orderkey", "l_orderkey", "equalTo"),
        ("o_orderdate", "l_shipdate", "lessThan"),
        ("o_totalprice", "l_extendedprice", "lessThanOrEqualTo"),
    ]
    star = sem.Star("lineitem", base.tables, [sem.Relationship("orders", "lineitem", links)])
    return sem.star_query(
        star,
        [
            sem.Item("orders", "o_orderpriority", alias="priority"),
            sem.Item("lineitem", "l_orderkey", alias="order_key"),
            sem.Item("lineitem", "l_linenumber", sem.FACT, "none", "line"),
        ],
    )


@query(
    "B2 A13",
    """select cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month,
        cast(o_orderdate as date) as day, 3 - cast(grouping(year(o_orderdate)) + grouping(month(o_orderdate))
            + grouping(cast(o_orderdate as date)) as integer) as drill_level,
        sum(l_quantity) as quantity, count(distinct l_partkey) as parts
    from lineitem join orders on l_orderkey = o_orderkey
    group by rollup (year(o_orderdate), month(o_orderdate), cast(o_orderdate as date))""",
)
def sales_drill_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sem.drill_query(
        _star(spark, sf_dir),
        [
            sem.Item("orders", "order_year", alias="year"),
            sem.Item("orders", "order_month", alias="month"),
            sem.Item("orders", "order_day", alias="day"),
        ],
        [
            sem.Item("lineitem", "l_quantity", sem.FACT, "total", "quantity"),
            sem.Item("lineitem", "l_partkey", sem.FACT, "countDistinct", "parts"),
        ],
    )


@query(
    "J9 B1",
    f"""select c_mktsegment as segment, count(o_orderkey) as dearer, sum(cents)::bigint as cents, min(cents) as lowest,
        {rounded('avg(cents)', 2)} as mean
    from customer join (select o_orderkey, cast(round(o_totalprice * 100) as bigint) as cents from orders)
        on c_acctbal * 100 < cents
    group by 1""",
)
def orders_dearer_than_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A relationship of one inequality: every pair of customer and dearer order counts, none is formed. ``cents`` is a bigint; where a total is beyond
    one, which the SQL cannot hold either, it is a decimal(38,0)."""
    orders = b.table(spark, sf_dir, "orders").withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("bigint"))
    customers = b.table(spark, sf_dir, "customer").withColumn("balance", F.col("c_acctbal") * 100)
    links = [sem.Relationship("customer", "orders", [("balance", "cents", "lessThan")])]
    fact = lambda column, aggregate, alias: sem.Item("orders", column, sem.FACT, aggregate, alias)
    result = sem.star_query(
        sem.Star("orders", {"orders": orders, "customer": customers}, links),
        [
            sem.Item("customer", "c_mktsegment", alias="segment"),
            fact("o_orderkey", "count", "dearer"),
            fact("cents", "total", "cents"),
            fact("cents", "minimum", "lowest"),
            fact("cents", "average", "mean"),
        ],
    )
    result = b.stored(spark, result, "orders-dearer")
    return sem.narrowed(result, ["cents"]).withColumn("mean", F.round(F.round("mean", 8), 2))


@query(
    "B1 A12",
    f"""select nation, segment, orders, order_value, quantity, parts
    from (select n_name as nation, c_mktsegment as segment, count(o_orderkey) as orders, {rounded('sum(o_totalprice)', 2)} as order_value
          from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1, 2)
    full join (select n_name as nation, c_mktsegment as segment, sum(l_quantity) as quantity, count(distinct l_partkey) as parts
               from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
                   join nation on c_nationkey = n_nationkey where l_discount > 0.05 group by 1, 2) using (nation, segment)""",
)
def orders_and_lines_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two facts of different grain in one query: order values are not multiplied by their lines."""
    base = _star(spark, sf_dir)
    star = sem.Star("lineitem", {**base.tables, "lineitem": base.tables["lineitem"].where("l_discount > 0.05")}, base.relationships)
    result = sem.several_facts_query(
        star,
        [sem.Item("nation", "n_name", alias="nation"), sem.Item("customer", "c_mktsegment", alias="segment")],
        {
            "orders": [
                sem.Item("orders", "o_orderkey", sem.FACT, "count", "orders"),
                sem.Item("orders", "o_totalprice", sem.FACT, "total", "order_value"),
            ],
            "lineitem": [
                sem.Item("lineitem", "l_quantity", sem.FACT, "total", "quantity"),
                sem.Item("lineitem", "l_partkey", sem.FACT, "countDistinct", "parts"),
            ],
        },
    )
    return result.withColumn("order_value", F.round(F.round("order_value", 6), 2))


@query(
    "B3 Q2",
    """select 'supplier_lineitem' as relationship, 'supplier' as table_name, cast(s_nationkey as varchar) as key,
        count(*) as n_records
    from supplier group by s_nationkey having count(*) > 1""",
)
def ambiguous_supplier_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A link declared to lead to one supplier that leads to many."""
    tables = {"supplier": b.table(spark, sf_dir, "supplier"), "lineitem": b.table(spark, sf_dir, "lineitem")}
    link = sem.Relationship("supplier", "lineitem", [("s_nationkey", "l_suppkey", "equalTo")])
    return sem.cardinality_breaches(sem.Star("lineitem", tables, [link]))


@query(
    "B4",
    """select p_brand, min(p_type) as p_type, min(p_name) as p_name, min(p_size) as p_size from part group by p_brand""",
)
def normalised_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sem.normalised_dimension(b.table(spark, sf_dir, "part"), "p_brand", ["p_type", "p_name", "p_size"])
