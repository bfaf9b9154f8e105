"""The whole warehouse on small raw tables: built, built again, and built after late rows."""

import datetime as dt
import os
import json

import pytest
from pyspark.sql import functions as F

from layerloom.operators import quality as q, sinks
from layerloom.operators.calendar import dim_date, dim_time
from layerloom.plans import raw_loads, rules
from layerloom.plans.warehouse import build
from layerloom.sources.schemas import RAW_PARTITIONS, RAW_SCHEMAS, RAW_SLICES
from layerloom.sources.tables import read_table, table_path

AS_OF = "2024-03-31"
DAYS = range(28, 36)  # 29 January to 5 February


def ts(day, hour=0, minute=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day, hours=hour, minutes=minute)


def weather(days, load, shift=0.0):
    return [
        (ts(d, h), ts(d).date(), h, key, lat, 13.4, 5.0 + h + shift, 4.0 + h, 0.5 if h == 3 else 0.0, 10.0, 3, 70.0, f"{d}.json", ts(load))
        for d in days for h in range(24) for key, lat in (("berlin", 52.5), ("wien", 48.2))
    ]


def prices(days, load, minutes=(0,)):
    return [
        (ts(d, h, m), ts(d).date(), h, zone, None if h == 5 else float(h - 3), f"{d}.json", ts(load))
        for d in days for h in range(24) for m in minutes for zone in ("DE-LU", "AT")
    ]


def snapshots(rows):
    return [(a, f"name {a}", "pop", 50, f, ts(d).date(), f"{d}.json", ts(d)) for a, f, d in rows]


def tracks(load):
    base = ("pop", 0.5, 0.5, 1, -5.0, 1, 0.1, 0.1, 0.0, 0.1, 0.5, 120.0, 4)
    genre, *audio = base
    return [(f"t{i}", f"song {i}", " Zoë ", "album", 40 + load, 1000, False, *audio, genre, f"{load}.csv", ts(load)) for i in range(3)]


def charts():
    return [
        (dt.date(2023, 12, 30) + dt.timedelta(days=d), p, f"song {p}", "Zoë", 100 if p > 1 else None, region, chart, "SAME", "u", "c.csv", ts(9))
        for d in range(4) for p in (1, 2) for region in ("de", "global") for chart in ("top200", "viral50")
    ]


def load(spark, root, name, data):
    df = spark.createDataFrame(data, RAW_SCHEMAS[name])
    sinks.replace_slices(spark, df, table_path(root, "raw", name), RAW_PARTITIONS[name], RAW_SLICES[name])


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    load(spark, root, "weather_hourly", weather(DAYS, 41))
    load(spark, root, "energy_price_hourly", prices(DAYS, 41))
    load(spark, root, "spotify_artist_snapshots", snapshots([("x", 1, 0), ("y", 5, 0)]))
    load(spark, root, "spotify_artist_snapshots", snapshots([("x", 2, 7), ("y", 5, 7)]))
    load(spark, root, "spotify_tracks", tracks(1))
    load(spark, root, "spotify_charts", charts())
    built = build(spark, root, AS_OF)
    assert len(built) == 13 + 2 + 5 + 3 + 3
    return root


TABLES = {
    "data_vault": [
        "h_location", "h_price_zone", "h_track", "h_country", "h_artist", "l_track_artist", "s_location_details",
        "s_track_details", "s_track_audio_features", "s_artist_profile", "s_weather_hourly", "s_energy_price_hourly",
        "s_chart_entry",
    ],
    "business_vault": [
        "dim_location", "dim_price_zone", "dim_country", "dim_track", "dim_artist", "fact_weather_hourly",
        "fact_energy_price_hourly", "fact_chart_entry", "fact_weather_daily", "fact_energy_price_daily",
        "fact_energy_price_monthly",
    ],
    "marts": ["weather_trends", "energy_price_trends", "artist_chart_performance"],
}


def content(spark, root):
    return {
        name: sorted(map(repr, (tuple(row[c] for c in sorted(row.__fields__)) for row in read_table(spark, root, layer, name).collect())))
        for layer, names in TABLES.items()
        for name in names
    }


def counts(spark, root):
    return {name: len(rows) for name, rows in content(spark, root).items()}


def test_first_build(spark, root, rows):
    found = counts(spark, root)
    assert found["h_location"] == 2 and found["s_weather_hourly"] == found["fact_weather_hourly"] == 8 * 48
    assert found["fact_weather_daily"] == found["fact_energy_price_daily"] == 16
    assert found["fact_energy_price_monthly"] == 4
    assert found["h_artist"] == 3 and found["dim_artist"] == 3 and found["dim_track"] == 3
    assert found["fact_chart_entry"] == 32
    star = lambda name: read_table(spark, root, "business_vault", name)
    assert rows(star("dim_artist"), "artist_bk", "followers", "version_number", "is_current") == [
        ("x", 1, 1, False),
        ("x", 2, 2, True),
        ("y", 5, 1, True),
    ]
    january = star("fact_energy_price_monthly").where("date_id = 20240101").first()
    assert (january.price_min, january.price_max, january.negative_price_hours) == (-3.0, 20.0, 3 * 3)


def test_rules_hold(spark, root):
    report = rules.check(spark, root)
    assert rules.failing(report).collect() == []
    assert sorted(map(str, rules.check_changed(spark, root).collect())) == sorted(map(str, report.collect()))
    kinds = {row.rule: row.n for row in report.groupBy("rule").agg(F.count("*").alias("n")).collect()}
    assert kinds["not_null"] > 88 and kinds["unique"] > 14 and kinds["relationships"] > 15 and kinds["complete"] == 2


def test_totals_are_kept(spark, root):
    star = lambda name: read_table(spark, root, "business_vault", name)
    assert q.missing_days(star("dim_date"), "full_date").count() == 0
    keys = ["location_hk", "date_key"]
    sums = q.unequal_sums(
        star("fact_weather_hourly"), star("fact_weather_daily"), keys, "precipitation", "precipitation_sum", 1e-9
    )
    assert sums.count() == 0
    mart = read_table(spark, root, "marts", "energy_price_trends")
    by_grain = mart.groupBy("granularity").agg(F.sum("negative_price_hours").alias("n"))
    totals = {row.granularity: row.n for row in by_grain.collect()}
    assert totals["weekly"] == totals["monthly"] == 2 * 8 * 3


def test_rules_find_defects(spark, tmp_path):
    root = str(tmp_path)
    bad = spark.sql(
        "select 'x' as location_sk, 'h' as location_hk, 20240101 as date_id, 500 as time_id, "
        "timestamp_ntz'2024-01-01' as measured_at, date'2024-01-01' as date_key, 60.0D as temperature_2m, "
        "10.0D as apparent_temperature, 101.0D as relative_humidity_2m, cast(null as timestamp_ntz) as load_date"
    )
    write = lambda df, name: sinks.overwrite_table(df, table_path(root, "business_vault", name))
    write(bad, "fact_weather_hourly")
    write(dim_date(spark, AS_OF), "dim_date")
    write(dim_time(spark), "dim_time")
    write(spark.sql("select 'y' as location_sk, 'g' as location_hk, 'k' as location_key, 1.0D as latitude, 1.0D as longitude, timestamp_ntz'2024-01-01' as valid_from"), "dim_location")
    found = {(row.rule, row.column_name) for row in rules.failing(rules.check(spark, root)).collect()}
    assert found == {
        ("not_null", "load_date"), ("relationships", "location_hk"), ("relationships", "time_id"),
        ("in_range", "temperature_2m"), ("in_range", "relative_humidity_2m"), ("near_temperature", "apparent_temperature"),
        ("complete", "location_hk, date_key"),
    }


def test_a_check_reads_the_partitions_that_changed(spark, tmp_path, monkeypatch):
    root, counted = str(tmp_path), []
    place = lambda name: table_path(root, "business_vault", name)

    def day(date, hours, temperature="20.0D", hk="'h'"):
        return spark.sql(
            f"select 'x' as location_sk, {hk} as location_hk, 20240101 as date_id, cast(id * 4 as int) as time_id, timestamp_ntz'2024-01-01' as measured_at, "
            f"{temperature} as temperature_2m, 10.0D as apparent_temperature, 50.0D as relative_humidity_2m, timestamp_ntz'2024-02-01' as load_date, "
            f"date'{date}' as date_key from range({hours})"
        )

    days = day("2024-01-01", 24).unionByName(day("2024-01-02", 24)).unionByName(day("2024-01-03", 23, hk="cast(null as string)"))
    sinks.overwrite_table(days, place("fact_weather_hourly"), ["date_key"], record=True)
    sinks.overwrite_table(dim_date(spark, AS_OF), place("dim_date"))
    sinks.overwrite_table(dim_time(spark), place("dim_time"))
    location = "select 'y' as location_sk, '{}' as location_hk, 'k' as location_key, 1.0D as latitude, 1.0D as longitude, timestamp_ntz'2024-01-01' as valid_from"
    sinks.overwrite_table(spark.sql(location.format("h")), place("dim_location"))
    count = q.counts_of_partitions

    def counting(df, *rest):
        counted.append(df.groupBy(F.col("date_key").cast("string").alias("d")).count().orderBy("d").collect())
        return count(df, *rest)

    monkeypatch.setattr(q, "counts_of_partitions", counting)
    both = lambda: [{tuple(r) for r in f(spark, root).collect()} for f in (rules.check, rules.check_changed)]
    whole, kept = both()
    assert whole == kept and ("complete", "business_vault.fact_weather_hourly", "location_hk, date_key", 1) in kept
    assert [r.d for r in counted.pop()] == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert both()[1] == whole and not counted
    sinks.replace_partitions(day("2024-01-02", 30, "60.0D", "'lost'"), place("fact_weather_hourly"), ["date_key"])
    whole, kept = both()
    assert whole == kept and ("relationships", "business_vault.fact_weather_hourly", "location_hk", 30) in kept
    assert [(r.d, r["count"]) for r in counted.pop()] == [("2024-01-02", 30)]
    sinks.overwrite_table(spark.sql(location.format("lost")), place("dim_location"))  # another parent: nothing of the fact is read
    whole, kept = both()
    assert whole == kept and ("relationships", "business_vault.fact_weather_hourly", "location_hk", 24) in kept and not counted


def test_marts(spark, root, rows):
    mart = read_table(spark, root, "marts", "artist_chart_performance")
    assert rows(mart, "granularity", "period_label", "chart_entries", "best_position", "total_streams", "distinct_tracks", "distinct_regions") == [
        ("monthly", "2023-12", 8, 1, 400, 2, 2),
        ("monthly", "2024-01", 8, 1, 400, 2, 2),
        ("weekly", "2023-W52", 8, 1, 400, 2, 2),
        ("weekly", "2024-W01", 8, 1, 400, 2, 2),
    ]
    weather_mart = read_table(spark, root, "marts", "weather_trends")
    labels = {row.granularity: row.l for row in weather_mart.groupBy("granularity").agg(F.min("period_label").alias("l")).collect()}
    assert labels == {"daily": "2024-01-29", "weekly": "2024-01-29", "monthly": "February 2024"}
    assert weather_mart.where("granularity = 'daily'").agg(F.min("period_label"), F.count("*")).first()[1] == 16


def landed_prices(folder, day, zone, prices):
    seconds = [1704067200 + 86400 * (day - 1) + 3600 * i for i in range(len(prices))]
    meta = {"bidding_zone": zone, "fetch_date": f"2024-01-{day:02d}"}
    body = {"unix_seconds": seconds, "price": prices, "_meta": meta}
    (folder / f"{zone}-2024-01-{day:02d}.json").write_text(json.dumps(body, indent=1))


def test_raw_loads(spark, tmp_path, rows):
    """From landed files to raw tables; each load twice, then a backfill that skips what is loaded per zone."""
    root, prices, charts = str(tmp_path / "root"), tmp_path / "prices", tmp_path / "charts.csv"
    prices.mkdir()
    landed_prices(prices, 1, "AT", [1.0, 2.0])
    charts.write_text(
        "title,rank,date,artist,url,region,chart,trend,streams\n"
        "A,1,2024-01-01,X,u,Germany,top200,SAME,5\nB,2,2024-01-01,Y,u,Peru,top200,SAME,NULL\n"
    )
    raw = lambda name: read_table(spark, root, "raw", name)
    for _ in range(2):
        raw_loads.load_prices(spark, root, str(prices), "2024-02-01 00:00:00")
        raw_loads.load_charts_of_regions(spark, root, str(charts), "2024-02-01 00:00:00")
    assert raw("energy_price_hourly").count() == 2
    assert rows(raw("spotify_charts"), "region", "streams") == [("Germany", 5)]
    raw_loads.load_all_charts(spark, root, str(charts), "2024-02-01 00:00:00")
    assert rows(raw("spotify_charts"), "region", "streams") == [("Germany", 5), ("Peru", None)]
    landed_prices(prices, 1, "AT", [9.0, 9.0])
    landed_prices(prices, 1, "DE-LU", [3.0])
    landed_prices(prices, 2, "AT", [4.0])
    raw_loads.load_missing_prices(spark, root, str(prices), "2024-02-02 00:00:00")
    assert rows(raw("energy_price_hourly"), "date_key", "bidding_zone", "price_eur_mwh") == [
        (dt.date(2024, 1, 1), "AT", 1.0),
        (dt.date(2024, 1, 1), "AT", 2.0),
        (dt.date(2024, 1, 1), "DE-LU", 3.0),
        (dt.date(2024, 1, 2), "AT", 4.0),
    ]


def test_backfill_opens_only_files_that_are_not_loaded(spark, tmp_path, rows):
    """A loaded file that did not change is not read again, not even one that cannot be read any more; a changed one is."""
    root, prices = str(tmp_path / "root"), tmp_path / "prices"
    prices.mkdir()
    landed_prices(prices, 1, "AT", [1.0])
    landed_prices(prices, 2, "AT", [2.0])
    raw_loads.load_missing_prices(spark, root, str(prices), "2024-02-01 00:00:00")
    for file in prices.glob("*.json"):
        file.write_text("no json")
        os.utime(file, (1_600_000_000, 1_600_000_000))
    raw_loads.load_missing_prices(spark, root, str(prices), "2024-02-02 00:00:00")
    landed_prices(prices, 3, "AT", [3.0])
    raw_loads.load_missing_prices(spark, root, str(prices), "2024-02-03 00:00:00")
    found = read_table(spark, root, "raw", "energy_price_hourly")
    assert rows(found, "price_eur_mwh") == [(1.0,), (2.0,), (3.0,)]
    for file in prices.glob("*.json"):
        os.utime(file)  # written again after it was loaded
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        raw_loads.load_missing_prices(spark, root, str(prices), "2024-02-04 00:00:00")


def test_query_result_loads(spark, tmp_path, rows):
    root, landed = str(tmp_path / "root"), str(tmp_path / "landed")
    report = spark.sql("select 'A' as SCHEMA_NAME, 'T' as TABLE_NAME, 'T' as TABLE_TYPE, 0L as ESTIMATED_ROWS, cast(null as int) as DATA_PAGES, '' as REMARKS")

    class Reader:
        def option(self, *_):
            return self

        def load(self):
            return report

    raw_loads.land_query_result(spark, Reader(), "select ...", landed, "2024-01-01", "db2_jdbc")
    for _ in range(2):
        raw_loads.load_query_result(spark, root, "db2_tables", landed)
    found = rows(read_table(spark, root, "raw", "db2_tables"), *RAW_SCHEMAS["db2_tables"].names)
    assert found == [(dt.date(2024, 1, 1), "A", "T", "T", 0, None, "")]


def test_second_build_changes_nothing(spark, root):
    before = content(spark, root)
    build(spark, root, AS_OF)
    assert content(spark, root) == before


def test_late_rows(spark, root):
    """A missing price slice arrives, weather goes on, an artist returns to an old state, a track changes."""
    before = counts(spark, root)
    load(spark, root, "weather_hourly", weather(range(36, 38), 43))
    load(spark, root, "energy_price_hourly", [row for row in prices([30], 44, minutes=(0, 15, 30, 45)) if row[3] == "AT"])
    load(spark, root, "spotify_artist_snapshots", snapshots([("x", 1, 14), ("y", 5, 14)]))
    load(spark, root, "spotify_tracks", tracks(2))
    build(spark, root, AS_OF)
    after = counts(spark, root)
    grown = {name: after[name] - before[name] for name in after if after[name] != before[name]}
    assert grown["s_weather_hourly"] == grown["fact_weather_hourly"] == 96
    assert grown["fact_weather_daily"] == 4
    assert grown["s_energy_price_hourly"] == grown["fact_energy_price_hourly"] == 72
    assert grown["s_artist_profile"] == grown["dim_artist"] == 1
    assert grown["s_track_details"] == 3 and "dim_track" not in grown
    assert "fact_energy_price_daily" not in grown and "fact_energy_price_monthly" not in grown
    star = lambda name: read_table(spark, root, "business_vault", name)
    touched = star("fact_energy_price_daily").where("date_id = 20240131").orderBy("negative_price_hours").collect()
    assert [row.negative_price_hours for row in touched] == [3, 12]
    january = star("fact_energy_price_monthly").where("date_id = 20240101").agg(F.sum("negative_price_hours")).first()[0]
    assert january == 2 * 3 * 3 + 9
    build(spark, root, AS_OF, full_refresh=True)
    assert counts(spark, root) == after


def test_days_outside_the_calendar_are_kept(spark, tmp_path):
    root = str(tmp_path)
    row = weather([0], 41)[0]
    old = (dt.datetime(2001, 5, 1, 3), dt.date(2001, 5, 1), *row[2:])
    load(spark, root, "weather_hourly", [row, old])
    build(spark, root, AS_OF)
    assert read_table(spark, root, "marts", "weather_trends").where("granularity = 'monthly'").count() == 2


def test_a_torn_document_stops_the_load(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    (landed / "a.json").write_text('{"query_date": "2024-01-01", "source": "db2", "row_count": 2, "data": [{"schema_name": "A"}]}')
    with pytest.raises(ValueError, match="a.json"):
        raw_loads.load_query_result(spark, str(tmp_path / "root"), "db2_tables", str(landed))


def corrected(spark, root, loads):
    """The price fact after each build of (price, load day), with the rows of the satellite at the end."""
    found = []
    for price, day in loads:
        load(spark, root, "energy_price_hourly", [(ts(30), ts(30).date(), 0, "AT", price, "f.json", ts(day))])
        build(spark, root, AS_OF, correctable=True)
        hourly, daily = (read_table(spark, root, "business_vault", f"fact_energy_price_{name}").collect() for name in ("hourly", "daily"))
        assert [row.price_eur_mwh for row in hourly] == [row.price_min for row in daily]
        found += [row.price_eur_mwh for row in hourly]
    return found, read_table(spark, root, "data_vault", "s_energy_price_hourly").count()


def test_a_reading_that_is_corrected_back(spark, tmp_path):
    """A, B, A, loaded twice at the end."""
    loads = [(1.0, 41), (2.0, 42), (1.0, 43), (1.0, 43)]
    assert corrected(spark, str(tmp_path), loads) == ([1.0, 2.0, 1.0, 1.0], 3)


def test_a_slice_that_is_loaded_again_with_the_same_load_time(spark, tmp_path):
    """Other values, as many rows, the same load time: the last ones count, as in a build from scratch. Loaded again, nothing is new."""
    loads = [(1.0, 41), (2.0, 41), (2.0, 41), (1.0, 40)]
    assert corrected(spark, str(tmp_path), loads) == ([1.0, 2.0, 2.0, 1.0], 3)


def test_a_correction_older_than_another_zones_load(spark, tmp_path):
    """Neither the number of rows nor the newest load time of the day changes."""
    root = str(tmp_path)
    row = (ts(30), ts(30).date(), 0)
    load(spark, root, "energy_price_hourly", [(*row, "AT", 1.0, "a", ts(41)), (*row, "DE-LU", 5.0, "d", ts(45))])
    build(spark, root, AS_OF, correctable=True)
    load(spark, root, "energy_price_hourly", [(*row, "AT", 2.0, "a", ts(43))])
    build(spark, root, AS_OF, correctable=True)
    for name in ("fact_energy_price_daily", "fact_energy_price_monthly"):
        assert sorted(r.price_min for r in read_table(spark, root, "business_vault", name).collect()) == [2.0, 5.0]


def test_chart_entries_of_a_later_build(spark, tmp_path):
    """Equal in all but streams: an entry of its own, also when it comes later; a row that is there already is not."""
    root, rows = str(tmp_path), charts()[:2]
    load(spark, root, "spotify_charts", rows)
    build(spark, root, AS_OF)
    load(spark, root, "spotify_charts", [(*row[:4], 7, *row[5:9], "later.csv", ts(10)) for row in rows] + [(*row[:9], "later.csv", ts(10)) for row in rows])
    build(spark, root, AS_OF)
    assert read_table(spark, root, "data_vault", "s_chart_entry").count() == 4
    assert read_table(spark, root, "business_vault", "fact_chart_entry").count() == 4
