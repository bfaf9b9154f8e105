import datetime as dt
import hashlib

from pyspark.sql import functions as F

from layerloom.operators import staging, vault
from layerloom.plans import domains
from layerloom.sources.schemas import RAW_SCHEMAS


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def raw_weather(spark, readings):
    """(location, latitude, hour of the year, load day)"""
    rows = [
        (day(0) + dt.timedelta(hours=h), (day(0) + dt.timedelta(hours=h)).date(), h % 24, key, lat, 1.0, 1.0, 1.0, 0.0, 1.0, 1, 50.0, "f", day(load))
        for key, lat, h, load in readings
    ]
    return spark.createDataFrame(rows, RAW_SCHEMAS["weather_hourly"])


def snapshots(spark, rows):
    """(artist, followers, load day)"""
    data = [(a, f"name {a}", "pop", 1, f, day(n).date(), f"{n}.json", day(n)) for a, f, n in rows]
    return staging.artist_snapshot(spark.createDataFrame(data, RAW_SCHEMAS["spotify_artist_snapshots"]))


def test_hub_and_state_have_one_row_however_often_a_key_is_loaded(spark, rows):
    """Load times that vary must not multiply keys (and through them facts)."""
    stg = staging.weather(raw_weather(spark, [("berlin", 52.5, h, h % 7 + 3) for h in range(112)]))
    assert rows(domains.h_location(stg), "location_bk", "load_date") == [("berlin", day(3))]
    assert rows(domains.s_location_details(stg), "latitude", "load_date") == [(52.5, day(3))]
    dim = domains.dim_location(domains.h_location(stg), domains.s_location_details(stg))
    assert domains.fact_weather_hourly(domains.s_weather_hourly(stg), dim).count() == 112


def test_second_load_adds_nothing(spark):
    stg = staging.weather(raw_weather(spark, [("a", 1.0, h, 1) for h in range(5)] + [("b", 2.0, 1, 2)] * 2))
    for load in (domains.h_location, domains.s_location_details, domains.s_weather_hourly):
        first = load(stg)
        assert first.count() > 0
        assert load(stg, first).count() == 0
    assert domains.s_weather_hourly(stg).count() == 6


def test_latest_state_wins(spark, rows):
    stg = staging.weather(raw_weather(spark, [("a", 1.0, 0, 1), ("a", 2.0, 1, 5), ("a", 1.5, 2, 3)]))
    dim = domains.dim_location(domains.h_location(stg), domains.s_location_details(stg))
    assert rows(dim, "location_key", "latitude", "valid_from") == [("a", 2.0, day(5))]


def test_rows_without_a_required_column_are_dropped(spark):
    assert staging.weather(raw_weather(spark, [(None, 1.0, 0, 1), ("a", 1.0, 0, 1)])).count() == 1


def test_shared_hub_prefers_the_service_id(spark, rows):
    def source(data):
        return spark.createDataFrame(data, "k string, bk string, _loaded_at timestamp_ntz")

    first = source([("k1", "b", day(1)), ("k1", "a", day(2)), ("k2", "z", day(3)), ("k2", "z", day(1))])
    second = source([("k1", "id1", day(5)), ("k3", "id3", day(4))])
    sources = [(first, ["k"], "bk", "files"), (second, ["k"], "bk", "api")]
    hub = vault.load_shared_hub(sources, "hk", "key", preferred="api")
    key = {name: hashlib.md5(name.encode()).hexdigest() for name in ("k1", "k2", "k3")}
    assert rows(hub) == sorted(
        [
            (key["k1"], "id1", day(1), "files"),
            (key["k2"], "z", day(1), "files"),
            (key["k3"], "id3", day(4), "api"),
        ]
    )
    again = vault.load_shared_hub(sources, "hk", "key", preferred="api", target=hub.where("key = 'id1'"))
    assert {row.hk for row in again.collect()} == {key["k2"], key["k3"]}


def versions(df):
    return sorted((row.artist_name[-1], row.followers, row.load_date) for row in df.collect())


def test_version_satellite_over_several_loads(spark):
    first = snapshots(spark, [("x", 1, 0), ("x", 1, 1), ("x", 2, 2), ("y", 5, 0)])
    target = domains.s_artist_profile(first)
    assert versions(target) == [("x", 1, day(0)), ("x", 2, day(2)), ("y", 5, day(0))]
    second = first.unionByName(snapshots(spark, [("x", 1, 3), ("x", 1, 4), ("y", 5, 4), ("z", 1, 4)]))
    added = domains.s_artist_profile(second, target)
    assert versions(added) == [("x", 1, day(3)), ("z", 1, day(4))]
    assert domains.s_artist_profile(second, target.unionByName(added)).count() == 0


def test_late_snapshot_finds_its_place(spark, rows):
    target = domains.s_artist_profile(snapshots(spark, [("x", 1, 0), ("x", 3, 6)]))
    late = domains.s_artist_profile(snapshots(spark, [("x", 2, 3)]), target)
    assert versions(late) == [("x", 2, day(3))]
    hub = spark.createDataFrame([(target.first().artist_hk, "x")], "artist_hk string, artist_bk string")
    dim = domains.dim_artist(hub, target.unionByName(late))
    assert rows(dim, "followers", "valid_from", "valid_to", "version_number") == [
        (1, day(0), day(3), 1),
        (2, day(3), day(6), 2),
        (3, day(6), None, 3),
    ]


def test_late_snapshot_that_repeats_a_later_state_merges(spark, rows):
    target = domains.s_artist_profile(snapshots(spark, [("x", 1, 0), ("x", 3, 6)]))
    late = domains.s_artist_profile(snapshots(spark, [("x", 3, 3)]), target)
    hub = spark.createDataFrame([(target.first().artist_hk, "x")], "artist_hk string, artist_bk string")
    dim = domains.dim_artist(hub, target.unionByName(late))
    assert rows(dim, "followers", "valid_from", "valid_to") == [(1, day(0), day(3)), (3, day(3), None)]


def test_literal_rule_never_takes_a_state_twice(spark):
    first = snapshots(spark, [("x", 1, 0), ("x", 2, 1)])
    columns, hashdiff = domains.PROFILE_COLUMNS, "artist_profile_hashdiff"
    target = vault.load_unseen_satellite(first, columns, hashdiff)
    again = vault.load_unseen_satellite(snapshots(spark, [("x", 1, 2), ("x", 7, 2), ("x", 7, 3)]), columns, hashdiff, target)
    assert versions(again) == [("x", 7, day(2)), ("x", 7, day(3))]


def test_country_names(spark, rows):
    hub = spark.createDataFrame([("1", "de", day(0)), ("2", "Germany", day(0)), ("3", "kr", day(0))], "country_hk string, country_bk string, load_date timestamp_ntz")
    found = domains.dim_country(hub).select("region_code", "country_name")
    assert rows(found) == [("Germany", "GERMANY"), ("de", "Deutschland"), ("kr", "Südkorea")]
    assert domains.dim_country(hub).where(F.length("country_sk") == 32).count() == 3
