"""The three domains as configurations of the generic operators: weather, energy prices, music.

Every model is a function of the tables it reads; incremental ones also take the current target and return the rows
to append.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from layerloom.operators import dims, facts, marts, staging, vault
from layerloom.operators.history import HotKeys

# --- hubs and link ----------------------------------------------------------------------------------------------------


def h_location(stg: DataFrame, target: DataFrame | None = None) -> DataFrame:
    return vault.load_hub(stg, "location_hk", "location_key", "location_bk", "open-meteo", target)


def h_price_zone(stg: DataFrame, target: DataFrame | None = None) -> DataFrame:
    return vault.load_hub(stg, "price_zone_hk", "bidding_zone", "zone_bk", "energy-charts", target)


def h_track(stg: DataFrame, target: DataFrame | None = None) -> DataFrame:
    return vault.load_hub(stg, "track_hk", "track_id", "track_bk", "spotify-kaggle", target)


def h_country(stg: DataFrame, target: DataFrame | None = None) -> DataFrame:
    return vault.load_hub(stg, "country_hk", "region", "country_bk", "spotify-kaggle", target)


def h_artist(stg_track: DataFrame, stg_snapshot: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Two key domains in one hub: the normalised name in the track files, the service's id in the snapshots."""
    sources = [
        (stg_track, ["artist_bk"], "artist_bk", "spotify-kaggle"),
        (stg_snapshot, ["artist_id"], "artist_id", "spotify-api"),
    ]
    return vault.load_shared_hub(sources, "artist_hk", "artist_bk", "spotify-api", target)


def l_track_artist(stg: DataFrame, target: DataFrame | None = None) -> DataFrame:
    return vault.load_link(
        stg,
        "track_artist_hk",
        ["track_id", "artist_bk"],
        {"track_hk": ["track_id"], "artist_hk": ["artist_bk"]},
        "spotify-kaggle",
        target,
    )


# --- satellites -------------------------------------------------------------------------------------------------------


def s_location_details(stg: DataFrame, target: DataFrame | None = None) -> DataFrame:
    attributes = ["location_key", "latitude", "longitude"]
    return vault.load_state_satellite(
        stg, "location_hk", "location_hashdiff", staging.WEATHER_KEYS, attributes, "open-meteo", target
    )


def s_track_details(
    stg: DataFrame, target: DataFrame | None = None, *, full_hashdiff: bool = True
) -> DataFrame:
    keys = staging.track_keys(full_hashdiff=full_hashdiff)
    return vault.load_state_satellite(
        stg, "track_hk", "track_hashdiff", keys, staging.DETAIL_COLUMNS, "spotify-kaggle", target
    )


def s_track_audio_features(
    stg: DataFrame, target: DataFrame | None = None, *, full_hashdiff: bool = True
) -> DataFrame:
    keys = staging.track_keys(full_hashdiff=full_hashdiff)
    return vault.load_state_satellite(
        stg, "track_hk", "audio_hashdiff", keys, staging.AUDIO_COLUMNS, "spotify-kaggle", target
    )


PROFILE_COLUMNS = [
    "artist_hk", "artist_profile_hashdiff", "artist_name", "genres", "popularity", "followers", "snapshot_date",
]


def s_artist_profile(
    stg: DataFrame, target: DataFrame | None = None, *, hot: HotKeys | None = None
) -> DataFrame:
    return vault.load_version_satellite(
        stg, "artist_hk", PROFILE_COLUMNS, "artist_profile_hashdiff", target, hot=hot
    )


WEATHER_COLUMNS = ["location_hk", "weather_hashdiff", "measured_at", "date_key", "hour", *staging.WEATHER_MEASURES]
PRICE_COLUMNS = ["price_zone_hk", "price_hashdiff", "measured_at", "date_key", "hour", "price_eur_mwh"]
CHART_COLUMNS = [
    "chart_hashdiff", "country_hk", "chart_date", "position", "track_name", "artist_name", "streams", "region",
    "chart_type", "trend", "url",
]


def s_weather_hourly(stg: DataFrame, target: DataFrame | None = None, *, correctable: bool = False) -> DataFrame:
    if correctable:
        return vault.load_correctable_satellite(stg, ["location_hk", "measured_at"], WEATHER_COLUMNS, "weather_hashdiff", target)
    return vault.load_event_satellite(stg, WEATHER_COLUMNS, "weather_hashdiff", target)


def s_energy_price_hourly(stg: DataFrame, target: DataFrame | None = None, *, correctable: bool = False) -> DataFrame:
    if correctable:
        return vault.load_correctable_satellite(stg, ["price_zone_hk", "measured_at"], PRICE_COLUMNS, "price_hashdiff", target)
    return vault.load_event_satellite(stg, PRICE_COLUMNS, "price_hashdiff", target)


def s_chart_entry(stg: DataFrame, target: DataFrame | None = None) -> DataFrame:
    return vault.load_event_satellite(stg, CHART_COLUMNS, "chart_hashdiff", target, whole_rows=True)


# --- dimensions -------------------------------------------------------------------------------------------------------


def dim_location(hub: DataFrame, details: DataFrame) -> DataFrame:
    return dims.current_dimension(
        hub, details, "location_sk", "location_hk", "location_bk", "location_key", "location_hashdiff",
        ["latitude", "longitude"],
    )


def dim_price_zone(hub: DataFrame) -> DataFrame:
    return dims.hub_dimension(hub, "price_zone_sk", "price_zone_hk", "zone_bk", "bidding_zone")


def dim_country(hub: DataFrame) -> DataFrame:
    return dims.lookup_dimension(hub, "country_sk", "country_hk", "country_bk", "region_code", "country_name")


def dim_track(hub: DataFrame, details: DataFrame, features: DataFrame) -> DataFrame:
    return dims.current_dimension_with_extra(
        hub,
        details,
        features,
        "track_sk",
        "track_hk",
        "track_bk",
        "track_id",
        hashdiff="track_hashdiff",
        attributes=staging.DETAIL_COLUMNS,
        extra_hashdiff="audio_hashdiff",
        extra_attributes=staging.AUDIO_COLUMNS,
    )


def dim_artist(hub: DataFrame, profile: DataFrame, *, hot: HotKeys | None = None) -> DataFrame:
    return dims.versioned_dimension(
        hub, profile, "artist_sk", "artist_hk", "artist_bk", "artist_profile_hashdiff",
        ["artist_name", "genres", "popularity", "followers"], hot=hot,
    )


# --- facts ------------------------------------------------------------------------------------------------------------


def fact_weather_hourly(satellite: DataFrame, dimension: DataFrame, target: DataFrame | None = None) -> DataFrame:
    rows = facts.since_watermark(satellite, target, "load_date")
    return facts.reading_fact(rows, dimension, "location_sk", "location_hk", staging.WEATHER_MEASURES)


def fact_energy_price_hourly(satellite: DataFrame, dimension: DataFrame, target: DataFrame | None = None) -> DataFrame:
    rows = facts.since_watermark(satellite, target, "load_date")
    return facts.reading_fact(rows, dimension, "price_zone_sk", "price_zone_hk", ["price_eur_mwh"])


def fact_chart_entry(satellite: DataFrame, dimension: DataFrame, target: DataFrame | None = None) -> DataFrame:
    rows = facts.since_watermark(satellite, target, "load_date")
    columns = ["track_name", "artist_name", "chart_date", "position", "streams", "region", "chart_type", "trend", "url"]
    return facts.entry_fact(rows, dimension, "country_sk", "country_hk", "chart_hashdiff", "chart_date", columns)


def fact_weather_daily(
    hourly: DataFrame, target: DataFrame | None = None, *, lookback: str | None = None
) -> DataFrame:
    return facts.weather_daily(facts.since_watermark(hourly, target, "date_key", lookback=lookback))


def fact_energy_price_daily(
    hourly: DataFrame, target: DataFrame | None = None, *, lookback: str | None = None
) -> DataFrame:
    return facts.energy_price_daily(facts.since_watermark(hourly, target, "date_key", lookback=lookback))


def fact_energy_price_monthly(daily: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Months from the target's newest one on are aggregated again: its month may have got new days."""
    if target is not None:
        target = target.select("date_key")
    return facts.energy_price_monthly(facts.since_watermark(daily, target, "date_key", lookback="0 days"))


# --- marts ------------------------------------------------------------------------------------------------------------


def weather_trends(daily: DataFrame, calendar: DataFrame, dimension: DataFrame, as_of: str) -> DataFrame:
    return marts.trend_mart(daily, calendar, dimension, as_of, marts.WEATHER_TRENDS)


def energy_price_trends(daily: DataFrame, calendar: DataFrame, dimension: DataFrame, as_of: str) -> DataFrame:
    return marts.trend_mart(daily, calendar, dimension, as_of, marts.ENERGY_PRICE_TRENDS)


def artist_chart_performance(entries: DataFrame, calendar: DataFrame) -> DataFrame:
    return marts.performance_mart(entries, calendar, marts.ARTIST_CHART_PERFORMANCE)
