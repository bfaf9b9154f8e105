"""Staging: raw rows with hash keys, casts, required columns and a source tag, as one projection over the scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from layerloom.functions.keys import with_keys
from layerloom.functions.values import business_name


def stage(
    raw: DataFrame,
    *,
    keys: Mapping[str, Sequence[str]],
    columns: Sequence[str],
    required: Sequence[str],
    record_source: str,
    casts: Mapping[str, str] | None = None,
    renames: Mapping[str, str] | None = None,
    derive: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Filter, derive, cast, hash and tag.

    ``keys`` hash the typed values under their raw names, so a load that hashes grouped staging rows gets the same
    keys; ``columns`` are the raw or derived columns to carry, ``renames`` give some of them another name.
    """
    rows = raw.dropna(subset=list(required))
    computed = {**(derive or {}), **{name: F.col(name).cast(data_type) for name, data_type in (casts or {}).items()}}
    if computed:
        rows = rows.withColumns(computed)
    renames = renames or {}
    return with_keys(rows, keys).select(
        *keys,
        *[F.col(name).alias(renames.get(name, name)) for name in columns],
        "_source_file",
        "_loaded_at",
        F.lit(record_source).alias("record_source"),
    )


# Which columns enter which key. Keys of existing tables depend on them.
WEATHER_KEYS = {
    "location_hk": ["location_key"],
    "location_hashdiff": ["location_key", "latitude", "longitude"],
    "weather_hashdiff": ["location_key", "timestamp"],
}
PRICE_KEYS = {"price_zone_hk": ["bidding_zone"], "price_hashdiff": ["bidding_zone", "timestamp"]}
NARROW_CHART_KEY = ["track_name", "artist_name", "chart_date", "region"]
WIDE_CHART_KEY = [*NARROW_CHART_KEY, "chart_type", "position"]
PROFILE_KEYS = {
    "artist_hk": ["artist_id"],
    "artist_profile_hashdiff": ["artist_id", "artist_name", "genres", "popularity", "followers"],
}
DETAIL_INPUTS = ["track_id", "track_name", "album_name", "duration_ms", "explicit"]
AUDIO_INPUTS = [
    "danceability", "energy", "musical_key", "loudness", "musical_mode", "speechiness", "acousticness",
    "instrumentalness", "liveness", "valence", "tempo",
]

WEATHER_MEASURES = [
    "temperature_2m", "apparent_temperature", "precipitation", "windspeed_10m", "weathercode", "relative_humidity_2m",
]
DETAIL_COLUMNS = ["track_name", "album_name", "duration_ms", "explicit", "popularity", "track_genre"]
AUDIO_COLUMNS = [*AUDIO_INPUTS, "time_signature"]
INTEGER_AUDIO = ("musical_key", "musical_mode", "time_signature")


def weather(raw: DataFrame, *, correctable: bool = False) -> DataFrame:
    """``correctable``: the hashdiff covers the measures, so a corrected reading is a new row of the satellite."""
    doubles = ["latitude", "longitude", *[name for name in WEATHER_MEASURES if name != "weathercode"]]
    return stage(
        raw,
        keys={**WEATHER_KEYS, "weather_hashdiff": [*WEATHER_KEYS["weather_hashdiff"], *(WEATHER_MEASURES if correctable else [])]},
        columns=["timestamp", "date_key", "hour", "location_key", "latitude", "longitude", *WEATHER_MEASURES],
        casts={**{name: "double" for name in doubles}, "weathercode": "int"},
        renames={"timestamp": "measured_at"},
        required=["timestamp", "location_key"],
        record_source="open-meteo",
    )


def energy_price(raw: DataFrame, *, correctable: bool = False) -> DataFrame:
    """``correctable``: as in weather."""
    return stage(
        raw,
        keys={**PRICE_KEYS, "price_hashdiff": [*PRICE_KEYS["price_hashdiff"], *(["price_eur_mwh"] if correctable else [])]},
        columns=["timestamp", "date_key", "hour", "bidding_zone", "price_eur_mwh"],
        casts={"price_eur_mwh": "double"},
        renames={"timestamp": "measured_at"},
        required=["timestamp", "bidding_zone"],
        record_source="energy-charts",
    )


def track_keys(*, full_hashdiff: bool = True) -> dict[str, list[str]]:
    """``full_hashdiff``: the hashdiffs cover every attribute their satellite holds, so one hashdiff is one state.
    False leaves popularity, genre and time signature out, as existing keys may have been built."""
    return {
        "track_hk": ["track_id"],
        "artist_hk": ["artist_bk"],
        "track_hashdiff": [*DETAIL_INPUTS, "popularity", "track_genre"] if full_hashdiff else DETAIL_INPUTS,
        "audio_hashdiff": ["track_id", *(AUDIO_COLUMNS if full_hashdiff else AUDIO_INPUTS)],
    }


def track(raw: DataFrame, *, full_hashdiff: bool = True) -> DataFrame:
    casts = {name: "int" if name in INTEGER_AUDIO else "double" for name in AUDIO_COLUMNS}
    return stage(
        raw,
        derive={"artist_bk": business_name(F.col("artist_name"))},
        keys=track_keys(full_hashdiff=full_hashdiff),
        columns=[
            "track_id", "artist_bk", "track_name", "artist_name", "album_name", "popularity", "duration_ms",
            "explicit", "track_genre", *AUDIO_COLUMNS,
        ],
        casts={**casts, "popularity": "int", "duration_ms": "int"},
        required=["track_id", "artist_name"],
        record_source="spotify-kaggle",
    )


def chart(raw: DataFrame, *, wide_key: bool = True) -> DataFrame:
    """``wide_key``: one track may stand in several charts of a day, or several times in one, and each is an entry of its own.
    False leaves chart type and position out of the key, as existing keys may have been built."""
    return stage(
        raw,
        keys={"chart_hashdiff": WIDE_CHART_KEY if wide_key else NARROW_CHART_KEY, "country_hk": ["region"]},
        columns=[
            "chart_date", "position", "track_name", "artist_name", "streams", "region", "chart_type", "trend", "url",
        ],
        casts={"position": "int", "streams": "bigint"},
        required=["chart_date", "track_name", "region"],
        record_source="spotify-kaggle",
    )


def artist_snapshot(raw: DataFrame) -> DataFrame:
    return stage(
        raw,
        keys=PROFILE_KEYS,
        columns=["artist_id", "artist_name", "genres", "popularity", "followers", "snapshot_date"],
        casts={"popularity": "int", "followers": "bigint"},
        required=["artist_id"],
        record_source="spotify-api",
    )
