"""Raw-layer and landing-document schemas. Nothing is inferred.

Column names and types are fixed values: they are the raw tables' interface.
"""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
BOOL, DATE, TIMESTAMP = T.BooleanType(), T.DateType(), T.TimestampNTZType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, data_type) for name, data_type in fields.items()])


LINEAGE = {"_source_file": TEXT, "_loaded_at": TIMESTAMP}

RAW_SCHEMAS: dict[str, T.StructType] = {
    "weather_hourly": struct(
        timestamp=TIMESTAMP,
        date_key=DATE,
        hour=INT,
        location_key=TEXT,
        latitude=DOUBLE,
        longitude=DOUBLE,
        temperature_2m=DOUBLE,
        apparent_temperature=DOUBLE,
        precipitation=DOUBLE,
        windspeed_10m=DOUBLE,
        weathercode=INT,
        relative_humidity_2m=DOUBLE,
        **LINEAGE,
    ),
    "energy_price_hourly": struct(
        timestamp=TIMESTAMP, date_key=DATE, hour=INT, bidding_zone=TEXT, price_eur_mwh=DOUBLE, **LINEAGE
    ),
    "spotify_tracks": struct(
        track_id=TEXT,
        track_name=TEXT,
        artist_name=TEXT,
        album_name=TEXT,
        popularity=INT,
        duration_ms=INT,
        explicit=BOOL,
        danceability=DOUBLE,
        energy=DOUBLE,
        musical_key=INT,
        loudness=DOUBLE,
        musical_mode=INT,
        speechiness=DOUBLE,
        acousticness=DOUBLE,
        instrumentalness=DOUBLE,
        liveness=DOUBLE,
        valence=DOUBLE,
        tempo=DOUBLE,
        time_signature=INT,
        track_genre=TEXT,
        **LINEAGE,
    ),
    "spotify_charts": struct(
        chart_date=DATE,
        position=INT,
        track_name=TEXT,
        artist_name=TEXT,
        streams=LONG,
        region=TEXT,
        chart_type=TEXT,
        trend=TEXT,
        url=TEXT,
        **LINEAGE,
    ),
    "spotify_artist_snapshots": struct(
        artist_id=TEXT,
        artist_name=TEXT,
        genres=TEXT,
        popularity=INT,
        followers=LONG,
        snapshot_date=DATE,
        **LINEAGE,
    ),
    "rnacentral_stats": struct(
        query_date=DATE, source_database=TEXT, sequence_count=LONG, min_length=INT, max_length=INT, avg_length=INT
    ),
    "oracle_tables": struct(
        query_date=DATE,
        owner=TEXT,
        table_name=TEXT,
        tablespace_name=TEXT,
        num_rows=LONG,
        blocks=INT,
        avg_row_kb=DOUBLE,
        last_analyzed=TEXT,
    ),
    "db2_tables": struct(
        query_date=DATE,
        schema_name=TEXT,
        table_name=TEXT,
        table_type=TEXT,
        estimated_rows=LONG,
        data_pages=INT,
        remarks=TEXT,
    ),
}

RAW_PARTITIONS: dict[str, list[str]] = {
    "weather_hourly": ["date_key"],
    "energy_price_hourly": ["date_key"],
    "spotify_tracks": [],
    "spotify_charts": ["region"],
    "spotify_artist_snapshots": ["snapshot_date"],
    "rnacentral_stats": ["query_date"],
    "oracle_tables": ["query_date"],
    "db2_tables": ["query_date"],
}

# Rows that are replaced together when a slice is loaded again.
RAW_SLICES: dict[str, list[str]] = {
    "weather_hourly": ["date_key", "location_key"],
    "energy_price_hourly": ["date_key", "bidding_zone"],
    "spotify_tracks": ["_source_file"],
    "spotify_charts": ["_source_file"],
    "spotify_artist_snapshots": ["snapshot_date"],
    "rnacentral_stats": ["query_date"],
    "oracle_tables": ["query_date"],
    "db2_tables": ["query_date"],
}

WEATHER_DOCUMENT = struct(
    latitude=DOUBLE,
    longitude=DOUBLE,
    hourly=struct(
        time=T.ArrayType(TEXT),
        temperature_2m=T.ArrayType(DOUBLE),
        apparent_temperature=T.ArrayType(DOUBLE),
        precipitation=T.ArrayType(DOUBLE),
        windspeed_10m=T.ArrayType(DOUBLE),
        weathercode=T.ArrayType(DOUBLE),
        relative_humidity_2m=T.ArrayType(DOUBLE),
    ),
    _meta=struct(location_key=TEXT, fetch_date=TEXT, source=TEXT),
)

PRICE_DOCUMENT = struct(
    unix_seconds=T.ArrayType(LONG),
    price=T.ArrayType(DOUBLE),
    license_info=TEXT,
    _meta=struct(bidding_zone=TEXT, fetch_date=TEXT, source=TEXT, license=TEXT),
)

ARTIST_DOCUMENT = struct(
    artists=T.ArrayType(
        struct(artist_id=TEXT, artist_name=TEXT, genres=TEXT, popularity=INT, followers=LONG, snapshot_date=TEXT)
    ),
    _meta=struct(
        snapshot_date=TEXT, source=TEXT, total_queried=LONG, total_found=LONG, total_skipped=LONG, checkpoints=LONG
    ),
)


def query_document(row: T.StructType) -> T.StructType:
    """Document that wraps a query result: header fields and the rows."""
    return struct(query_date=TEXT, source=TEXT, row_count=LONG, data=T.ArrayType(row))
