"""Landing documents (JSON) read into typed rows.

Every scan is one narrow stage: read with an explicit schema, zip the parallel arrays, explode. No shuffle, no
driver-side loop over files, and a directory of any number of documents is one read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from layerloom.functions.calendar import epoch_to_timestamp
from layerloom.sources import schemas

DAY_IN_NAME = r"(\d{4}-\d{2}-\d{2})"


def files_not_loaded(spark: SparkSession, path: str, loaded: DataFrame) -> list[str]:
    """The ``.json`` files below a path that a raw table does not hold as they are now: it has no row of the file, or the file was written after
    its rows were loaded. Only names and times are read; a list of files is on the driver for every read of a folder."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(F.col("_metadata.file_path").alias("_source_file"), F.col("modificationTime").cast("timestamp_ntz").alias("_written"))
    )
    known = loaded.groupBy("_source_file").agg(F.min("_loaded_at").alias("_loaded_at"))
    left = files.join(known, "_source_file", "left").where(F.col("_loaded_at").isNull() | (F.col("_loaded_at") <= F.col("_written")))
    return [row["_source_file"] for row in left.select("_source_file").collect()]


def read_documents(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    pretty: bool = True,
    mode: str = "FAILFAST",
    files: Sequence[str] | None = None,
) -> DataFrame:
    """All ``.json`` documents below a path, with the file they came from.

    ``pretty``: one document per file, possibly over many lines. False: one document per line, which lets Spark split
    large files. ``files``: only these are opened.
    """
    documents = (
        spark.read.schema(schema)
        .option("multiLine", pretty)
        .option("mode", mode)
        .option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", True)
        .json(path)
    )
    if files is not None:  # a condition on the file alone: the others drop out when the scan lists its files
        documents = documents.where(F.col("_metadata.file_path").isin(*files) if files else F.lit(False))
    return documents.select("*", F.col("_metadata.file_path").alias("_source_file"))


def day_in_file_name(source_file: Column) -> Column:
    """The day that names a landing file (``.../2024-01-31.json``), or NULL."""
    name = F.element_at(F.split(source_file, "/"), -1)
    return F.regexp_extract(name, DAY_IN_NAME, 1).try_cast("date")


def with_lineage(df: DataFrame, loaded_at: str | Column, source_file: str | Column = "_source_file") -> DataFrame:
    """Append ``_source_file`` and ``_loaded_at`` as the last two columns."""
    file_column = F.col(source_file) if isinstance(source_file, str) else source_file
    loaded = F.lit(loaded_at) if isinstance(loaded_at, str) else loaded_at
    rest = [name for name in df.columns if name not in ("_source_file", "_loaded_at")]
    return df.select(
        *rest, file_column.alias("_source_file"), loaded.cast("timestamp_ntz").alias("_loaded_at")
    )


def zip_arrays(arrays: Mapping[str, Column]) -> Column:
    """Parallel arrays as one array of structs.

    A missing array becomes an empty one first: arrays_zip pads short arrays with NULL, but returns NULL as a whole
    for a NULL input, which would lose all rows of the document.
    """
    padded = [F.coalesce(array, F.array()).alias(name) for name, array in arrays.items()]
    return F.arrays_zip(*padded)


def explode_series(documents: DataFrame, keep: Mapping[str, Column], arrays: Mapping[str, Column]) -> DataFrame:
    """One row per position of the first array, which is the leading one: longer arrays beside it add no rows."""
    leading = next(iter(arrays))
    rows = documents.select(
        *[column.alias(name) for name, column in keep.items()], F.explode(zip_arrays(arrays)).alias("reading")
    )
    return rows.where(F.col(f"reading.{leading}").isNotNull()).select(
        *keep, *[F.col(f"reading.{name}").alias(name) for name in arrays]
    )


def weather_rows(documents: DataFrame, loaded_at: str | Column) -> DataFrame:
    """Column-oriented weather documents -> raw weather_hourly. The date is the document's day, not the reading's."""
    measures = [
        "temperature_2m",
        "apparent_temperature",
        "precipitation",
        "windspeed_10m",
        "weathercode",
        "relative_humidity_2m",
    ]
    rows = explode_series(
        documents,
        keep={
            "date_key": F.col("_meta.fetch_date").cast("date"),
            "location_key": F.col("_meta.location_key"),
            "latitude": F.col("latitude"),
            "longitude": F.col("longitude"),
            "_source_file": F.col("_source_file"),
        },
        arrays={"time": F.col("hourly.time"), **{name: F.col(f"hourly.{name}") for name in measures}},
    )
    typed = rows.withColumns(
        {
            "timestamp": F.col("time").cast("timestamp_ntz"),
            "hour": F.hour(F.col("time").cast("timestamp_ntz")),
            "weathercode": F.col("weathercode").cast("int"),
        }
    )
    return _as_raw(typed, "weather_hourly", loaded_at)


def price_rows(documents: DataFrame, loaded_at: str | Column) -> DataFrame:
    """Epoch/value price documents -> raw energy_price_hourly.

    ``timestamp`` and ``hour`` are UTC; ``date_key`` is the local day the document was requested for, so the first
    readings of a day may carry the UTC date before it.
    """
    rows = explode_series(
        documents,
        keep={
            "date_key": F.col("_meta.fetch_date").cast("date"),
            "bidding_zone": F.col("_meta.bidding_zone"),
            "_source_file": F.col("_source_file"),
        },
        arrays={"unix_seconds": F.col("unix_seconds"), "price_eur_mwh": F.col("price")},
    )
    utc = epoch_to_timestamp(F.col("unix_seconds"))
    return _as_raw(rows.withColumns({"timestamp": utc, "hour": F.hour(utc)}), "energy_price_hourly", loaded_at)


def artist_rows(documents: DataFrame, loaded_at: str | Column) -> DataFrame:
    """Artist snapshot documents -> raw spotify_artist_snapshots."""
    rows = documents.select(
        F.explode("artists").alias("artist"), F.col("_meta.snapshot_date").alias("document_date"), "_source_file"
    ).select(
        "artist.artist_id",
        "artist.artist_name",
        F.coalesce("artist.genres", F.lit("")).alias("genres"),
        "artist.popularity",
        "artist.followers",
        F.coalesce("document_date", "artist.snapshot_date").cast("date").alias("snapshot_date"),
        "_source_file",
    )
    return _as_raw(rows, "spotify_artist_snapshots", loaded_at)


def artist_from_service(item: Column) -> Column:
    """One artist object of the service's answer as the landed struct: genre list joined, follower total lifted."""
    return F.struct(
        item["id"].alias("artist_id"),
        item["name"].alias("artist_name"),
        F.array_join(F.coalesce(item["genres"], F.array()), ", ").alias("genres"),
        item["popularity"].alias("popularity"),
        item["followers"]["total"].alias("followers"),
    )


def query_rows(documents: DataFrame) -> DataFrame:
    """Rows of wrapped query results, dated with the document's day; an empty result gives no rows."""
    return documents.select(
        F.col("query_date").cast("date").alias("query_date"), F.explode("data").alias("row")
    ).select("query_date", "row.*")


def miscounted_documents(documents: DataFrame) -> DataFrame:
    """Wrapped query results whose row_count does not equal the number of rows they carry."""
    rows = F.coalesce(F.size("data"), F.lit(0))
    return documents.where(~F.col("row_count").eqNullSafe(rows.cast("bigint"))).select(
        "_source_file", "query_date", "source", "row_count", rows.alias("rows_found")
    )


def _as_raw(df: DataFrame, table: str, loaded_at: str | Column) -> DataFrame:
    names = [field.name for field in schemas.RAW_SCHEMAS[table].fields]
    return with_lineage(df, loaded_at).select(*names)
