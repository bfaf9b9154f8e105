"""Landing to raw: each load reads landed files and replaces the slices they carry in the raw table.

Every load can be repeated. A load over a folder of many days is one job, not one per day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F

from layerloom.operators import sinks
from layerloom.sources import delimited, jdbc, landing, schemas
from layerloom.sources.tables import read_table, table_exists, table_path


def _replace(spark: SparkSession, root: str, name: str, rows: DataFrame) -> None:
    path = table_path(root, "raw", name)
    sinks.replace_slices(spark, rows, path, schemas.RAW_PARTITIONS[name], schemas.RAW_SLICES[name])


def load_weather(spark: SparkSession, root: str, landed: str, loaded_at: str, *, pretty: bool = True) -> None:
    documents = landing.read_documents(spark, landed, schemas.WEATHER_DOCUMENT, pretty=pretty)
    _replace(spark, root, "weather_hourly", landing.weather_rows(documents, loaded_at))


def load_prices(spark: SparkSession, root: str, landed: str, loaded_at: str, *, pretty: bool = True) -> None:
    documents = landing.read_documents(spark, landed, schemas.PRICE_DOCUMENT, pretty=pretty)
    _replace(spark, root, "energy_price_hourly", landing.price_rows(documents, loaded_at))


def load_missing_prices(spark: SparkSession, root: str, landed: str, loaded_at: str, *, pretty: bool = True) -> None:
    """Backfill: only documents whose day and zone the raw table does not hold yet. Files that it holds as they are now are not opened."""
    keys = schemas.RAW_SLICES["energy_price_hourly"]
    if not table_exists(spark, table_path(root, "raw", "energy_price_hourly")):
        return load_prices(spark, root, landed, loaded_at, pretty=pretty)
    loaded = read_table(spark, root, "raw", "energy_price_hourly")
    files = landing.files_not_loaded(spark, landed, loaded)
    if not files:
        return
    documents = landing.read_documents(spark, landed, schemas.PRICE_DOCUMENT, pretty=pretty, files=files)
    rows = landing.price_rows(documents, loaded_at)
    missing = sinks.slices_to_load(rows.select(*keys).distinct(), loaded, keys)
    _replace(spark, root, "energy_price_hourly", rows.join(missing, keys, "left_semi"))


def load_artist_snapshots(spark: SparkSession, root: str, landed: str, loaded_at: str, *, pretty: bool = True) -> None:
    documents = landing.read_documents(spark, landed, schemas.ARTIST_DOCUMENT, pretty=pretty)
    _replace(spark, root, "spotify_artist_snapshots", landing.artist_rows(documents, loaded_at))


def load_tracks(spark: SparkSession, root: str, landed: str, loaded_at: str, *, multiline: bool = True) -> None:
    """The rows of the source files are replaced; the table is partitioned by file, so no other file's rows are touched. ``multiline``: line
    breaks in quotes are allowed, which costs a pass that counts quotes; large files are read in splits either way."""
    text = delimited.read_text_columns(spark, landed, multiline=multiline)
    sinks.replace_source_files(spark, delimited.track_rows(text, loaded_at), table_path(root, "raw", "spotify_tracks"))


def load_all_charts(spark: SparkSession, root: str, landed: str, loaded_at: str) -> None:
    """Bulk load: the whole table is replaced."""
    text = delimited.read_text_columns(spark, landed, columns=list(delimited.CHART_COLUMNS))
    path = table_path(root, "raw", "spotify_charts")
    sinks.overwrite_table(sinks.with_file_key(delimited.chart_rows(text, loaded_at)), path, ["file_key"], record=True)


def load_charts_of_regions(
    spark: SparkSession, root: str, landed: str, loaded_at: str, regions: Sequence[str] = delimited.CHART_REGIONS
) -> None:
    """Filtered load: the rows of the source files are replaced, in their own partitions."""
    text = delimited.read_text_columns(spark, landed, columns=list(delimited.CHART_COLUMNS))
    rows = delimited.chart_rows_of_regions(text, loaded_at, regions)
    sinks.replace_source_files(spark, rows, table_path(root, "raw", "spotify_charts"))


def land_query_result(
    spark: SparkSession, reader: DataFrameReader, query: str, landed: str, query_date: str, source: str
) -> None:
    """A database report, run by the database, as a landed document."""
    result = jdbc.lower_case_names(jdbc.read_query(reader, query))
    sinks.write_query_document(spark, result, landed, query_date, source)


def load_query_result(spark: SparkSession, root: str, name: str, landed: str) -> None:
    """A landed report into its raw table, by query date. Names of other cases are matched, zeros stay zeros. A document that does not carry as
    many rows as it says stops the load."""
    fields = [field for field in schemas.RAW_SCHEMAS[name].fields if field.name != "query_date"]
    row = schemas.struct(**{field.name: field.dataType for field in fields})
    documents = landing.read_documents(spark, landed, schemas.query_document(row), pretty=False)
    torn = landing.miscounted_documents(documents).limit(5).collect()
    if torn:
        raise ValueError(f"documents with another number of rows than they say: {[row['_source_file'] for row in torn]}")
    rows = landing.query_rows(documents).select("query_date", *[F.col(field.name) for field in fields])
    _replace(spark, root, name, rows)
