"""CSV landing files read into typed rows.

All columns are read as text and typed in the projection above the scan, so the CSV parser still prunes the columns
nobody asks for and large files are split.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from layerloom.functions.values import (
    blank_to_null,
    marker_to_null,
    safe_boolean,
    safe_double,
    safe_int,
    safe_long,
)
from layerloom.sources import quoted, schemas
from layerloom.sources.landing import with_lineage

# Source column -> raw column, and the regions the filtered chart load keeps.
CHART_COLUMNS = {
    "title": "track_name",
    "rank": "position",
    "date": "chart_date",
    "artist": "artist_name",
    "url": "url",
    "region": "region",
    "chart": "chart_type",
    "trend": "trend",
    "streams": "streams",
}
TRACK_RENAMES = {"artists": "artist_name", "key": "musical_key", "mode": "musical_mode"}
CHART_REGIONS = ("Germany", "Austria", "Switzerland", "United States", "Global")

SAFE_BY_TYPE = {
    T.IntegerType: safe_int,
    T.LongType: safe_long,
    T.DoubleType: safe_double,
    T.BooleanType: safe_boolean,
}


def read_text_columns(
    spark: SparkSession,
    path: str,
    *,
    columns: Sequence[str] | None = None,
    separator: str = ",",
    encoding: str = "UTF-8",
    multiline: bool = False,
) -> DataFrame:
    """CSV files with a header, every column as text, plus ``_source_file``.

    With ``columns`` the header is only checked, otherwise it is read first. Bytes that are invalid in the encoding
    become the replacement character. ``multiline`` allows line breaks inside quotes: files that hold such are found by
    counting quotes and read in splits too (``sources/quoted.py``); only a file whose quotes are not paired, or one in
    another encoding than UTF-8, is read by a single task.
    """
    form = {"sep": separator, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    reader = spark.read.options(header=True, encoding=encoding, **form)
    if columns is not None:
        text = T.StructType([T.StructField(name, T.StringType()) for name in columns])
        reader = reader.schema(text).option("enforceSchema", False)
    source = F.col("_metadata.file_path").alias("_source_file")
    if not multiline:
        return reader.csv(path).select("*", source)
    if encoding.upper().replace("-", "") != "UTF8":
        return reader.option("multiLine", True).csv(path).select("*", source)

    files = quoted.files_by_quoting(spark, path)
    plain = reader.csv(path).select("*", source)
    found = [plain.where(F.col("_metadata.file_path").isin(*files["plain"]))] if files["plain"] else []
    names = plain.columns[:-1]
    if files["broken"]:
        found.append(_quoted_rows(spark, path, files["broken"], names, form))
    if files["unpaired"]:
        whole = reader.schema(plain.drop("_source_file").schema).option("multiLine", True).csv(path)
        found.append(whole.select("*", source).where(F.col("_metadata.file_path").isin(*files["unpaired"])))
    return reduce(DataFrame.unionByName, found) if found else plain


def _quoted_rows(spark: SparkSession, path: str, files: Sequence[str], names: Sequence[str], form: dict[str, str]) -> DataFrame:
    """The rows of files with line breaks in quotes; all must have the same header."""
    records = quoted.quoted_records(spark, path, files)
    header = F.from_csv("value", ", ".join(f"_c{i} string" for i in range(len(names) + 1)), form)
    expected = F.array(*[F.lit(name) for name in names], F.lit(None).cast("string"))
    actual = F.array(*[header[f"_c{i}"] for i in range(len(names) + 1)])
    other = records.where("_first").where(~actual.eqNullSafe(expected)).select("_file").limit(5).collect()
    if other:
        raise ValueError(f"files with another header than {list(names)}: {[row['_file'] for row in other]}")
    row = quoted.parsed(F.col("value"), names, form)
    return records.where("not _first").select(row.alias("row"), F.col("_file").alias("_source_file")).select("row.*", "_source_file")


def typed_strict(text: Column, data_type: T.DataType) -> Column:
    """Bulk rule: "" and "NULL" are NULL, anything else must convert (a bad value fails the load)."""
    return marker_to_null(text).cast(data_type)


def typed_lenient(text: Column, data_type: T.DataType) -> Column:
    """Row rule: blank or unconvertible values are NULL."""
    safe = SAFE_BY_TYPE.get(type(data_type))
    if safe is not None:
        return safe(text)
    if isinstance(data_type, T.StringType):
        return blank_to_null(text)
    return blank_to_null(text).try_cast(data_type)


def typed_rows(
    text: DataFrame, table: str, renames: Mapping[str, str], loaded_at: str | Column, *, lenient: bool
) -> DataFrame:
    """Rename source columns to the raw table's names and type them; columns the table does not have are dropped."""
    source_of = {target: source for source, target in renames.items()}
    convert = typed_lenient if lenient else typed_strict
    fields = [field for field in schemas.RAW_SCHEMAS[table].fields if not field.name.startswith("_")]
    typed = text.select(
        *[convert(F.col(source_of.get(f.name, f.name)), f.dataType).alias(f.name) for f in fields], "_source_file"
    )
    return with_lineage(typed, loaded_at)


def chart_rows(text: DataFrame, loaded_at: str | Column) -> DataFrame:
    """Bulk chart load: all regions, strict typing."""
    return typed_rows(text, "spotify_charts", CHART_COLUMNS, loaded_at, lenient=False)


def chart_rows_of_regions(
    text: DataFrame, loaded_at: str | Column, regions: Sequence[str] = CHART_REGIONS
) -> DataFrame:
    """Filtered chart load: rows without a date are skipped, only the listed regions are kept, lenient typing."""
    kept = text.where((F.col("date") != "") & F.col("region").isin(*regions))
    return typed_rows(kept, "spotify_charts", CHART_COLUMNS, loaded_at, lenient=True)


def track_rows(text: DataFrame, loaded_at: str | Column) -> DataFrame:
    """Track load with the renamed columns, lenient typing."""
    return typed_rows(text, "spotify_tracks", TRACK_RENAMES, loaded_at, lenient=True)
