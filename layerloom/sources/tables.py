"""Table scans by layer and name, and the folder layout behind them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from layerloom.sources.schemas import RAW_SCHEMAS

LAYERS = ("landing", "raw", "data_vault", "business_vault", "marts")


def table_path(root: str, layer: str, name: str) -> str:
    """``{root}/{layer}/{name}``; the layer name is used as it is."""
    return f"{root.rstrip('/')}/{layer.strip()}/{name}"


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was written at a path. Asks the file system, so it works on any storage Spark can reach."""
    jvm = spark._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def read_table(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    """A stored table. Raw tables are read with their declared schema: the type of a partition column that only
    exists in folder names would otherwise be guessed from its values."""
    reader = spark.read
    if layer == "raw" and name in RAW_SCHEMAS:
        reader = reader.schema(RAW_SCHEMAS[name])
    return reader.parquet(table_path(root, layer, name))


def register_layer(spark: SparkSession, root: str, layer: str, names: list[str]) -> None:
    """Make the tables of a layer known to SQL as ``{layer}__{name}`` views."""
    for name in names:
        read_table(spark, root, layer, name).createOrReplaceTempView(f"{layer}__{name}")


def list_tables(spark: SparkSession, layer: str | None = None) -> list[str]:
    """Names of the tables and views the session knows, those of one layer only if asked."""
    names = sorted(entry.name for entry in spark.catalog.listTables())
    return names if layer is None else [name for name in names if name.startswith(f"{layer}__")]
