"""Database sources: query scans through JDBC, and the same report shapes as DataFrame functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F

# Schemas owned by the database system, which the catalog reports leave out.
ORACLE_SYSTEM_OWNERS = (
    "SYS", "SYSTEM", "OUTLN", "DBSNMP", "APPQOSSYS", "DBSFWUSER", "GGSYS", "ANONYMOUS", "CTXSYS", "DVSYS", "DVF",
    "GSMADMIN_INTERNAL", "MDSYS", "OLAPSYS", "ORDDATA", "ORDSYS", "ORDPLUGINS", "SI_INFORMTN_SCHEMA", "WMSYS", "XDB",
    "APEX_PUBLIC_USER", "FLOWS_FILES", "LBACSYS", "REMOTE_SCHEDULER_AGENT",
)
DB2_SYSTEM_SCHEMAS = ("SYSIBM", "SYSCAT", "SYSSTAT", "SYSPROC", "SYSIBMTS", "SYSTOOLS", "NULLID", "SQLJ")


def jdbc_reader(spark: SparkSession, url: str, driver: str, *, fetch_size: int = 10_000, **options: str):
    """Reader with the connection options; credentials come in through ``options``."""
    reader = spark.read.format("jdbc").option("url", url).option("driver", driver)
    return reader.option("fetchsize", fetch_size).options(**options)


def read_query(reader: DataFrameReader, query: str) -> DataFrame:
    """Let the database run a whole query (for results that are small by nature, such as a top-k report)."""
    return reader.option("query", query).load()


def read_table(
    reader: DataFrameReader,
    table: str,
    *,
    partition_column: str | None = None,
    lower: str | int | None = None,
    upper: str | int | None = None,
    partitions: int = 1,
) -> DataFrame:
    """Read a table, in parallel ranges of a numeric, date or timestamp column when one is given.

    Spark pushes the filters, limits and aggregates that follow down to the database.
    """
    reader = reader.option("dbtable", table)
    if partition_column is not None:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", partitions)
        )
    return reader.load()


def lower_case_names(df: DataFrame) -> DataFrame:
    """Databases that fold names to upper case: bring them back to lower case."""
    return df.toDF(*[name.lower() for name in df.columns])


def source_statistics(
    references: DataFrame, sources: DataFrame, items: DataFrame, *, active: str = "N", limit: int = 10
) -> DataFrame:
    """Items per source: distinct count and length statistics of the sources with the most items.

    ``references(source_id, item_id, deleted)``, ``sources(source_id, source_database)``, ``items(item_id, length)``.
    Copies of a reference are collapsed before the join with the items, so the distinct count needs no expand and a
    source that holds most rows shuffles each of its items once. The average stays one over references: the number
    of copies is kept as a weight.
    """
    copies = (
        references.where(F.col("deleted") == active)
        .join(sources, "source_id")
        .groupBy("source_database", "item_id")
        .agg(F.count("*").alias("copies"))
    )
    average = F.sum(F.col("length") * F.col("copies")) / F.sum("copies")
    return (
        copies.join(items, "item_id")
        .groupBy("source_database")
        .agg(
            F.count("*").alias("sequence_count"),
            F.min("length").alias("min_length"),
            F.max("length").alias("max_length"),
            F.round(average).cast("int").alias("avg_length"),
        )
        .orderBy(F.desc("sequence_count"), "source_database")
        .limit(limit)
    )


def largest_tables(
    tables: DataFrame, *, excluded: Sequence[str] = ORACLE_SYSTEM_OWNERS, limit: int = 50
) -> DataFrame:
    """Catalog report: tables of all but the excluded owners, largest first within an owner, unknown sizes last."""
    return (
        tables.where(~F.col("owner").isin(*excluded))
        .select(
            "owner",
            "table_name",
            "tablespace_name",
            "num_rows",
            "blocks",
            F.round(F.col("avg_row_len") / 1024, 2).alias("avg_row_kb"),
            F.substring(F.col("last_analyzed").cast("string"), 1, 19).alias("last_analyzed"),
        )
        .orderBy("owner", F.desc_nulls_last("num_rows"), "table_name")
        .limit(limit)
    )


def first_tables(
    tables: DataFrame,
    *,
    types: Sequence[str] = ("T", "V"),
    excluded: Sequence[str] = DB2_SYSTEM_SCHEMAS,
    limit: int = 50,
) -> DataFrame:
    """Catalog report: tables and views of all but the system schemas, by name, texts trimmed."""
    return (
        tables.where(F.col("type").isin(*types) & ~F.trim("creator").isin(*excluded))
        .select(
            F.trim("creator").alias("schema_name"),
            F.trim("name").alias("table_name"),
            F.trim("type").alias("table_type"),
            F.col("card").alias("estimated_rows"),
            F.col("npages").alias("data_pages"),
            F.trim(F.coalesce("remarks", F.lit(""))).alias("remarks"),
        )
        .orderBy("schema_name", "table_name")
        .limit(limit)
    )
