"""Small helpers shared by the operators: reading tables, written intermediate results, text columns."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from layerloom.session import scratch_path, tune

# Arrow batches hold whole texts, so a batch is kept to few rows.
ROWS_PER_BATCH = 1000
PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])


def prepared(spark: SparkSession) -> SparkSession:
    """Session options the operators rely on."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    context = spark.sparkContext
    if context.master.startswith("local"):  # Python workers on this machine find the package, wherever the session was started
        paths = [p for p in context.environment.get("PYTHONPATH", "").split(os.pathsep) if p and p != PACKAGE_ROOT]
        context.environment["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *paths])
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back: later steps do not depend on executors
    that computed it, and a retried task sees the same rows."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(column: str = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def parts_for(df: DataFrame) -> int:
    """Shuffle partitions of the session, as a number of parts to deal rows into."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
