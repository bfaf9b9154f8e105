"""Landing files as a stream: every file is loaded once, each batch replaces the slices it carries.

The checkpoint keeps the list of files already seen, so there is no list of loaded days to maintain; a file that
arrives late is picked up by the next run. The write is the batch path's slice replace, so a batch that is run again
after a failure leaves the same table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from layerloom.operators.matching import null_safe_join
from layerloom.operators.sinks import replace_slices


FILE_TIME = "_file_time"


def newest_documents(rows: DataFrame, files: DataFrame, slice_keys: Sequence[str]) -> DataFrame:
    """The rows of the newest document of each slice (by the file's time, then its name)."""
    dated = rows.join(files.select("_source_file", FILE_TIME).distinct(), "_source_file")
    newest = dated.groupBy(*slice_keys).agg(F.max(F.struct(FILE_TIME, "_source_file"))["_source_file"].alias("_source_file"))
    return null_safe_join(rows, newest, [*slice_keys, "_source_file"], "left_semi")


def document_stream(
    spark: SparkSession, path: str, schema: T.StructType, *, pretty: bool = True, files_per_batch: int | None = None
) -> DataFrame:
    reader = (
        spark.readStream.schema(schema)
        .option("multiLine", pretty)
        .option("mode", "FAILFAST")
        .option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", True)
    )
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lineage = [F.col("_metadata.file_path").alias("_source_file"), F.col("_metadata.file_modification_time").alias(FILE_TIME)]
    return reader.json(path).select("*", *lineage)


def ingest_available(
    documents: DataFrame,
    to_rows: Callable[[DataFrame], DataFrame],
    path: str,
    *,
    partition_by: Sequence[str],
    slice_keys: Sequence[str],
    checkpoint: str,
) -> StreamingQuery:
    """Load all files that have arrived since the last run, then stop.

    ``to_rows`` is the batch function that turns documents into raw rows, lineage included. A slice is what its newest document says,
    whether two documents of it arrive in one batch or in two: files are read in the order of their times.
    """

    def load(batch: DataFrame, _: int) -> None:
        rows = to_rows(batch.drop(FILE_TIME))
        replace_slices(batch.sparkSession, newest_documents(rows, batch, slice_keys), path, partition_by, slice_keys)

    return (
        documents.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
