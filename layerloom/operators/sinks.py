"""Writes: slice replace, appends with guards, full refresh.

Tables are partitioned Parquet. A slice is replaced by dynamic partition overwrite, so a load can be repeated and a
late correction replaces exactly its own slice. Writes to partitioned tables are rebalanced by the partition columns
first: small partitions share a task and a hot partition (a day or region that holds a third of the rows) is split
over many.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import nullcontext
from datetime import timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from layerloom.operators import changes
from layerloom.operators.matching import null_safe_join
from layerloom.session import scratch_path
from layerloom.sources.tables import table_exists


class SchemaMismatch(ValueError):
    """The new rows do not have the columns of the target table."""


class DuplicateKeys(ValueError):
    """An append would break the uniqueness of a declared key."""


def balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition together without putting a hot one into a single task (AQE splits it)."""
    return df.hint("rebalance", *partition_by)


def _writer(df: DataFrame, partition_by: Sequence[str]):
    """Tables without partitions are written as they come: a shuffle would buy them nothing."""
    return balanced(df, partition_by).write.partitionBy(*partition_by) if partition_by else df.write


def check_schema(new: DataFrame, target: DataFrame) -> None:
    """Fail when names or types differ; order and nullability do not matter."""

    def described(df: DataFrame) -> dict[str, T.DataType]:
        return {field.name: field.dataType for field in df.schema.fields}

    mine, theirs = described(new), described(target)
    if mine != theirs:
        changed = sorted(name for name in mine.keys() | theirs.keys() if mine.get(name) != theirs.get(name))
        raise SchemaMismatch(f"columns differ from the target: {', '.join(changed)}")


def create_if_missing(spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
    """Write an empty table with a schema, unless the path already holds one."""
    if not table_exists(spark, path):
        writer = spark.createDataFrame([], schema).write.mode("ignore")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), *, record: bool = False) -> None:
    """Full refresh: the whole table is replaced. ``record``: begin a record of changes, for those who read the table in deltas; one that is there is
    kept in any case."""
    kept = record or changes.has_record(df.sparkSession, path)
    with changes.recorded_whole(df.sparkSession, path) if kept else nullcontext():
        _writer(df, partition_by).mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str], *, stored: bool = False, parts: Sequence[str | None] | None = None) -> None:
    """Replace just the partitions the new rows fall into; one statement for any number of days. If the table's changes are recorded, the rows are
    staged first, so that what is recorded is what is written, unless they are a stored table or it is enough to record which ``parts`` they are."""
    spark, staged, record = df.sparkSession, None, nullcontext()
    if changes.has_record(spark, path):
        if not stored and parts is None:
            staged = scratch_path(spark, "partitions")
            df.write.parquet(staged)
            df = spark.read.schema(df.schema).parquet(staged)
        record = changes.recorded(spark, path, df, partition_by[0], parts=parts)
    with record:
        _writer(df, partition_by).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    if staged:
        release(spark, staged)


def only_between(target: DataFrame, batch: DataFrame, column: str, limit: int = 1000) -> DataFrame:
    """The part of a target on the days of the batch, by a column of dates or times; without NULLs.

    Exact for key lookups whenever the column is a function of the key: equal keys then mean equal values, and rows on other days cannot match. Days that follow one
    another are one range, so one late row adds a day and not all that lies between. As literals the ranges prune partitions and row groups of the target. Beyond
    ``limit`` days it is the range of all.
    """
    day = F.to_date(column)
    days = sorted(row[0] for row in batch.where(F.col(column).isNotNull()).select(day).distinct().limit(limit + 1).collect())
    if not days:
        return target.limit(0)
    if len(days) > limit:
        low, high = batch.agg(F.min(column), F.max(column)).first()
        return target.where(F.col(column).between(F.lit(low), F.lit(high)))
    ranges = [[days[0], days[0]]]
    for found in days[1:]:
        if found - ranges[-1][1] > timedelta(days=1):
            ranges.append([found, found])
        ranges[-1][1] = found
    kind = target.schema[column].dataType
    wanted = [(F.col(column) >= F.lit(low).cast(kind)) & (F.col(column) < F.lit(high + timedelta(days=1)).cast(kind)) for low, high in ranges]
    return target.where(reduce(or_, wanted))


def only_values(target: DataFrame, batch: DataFrame, column: str, limit: int = 1000) -> DataFrame:
    """The part of a target that holds the batch's values of a column, NULL among them; beyond ``limit`` values, their range."""
    found = [row[0] for row in batch.select(column).distinct().limit(limit + 1).collect()]
    values = [value for value in found if value is not None]
    if len(found) > limit:
        low, high, nulls = batch.agg(F.min(column), F.max(column), F.count_if(F.col(column).isNull())).first()
        inside = F.col(column).between(F.lit(low), F.lit(high))
        return target.where(inside | F.col(column).isNull() if nulls else inside)
    wanted = F.col(column).isin(*values) if values else F.lit(False)
    return target.where(wanted | F.col(column).isNull() if None in found else wanted) if found else target.limit(0)


def replace_slices(
    spark: SparkSession, df: DataFrame, path: str, partition_by: Sequence[str], slice_keys: Sequence[str]
) -> None:
    """Idempotent load: rows of the target that share a slice key with the new rows go, the new rows come.

    * Partitioned by exactly the slice keys: a plain partition overwrite.
    * Partitioned by some of them: the partitions that are touched are read (by literal partition values, so no other
      one is) and their other slices kept.
    * Partitioned by something else, or not at all: a slice may lie anywhere, so the whole table is rewritten. Give a
      large table a partition column that the slice determines (see with_file_key).

    In the last two cases the result goes to a shared staging folder first, from which the target is overwritten: a
    table is never read and replaced in one plan. A NULL is a slice key like any other: rows without an entity or a
    day replace rows without one.
    """
    by_slice = bool(partition_by) and set(partition_by) <= set(slice_keys)
    if not table_exists(spark, path):
        overwrite_table(df, path, partition_by, record=True)
        return
    if by_slice and set(partition_by) == set(slice_keys):
        replace_partitions(df, path, partition_by)
        return
    target = spark.read.schema(df.schema).parquet(path)
    check_schema(df, target)
    staged = scratch_path(spark, "slice")
    df.write.parquet(staged + "/new")
    new = spark.read.schema(df.schema).parquet(staged + "/new")
    if by_slice:
        touched = new.select(*partition_by).distinct()
        target = null_safe_join(only_values(target, new, partition_by[0]), touched, partition_by, "left_semi")
    kept = null_safe_join(target, new.select(*slice_keys).distinct(), slice_keys, "left_anti")
    kept.unionByName(new).write.parquet(staged + "/merged")
    merged = spark.read.schema(df.schema).parquet(staged + "/merged")
    if by_slice:
        replace_partitions(merged, path, partition_by, stored=True)
    else:
        overwrite_table(merged, path, partition_by, record=True)
    release(spark, staged + "/new", staged + "/merged")


def release(spark: SparkSession, *paths: str) -> None:
    """Free the space of staged copies whose rows have reached their table: each is replaced by an empty table."""
    for path in paths:
        spark.createDataFrame([], "released boolean").coalesce(1).write.mode("overwrite").parquet(path)


def with_file_key(df: DataFrame) -> DataFrame:
    """A short partition key of the source file, for large tables whose slices are whole files."""
    return df.withColumn("file_key", F.substring(F.md5("_source_file"), 1, 8))


def replace_source_files(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Slice replace by source file in a table partitioned by file key; two files may share a file key, so the file
    itself is part of the slice."""
    replace_slices(spark, with_file_key(df), path, ["file_key"], ["file_key", "_source_file"])


def overwrite_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> None:
    """Full refresh of a catalog table that is bucketed and sorted by its keys.

    Tables bucketed alike by a hash key (a hub and its satellites) join on it without a shuffle. A key's rows lie in
    one bucket, so this is for tables without hot keys: hubs, links, state satellites.
    """
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    writer.mode("overwrite").option("path", path).saveAsTable(table)


def slices_to_load(available: DataFrame, target: DataFrame, slice_keys: Sequence[str]) -> DataFrame:
    """Slices that are available but not in the target. The key names the entity as well as the day, so a day that is
    loaded for one entity is not skipped for another."""
    loaded = target.select(*slice_keys).distinct()
    return available.join(loaded, list(slice_keys), "left_anti")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def new_rows(df: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the target does not hold yet. The keys are not NULL, so this equals NOT IN; unlike NOT IN it
    can be shuffled, and a skewed side is split."""
    return df.join(target.select(*keys), list(keys), "left_anti")


def append_rows(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    *,
    unique_key: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    check_target: bool = True,
) -> None:
    """Append behind two guards: same columns as the target, and a key that stays unique.

    The rows are staged in the shared folder first, so the check and the append see the same rows and the plan that
    made them runs once. Turn ``check_target`` off when the rows were just anti-joined with the target on that key.
    """
    exists, staged, record = table_exists(spark, path), None, nullcontext()
    told = changes.has_record(spark, path)
    if exists:
        check_schema(df, spark.read.parquet(path))
    if unique_key or told:
        staged = scratch_path(spark, "append")
        df.write.parquet(staged)
        df = spark.read.schema(df.schema).parquet(staged)
    if unique_key:
        if duplicate_keys(df, unique_key).limit(1).count():
            raise DuplicateKeys(f"the new rows repeat a key of {list(unique_key)}")
        if exists and check_target:
            present = spark.read.parquet(path).select(*unique_key)
            known = df.select(*unique_key).join(present, list(unique_key), "left_semi")
            if known.limit(1).count():
                raise DuplicateKeys(f"the target already holds a key of {list(unique_key)}")
    if staged and exists and df.isEmpty():
        return
    if told:
        record = changes.recorded(spark, path, df, next(iter(partition_by), None), replaces=False)
    with record:
        _writer(df, partition_by).mode("append").parquet(path)
    if staged:
        release(spark, staged)


def write_query_document(
    spark: SparkSession, df: DataFrame, path: str, query_date: str, source: str, *, rows_per_document: int = 10_000
) -> None:
    """Land a query result as ``{query_date, source, row_count, data[]}`` documents, one JSON line each.

    A report of a few rows gives one document. A longer result is cut into documents of bounded size, so no task has
    to hold it whole; ``row_count`` counts the rows of its own document. The result is staged first: numbers given to
    rows read from a file stay the same when a lost task is run again.
    """
    names = df.columns
    staged = scratch_path(spark, "result")
    df.write.parquet(staged)
    numbered = spark.read.schema(df.schema).parquet(staged).withColumn("_number", F.monotonically_increasing_id())
    block = F.floor(F.col("_number") / rows_per_document)
    documents = (
        numbered.groupBy(block.alias("_block"))
        .agg(F.sort_array(F.collect_list(F.struct("_number", F.struct(*names).alias("row")))).alias("rows"))
        .select(
            F.lit(query_date).alias("query_date"),
            F.lit(source).alias("source"),
            F.size("rows").cast("bigint").alias("row_count"),
            F.col("rows.row").alias("data"),
        )
    )
    documents.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def audit_counters(queried: DataFrame, found: DataFrame, keys: Sequence[str], **labels: str | Column) -> DataFrame:
    """One row: how many keys were asked for, found and skipped."""
    marked = queried.select(*keys).join(
        found.select(*keys).distinct().withColumn("_found", F.lit(True)), list(keys), "left"
    )
    counters = marked.agg(
        F.count("*").alias("total_queried"),
        F.count("_found").alias("total_found"),
        F.count_if(F.col("_found").isNull()).alias("total_skipped"),
    )
    constants = {name: value if isinstance(value, Column) else F.lit(value) for name, value in labels.items()}
    return counters.select(*[column.alias(name) for name, column in constants.items()], *counters.columns)


COUNTERS = ("total_queried", "total_found", "total_skipped")
ARTISTS_PER_DOCUMENT = 50


def write_artist_documents(
    asked: DataFrame, found: DataFrame, path: str, *, source: str = "spotify-api", artists_per_document: int = ARTISTS_PER_DOCUMENT
) -> None:
    """Land snapshots as ``{artists[], _meta}`` documents, the run's counters in ``_meta``.

    ``asked``: ``snapshot_date`` and ``artist_name``; ``found``: these and the attributes. A day is cut into ``checkpoints`` documents of bounded
    size that all carry the counters of the day, so a run that found nobody still lands one document. Names are counted once each.
    """
    keys = ["snapshot_date", "artist_name"]
    fields = ["artist_id", "artist_name", "genres", "popularity", "followers"]
    spark = asked.sparkSession
    staged = scratch_path(spark, "artists")
    found.select("snapshot_date", *fields).write.parquet(staged)  # dealt into documents by a hash of the name, so a retried task deals alike
    found = spark.read.schema(found.select("snapshot_date", *fields).schema).parquet(staged)
    names = found.select(*keys).distinct().withColumn("_found", F.lit(1))
    counted = null_safe_join(asked.select(*keys).distinct(), names, keys, "left").groupBy("snapshot_date").agg(
        F.count("*").alias("total_queried"), F.count("_found").alias("total_found"), F.count_if(F.col("_found").isNull()).alias("total_skipped")
    )
    heads = counted.withColumn("checkpoints", F.ceil(F.col("total_found") / artists_per_document).cast("bigint"))
    dealt = null_safe_join(found, heads.select("snapshot_date", "checkpoints"), ["snapshot_date"], "inner").withColumn(
        "_document", F.pmod(F.xxhash64("artist_name"), F.col("checkpoints"))
    )
    documents = dealt.groupBy("snapshot_date", "_document").agg(
        F.sort_array(F.collect_list(F.struct(*fields, "snapshot_date"))).alias("artists")
    )
    meta = F.struct("snapshot_date", F.lit(source).alias("source"), *COUNTERS, "checkpoints").alias("_meta")
    landed = null_safe_join(heads, documents, ["snapshot_date"], "left")
    empty = F.array().cast(documents.schema["artists"].dataType)
    landed.select(F.coalesce("artists", empty).alias("artists"), meta).write.mode("overwrite").option("ignoreNullFields", False).json(path)
    release(spark, staged)
