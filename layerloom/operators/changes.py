"""A record of changes beside each table that is read in deltas, kept by the functions that write it.

A write adds one entry per partition it touches: the number of rows and the sum of the rows' hashes, for a partition that is replaced or for rows that are
added to it. Both are taken from the batch, which is staged anyway, so recording costs what the batch costs, whatever the size of the table. Readers add the
entries up (a few numbers per partition) and compare; a slice that is loaded again with the same rows is no change.

Replacements are recorded when the rows are there: a load that fails in between is run again and recorded then. Rows that are added are announced
before, since a second run would not find them new: an announcement without an entry that closes it is a change by itself. A write of the whole table is one
entry without a partition and makes all earlier ones void.

The record speaks for what this library writes. Readers of a table without one (``forget`` removes it) look at its content.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from layerloom.session import scratch_path
from layerloom.sources.tables import table_exists

ENTRY = "at long, whole boolean, part string, replaces boolean, rows long, content string, open boolean, stamp string"
STATE = "kind string, part string, rows long, content string, stamp string"
# About every so many writes the entries are added up and the record is written anew.
WRITES_KEPT = 64

# (kind, partition) -> (rows, sum of hashes, stamps of writes whose content is not known). Kind 'table': the last write of the whole.
State = dict[tuple[str, str | None], tuple]


def book_of(path: str) -> str:
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_changes/{name}"


def has_record(spark: SparkSession, path: str) -> bool:
    return table_exists(spark, book_of(path))


def partition_name(partition: str | None) -> Column:
    return F.col(partition).cast("string") if partition else F.lit("whole table")


def content_of(table: DataFrame) -> Column:
    """The sum of the rows' hashes, as text. A hash skips NULLs, so which columns are NULL is hashed as well. The order of rows and columns does not show."""
    columns = [F.col(name) for name in sorted(table.columns)]
    return F.sum(F.xxhash64(*columns, *[column.isNull() for column in columns]).cast("decimal(20,0)")).cast("string")


def added_up(entries: Iterable[Row]) -> State:
    """What the entries say together, in the order they were written; empty if the table was never written as a whole."""
    state: State = {}
    for entry in sorted(entries, key=lambda e: (e.at, not e.whole)):
        if entry.whole:
            state = {("table", None): (None, None, entry.stamp)}
            continue
        key = ("part", entry.part)
        rows, content, stamps = (0, "0", "") if entry.replaces else state.get(key, (0, "0", ""))
        waiting = set(filter(None, stamps.split(",")))
        if entry.open or entry.rows is None:
            waiting.add(entry.stamp)
        else:
            waiting.discard(entry.stamp)
            rows, content = rows + entry.rows, str(int(content) + int(entry.content))
        state[key] = (rows, content, ",".join(sorted(waiting)))
    return state if ("table", None) in state else {}


def state(spark: SparkSession, path: str) -> State:
    """The recorded state of a table; empty if there is no record."""
    return added_up(spark.read.schema(ENTRY).parquet(book_of(path)).collect()) if has_record(spark, path) else {}


def _add(spark: SparkSession, path: str, entries: list[tuple]) -> None:
    spark.createDataFrame(entries, ENTRY).coalesce(1).write.mode("append").parquet(book_of(path))


def forget(spark: SparkSession, path: str) -> None:
    """No record any more: readers look at the content again."""
    if has_record(spark, path):
        spark.createDataFrame([], ENTRY).coalesce(1).write.mode("overwrite").parquet(book_of(path))


def compact(spark: SparkSession, path: str) -> None:
    """Write the record anew, one entry per partition. If that fails half-way there is no record, and everything counts as changed."""
    found = spark.read.schema(ENTRY).parquet(book_of(path)).collect()
    told = added_up(found)
    if not told:
        return
    at = max(entry.at for entry in found)
    entries = [(at - 1, True, None, True, None, None, False, told.pop(("table", None))[2])]
    for (_, part), (rows, content, stamps) in told.items():
        entries.append((at - 1, False, part, True, rows, content, False, ""))
        entries += [(at, False, part, False, None, None, True, stamp) for stamp in stamps.split(",") if stamp]
    staged = scratch_path(spark, "changes")
    spark.createDataFrame(entries, ENTRY).coalesce(1).write.parquet(staged)
    spark.read.schema(ENTRY).parquet(staged).coalesce(1).write.mode("overwrite").parquet(book_of(path))


@contextmanager
def recorded_whole(spark: SparkSession, path: str) -> Iterator[None]:
    """Around a write of the whole table."""
    yield
    _add(spark, path, [(time.time_ns(), True, None, True, None, None, False, uuid.uuid4().hex)])


@contextmanager
def recorded(
    spark: SparkSession, path: str, batch: DataFrame, partition: str | None, *, replaces: bool = True, parts: Iterable[str | None] | None = None
) -> Iterator[None]:
    """Around a write of ``batch`` (a stored table) that replaces its partitions or is added to them. ``parts``: the partitions, where their content
    need not be known; the batch is not read then."""
    stamp = uuid.uuid4().hex
    if parts is None:
        sums = batch.groupBy(partition_name(partition).alias("part")).agg(F.count("*").alias("rows"), content_of(batch).alias("content")).collect()
    else:
        sums = [Row(part=part, rows=None, content=None) for part in parts]

    def entries(open_: bool) -> list[tuple]:
        at = time.time_ns()
        return [(at, False, row.part, replaces, row.rows, row.content, open_, stamp) for row in sums]

    if not replaces:
        _add(spark, path, entries(True))
    yield
    _add(spark, path, entries(False))
    if int(stamp, 16) % WRITES_KEPT == 0:
        compact(spark, path)
