"""Which partitions of a table have changed since a model last read it.

The state of a table is what the functions that write it have recorded (``changes``): a few numbers per partition. For a table without a record, one that something
else writes, the state is taken from its content: the number of rows, the newest load time and a hash of each partition. A model remembers the state it has read in a small
table of its own, written after its load has succeeded; a run that fails reads the same partitions again. There is no watermark, so rows that
arrive late, with an old load time or for an old day, are found like any others, and so are other values under the same load time.

If the whole table was written anew, or a partition is gone, everything counts as changed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from layerloom.operators import changes
from layerloom.operators.changes import content_of, partition_name
from layerloom.operators.matching import null_safe_join
from layerloom.sources.tables import table_exists

# Partitions that are named one by one in a filter, which then prunes files; beyond that they are joined.
NAMED = 1000


def state_of(table: DataFrame, partition: str | None, load: str) -> changes.State:
    """The state of a table as its content shows it. All columns are read; only one row per partition and task is shuffled."""
    sums = (F.count("*").alias("rows"), F.max(load).cast("string").alias("newest"), content_of(table).alias("content"))
    found = table.groupBy(partition_name(partition).alias("part")).agg(*sums)
    return {("content", row.part): (row.rows, row.content, str(row.newest)) for row in found.collect()}


@dataclass
class Delta:
    """The partitions of ``table``, stored at ``path``, that differ from what was remembered at ``book``; all of them if nothing was, or with
    ``everything``."""

    spark: SparkSession
    table: DataFrame
    path: str
    partition: str | None
    load: str
    book: str
    everything: bool = False

    def __post_init__(self) -> None:
        # One row per partition. Held here, so that what is remembered is what was read, even if the table grows meanwhile.
        self.state = changes.state(self.spark, self.path) or state_of(self.table, self.partition, self.load)
        known: changes.State = {}
        if not self.everything and table_exists(self.spark, self.book):
            rows = self.spark.read.schema(changes.STATE).parquet(self.book).collect()
            known = {(row.kind, row.part): (row.rows, row.content, row.stamp) for row in rows}
        differs = [key for key, value in self.state.items() if known.get(key) != value]
        self.first = not known or any(kind == "table" for kind, _ in differs) or not known.keys() <= self.state.keys()
        self.parts = list(self.state) if self.first else [part for _, part in differs]

    @property
    def changed(self) -> DataFrame:
        """The changed partitions as rows; of a table that counts as changed as a whole, those that have a state of their own."""
        parts = [part for _, part in self.state] if self.first else self.parts
        return self.spark.createDataFrame([(part,) for part in parts], "part string")

    @property
    def empty(self) -> bool:
        return not self.parts

    def rows(self, table: DataFrame | None = None) -> DataFrame:
        """The rows of the changed partitions, of this table or of another one with the same partition column."""
        table = self.table if table is None else table
        if self.first or self.partition is None:
            return table if self.parts or self.first else table.limit(0)
        if len(self.parts) > NAMED:
            marked = table.withColumn("part", F.col(self.partition).cast("string"))
            return null_safe_join(marked, self.changed, ["part"], "left_semi").drop("part")
        kind = table.schema[self.partition].dataType
        named = [F.lit(part).cast(kind) for part in self.parts if part is not None]
        wanted = F.col(self.partition).isin(*named) if named else F.lit(False)
        return table.where(wanted | F.col(self.partition).isNull() if None in self.parts else wanted)

    def remember(self) -> None:
        rows = [(*key, *value) for key, value in self.state.items()]
        self.spark.createDataFrame(rows, changes.STATE).coalesce(1).write.mode("overwrite").parquet(self.book)
