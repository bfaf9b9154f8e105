"""CSV records with line breaks inside quotes, read in splits.

A line break ends a record if the quotes before it are even in number. Every split counts its own quotes; the parity that a split begins with is a
prefix sum over the splits of its file. Lines that are a record by themselves go on as they are, only the lines of longer records are brought
together. Files without such records are left to the plain reader, which needs none of this.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

QUOTE = '"'


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the file and the split they begin in, in the order of the split, and their number of quotes."""
    lines = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    return lines.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_order"),
        quotes.alias("_quotes"),
        "value",
    )


def files_by_quoting(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files under a path by what their quotes ask for: ``plain`` (every line has its quotes in pairs), ``broken`` (line breaks in quotes),
    ``unpaired`` (an odd number of quotes: not readable by parity). One pass; as many rows come back as there are files."""
    odd = F.col("_quotes") % 2
    kind = F.when(F.max(odd) == 0, "plain").when(F.sum(odd) % 2 == 0, "broken").otherwise("unpaired")
    found: dict[str, list[str]] = {"plain": [], "broken": [], "unpaired": []}
    for row in _lines(spark, path).groupBy("_file").agg(kind.alias("kind")).collect():
        found[row["kind"]].append(row["_file"])
    return found


def _split_starts(numbered: DataFrame) -> DataFrame:
    """Per split: whether it begins inside quotes, and the split and line of the last record begun before it."""
    # which line begins a record depends on the parity the split begins with, so both cases are noted
    last = {p: F.max(F.when(F.col("_before") % 2 == p, F.col("_line"))) for p in (0, 1)}
    splits = numbered.groupBy("_file", "_split").agg(
        F.sum("_quotes").alias("_quotes"), last[0].alias("_last_outside"), last[1].alias("_last_inside")
    )
    earlier = W.partitionBy("_file").orderBy("_split").rowsBetween(W.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("_quotes").over(earlier), F.lit(0)) % 2
    begun = F.when(F.col("_inside") == 0, F.col("_last_outside")).otherwise(F.col("_last_inside"))
    carried = F.last(F.when(begun.isNotNull(), F.struct("_split", begun.alias("_line"))), ignorenulls=True).over(earlier)
    return splits.withColumn("_inside", inside).select("_file", "_split", "_inside", carried.alias("_carried"))


def quoted_records(spark: SparkSession, path: str, files: Sequence[str] | None = None) -> DataFrame:
    """The records of CSV files as text, header included: ``_file``, ``_first`` (the first of its file), ``value``.

    Quotes must come in pairs (``""`` inside a quoted field counts as one). A record is one row whatever splits it spans. A carriage return
    before the line break that ends a record is dropped, as is a byte order mark. Blank lines between records are no records.
    """
    lines = _lines(spark, path)
    if files is not None:
        lines = lines.where(F.col("_file").isin(*files))
    split = W.partitionBy("_file", "_split").orderBy("_order")
    before = F.coalesce(F.sum("_quotes").over(split.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    numbered = lines.withColumns({"_before": before, "_line": F.row_number().over(split)})
    placed = numbered.join(_split_starts(numbered), ["_file", "_split"])

    inside = F.col("_inside") + F.col("_before")
    starts, ends = inside % 2 == 0, (inside + F.col("_quotes")) % 2 == 0
    here = F.last(F.when(starts, F.struct("_split", "_line")), ignorenulls=True).over(split.rowsBetween(W.unboundedPreceding, 0))
    placed = placed.select("_file", "_split", "_line", "value", F.coalesce(here, "_carried").alias("_record"), (starts & ends).alias("_whole"))

    whole = placed.where("_whole").select("_file", "_record", "value")
    parts = F.sort_array(F.collect_list(F.struct("_split", "_line", "value")))
    joined = placed.where("not _whole").groupBy("_file", "_record").agg(F.array_join(parts["value"], "\n").alias("value"))
    first = (F.col("_record._split") == 0) & (F.col("_record._line") == 1)
    bare = F.regexp_replace(F.regexp_replace("value", "\r$", ""), "^\ufeff", "")
    records = whole.unionByName(joined).select("_file", first.alias("_first"), bare.alias("value"))
    return records.where(F.trim("value") != "")


def parsed(record: Column, columns: Sequence[str], options: dict[str, str]) -> Column:
    """A record's fields as a struct of text."""
    return F.from_csv(record, ", ".join(f"`{name.replace('`', '``')}` string" for name in columns), options)
