"""Data-quality rules: each returns the failing rows, and a runner counts the failures of a whole rule set.

Row rules of one table are counted in a single pass over it, and so are its key rules (unique, relationships): all key columns go through one
shuffle, reduced to distinct keys before it, so a key with a third of the rows costs one row per task. Group rules aggregate before they compare.

For tables in partitions the counts can be taken per partition (``counts_of_partitions``), kept, and added up (``kept_failures``): a check then reads the partitions
that have changed and nothing else of the table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Plausible ranges, and the numbers of readings a day may have (23, 24 or 25 hours, hourly or quarterly).
TEMPERATURE_RANGE = (-40, 50)
HUMIDITY_RANGE = (0, 100)
PRICE_RANGE = (-500, 3000)
MAX_APPARENT_DEVIATION = 20
HOURS_PER_DAY = (24,)
PRICE_INTERVALS_PER_DAY = (23, 24, 25, 92, 96, 100)


# --- failing rows -----------------------------------------------------------------------------------------------------


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def repeated_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values that occur more than once, with their count; NULLs are left out."""
    return df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count("*").alias("n_records")).where("n_records > 1")


def orphans(child: DataFrame, fk: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose foreign key has no parent; NULL keys are left out."""
    keys = parent.select(F.col(key).alias(fk)).distinct()
    return child.where(F.col(fk).isNotNull()).join(keys, fk, "left_anti")


def orphan_keys(child: DataFrame, fk: str, parent: DataFrame, key: str) -> DataFrame:
    """Foreign keys without a parent and the number of rows that carry them. One row per key reaches the join."""
    counted = child.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count("*").alias("n_records"))
    return counted.join(parent.select(F.col(key).alias(fk)), fk, "left_anti")


def unaccepted_values(df: DataFrame, column: str, accepted: Sequence) -> DataFrame:
    """Values outside a list, with their count."""
    return df.where(~F.col(column).isin(*accepted)).groupBy(column).agg(F.count("*").alias("n_records"))


def incomplete_groups(df: DataFrame, keys: Sequence[str], allowed: Sequence[int], count: str) -> DataFrame:
    """Groups whose number of rows is not one of the allowed ones."""
    return df.groupBy(*keys).agg(F.count("*").alias(count)).where(~F.col(count).isin(*allowed))


def out_of_range(df: DataFrame, column: str, low: float, high: float, keep: Sequence[str]) -> DataFrame:
    """Rows outside the bounds; the bounds themselves are fine, NULL is no failure."""
    return df.where((F.col(column) < low) | (F.col(column) > high)).select(*keep, column)


def deviating_rows(df: DataFrame, left: str, right: str, limit: float, keep: Sequence[str]) -> DataFrame:
    """Rows in which two columns lie more than a limit apart."""
    delta = F.abs(F.col(left) - F.col(right))
    return df.where(delta > limit).select(*keep, right, left, delta.alias("delta"))


def slices_that_grew(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Slices whose row count a repeated load changed; none, if loading is idempotent. NULL is a slice like any other."""
    both = before.select(*keys, F.lit(True).alias("_old")).unionByName(after.select(*keys, F.lit(False).alias("_old")))
    old, new = F.count_if("_old"), F.count_if(~F.col("_old"))
    both = both.groupBy(*keys).agg(F.when(old > 0, old).alias("rows_before"), F.when(new > 0, new).alias("rows_after"))
    return both.where(~F.col("rows_before").eqNullSafe(F.col("rows_after")))


def missing_days(df: DataFrame, date: str) -> DataFrame:
    """Days between the first and the last one that do not occur. Only distinct days are compared, and their number
    is bounded by the calendar."""
    days = df.select(F.col(date).cast("date").alias("missing_day")).distinct()
    bounds = days.agg(F.min("missing_day").alias("first"), F.max("missing_day").alias("last"))
    spine = bounds.where(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last")).alias("missing_day")
    )
    return spine.join(days, "missing_day", "left_anti")


def unequal_sums(
    detail: DataFrame, total: DataFrame, keys: Sequence[str], detail_column: str, total_column: str, tolerance: float
) -> DataFrame:
    """Groups in which the sum of the details does not equal the stored total."""
    sums = detail.groupBy(*keys).agg(F.sum(detail_column).alias("detail_sum"))
    stored = total.select(*keys, F.col(total_column).alias("stored_total"))
    both = sums.join(stored, list(keys), "full")
    difference = F.abs(F.col("detail_sum") - F.col("stored_total"))
    one_sided = F.col("detail_sum").isNull() != F.col("stored_total").isNull()
    return both.where((difference > tolerance) | one_sided)


# --- rules and report -------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class RowRule:
    """A rule on single rows; ``failing`` is true for rows that break it."""

    name: str
    column: str
    failing: Column


@dataclass(frozen=True)
class GroupRule:
    """A rule whose failures are the rows of a frame built from the table, or the sum of one of its columns."""

    name: str
    column: str
    failures: DataFrame
    counted: str | None = None


@dataclass(frozen=True)
class KeyRule:
    """A rule on the values of one column of ``table``, NULLs left out: none occurs twice, or, with a parent, each is a key of the parent. Values are compared as
    text, so a key and its parent's are of one kind (texts, whole numbers, dates or times)."""

    name: str
    column: str
    table: DataFrame
    parent: DataFrame | None = None
    parent_key: str | None = None


def not_null(column: str) -> RowRule:
    return RowRule("not_null", column, F.col(column).isNull())


def accepted_values(column: str, accepted: Sequence) -> RowRule:
    return RowRule("accepted_values", column, ~F.col(column).isin(*accepted))


def in_range(column: str, low: float, high: float) -> RowRule:
    return RowRule("in_range", column, (F.col(column) < low) | (F.col(column) > high))


def holds(name: str, column: str, condition: Column) -> RowRule:
    """Any condition that must not be false; unknown (NULL) is no failure."""
    return RowRule(name, column, ~condition)


def unique(df: DataFrame, column: str) -> KeyRule:
    """Failures are values that occur more than once."""
    return KeyRule("unique", column, df)


def relationship(child: DataFrame, fk: str, parent: DataFrame, key: str | None = None) -> KeyRule:
    """Failures are child rows without a parent, however few keys they share."""
    return KeyRule("relationships", fk, child, parent, key or fk)


def complete(df: DataFrame, keys: Sequence[str], allowed: Sequence[int]) -> GroupRule:
    return GroupRule("complete", ", ".join(keys), incomplete_groups(df, keys, allowed, "n_records"))


def row_count_between(df: DataFrame, low: int, high: int) -> GroupRule:
    return GroupRule(
        "row_count_between", "*", df.agg(F.count("*").alias("n")).where(~F.col("n").between(low, high))
    )


def mean_between(df: DataFrame, column: str, low: float, high: float) -> GroupRule:
    return GroupRule(
        "mean_between", column, df.agg(F.avg(column).alias("mean")).where(~F.col("mean").between(low, high))
    )


def same_row_count(df: DataFrame, other: DataFrame) -> GroupRule:
    counts = df.agg(F.count("*").alias("n")).unionByName(other.agg(F.count("*").alias("n")))
    return GroupRule("same_row_count", "*", counts.agg(F.min("n").alias("a"), F.max("n").alias("b")).where("a <> b"))


def _row_counts(rules: Sequence[RowRule]) -> Column:
    def counted(rule: RowRule) -> Column:
        failures = F.count_if(F.coalesce(rule.failing, F.lit(False)))
        return F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.column).alias("column_name"), failures.alias("failures"))

    return F.array(*map(counted, rules))


def _keys(df: DataFrame, columns: Sequence[tuple[int, str]], *more: Column) -> DataFrame:
    """One row per row and key: the rule's number and the key as text; NULL keys are left out."""
    keys = [F.struct(F.lit(number).alias("number"), F.col(name).cast("string").alias("key")) for number, name in columns]
    return df.select(*more, F.inline(F.array(*keys))).where("key is not null")


def key_failures(rules: Sequence[KeyRule], counted: DataFrame | None = None) -> DataFrame:
    """Rule, column_name and failures of key rules on one table, in one scan and one shuffle of it; each parent is scanned once for each rule that names it.
    ``counted``: the table's keys as (number of the rule, key, n), if they are known."""
    if counted is None:
        counted = _keys(rules[0].table, [(i, rule.column) for i, rule in enumerate(rules)]).withColumn("n", F.lit(1))
    sides = counted.select("number", "key", F.col("n").cast("long").alias("n"), F.lit(False).alias("listed"))
    for i, rule in enumerate(rules):
        if rule.parent is not None:
            listed = _keys(rule.parent, [(i, rule.parent_key)])
            sides = sides.unionByName(listed.select("number", "key", F.lit(0).cast("long").alias("n"), F.lit(True).alias("listed")))
    met = sides.groupBy("number", "key").agg(F.sum("n").alias("n"), F.bool_or("listed").alias("listed"))
    alone = F.array(*[F.lit(rule.parent is None) for rule in rules])[F.col("number")]
    failures = F.sum(F.when(alone, (F.col("n") > 1).cast("long")).otherwise(F.when(F.col("listed"), 0).otherwise(F.col("n"))))
    found = met.groupBy("number").agg(failures.alias("failures"))
    named = counted.sparkSession.createDataFrame([(i, r.name, r.column) for i, r in enumerate(rules)], "number int, rule string, column_name string")
    return named.join(found, "number", "left").select("rule", "column_name", F.coalesce("failures", F.lit(0)).alias("failures"))


COUNTS = "part string, rule string, column_name string, key string, failures long"


def counts_of_partitions(df: DataFrame, partition: str, rules: Sequence[RowRule | KeyRule | GroupRule]) -> DataFrame:
    """What the rules count in each partition (COUNTS), to be added up: failures of row rules, of group rules whose groups lie in one partition (their failing rows name it), values
    that occur twice, for keys that determine the partition, and for relationships the rows of each key, which is checked when the parents are known."""
    part = F.col(partition).cast("string").alias("part")
    whole = F.lit(None).cast("string").alias("key")
    found = []
    if rows := [rule for rule in rules if isinstance(rule, RowRule)]:
        counted = df.groupBy(part).agg(_row_counts(rows).alias("counted")).select("part", F.explode("counted").alias("c"))
        found.append(counted.select("part", "c.rule", "c.column_name", whole, "c.failures"))
    if keys := [rule for rule in rules if isinstance(rule, KeyRule)]:
        numbered = _keys(df, [(i, rule.column) for i, rule in enumerate(keys)], part)
        counted = numbered.groupBy("part", "number", "key").agg(F.count("*").alias("failures"))
        named = {column: F.array(*[F.lit(value) for value in values])[F.col("number")] for column, values in
                 {"rule": [r.name for r in keys], "column_name": [r.column for r in keys], "_alone": [r.parent is None for r in keys]}.items()}
        counted = counted.withColumns(named)
        twice = counted.where("_alone").groupBy("part", "rule", "column_name").agg(F.count_if(F.col("failures") > 1).alias("failures"))
        found += [counted.where("not _alone"), twice.withColumn("key", F.lit(None).cast("string"))]
    for rule in rules:
        if isinstance(rule, GroupRule):
            groups = rule.failures.groupBy(part).agg(F.count("*").alias("failures"))
            found.append(groups.select("part", F.lit(rule.name).alias("rule"), F.lit(rule.column).alias("column_name"), whole, "failures"))
    names = ["part", "rule", "column_name", "key", "failures"]
    return reduce(DataFrame.unionByName, [counts.select(*names) for counts in found])


def kept_failures(counts: DataFrame, rules: Sequence[RowRule | KeyRule | GroupRule]) -> DataFrame:
    """Rule, column_name and failures from the counts of all partitions; relationships are looked up in the parents as they are now."""
    spark = counts.sparkSession
    related = [rule for rule in rules if isinstance(rule, KeyRule) and rule.parent is not None]
    others = [(rule.name, rule.column) for rule in rules if not (isinstance(rule, KeyRule) and rule.parent is not None)]
    named = spark.createDataFrame(others, "rule string, column_name string")
    summed = counts.where("key is null").groupBy("rule", "column_name").agg(F.sum("failures").alias("failures"))
    result = named.join(summed, ["rule", "column_name"], "left").select("rule", "column_name", F.coalesce("failures", F.lit(0)).alias("failures"))
    if related:
        numbers = spark.createDataFrame([(i, r.name, r.column) for i, r in enumerate(related)], "number int, rule string, column_name string")
        keyed = counts.where("key is not null").join(F.broadcast(numbers), ["rule", "column_name"]).select("number", "key", F.col("failures").alias("n"))
        result = result.unionByName(key_failures(related, keyed))
    return result


def report(tables: Mapping[str, tuple[DataFrame, Sequence[RowRule | KeyRule | GroupRule]]]) -> DataFrame:
    """One row per rule: rule, table_name, column_name, failures.

    ``tables`` maps a name to the table and its rules. All row rules of a table are counted in one scan, all its key rules in another.
    """
    parts = []
    for name, (df, rules) in tables.items():
        rows = [rule for rule in rules if isinstance(rule, RowRule)]
        if rows:
            counts = df.agg(_row_counts(rows).alias("counted"))
            parts.append(counts.select(F.explode("counted").alias("c")).select("c.*", F.lit(name).alias("table_name")))
        keyed: dict[int, list[KeyRule]] = {}
        for rule in rules:
            if isinstance(rule, KeyRule):
                keyed.setdefault(id(rule.table), []).append(rule)
        parts += [key_failures(of_one).withColumn("table_name", F.lit(name)) for of_one in keyed.values()]
        for rule in rules:
            if isinstance(rule, GroupRule):
                total = F.count("*") if rule.counted is None else F.coalesce(F.sum(rule.counted), F.lit(0))
                parts.append(
                    rule.failures.agg(total.alias("failures")).select(
                        F.lit(rule.name).alias("rule"),
                        F.lit(rule.column).alias("column_name"),
                        "failures",
                        F.lit(name).alias("table_name"),
                    )
                )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.select("rule", "table_name", "column_name", "failures")
