"""Queries over a declared star: joins from relationships, default aggregates from column roles, drill paths."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from layerloom.operators import ranges
from layerloom.operators.quality import repeated_values

IDENTIFIER, FACT = "identifier", "fact"
# Holds sums of integers over pairs of rows.
WIDE = "decimal(38,0)"

# Names of the default aggregates, join filter types and comparison operators of a star declaration.
AGGREGATES = {
    "total": F.sum,
    "average": F.avg,
    "minimum": F.min,
    "maximum": F.max,
    "count": F.count,
    "countDistinct": F.count_distinct,
}
JOIN_TYPES = {
    "none": "inner",
    "outerLeftBody": "left",
    "outerRightBody": "right",
    "outerFullBody": "full",
}
COMPARISONS = {
    "equalTo": lambda left, right: left == right,
    "lessThan": lambda left, right: left < right,
    "greaterThan": lambda left, right: left > right,
    "lessThanOrEqualTo": lambda left, right: left <= right,
    "greaterThanOrEqualTo": lambda left, right: left >= right,
    "notEqualTo": lambda left, right: left != right,
}


@dataclass(frozen=True)
class Item:
    """A column of the star: its table, role and default aggregate ("none" leaves it alone)."""

    table: str
    column: str
    usage: str = IDENTIFIER
    aggregate: str = "countDistinct"
    alias: str | None = None

    @property
    def name(self) -> str:
        return self.alias or self.column

    def reference(self) -> Column:
        return F.col(qualified(self.table, self.column))


@dataclass(frozen=True)
class Relationship:
    """``left`` joins ``right`` over links (left column, right column, comparison). maxcard "one" means unique."""

    left: str
    right: str
    links: Sequence[tuple[str, str, str]]
    join_type: str = "none"
    left_maxcard: str = "one"
    right_maxcard: str = "many"


@dataclass(frozen=True)
class Star:
    """Tables and how they relate; ``fact`` is where joins start."""

    fact: str
    tables: Mapping[str, DataFrame]
    relationships: Sequence[Relationship] = field(default_factory=tuple)


def qualified(table: str, column: str) -> str:
    return f"{table}__{column}"


def _prefixed(star: Star, table: str, columns: set[str]) -> DataFrame:
    return star.tables[table].select(*[F.col(name).alias(qualified(table, name)) for name in sorted(columns)])


def joined(star: Star, items: Sequence[Item]) -> DataFrame:
    """The fact joined with the tables that the items need, and the tables on the way to them.

    Columns are named ``{table}__{column}`` and only those that are asked for or joined on are read.
    """
    wanted = {item.table for item in items} | {star.fact}
    path = _relationships_to(star, wanted)
    columns: dict[str, set[str]] = {}
    for item in items:
        columns.setdefault(item.table, set()).add(item.column)
    for relation in path:
        if not any(operator == "equalTo" for *_, operator in relation.links):
            raise ValueError(f"{relation.left} and {relation.right} need a link with equalTo; without one every row meets every row")
        for left, right, _ in relation.links:
            columns.setdefault(relation.left, set()).add(left)
            columns.setdefault(relation.right, set()).add(right)
    result = _prefixed(star, star.fact, columns[star.fact])
    present = {star.fact}
    for relation in path:
        fresh = relation.left if relation.right in present else relation.right
        condition = reduce(
            lambda a, b: a & b,
            [
                COMPARISONS[operator](
                    F.col(qualified(relation.left, left)), F.col(qualified(relation.right, right))
                )
                for left, right, operator in relation.links
            ],
        )
        other = _prefixed(star, fresh, columns[fresh])
        how = JOIN_TYPES[relation.join_type]
        # The join type is declared from the left table's view; the accumulated side may stand on either side.
        if fresh == relation.left:
            result = other.join(result, condition, how)
        else:
            result = result.join(other, condition, how)
        present.add(fresh)
    return result


def _relationships_to(star: Star, wanted: set[str]) -> list[Relationship]:
    """Relationships that connect the fact with the wanted tables, nearest first."""
    reached: dict[str, list[Relationship]] = {star.fact: []}
    frontier = [star.fact]
    while frontier:
        here = frontier.pop(0)
        for relation in star.relationships:
            for near, far in ((relation.left, relation.right), (relation.right, relation.left)):
                if near == here and far not in reached:
                    reached[far] = [*reached[here], relation]
                    frontier.append(far)
    missing = wanted - reached.keys()
    if missing:
        raise ValueError(f"no relationship leads to {sorted(missing)}")
    needed: list[Relationship] = []
    for table in sorted(wanted, key=lambda name: len(reached[name])):
        needed += [relation for relation in reached[table] if relation not in needed]
    return needed


def _aggregates(items: Sequence[Item]) -> list[Column]:
    return [
        AGGREGATES[item.aggregate](item.reference()).alias(item.name)
        for item in items
        if item.usage == FACT and item.aggregate != "none"
    ]


def star_query(star: Star, items: Sequence[Item]) -> DataFrame:
    """Group by the identifier items and apply each fact item's default aggregate.

    Fact items with aggregate "none" are not summarised: the query then lists rows instead of grouping them.
    """
    inequality = _only_inequality(star, items)
    if inequality is not None:
        return _aggregates_by_inequality(star, items, *inequality)
    rows = joined(star, items)
    if any(item.usage == FACT and item.aggregate == "none" for item in items):
        return rows.select(*[item.reference().alias(item.name) for item in items])
    keys = [item.reference().alias(item.name) for item in items if item.usage == IDENTIFIER]
    return rows.groupBy(*keys).agg(*_aggregates(items))


def _only_inequality(star: Star, items: Sequence[Item]) -> tuple[str, str, str, str] | None:
    """(fact column, operator, table, its column) if the fact's only way to the items' tables is one inequality and the items can be had without
    forming its pairs: identifiers beyond it, mergeable aggregates of the fact."""
    path = [r for r in _relationships_to(star, {item.table for item in items} | {star.fact}) if star.fact in (r.left, r.right)]
    if len(path) != 1 or len(path[0].links) != 1 or path[0].join_type != "none":
        return None
    relation, (left, right, operator) = path[0], path[0].links[0]
    if operator not in ranges.SWAPPED:
        return None
    for item in items:
        if (item.table == star.fact) != (item.usage == FACT) or item.usage == FACT and item.aggregate not in ranges.PARTS:
            return None
    return (left, operator, relation.right, right) if relation.left == star.fact else (right, ranges.SWAPPED[operator], relation.left, left)


def _aggregates_by_inequality(star: Star, items: Sequence[Item], key: str, operator: str, table: str, bound: str) -> DataFrame:
    """Aggregates of the fact's rows that compare with a table's rows, by identifiers of that side; every pair counts, none is formed."""
    measures = {item.name: (item.aggregate, item.column) for item in items if item.usage == FACT}
    identifiers = [item for item in items if item.usage == IDENTIFIER]
    others = [r for r in star.relationships if star.fact not in (r.left, r.right)]
    side = joined(Star(table, star.tables, others), [*identifiers, Item(table, bound)])
    limit = qualified(table, bound)
    parts = ranges.first_parts(measures)
    found = ranges.parts_by_inequality(star.tables[star.fact], key, operator, side, limit, parts)
    # rows of the table that share a value and its identifiers are counted before they meet their sums
    names = [item.name for item in identifiers]
    rows = side.groupBy(limit, *[item.reference().alias(item.name) for item in identifiers]).agg(F.count("*").alias("_copies"))
    # a sum over pairs outgrows the type that holds one over rows, so sums of integers go on as decimals
    widened = [name for name in parts if name.startswith("sum:") and isinstance(found.schema[name].dataType, T.IntegralType)]
    part = {name: F.col(f"`{name}`").cast(WIDE) if name in widened else F.col(f"`{name}`") for name in parts}
    times = [(part[name] * (F.col("_copies") if name.split(":")[0] in ("sum", "count") else F.lit(1))).alias(name) for name in parts]
    met = rows.join(found.where("rows > 0"), limit).select(*names, *times)
    return met.groupBy(*names).agg(*ranges.merged_parts(list(parts))).select(*names, *ranges.measures_of(measures, widened))


def narrowed(result: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Totals over pairs as bigint where every one fits, as they are where one does not. Reads ``result``: pass a stored one."""
    low, high = (F.lit(str(bound)).cast(WIDE) for bound in (-(2**63), 2**63 - 1))
    fit = result.agg(*[F.coalesce(F.bool_and(F.col(name).between(low, high)), F.lit(True)).alias(name) for name in columns]).first()
    return result.withColumns({name: F.col(name).cast("bigint") for name in columns if fit[name]})


def several_facts_query(star: Star, identifiers: Sequence[Item], facts: Mapping[str, Sequence[Item]]) -> DataFrame:
    """Facts of several grains side by side: each is grouped by the shared identifiers on its own, then the groups are brought together.

    A row of one fact is never repeated by another. From each fact only relationships towards a "one" side are followed. A group
    that a fact has no rows in has NULL for its items. NULL identifiers are one group.
    """
    keys = [item.name for item in identifiers]
    parts = []
    for fact, items in facts.items():
        own = _reachable_towards_one(fact, star.relationships)
        parts.append(star_query(Star(fact, star.tables, own), [*identifiers, *items]))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    # at most one row per fact and group, so any aggregate that skips NULL takes its value over
    return stacked.groupBy(*keys).agg(*[F.max(item.name).alias(item.name) for items in facts.values() for item in items])


def _reachable_towards_one(fact: str, relationships: Sequence[Relationship]) -> list[Relationship]:
    """The relationships that lead from a fact to tables each of its rows meets at most once."""
    reached, own, frontier = {fact}, [], [fact]
    while frontier:
        here = frontier.pop(0)
        for relation in relationships:
            steps = ((relation.left, relation.right, relation.right_maxcard), (relation.right, relation.left, relation.left_maxcard))
            for near, far, maxcard in steps:
                if near == here and far not in reached and maxcard == "one":
                    reached.add(far)
                    own.append(relation)
                    frontier.append(far)
    return own


def drill_query(star: Star, path: Sequence[Item], facts: Sequence[Item]) -> DataFrame:
    """Subtotals along a hierarchy (year, month, date): one row per member of every level and one grand total.

    ``drill_level`` is the number of levels shown: 0 for the grand total, which is there without any rows too. The joined rows are shuffled once, reduced
    to the finest level and the columns counted distinctly; every level is then rolled up from the level below it.
    """
    rows = joined(star, [*path, *facts])
    names = [item.name for item in path]
    facts = [item for item in facts if item.usage == FACT and item.aggregate != "none"]
    types = rows.agg(*_aggregates(facts)).schema
    measures = {item.name: (item.aggregate, qualified(item.table, item.column)) for item in facts if item.aggregate in ranges.PARTS}
    counted = {item.name: qualified(item.table, item.column) for item in facts if item.aggregate == "countDistinct"}
    distinct, parts = list(dict.fromkeys(counted.values())), ranges.first_parts(measures)
    # a level holds each value of an only counted column once per group, so no second table of them is needed to count them
    number = F.count if len(distinct) == 1 else F.count_distinct

    level = rows.groupBy(*[item.reference().alias(item.name) for item in path], *distinct).agg(
        F.count("*").alias("rows"), *[column.alias(name) for name, column in parts.items()]
    )
    levels = []
    for shown in range(len(names), -1, -1):
        kept = names[:shown]
        if shown < len(names):
            level = level.groupBy(*kept, *distinct).agg(*ranges.merged_parts(["rows", *parts]))
        sums = level.groupBy(*kept).agg(
            *ranges.merged_parts(list(parts)), *[number(F.col(column)).alias(name) for name, column in counted.items()], F.lit(1).alias("_")
        )
        found = sums.select(*kept, F.lit(shown).alias("drill_level"), *ranges.measures_of(measures), *counted)
        levels.append(found.select(*kept, "drill_level", *[F.col(f.name).cast(f.dataType).alias(f.name) for f in types]))
    result = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), levels)
    return result.select(*names, "drill_level", *[item.name for item in facts])


def cardinality_breaches(star: Star) -> DataFrame:
    """Join keys that repeat on a side declared as "one": relationship, table, key and number of rows."""
    parts = []
    for relation in star.relationships:
        sides = (
            (relation.left, relation.left_maxcard, [link[0] for link in relation.links]),
            (relation.right, relation.right_maxcard, [link[1] for link in relation.links]),
        )
        for table, maxcard, keys in sides:
            if maxcard != "one":
                continue
            repeated = repeated_values(star.tables[table].select(*keys), keys)
            parts.append(
                repeated.select(
                    F.lit(f"{relation.left}_{relation.right}").alias("relationship"),
                    F.lit(table).alias("table_name"),
                    F.concat_ws(",", *[F.col(key).cast("string") for key in keys]).alias("key"),
                    "n_records",
                )
            )
    if not parts:  # no side is declared as one
        spark = next(iter(star.tables.values())).sparkSession
        return spark.createDataFrame([], "relationship string, table_name string, key string, n_records long")
    return reduce(lambda a, b: a.unionByName(b), parts)


def normalised_dimension(df: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """One row per key; attributes that differ within a key take their minimum."""
    return df.groupBy(key).agg(*[F.min(name).alias(name) for name in attributes])
