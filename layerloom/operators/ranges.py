"""Aggregates over all rows below (or above) a bound, without forming the pairs.

Both sides are reduced to their distinct values, cut into bands at shared quantiles and summed within a band by a window; the bands before it come
in as one row per band. A value that a third of the rows share is one row, and no band depends on how many rows meet.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, Window as W, functions as F

# What an inequality link means when its sides are swapped.
SWAPPED = {
    "lessThan": "greaterThan",
    "greaterThan": "lessThan",
    "lessThanOrEqualTo": "greaterThanOrEqualTo",
    "greaterThanOrEqualTo": "lessThanOrEqualTo",
}

MERGE = {"rows": F.sum, "sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
# The parts from which a default aggregate is put together.
PARTS = {"total": ("sum",), "average": ("sum", "count"), "minimum": ("min",), "maximum": ("max",), "count": ("count",)}


def first_parts(measures: Mapping[str, tuple[str, str]]) -> dict[str, Column]:
    """The mergeable parts of measures (name -> aggregate, column), over single rows."""
    make = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
    return {f"{part}:{name}": make[part](column) for name, (aggregate, column) in measures.items() for part in PARTS[aggregate]}


def merged_parts(names: list[str], over=None) -> list[Column]:
    merged = {name: MERGE[name.split(":")[0]](F.col(f"`{name}`")) for name in names}
    return [(column if over is None else column.over(over)).alias(name) for name, column in merged.items()]


def measures_of(measures: Mapping[str, tuple[str, str]], widened: Collection[str] = ()) -> list[Column]:
    """The measures from their merged parts. Sums in ``widened`` are integers kept as decimals; their averages are doubles, as of integers."""

    def divided(name: str) -> Column:
        total = F.col(f"`sum:{name}`")
        return F.try_divide(total.cast("double") if f"sum:{name}" in widened else total, F.col(f"`count:{name}`"))

    value = {
        "total": lambda name: F.col(f"`sum:{name}`"),
        "average": divided,
        "minimum": lambda name: F.col(f"`min:{name}`"),
        "maximum": lambda name: F.col(f"`max:{name}`"),
        "count": lambda name: F.coalesce(F.col(f"`count:{name}`"), F.lit(0)),
    }
    return [value[aggregate](name).alias(name) for name, (aggregate, _) in measures.items()]


def _band(value: Column, cuts: list, ascending: bool) -> Column:
    """The band of a value: how many cuts come before it."""
    if not cuts:
        return F.lit(0)
    before = F.size(F.filter(F.array(*[F.lit(cut) for cut in cuts]), lambda cut: cut < value))
    return before if ascending else F.lit(len(cuts)) - before


def parts_by_inequality(
    facts: DataFrame, key: str, operator: str, bounds: DataFrame, bound: str, parts: Mapping[str, Column], bands: int | None = None
) -> DataFrame:
    """Per distinct value of ``bound``: the parts over all facts with ``key`` <operator> ``bound``, and their number (``rows``).

    NULL keys and bounds meet nothing. Values nothing lies below have ``rows`` 0. ``bands`` defaults to the session's shuffle partitions; their cuts are
    the only values that come to the driver.
    """
    spark = facts.sparkSession
    bands = bands or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ascending, strict = operator.startswith("less"), not operator.endswith("EqualTo")
    names = ["rows", *parts]
    reduced = facts.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_value")).agg(
        F.count("*").alias("rows"), *[column.alias(name) for name, column in parts.items()]
    )
    shares = [i / bands for i in range(1, bands)]
    found = reduced.agg(F.percentile_approx("_value", shares).alias("cuts")).first()["cuts"] if shares else None
    cuts = sorted(set(found or []))

    # at equal values a strict comparison reads the bound first
    facts_at, bounds_at = (1, 0) if strict else (0, 1)
    asked = bounds.select(F.col(bound).alias("_value")).where(F.col("_value").isNotNull()).distinct()
    band = _band(F.col("_value"), cuts, ascending).alias("_band")
    reduced = reduced.select("*", band, F.lit(facts_at).alias("_at"))
    events = reduced.unionByName(asked.select("*", band, F.lit(bounds_at).alias("_at")), allowMissingColumns=True)
    order = F.col("_value") if ascending else F.col("_value").desc()
    within = W.partitionBy("_band").orderBy(order, "_at").rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = events.select("_value", "_band", "_at", *merged_parts(names, within)).where(F.col("_at") == bounds_at)

    # each band's row is handed to all later bands, which is bounded by the number of bands and needs no window over all of them
    per_band = reduced.groupBy("_band").agg(*merged_parts(names)).where(F.col("_band") < len(cuts))
    later = F.explode(F.sequence(F.col("_band") + 1, F.lit(len(cuts)))).alias("_band")
    before = per_band.select(later, *[F.col(f"`{name}`") for name in names]).groupBy("_band").agg(*merged_parts(names))
    both = inside.drop("_at").unionByName(
        inside.select("_value", "_band").join(F.broadcast(before), "_band")
    )  # two rows per bound: its own band and the bands before it
    result = both.groupBy("_value").agg(*merged_parts(names))
    return result.withColumn("rows", F.coalesce("rows", F.lit(0))).withColumnRenamed("_value", bound)
