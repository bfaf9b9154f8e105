"""Star queries that need more than joins on keys: inequalities alone, several facts, drill levels."""

import random
from decimal import Decimal

import pytest

from layerloom.operators import ranges, semantic as sem
from pyspark.sql import functions as F

COMPARE = {
    "lessThan": lambda a, b: a < b,
    "lessThanOrEqualTo": lambda a, b: a <= b,
    "greaterThan": lambda a, b: a > b,
    "greaterThanOrEqualTo": lambda a, b: a >= b,
}


@pytest.mark.parametrize("operator", COMPARE)
@pytest.mark.parametrize("bands", [1, 7])
def test_parts_by_inequality_equal_all_pairs(spark, operator, bands):
    rng = random.Random(5)
    # a third of the keys are one value; some are NULL
    keys = [None if i % 11 == 0 else 4 if i % 3 == 0 else rng.randint(-20, 20) for i in range(400)]
    bounds = [None, -100, 100, *[rng.randint(-25, 25) for _ in range(60)]]
    facts = spark.createDataFrame([(k, i % 17) for i, k in enumerate(keys)], "k int, v int")
    limits = spark.createDataFrame([(b,) for b in bounds], "b int")
    measures = {"total": ("total", "v"), "least": ("minimum", "v"), "most": ("maximum", "v"), "n": ("count", "v"), "mean": ("average", "v")}
    found = ranges.parts_by_inequality(facts, "k", operator, limits, "b", ranges.first_parts(measures), bands)
    result = {r["b"]: r for r in found.select("b", "rows", *ranges.measures_of(measures)).collect()}
    assert set(result) == {b for b in bounds if b is not None}
    for b, row in result.items():
        values = [i % 17 for i, k in enumerate(keys) if k is not None and COMPARE[operator](k, b)]
        assert row["rows"] == len(values) == row["n"]
        if values:
            assert (row["total"], row["least"], row["most"]) == (sum(values), min(values), max(values))
            assert row["mean"] == pytest.approx(sum(values) / len(values))
        else:
            assert row["total"] is None and row["mean"] is None


def inequality_star(spark):
    sales = spark.createDataFrame([(1, 10), (2, 20), (2, 5), (9, 1), (None, 7)], "day int, v int")
    periods = spark.createDataFrame([("a", 2, 1), ("a", 2, 1), ("b", 9, 1), ("c", 0, 2), ("d", None, 2)], "name string, until int, g int")
    groups = spark.createDataFrame([(1, "G"), (2, "H")], "g int, label string")
    links = [sem.Relationship("period", "sales", [("until", "day", "greaterThanOrEqualTo")]), sem.Relationship("group", "period", [("g", "g", "equalTo")])]
    return sem.Star("sales", {"sales": sales, "period": periods, "group": groups}, links)


def test_a_relationship_of_one_inequality(spark, rows):
    """Equal rows of the table count each; rows that meet nothing are not there, as in an inner join."""
    total = sem.Item("sales", "v", sem.FACT, "total", "v")
    found = sem.star_query(inequality_star(spark), [sem.Item("period", "name"), total])
    assert rows(found) == [("a", 70), ("b", 36)]
    assert rows(sem.star_query(inequality_star(spark), [sem.Item("group", "label"), total])) == [("G", 106)]


def test_pairs_of_an_inequality_are_not_listed(spark):
    items = [sem.Item("period", "name"), sem.Item("sales", "v", sem.FACT, "none", "v")]
    with pytest.raises(ValueError, match="equalTo"):
        sem.star_query(inequality_star(spark), items)


def test_no_pairs_are_formed(spark, capsys):
    total = sem.Item("sales", "v", sem.FACT, "total", "v")
    sem.star_query(inequality_star(spark), [sem.Item("period", "name"), total]).explain()
    plan = capsys.readouterr().out
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_facts_of_several_grains(spark, rows):
    orders = spark.createDataFrame([(1, "x", 10), (2, "x", 5), (3, "y", 7), (4, None, 1)], "o int, c string, total int")
    lines = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (3, 4)], "o int, q int")
    customers = spark.createDataFrame([("x", "N"), ("y", None)], "c string, nation string")
    links = [
        sem.Relationship("orders", "lines", [("o", "o", "equalTo")]),
        sem.Relationship("customers", "orders", [("c", "c", "equalTo")], "outerRightBody"),
    ]
    star = sem.Star("lines", {"orders": orders, "lines": lines, "customers": customers}, links)
    found = sem.several_facts_query(
        star,
        [sem.Item("customers", "nation")],
        {
            "orders": [sem.Item("orders", "total", sem.FACT, "total", "value")],
            "lines": [sem.Item("lines", "q", sem.FACT, "total", "quantity")],
        },
    )
    assert rows(found) == [("N", 15, 6), (None, 8, 4)]


def test_a_fact_does_not_pass_through_a_finer_one(spark):
    lines = spark.createDataFrame([(1, 1)], "o int, p int")
    star = sem.Star(
        "lines",
        {"orders": spark.createDataFrame([(1, 5)], "o int, total int"), "lines": lines, "parts": spark.createDataFrame([(1, "b")], "p int, brand string")},
        [sem.Relationship("orders", "lines", [("o", "o", "equalTo")]), sem.Relationship("parts", "lines", [("p", "p", "equalTo")])],
    )
    with pytest.raises(ValueError, match="parts"):
        sem.several_facts_query(star, [sem.Item("parts", "brand")], {"orders": [sem.Item("orders", "total", sem.FACT, "total", "value")]})


def drill_star(spark):
    data = [(y, m, v, d, Decimal(v)) for y, m, v, d in [(1, 1, 5, "a"), (1, 1, 6, "b"), (1, 2, 7, "a"), (2, 1, 8, None), (None, 3, 9, "a")]]
    return sem.Star("f", {"f": spark.createDataFrame(data, "y int, m int, v int, d string, e decimal(9,2)")}, [])


def test_drill_levels_equal_a_rollup(spark, rows):
    fact = lambda column, aggregate, alias: sem.Item("f", column, sem.FACT, aggregate, alias)
    facts = [
        fact("v", "total", "total"), fact("v", "average", "mean"), fact("d", "countDistinct", "kinds"), fact("v", "minimum", "least"),
        fact("v", "maximum", "most"), fact("d", "count", "named"), fact("e", "total", "exact"), fact("v", "countDistinct", "values"),
    ]
    found = sem.drill_query(drill_star(spark), [sem.Item("f", "y"), sem.Item("f", "m")], facts)
    table = drill_star(spark).tables["f"]
    shown = 2 - F.grouping("y").cast("int") - F.grouping("m").cast("int")
    expected = table.rollup("y", "m").agg(
        shown.alias("drill_level"), F.sum("v").alias("total"), F.avg("v").alias("mean"), F.count_distinct("d").alias("kinds"),
        F.min("v").alias("least"), F.max("v").alias("most"), F.count("d").alias("named"), F.sum("e").alias("exact"), F.count_distinct("v").alias("values"),
    )
    assert rows(found) == rows(expected)
    assert [f.dataType for f in found.schema] == [f.dataType for f in expected.schema]


def test_drill_of_no_rows_is_the_grand_total(spark, rows):
    base = drill_star(spark)
    empty = sem.Star("f", {"f": base.tables["f"].limit(0)}, [])
    found = sem.drill_query(empty, [sem.Item("f", "y")], [sem.Item("f", "v", sem.FACT, "total", "v"), sem.Item("f", "d", sem.FACT, "countDistinct", "d")])
    assert rows(found) == [(None, 0, None, 0)]


def test_totals_over_pairs_beyond_a_bigint(spark):
    """As many pairs as make the total greater than a bigint: it is a decimal, and its average a double; a total that fits becomes a bigint."""
    facts = spark.createDataFrame([(1, 2**61), (2, 2**61), (3, 2**61)], "day int, v long")
    sides = spark.createDataFrame([("a", 9), ("a", 9), ("b", 2)], "name string, until int")
    links = [sem.Relationship("side", "facts", [("until", "day", "greaterThanOrEqualTo")])]
    items = [sem.Item("side", "name"), sem.Item("facts", "v", sem.FACT, "total", "v"), sem.Item("facts", "v", sem.FACT, "average", "mean")]
    found = sem.star_query(sem.Star("facts", {"facts": facts, "side": sides}, links), items)
    assert {r["name"]: (int(r["v"]), r["mean"]) for r in found.collect()} == {"a": (6 * 2**61, 2.0**61), "b": (2 * 2**61, 2.0**61)}
    assert dict(sem.narrowed(found, ["v"]).dtypes)["v"] == "decimal(38,0)"
    small = sem.narrowed(found.where("name = 'b'"), ["v"])
    assert dict(small.dtypes)["v"] == "bigint" and small.first()["v"] == 2**62
    assert dict(sem.narrowed(found.where("name = 'c'"), ["v"]).dtypes)["v"] == "bigint"


def test_bands_need_no_window_over_all(spark):
    facts = spark.createDataFrame([(i % 50, i) for i in range(200)], "k int, v int")
    found = ranges.parts_by_inequality(facts, "k", "lessThan", facts.select(F.col("k").alias("b")), "b", ranges.first_parts({"t": ("total", "v")}), 7)
    assert "SinglePartition" not in found._jdf.queryExecution().executedPlan().toString()


def test_one_counted_column_is_counted_from_its_level(spark):
    """Copies, NULL values and NULL members count as by count(distinct); the plan holds no second distinct aggregate."""
    sales = spark.createDataFrame([(1, 1, 5), (1, 1, 5), (1, 2, 5), (1, 2, None), (None, 1, 7), (2, 1, None)], "y int, m int, p int")
    item = lambda column, *more: sem.Item("sales", column, *more)
    found = sem.drill_query(sem.Star("sales", {"sales": sales}), [item("y"), item("m")], [item("p", sem.FACT, "countDistinct", "parts")])
    plain = sales.rollup("y", "m").agg(F.count_distinct("p").alias("parts"), (2 - F.grouping("y") - F.grouping("m")).cast("int").alias("drill_level"))
    assert sorted(map(str, found.select("y", "m", "drill_level", "parts").collect())) == sorted(map(str, plain.select("y", "m", "drill_level", "parts").collect()))
    assert "distinct" not in found._jdf.queryExecution().optimizedPlan().toString().lower()
