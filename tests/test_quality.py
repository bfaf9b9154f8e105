import datetime as dt

from pyspark.sql import functions as F

from layerloom.operators import quality as q, semantic as sem


def readings(spark, counts):
    data = [("z", dt.date(2024, 1, day), i) for day, n in counts.items() for i in range(n)]
    return spark.createDataFrame(data, "zone string, day date, i int")


def test_allowed_counts(spark, rows):
    df = readings(spark, {1: 23, 2: 24, 3: 25, 4: 92, 5: 96, 6: 100, 7: 22, 8: 48})
    found = q.incomplete_groups(df, ["zone", "day"], q.PRICE_INTERVALS_PER_DAY, "n")
    assert rows(found, "day", "n") == [(dt.date(2024, 1, 7), 22), (dt.date(2024, 1, 8), 48)]
    assert q.incomplete_groups(df, ["zone", "day"], q.HOURS_PER_DAY, "n").count() == 7


def test_ranges_take_bounds_and_null_as_fine(spark, rows):
    df = spark.createDataFrame([(1, -40.0), (2, 50.0), (3, 50.1), (4, -40.1), (5, None)], "id int, t double")
    assert rows(q.out_of_range(df, "t", *q.TEMPERATURE_RANGE, keep=["id"]), "id") == [(3,), (4,)]


def test_deviation(spark, rows):
    df = spark.createDataFrame([(1, 10.0, 30.0), (2, 10.0, 30.5), (3, None, 1.0)], "id int, a double, t double")
    assert rows(q.deviating_rows(df, "a", "t", 20, ["id"])) == [(2, 30.5, 10.0, 20.5)]


def test_null_keys_are_no_orphans_and_no_duplicates(spark, rows):
    child = spark.createDataFrame([(1, "a"), (2, "x"), (3, "x"), (4, None), (5, None)], "id int, k string")
    parent = spark.createDataFrame([("a",), (None,)], "k string")
    assert rows(q.orphans(child, "k", parent, "k"), "id") == [(2,), (3,)]
    assert rows(q.orphan_keys(child, "k", parent, "k")) == [("x", 2)]
    assert rows(q.repeated_values(child, ["k"])) == [("x", 2)]
    assert rows(q.null_rows(child, "k"), "id") == [(4,), (5,)]


def test_missing_days(spark, rows):
    df = readings(spark, {1: 1, 2: 2, 5: 1})
    assert rows(q.missing_days(df, "day")) == [(dt.date(2024, 1, 3),), (dt.date(2024, 1, 4),)]
    assert q.missing_days(df.limit(0), "day").count() == 0


def test_unequal_sums(spark, rows):
    detail = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 5.0), (3, 1.0)], "k int, v double")
    total = spark.createDataFrame([(1, 3.0), (2, 5.5), (4, 1.0)], "k int, t double")
    assert rows(q.unequal_sums(detail, total, ["k"], "v", "t", 0.1)) == [(2, 5.0, 5.5), (3, 1.0, None), (4, None, 1.0)]


def test_growth(spark, rows):
    before, after = readings(spark, {1: 24, 2: 24}), readings(spark, {1: 24, 2: 48, 3: 1})
    assert rows(q.slices_that_grew(before, after, ["day"])) == [(dt.date(2024, 1, 2), 24, 48), (dt.date(2024, 1, 3), None, 1)]


def test_report_finds_seeded_defects_and_is_clean_without(spark):
    good = spark.createDataFrame([(i, "a", 10.0) for i in range(24)], "id int, k string, t double")
    bad = good.unionByName(spark.createDataFrame([(1, "b", 99.0), (None, "c", None)], good.schema))
    parents = spark.createDataFrame([("a",)], "k string")

    def failures(df):
        rules = [
            q.not_null("id"),
            q.accepted_values("k", ["a", "b"]),
            q.in_range("t", *q.TEMPERATURE_RANGE),
            q.holds("positive", "t", F.col("t") > 0),
            q.unique(df, "id"),
            q.relationship(df, "k", parents),
            q.complete(df, ["k"], q.HOURS_PER_DAY),
            q.row_count_between(df, 1, 24),
            q.mean_between(df, "t", 9, 11),
            q.same_row_count(df, good),
        ]
        return {(row.rule, row.column_name): row.failures for row in q.report({"t": (df, rules)}).collect()}

    assert set(failures(good).values()) == {0}
    assert failures(bad) == {
        ("not_null", "id"): 1,
        ("accepted_values", "k"): 1,
        ("in_range", "t"): 1,
        ("positive", "t"): 0,
        ("unique", "id"): 1,
        ("relationships", "k"): 2,
        ("complete", "k"): 2,
        ("row_count_between", "*"): 1,
        ("mean_between", "t"): 1,
        ("same_row_count", "*"): 1,
    }


def star(spark, join_type="none"):
    sales = spark.createDataFrame([(1, 1, 10.0), (2, 1, 5.0), (3, 9, 2.0)], "id int, c int, v double")
    customers = spark.createDataFrame([(1, "x", 1), (2, "y", 1)], "c int, name string, n int")
    nations = spark.createDataFrame([(1, "N")], "n int, nation string")
    links = [sem.Relationship("customer", "sales", [("c", "c", "equalTo")], join_type), sem.Relationship("nation", "customer", [("n", "n", "equalTo")])]
    return sem.Star("sales", {"sales": sales, "customer": customers, "nation": nations}, links)


def test_join_types(spark, rows):
    items = [sem.Item("customer", "name"), sem.Item("sales", "v", sem.FACT, "total", "v")]
    assert rows(sem.star_query(star(spark), items)) == [("x", 15.0)]
    assert rows(sem.star_query(star(spark, "outerLeftBody"), items)) == [("x", 15.0), ("y", None)]
    assert rows(sem.star_query(star(spark, "outerRightBody"), items)) == [("x", 15.0), (None, 2.0)]
    assert rows(sem.star_query(star(spark, "outerFullBody"), items)) == [("x", 15.0), ("y", None), (None, 2.0)]


def test_tables_on_the_way_are_joined(spark, rows):
    items = [sem.Item("nation", "nation"), sem.Item("sales", "id", sem.FACT, "countDistinct", "sales")]
    assert rows(sem.star_query(star(spark), items)) == [("N", 2)]


def test_unreachable_table(spark):
    import pytest

    with pytest.raises(ValueError, match="nowhere"):
        sem.star_query(star(spark), [sem.Item("nowhere", "x")])


def test_drill_levels(spark, rows):
    path = [sem.Item("nation", "nation"), sem.Item("customer", "name")]
    found = sem.drill_query(star(spark), path, [sem.Item("sales", "v", sem.FACT, "total", "v")])
    assert rows(found) == [("N", "x", 2, 15.0), ("N", None, 1, 15.0), (None, None, 0, 15.0)]


def test_cardinality(spark, rows):
    base = star(spark)
    assert sem.cardinality_breaches(base).count() == 0
    wrong = sem.Relationship("customer", "sales", [("n", "c", "equalTo")])
    assert rows(sem.cardinality_breaches(sem.Star("sales", base.tables, [wrong]))) == [("customer_sales", "customer", "1", 2)]
