import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from layerloom.operators import dims, history

START = dt.datetime(2024, 1, 1)


def at(day, hour=0):
    return START + dt.timedelta(days=day, hours=hour)


def snapshots(spark, rows):
    return spark.createDataFrame(rows, "hk string, load_date timestamp_ntz, hashdiff string")


def hot(spark, df, keys=("hk",), min_rows=1, grain=None):
    found = history.find_hot_keys(df, list(keys), min_rows=min_rows, grain=grain)
    assert found.frame is not None
    return found


NONE = history.HotKeys()


def test_a_returning_state_is_a_new_version(spark, rows):
    df = snapshots(spark, [("x", at(d), h) for d, h in enumerate("AABA")])
    expected = [("x", at(0), "A"), ("x", at(2), "B"), ("x", at(3), "A")]
    assert rows(history.changes_only(df, ["hk"], "load_date", "hashdiff", hot=NONE)) == expected
    assert rows(history.changes_only(df, ["hk"], "load_date", "hashdiff", hot=hot(spark, df))) == expected


def test_equal_load_times_give_one_version(spark, rows):
    df = snapshots(spark, [("x", at(0), "A"), ("x", at(0), "B"), ("x", at(1), "A")])
    versions = history.changes_only(df, ["hk"], "load_date", "hashdiff")
    assert rows(versions) == [("x", at(0), "B"), ("x", at(1), "A")]


def test_validity(spark, rows):
    df = snapshots(spark, [("x", at(d), h) for d, h in enumerate("ABC")] + [("y", at(5), "A")])
    expected = [
        ("x", "A", at(0), at(1), 1, False),
        ("x", "B", at(1), at(2), 2, False),
        ("x", "C", at(2), None, 3, True),
        ("y", "A", at(5), None, 1, True),
    ]
    columns = ["hk", "hashdiff", "valid_from", "valid_to", "version_number", "is_current"]
    assert rows(history.with_validity(df, ["hk"], "load_date", hot=NONE), *columns) == expected
    assert rows(history.with_validity(df, ["hk"], "load_date", hot=hot(spark, df)), *columns) == expected


def random_history(seed, size=400):
    """One key holds a third of the rows; times are unique per key."""
    rng = random.Random(seed)
    found = {}
    for _ in range(size):
        key = "hot" if rng.random() < 0.34 else f"k{rng.randrange(20)}"
        found[(key, at(rng.randrange(40), rng.randrange(24)))] = rng.choice("ABC")
    return [(key, time, value) for (key, time), value in found.items()]


@pytest.mark.parametrize("seed, grain", [(1, "day"), (2, "hour"), (3, "month"), (4, None)])
def test_chunks_give_the_same_history(spark, rows, seed, grain):
    df = snapshots(spark, random_history(seed))
    cut = hot(spark, df, min_rows=15, grain=grain)
    assert [row.hk for row in cut.frame.collect()].count("hot") == 1
    plain = history.with_validity(history.changes_only(df, ["hk"], "load_date", "hashdiff", hot=NONE), ["hk"], "load_date", hot=NONE)
    in_chunks = history.with_validity(history.changes_only(df, ["hk"], "load_date", "hashdiff", hot=cut), ["hk"], "load_date", hot=cut)
    assert rows(in_chunks, *plain.columns) == rows(plain)


def test_versions_take_one_shuffle_and_one_sort(spark):
    df = snapshots(spark, random_history(5))
    versions = history.changes_only(df, ["hk"], "load_date", "hashdiff", hot=NONE)
    plan = history.with_validity(versions, ["hk"], "load_date", hot=NONE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count(" Sort ") == 1


def test_intervals_do_not_overlap_and_one_version_is_current(spark):
    df = snapshots(spark, random_history(7))
    found = {}
    for row in history.with_validity(history.changes_only(df, ["hk"], "load_date", "hashdiff"), ["hk"], "load_date").collect():
        found.setdefault(row.hk, []).append(row)
    for versions in found.values():
        versions.sort(key=lambda row: row.valid_from)
        assert [row.version_number for row in versions] == list(range(1, len(versions) + 1))
        assert [row.valid_to for row in versions] == [row.valid_from for row in versions[1:]] + [None]
        assert [row.is_current for row in versions] == [False] * (len(versions) - 1) + [True]
        assert all(a.hashdiff != b.hashdiff for a, b in zip(versions, versions[1:]))


def test_a_key_with_all_rows_in_one_day_is_cut(spark, rows):
    data = [("hot", START + dt.timedelta(seconds=i), f"h{i // 3}") for i in range(20_000)] + [("x", at(d), "A") for d in range(5)]
    data += [("hot", START + dt.timedelta(seconds=20_000), f"s{i}") for i in range(50)]  # one instant
    df = spark.createDataFrame(data, "hk string, load_date timestamp_ntz, hashdiff string")
    cut = hot(spark, df, min_rows=100)
    sizes = history.chunked(df.where("hk = 'hot'"), ["hk"], "load_date", cut).groupBy(history.CHUNK).count().collect()
    assert len(sizes) > 500 and max(row["count"] for row in sizes) < 200
    versions = history.changes_only(df, ["hk"], "load_date", "hashdiff", hot=cut)
    assert rows(versions) == rows(history.changes_only(df, ["hk"], "load_date", "hashdiff", hot=NONE))
    assert rows(history.with_validity(versions, ["hk"], "load_date", hot=cut)) == rows(history.with_validity(versions, ["hk"], "load_date", hot=NONE))


def test_hot_keys_are_a_bounded_list(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    assert history.find_hot_keys(df, ["k"], share=0.1, min_rows=10).frame.collect()[0].k == "hot"
    assert history.find_hot_keys(df, ["k"]).frame is None


@pytest.mark.parametrize("seed", [11, 12])
def test_point_in_time_plans_agree(spark, rows, seed):
    versions = history.with_validity(
        history.changes_only(snapshots(spark, random_history(seed)), ["hk"], "load_date", "hashdiff"), ["hk"], "load_date"
    )
    # End one version early, so that there is a gap.
    versions = versions.withColumn(
        "valid_to", F.when(F.col("version_number") == 2, F.col("valid_from") + F.expr("interval 1 hour")).otherwise(F.col("valid_to"))
    )
    rng = random.Random(seed)
    keys = [f"k{i}" for i in range(22)] + ["hot"] * 11
    facts = [(i, rng.choice(keys), at(rng.randrange(-2, 45), rng.randrange(24))) for i in range(500)]
    facts += [(900 + i, row.hk, row.valid_from) for i, row in enumerate(versions.limit(20).collect())]
    facts = spark.createDataFrame(facts, "id int, hk string, t timestamp_ntz")
    options = {"attributes": ["hashdiff", "version_number"]}
    small = history.interval_join(facts, versions, ["hk"], "t", **options)
    large = history.carry_forward_join(facts, versions, ["hk"], "t", hot=NONE, **options)
    cut = hot(spark, facts, min_rows=20)
    in_chunks = history.carry_forward_join(facts, versions, ["hk"], "t", hot=cut, **options)
    expected = rows(small, "id", "hk", "t", "hashdiff", "version_number")
    assert len(expected) > 300
    assert rows(large) == expected
    assert rows(in_chunks) == expected


def test_the_size_of_the_versions_does_not_show(spark, rows, monkeypatch):
    """Overlapping versions, versions that begin together, and NULL keys, times and beginnings: one meaning on both plans and for hot keys."""
    versions = [
        ("a", at(0), at(5), "A0"), ("a", at(3), at(9), "A3"), ("a", at(3), at(4), "short"), ("a", None, at(9), "no start"), ("a", at(20), None, "A20"),
        (None, at(0), None, "no key"), ("b", at(2), at(3), "B2"), ("b", at(6), None, "B6"),
    ]
    versions = spark.createDataFrame(versions, "hk string, valid_from timestamp_ntz, valid_to timestamp_ntz, h string")
    facts = [(i, hk, at(day, 1)) for i, (hk, day) in enumerate((hk, day) for hk in ("a", "b", "c", None) for day in range(0, 24))]
    facts = spark.createDataFrame([*facts, (900, "a", None), (901, None, None)], "id int, hk string, t timestamp_ntz")
    join = lambda heat: rows(history.point_in_time_join(facts, versions, ["hk"], "t", attributes=["h"], hot=heat))
    heat = history.find_hot_keys(facts, ["hk"], share=0.01, min_rows=2)
    assert heat.frame.count() == 4  # NULL is one of them
    expected = join(NONE)
    assert [row[0] for row in expected if row[3] == "A0"] == [0, 1, 2] and {row[3] for row in expected if row[1] == "a"} == {"A0", "A3", "A20"}
    monkeypatch.setattr(history, "MAX_SENT_VERSIONS", 1)
    assert join(NONE) == expected and join(heat) == expected


def test_null_orders_and_keys_stay_for_hot_keys(spark, rows):
    data = [(hk, when, i) for i, (hk, when) in enumerate((hk, when) for hk in ("a", None) for when in (None, at(1), at(2), at(2, 5), at(9)))]
    df = spark.createDataFrame(data, "hk string, t timestamp_ntz, id int")
    heat = history.find_hot_keys(df, ["hk"], share=0.01, min_rows=1)
    options = {"previous": {"before": "id"}, "following": {"after": "id"}, "position": "n"}
    plain = rows(history.neighbours(df, ["hk"], "t", hot=NONE, **options))
    assert len(plain) == 10
    for grain in ("hour", "day", "month", None):
        assert rows(history.neighbours(df, ["hk"], "t", hot=history.HotKeys(heat.frame, grain), **options)) == plain


def test_many_versions_of_one_key_are_not_compared_pairwise(spark):
    facts = spark.createDataFrame([(1, "a", at(0, 5))], "id int, hk string, t timestamp_ntz")
    versions = spark.range(history.MAX_COMPARED_VERSIONS + 1).select(
        F.lit("a").alias("hk"),
        F.timestamp_add("HOUR", "id", F.lit(START).cast("timestamp_ntz")).alias("valid_from"),
        F.timestamp_add("HOUR", F.col("id") + 1, F.lit(START).cast("timestamp_ntz")).alias("valid_to"),
        "id",
    )
    versions = versions.select("hk", "valid_from", "valid_to", F.col("id").alias("version"))
    joined = history.point_in_time_join(facts, versions, ["hk"], "t", attributes=["version"], hot=NONE)
    assert "Window" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.first().version == 5


def test_latest_row_with_a_tie(spark, rows):
    df = snapshots(spark, [("x", at(1), "A"), ("x", at(1), "B"), ("x", at(0), "C")])
    assert rows(history.latest_per_key(df, ["hk"], "load_date", ["hashdiff"])) == [("x", at(1), "B")]


@pytest.mark.parametrize("sent", [0, 500_000])
def test_rows_of_keys_that_hardly_repeat_are_not_shuffled(spark, rows, monkeypatch, sent):
    """One row per key, NULL a key too; hashes of repeated keys are sent to the rows up to a bound, and joined by a shuffle beyond it."""
    monkeypatch.setattr(history, "MAX_SENT_HASHES", sent)
    entries = [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "x"), (None, 3, "z"), (None, 3, "w"), ("c", None, "x"), ("c", None, "x")]
    df = spark.createDataFrame(entries, "k string, n int, v string")
    assert rows(history.one_per_repeated(df, ["k"], ["n", "v"])) == rows(history.one_per(df, ["k"], ["n", "v"]))
    assert rows(history.one_per_repeated(df, ["k"], ["n", "v"], ["k", "v"])) == rows(history.one_per(df, ["k", "v"], ["n", "v"]))
    alone = df.where("k = 'b'")
    assert rows(history.one_per_repeated(alone, ["k"], ["n"])) == [("b", 1, "x")]
    if sent:  # what is left of the rows goes on as it was read: the anti join's side is no exchange
        plan = history.one_per_repeated(df, ["k"], ["n", "v"])._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_dimensions_are_not_sent_through_the_driver(spark, rows):
    """Hub and satellites of a dimension grow with the entities; even small ones are joined without a broadcast."""
    hub = spark.createDataFrame([(h, h.upper()) for h in "abc"], "hk string, bk string")
    satellite = spark.createDataFrame([("a", "1", at(0), 5), ("b", "2", at(0), 6), ("a", "3", at(1), 7)], "hk string, d string, load_date timestamp_ntz, v int")
    extra = spark.createDataFrame([("a", "9", at(0), 8)], "hk string, e string, load_date timestamp_ntz, w int")
    found = dims.current_dimension_with_extra(
        hub, satellite, extra, "sk", "hk", "bk", "id", hashdiff="d", attributes=["v"], extra_hashdiff="e", extra_attributes=["w"]
    )
    assert rows(found, "id", "v", "w") == [("A", 7, 8), ("B", 6, None)]
    versions = dims.versioned_dimension(hub, satellite, "sk", "hk", "bk", "d", ["v"])
    for df in (found, versions):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
