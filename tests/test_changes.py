"""The record of changes, and the deltas that readers take from it."""

import pytest
from pyspark.sql import functions as F

from layerloom.operators import changes, deltas, sinks
from layerloom.operators.deltas import Delta
from layerloom.plans import warehouse
from layerloom.sources.schemas import RAW_PARTITIONS, RAW_SLICES
from layerloom.sources.tables import table_path

SCHEMA = "day date, zone string, v int, loaded timestamp"
PARTITION, SLICE = ["day"], ["day", "zone"]


def frame(spark, rows):
    return spark.createDataFrame([(d, z, v, "2024-01-01 00:00:00") for d, z, v in rows], "day string, zone string, v int, loaded string").selectExpr(
        "cast(day as date) day", "zone", "v", "cast(loaded as timestamp) loaded"
    )


def load(spark, path, rows):
    sinks.replace_slices(spark, frame(spark, rows), path, PARTITION, SLICE)


def delta(spark, path, reader="reader"):
    table = spark.read.schema(SCHEMA).parquet(path)
    return Delta(spark, table, path, "day", "loaded", f"{path}-{reader}")


@pytest.fixture
def no_content(monkeypatch):
    """No state may be taken from a table's content."""

    def stop(*_):
        raise AssertionError("the whole table is read")

    monkeypatch.setattr(deltas, "state_of", stop)


def test_a_slice_is_one_partition_of_the_delta(spark, tmp_path, no_content):
    path = f"{tmp_path}/raw/prices"
    load(spark, path, [(f"2024-01-{d:02d}", z, d) for d in range(1, 10) for z in "ab"])
    seen = delta(spark, path)
    assert seen.first
    seen.remember()
    assert delta(spark, path).empty
    load(spark, path, [("2024-01-03", "a", 100), (None, "a", 7)])
    found = delta(spark, path)
    assert not found.first and set(found.parts) == {"2024-01-03", None}
    assert sorted((str(r.day), r.zone, r.v) for r in found.rows().collect()) == [("2024-01-03", "a", 100), ("2024-01-03", "b", 3), ("None", "a", 7)]
    plan = found.rows()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(" in plan or "PartitionFilters: [" in plan and "2024" in plan
    found.remember()
    load(spark, path, [("2024-01-03", "a", 5)])
    load(spark, path, [("2024-01-03", "a", 100)])  # there and back between two readings
    assert delta(spark, path).empty
    load(spark, path, [("2024-01-04", "a", None), ("2024-01-04", "a", None)])
    assert delta(spark, path).parts == ["2024-01-04"]


def test_added_rows_and_failed_writes(spark, tmp_path, no_content, monkeypatch):
    path = f"{tmp_path}/vault/s"
    sinks.overwrite_table(frame(spark, [("2024-01-01", "a", 1)]), path, PARTITION, record=True)
    delta(spark, path).remember()
    sinks.append_rows(spark, frame(spark, [("2024-01-02", "a", 1)]), path, partition_by=PARTITION)
    sinks.append_rows(spark, frame(spark, [("2024-01-02", "b", 2), ("2024-01-01", "b", 2)]), path, partition_by=PARTITION)
    found = delta(spark, path)
    assert sorted(found.parts) == ["2024-01-01", "2024-01-02"] and found.state["part", "2024-01-02"][0] == 2
    found.remember()
    with pytest.raises(RuntimeError):
        with changes.recorded(spark, path, frame(spark, [("2024-01-05", "a", 1)]), "day", replaces=False):
            raise RuntimeError("lost after the rows were there")
    found = delta(spark, path)
    assert found.parts == ["2024-01-05"]
    found.remember()
    assert delta(spark, path).empty
    before = changes.state(spark, path)
    changes.compact(spark, path)
    assert changes.state(spark, path) == before and delta(spark, path).empty
    sinks.overwrite_table(frame(spark, [("2024-01-01", "a", 1)]), path, PARTITION)
    assert delta(spark, path).first


def test_known_parts_need_no_reading(spark, tmp_path, no_content):
    path = f"{tmp_path}/star/f"
    sinks.overwrite_table(frame(spark, [("2024-01-01", "a", 1), ("2024-01-02", "a", 1)]), path, PARTITION, record=True)
    delta(spark, path).remember()
    sinks.replace_partitions(frame(spark, [("2024-01-02", "a", 1)]), path, PARTITION, parts=["2024-01-02"])
    assert delta(spark, path).parts == ["2024-01-02"]


def test_a_table_that_something_else_writes(spark, tmp_path):
    path = f"{tmp_path}/raw/other"
    write = lambda rows: frame(spark, rows).write.mode("overwrite").partitionBy("day").parquet(path)
    write([("2024-01-01", "a", 1), ("2024-01-02", "a", 1)])
    delta(spark, path).remember()
    assert delta(spark, path).empty
    write([("2024-01-01", "a", 2), ("2024-01-02", "a", 1)])
    found = delta(spark, path)
    assert found.parts == ["2024-01-01"] and not found.first
    write([("2024-01-01", "a", 2)])
    assert delta(spark, path).first  # a partition is gone
    load(spark, f"{tmp_path}/raw/own", [("2024-01-01", "a", 1)])
    delta(spark, f"{tmp_path}/raw/own").remember()
    changes.forget(spark, f"{tmp_path}/raw/own")
    assert delta(spark, f"{tmp_path}/raw/own").first


def test_days_of_a_batch_are_ranges(spark):
    rows = frame(spark, [("2018-05-01", "a", 1)] + [(f"2024-01-{d:02d}", "a", d) for d in (3, 4, 5, 9)] + [(None, "a", 0)])
    target = frame(spark, [("2018-05-01", "x", 0), ("2019-01-01", "x", 1), ("2024-01-04", "x", 2), ("2024-01-07", "x", 3), ("2024-01-09", "x", 4), (None, "x", 5)])
    assert sorted(r.v for r in sinks.only_between(target, rows, "day").collect()) == [0, 2, 4]
    assert sorted(r.v for r in sinks.only_between(target, rows, "day", limit=2).collect()) == [0, 1, 2, 3, 4]
    assert sinks.only_between(target, rows.where("day is null"), "day").count() == 0


def test_a_daily_build_reads_the_day(spark, tmp_path, no_content, monkeypatch):
    """Raw, satellite and fact: the second build takes one day of each."""
    from layerloom.plans import bindings

    root = str(tmp_path)
    raw = bindings.raw_weather(spark, "/root/testdata/sf0.001").where("location_key is not null and day(timestamp) < 6")
    last = raw.agg(F.max("date_key")).first()[0]
    taken = []
    rows = Delta.rows
    monkeypatch.setattr(Delta, "rows", lambda self, table=None: taken.append((self.path.rsplit("/", 2)[1:], self.first, self.parts)) or rows(self, table))
    for part in (raw.where(F.col("date_key") < F.lit(last)), raw.where(F.col("date_key") == F.lit(last))):
        taken.clear()
        sinks.replace_slices(spark, part, table_path(root, "raw", "weather_hourly"), RAW_PARTITIONS["weather_hourly"], RAW_SLICES["weather_hourly"])
        warehouse.build(spark, root, bindings.EVENTS_AS_OF)
    assert {tuple(place) for place, _, _ in taken} == {("raw", "weather_hourly"), ("data_vault", "s_weather_hourly"), ("business_vault", "fact_weather_hourly")}
    assert all(not first and parts == [str(last)] for _, first, parts in taken)
    assert [r[0] for r in spark.read.parquet(table_path(root, "business_vault", "fact_weather_hourly")).select("date_key").distinct().orderBy("date_key").collect()][-1] == last
