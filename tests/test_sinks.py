import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from layerloom.operators import sinks
from layerloom.session import scratch_path, shared_folder
from layerloom.sources import jdbc, tables
from layerloom.sources.schemas import RAW_PARTITIONS, RAW_SCHEMAS, RAW_SLICES


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "day int, zone string, v int")


def read(spark, path, rows):
    return rows(spark.read.schema("day int, zone string, v int").parquet(path), "day", "zone", "v")


def test_slices_are_replaced_alone(spark, tmp_path, rows):
    for partition_by in (["day", "zone"], ["day"]):
        path = str(tmp_path / "-".join(partition_by))
        load = lambda df: sinks.replace_slices(spark, df, path, partition_by, ["day", "zone"])
        load(frame(spark, (1, "a", 1), (1, "a", 2), (1, "b", 3), (2, "a", 4)))
        load(frame(spark, (1, "a", 9)))
        load(frame(spark, (1, "a", 9), (3, "c", 5)))
        load(frame(spark))
        assert read(spark, path, rows) == [(1, "a", 9), (1, "b", 3), (2, "a", 4), (3, "c", 5)]


def test_slices_may_lie_across_partitions(spark, tmp_path, rows):
    """A slice that is not tied to a partition, or a table without partitions: nothing of the old slice stays."""
    for partition_by in (["zone"], []):
        path = str(tmp_path / f"t{len(partition_by)}")
        load = lambda df: sinks.replace_slices(spark, df, path, partition_by, ["day"])
        load(frame(spark, (1, "a", 1), (1, "b", 2), (2, "a", 3)))
        load(frame(spark, (1, "a", 9)))
        assert read(spark, path, rows) == [(1, "a", 9), (2, "a", 3)]


def test_file_slices(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    load = lambda *data: sinks.replace_source_files(spark, spark.createDataFrame(list(data), "_source_file string, v int"), path)
    load(("a", 1), ("a", 2), ("b", 3))
    load(("a", 7))
    load(("c", 8))
    assert rows(spark.read.parquet(path), "_source_file", "v") == [("a", 7), ("b", 3), ("c", 8)]


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    hub = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("hk"), "id")
    satellite = hub.select("hk", (F.col("id") * 2).alias("v"))
    sinks.overwrite_bucketed(hub, "hub_bucketed", str(tmp_path / "h"), ["hk"], 4)
    sinks.overwrite_bucketed(satellite, "satellite_bucketed", str(tmp_path / "s"), ["hk"], 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("hub_bucketed").join(spark.table("satellite_bucketed"), "hk")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.where("v = id * 2").count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_slice_replace_reads_touched_partitions_only(spark, tmp_path):
    target = frame(spark, *[(d, "a", d) for d in range(40)])
    target.write.partitionBy("day").parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    few = sinks.only_values(stored, frame(spark, (3, "a", 1), (30, "a", 1)), "day")
    assert sorted(row.day for row in few.collect()) == [3, 30]
    many = sinks.only_values(stored, frame(spark, (3, "a", 1), (30, "a", 1), (7, "a", 1)), "day", limit=2)
    assert sorted(row.day for row in many.collect()) == list(range(3, 31))
    for pruned in (few, many):
        assert "PartitionFilters: [isnotnull(day" in pruned._jdf.queryExecution().executedPlan().toString() or (
            "PartitionFilters: [day" in pruned._jdf.queryExecution().executedPlan().toString()
        )
    assert sinks.only_values(stored, frame(spark), "day").count() == 0


def test_schema_guard(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.append_rows(spark, frame(spark, (1, "a", 1)), path)
    with pytest.raises(sinks.SchemaMismatch, match="extra"):
        sinks.append_rows(spark, frame(spark, (1, "a", 1)).withColumn("extra", F.lit(1)), path)
    with pytest.raises(sinks.SchemaMismatch, match="v"):
        sinks.append_rows(spark, frame(spark, (1, "a", 1)).withColumn("v", F.lit(1.5)), path)
    sinks.append_rows(spark, frame(spark, (2, "b", 2)).select("v", "zone", "day"), path)
    assert spark.read.parquet(path).count() == 2


def test_unique_key_guard(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(sinks.DuplicateKeys):
        sinks.append_rows(spark, frame(spark, (1, "a", 1), (1, "b", 1)), path, unique_key=["day"])
    sinks.append_rows(spark, frame(spark, (1, "a", 1)), path, unique_key=["day"])
    with pytest.raises(sinks.DuplicateKeys):
        sinks.append_rows(spark, frame(spark, (1, "a", 1)), path, unique_key=["day"])
    assert spark.read.parquet(path).count() == 1


def test_overwrites(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    sinks.overwrite_table(frame(spark, (1, "a", 1), (2, "a", 2)), path, ["day"])
    sinks.replace_partitions(frame(spark, (2, "b", 3)), path, ["day"])
    assert read(spark, path, rows) == [(1, "a", 1), (2, "b", 3)]
    sinks.overwrite_table(frame(spark, (5, "a", 1)), path, ["day"])
    assert read(spark, path, rows) == [(5, "a", 1)]


@pytest.mark.parametrize("name", sorted(RAW_SCHEMAS))
def test_raw_tables_can_be_created(spark, tmp_path, name):
    path = tables.table_path(str(tmp_path), "raw", name)
    for _ in range(2):
        sinks.create_if_missing(spark, path, RAW_SCHEMAS[name], RAW_PARTITIONS[name])
    assert tables.read_table(spark, str(tmp_path), "raw", name).count() == 0
    names = set(RAW_SCHEMAS[name].names)
    assert set(RAW_PARTITIONS[name]) <= names and set(RAW_SLICES[name]) <= names


def test_partition_values_keep_their_type(spark, tmp_path):
    raw = spark.createDataFrame([], RAW_SCHEMAS["spotify_charts"])
    row = raw.sparkSession.sql("select date'2024-01-01' as chart_date, 1 as position, 't' as track_name, 'a' as artist_name, 5L as streams, '007' as region, 'top200' as chart_type, 'x' as trend, 'u' as url, 'f' as _source_file, timestamp_ntz'2024-01-01' as _loaded_at")
    sinks.overwrite_table(row, tables.table_path(str(tmp_path), "raw", "spotify_charts"), ["region"])
    assert tables.read_table(spark, str(tmp_path), "raw", "spotify_charts").first().region == "007"


def test_query_documents(spark, tmp_path):
    path = str(tmp_path / "docs")
    result = spark.createDataFrame([("a", 0), ("b", None)], "owner string, n int").coalesce(1)
    sinks.write_query_document(spark, result, path, "2024-01-01", "src")
    lines = [json.loads(line) for file in (tmp_path / "docs").glob("*.json") for line in file.read_text().splitlines()]
    assert lines == [
        {"query_date": "2024-01-01", "source": "src", "row_count": 2, "data": [{"owner": "a", "n": 0}, {"owner": "b", "n": None}]}
    ]


def session_with(folder, master):
    conf = SimpleNamespace(get=lambda key, default: folder if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_scratch_space_is_the_clusters_folder():
    assert shared_folder(session_with("hdfs:///shared/", "yarn")) == "hdfs:///shared"
    assert scratch_path(session_with("hdfs:///shared", "yarn"), "x").startswith("hdfs:///shared/x-")
    assert shared_folder(session_with(None, "local[2]")) == shared_folder(session_with(None, "local[2]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session_with(None, "yarn"))


def test_layer_listing(spark, tmp_path):
    frame(spark, (1, "a", 1)).write.parquet(tables.table_path(str(tmp_path), "marts", "sales"))
    tables.register_layer(spark, str(tmp_path), "marts", ["sales"])
    assert "marts__sales" in tables.list_tables(spark, "marts")
    assert spark.table("marts__sales").count() == 1


class RecordingReader:
    """Stands in for a DataFrameReader: no database is started for a test."""

    def __init__(self):
        self.options = {}

    def option(self, key, value):
        self.options[key] = value
        return self

    def load(self):
        return self.options


def test_jdbc_options():
    assert jdbc.read_query(RecordingReader(), "select 1") == {"query": "select 1"}
    assert jdbc.read_table(RecordingReader(), "t") == {"dbtable": "t"}
    assert jdbc.read_table(RecordingReader(), "t", partition_column="id", lower=0, upper=9, partitions=3) == {
        "dbtable": "t", "partitionColumn": "id", "lowerBound": 0, "upperBound": 9, "numPartitions": 3,
    }
