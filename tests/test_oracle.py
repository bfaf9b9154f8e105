"""Every registered query against its SQL, on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract  # noqa: E402
from layerloom.plans.registry import ENTRIES  # noqa: E402
from oracle import connect, differences  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {name: run for name, run in contract.queries().items() if name in ENTRIES}
ORACLE = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


# Physical operators that do not scale: all pairs of rows, rows through Python, a window without a key.
UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"]


def plan_problems(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    keyless = [
        line.strip()
        for number, line in enumerate(lines)
        if "Window [" in line and any("Exchange SinglePartition" in below for below in lines[number + 1 : number + 4])
    ]
    return [name for name in UNWANTED if name in plan] + keyless


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert plan_problems(df) == []
    ours = df.toArrow()
    assert len(set(ours.column_names)) == len(ours.column_names)
    if name in ORACLE:
        assert differences(ours, con.sql(ORACLE[name]).to_arrow_table()) == []


def test_every_query_has_sql():
    assert QUERIES.keys() <= ORACLE.keys()


def test_a_window_without_a_key_is_noticed(spark):
    from pyspark.sql import Window, functions as F

    assert plan_problems(spark.range(5).withColumn("n", F.row_number().over(Window.orderBy("id"))))
    assert not plan_problems(spark.range(5).withColumn("n", F.row_number().over(Window.partitionBy("id").orderBy("id"))))


def test_entry(spark):
    assert contract.entry(spark).count() > 0
