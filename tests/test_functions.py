import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from layerloom.functions import calendar as cal, keys, values


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_surrogate_key_text(spark):
    df = spark.sql(
        "select 'a' as s, cast(null as string) as n, 7 as i, true as b, date'2024-02-03' as d, "
        "timestamp_ntz'2024-01-01 05:06:07' as t, timestamp_ntz'2024-01-01 05:06:07.120' as f, 1.5D as x"
    )
    assert df.select(keys.surrogate_key(df, ["s", "n", "i"])).first()[0] == md5(f"a-{keys.NULL_TOKEN}-7")
    assert df.select(keys.surrogate_key(df, ["b", "d", "x"])).first()[0] == md5("true-2024-02-03-1.5")
    assert df.select(keys.surrogate_key(df, ["t"])).first()[0] == md5("2024-01-01 05:06:07.000000")
    assert df.select(keys.surrogate_key(df, ["f"])).first()[0] == md5("2024-01-01 05:06:07.120000")


def test_null_position_matters(spark):
    df = spark.sql("select cast(null as string) as a, 'x' as b")
    assert df.select(keys.surrogate_key(df, ["a", "b"]) != keys.surrogate_key(df, ["b", "a"])).first()[0]


def test_dimension_sk(spark):
    df = spark.sql("select 'k' as hk, timestamp_ntz'2024-01-01 00:00:00' as valid_from, cast(null as string) as n")
    assert df.select(keys.dimension_sk(df, ["hk", "valid_from"])).first()[0] == md5("k|2024-01-01 00:00:00.000000")
    assert df.select(keys.dimension_sk(df, ["hk", "n"])).first()[0] is None


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Tokyo"])
def test_keys_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("select timestamp_ntz'2018-11-04 00:30:00' as t, 1538344800L as s")
        found = df.select(keys.surrogate_key(df, ["t"]), cal.epoch_to_timestamp(F.col("s")), F.hour("t")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found[0] == md5("2018-11-04 00:30:00.000000")
    assert found[1] == dt.datetime(2018, 9, 30, 22, 0)
    assert found[2] == 0


@pytest.mark.parametrize(
    "text, double, integer, boolean",
    [
        (None, None, None, None),
        ("", None, None, None),
        ("  ", None, None, None),
        ("3.7", 3.7, 3, False),
        ("-3.7", -3.7, -3, False),
        (" 5 ", 5.0, 5, False),
        ("1e3", 1000.0, 1000, False),
        (".5", 0.5, 0, False),
        ("x", None, None, False),
        ("1.5d", None, None, False),
        ("NaN", "nan", None, False),
        ("99999999999", 99999999999.0, None, False),
        ("1", 1.0, 1, True),
        ("YES", None, None, True),
        ("True", None, None, True),
        (" true ", None, None, False),
        ("NULL", None, None, False),
    ],
)
def test_safe_conversion(spark, text, double, integer, boolean):
    df = spark.createDataFrame([(text,)], "t string")
    t = F.col("t")
    found = df.select(values.safe_double(t), values.safe_int(t), values.safe_boolean(t)).first()
    assert (str(found[0]) if double == "nan" else found[0], found[1], found[2]) == (double, integer, boolean)


def test_large_whole_numbers_keep_their_digits(spark):
    df = spark.createDataFrame([("9007199254740993",)], "t string")
    assert df.select(values.safe_long(F.col("t"))).first()[0] == 9007199254740993


def test_null_markers(spark, rows):
    df = spark.createDataFrame([("",), ("NULL",), (" ",), ("null",), ("x",)], "t string")
    assert rows(df.select(values.marker_to_null(F.col("t")))) == [(" ",), ("null",), ("x",), (None,), (None,)]


@pytest.mark.parametrize(
    "name, parts",
    [
        ("A;B, C", ["A", "B, C"]),
        ("A, B", ["A", "B"]),
        (" A ", ["A"]),
        (";", []),
        ("", [""]),
        ("A;;A", ["A", "A"]),
        (None, None),
    ],
)
def test_split_names(spark, name, parts):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(values.split_names(F.col("n"))).first()[0] == parts


def test_stable_round_ignores_noise(spark):
    df = spark.sql("select 12.341249999999999D as low, 12.341250000000002D as high, -0.00005D as half")
    found = df.select(*[values.stable_round(F.col(name), 4) for name in df.columns]).first()
    assert tuple(found) == (12.3413, 12.3413, -0.0001)


@pytest.mark.parametrize(
    "day, iso_year, week, weekday",
    [("2018-12-31", 2019, 1, 1), ("2021-01-01", 2020, 53, 5), ("2024-12-30", 2025, 1, 1), ("2024-06-30", 2024, 26, 7)],
)
def test_iso_weeks(spark, day, iso_year, week, weekday):
    df = spark.sql(f"select date'{day}' as d")
    d = F.col("d")
    found = df.select(cal.iso_year(d), F.weekofyear(d), cal.iso_weekday(d), cal.date_id(d)).first()
    assert tuple(found) == (iso_year, week, weekday, int(day.replace("-", "")))
