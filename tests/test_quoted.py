"""CSV with line breaks inside quotes, read in splits, against the reader that takes a file whole."""

import random

import pytest
from pyspark.sql import functions as F

from layerloom.sources import delimited, quoted

COLUMNS = ["id", "note", "tag"]


def field(rng):
    text = "".join(rng.choice(["a", "é", ",", '"', "\n", "\n\n", "line ", " "]) for _ in range(rng.randint(0, 30)))
    return '"' + text.replace('"', '""') + '"'


def write(path, rng, records, end="\n", first=0):
    lines = [f"{first + i},{field(rng)},{rng.choice(['x', '', 'y z'])}" for i in range(records)]
    path.write_bytes(end.join(["id,note,tag", *lines, ""]).encode())


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def whole(spark, path):
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": True}
    return spark.read.options(**options).csv(path).select("*", F.col("_metadata.file_path").alias("_source_file"))


def test_records_over_splits_equal_the_whole_read(spark, rows, tmp_path, small_splits):
    rng = random.Random(1)
    for number in range(3):
        write(tmp_path / f"broken{number}.csv", rng, 150, first=1000 * number)
    # one field longer than several splits, and a file in which no line break is quoted
    (tmp_path / "long.csv").write_text('id,note,tag\n7001,"' + "word\n" * 800 + '",x\n7002,"b",\n')
    (tmp_path / "plain.csv").write_text("id,note,tag\n" + "".join(f"{8000 + i},n{i},t\n" for i in range(200)))
    found = delimited.read_text_columns(spark, str(tmp_path), columns=COLUMNS, multiline=True)
    assert rows(found) == rows(whole(spark, str(tmp_path)))
    assert found.count() == 3 * 150 + 2 + 200
    kinds = quoted.files_by_quoting(spark, str(tmp_path))
    assert len(kinds["broken"]) == 4 and len(kinds["plain"]) == 1 and not kinds["unpaired"]
    splits = quoted._lines(spark, str(tmp_path / "broken0.csv")).select("_split").distinct().count()
    assert splits > 3  # so several tasks read one file


def test_windows_line_ends_and_marks(spark, rows, tmp_path, small_splits):
    text = '\ufeffid,note,tag\r\n1,"a\nb",x\r\n\r\n2,c,\r\n'
    (tmp_path / "w.csv").write_bytes(text.encode())
    found = delimited.read_text_columns(spark, str(tmp_path), columns=COLUMNS, multiline=True).drop("_source_file")
    assert rows(found) == [("1", "a\nb", "x"), ("2", "c", None)]


def test_unpaired_quotes_are_left_to_the_whole_read(spark, rows, tmp_path, small_splits):
    (tmp_path / "u.csv").write_text('id,note,tag\n1,5" disk,x\n2,b,y\n')
    found = delimited.read_text_columns(spark, str(tmp_path), multiline=True).drop("_source_file")
    assert rows(found) == [("1", '5" disk', "x"), ("2", "b", "y")]


def test_other_headers_stop_the_load(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note,label\n1,"a\nb",x\n')
    with pytest.raises(ValueError, match="another header"):
        delimited.read_text_columns(spark, str(tmp_path), columns=COLUMNS, multiline=True)
