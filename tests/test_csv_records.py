"""CSV with line breaks in cells, read in ranges, against the csv module and the loaders users call."""

import csv
import random

import pytest
from pyspark.sql import types as T

from tablewright.sources import readers, records, sinks

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])


def cells(n, seed=1):
    r = random.Random(seed)
    parts = ["a", "b c", '"', '""', "\n", "\n\n", ",", "é", "\r\n", "NA", "x" * 40]
    return [(i, "q" + "".join(r.choices(parts, k=r.randrange(6))) + "q", "z" + r.choice(parts) + "z") for i in range(n)]


def write(path, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator=end)
        out.writerow(["id", "a", "b"])
        out.writerows(rows)


@pytest.fixture
def small_ranges(spark):
    """Ranges of a few hundred bytes."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0b")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def found(df):
    return sorted((r.id, r.a, r.b) for r in df.collect())


def test_many_ranges_equal_the_rows_written(spark, tmp_path, small_ranges):
    rows = cells(300)
    write(tmp_path / "x.csv", rows)
    df = readers.read_csv(spark, str(tmp_path / "x.csv"), SCHEMA, na_tokens=())
    assert records._lines(spark, str(tmp_path / "x.csv")).select("start").distinct().count() > 20
    assert found(df) == rows


def test_several_files_each_with_a_header(spark, tmp_path, small_ranges):
    (tmp_path / "d.csv").mkdir()
    parts = [cells(60, s) for s in range(4)]
    for i, part in enumerate(parts):
        write(tmp_path / "d.csv" / f"part-{i}.csv", part, "\r\n" if i == 2 else "\n")
    df = readers.read_csv(spark, str(tmp_path / "d.csv"), SCHEMA, na_tokens=())
    assert found(df) == sorted(r for part in parts for r in part)


def test_a_record_longer_than_several_ranges(spark, tmp_path, small_ranges):
    rows = [(0, "short", "x"), (1, 'line "one"\n' * 300, "y"), (2, "after", "z\n" * 200), (3, "end", "w")]
    write(tmp_path / "x.csv", rows)
    assert found(readers.read_csv(spark, str(tmp_path / "x.csv"), SCHEMA, na_tokens=())) == rows


def test_same_as_the_whole_file_reader(spark, tmp_path, small_ranges):
    write(tmp_path / "x.csv", cells(200, 5))
    whole = spark.read.options(header=True, quote='"', escape='"', multiLine=True, emptyValue="").schema("id long, a string, b string").csv(str(tmp_path / "x.csv"))
    assert found(readers.read_csv(spark, str(tmp_path / "x.csv"), SCHEMA, na_tokens=())) == found(whole)


def test_loaders_keep_line_breaks(spark, tmp_path):
    write(tmp_path / "x.csv", [(1, "a\nb", "NA"), (2, "", "c")])
    path = str(tmp_path / "x.csv")
    df, source = readers.read(spark, path=path)
    assert found(df) == [(1, "a\nb", None), (2, None, "c")] and source.startswith("CSV")
    one, other, _ = readers.read_pair(spark, {"path": path}, {"path": path, "na_tokens": readers.BLANK_ONLY})
    assert found(one) == found(df) and found(other) == [(1, "a\nb", "NA"), (2, None, "c")]
    spark.sql("DROP TABLE IF EXISTS broken_lines")
    sinks.load_csv_into_table(spark, path, "broken_lines")
    try:
        assert found(spark.table("broken_lines")) == [(1, "a\nb", "NA"), (2, None, "c")]
    finally:
        spark.sql("DROP TABLE broken_lines")


def test_blank_lines_odd_names_and_no_rows(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a.b,,"c ""d"""\n\n1,2,"3\n4"\n\n')
    df = readers.read_csv(spark, str(tmp_path / "x.csv"))
    assert df.columns == ["a.b", "_c1", 'c "d"'] and [tuple(r) for r in df.collect()] == [(1, 2, "3\n4")]
    (tmp_path / "y.csv").write_text("a,b\n")
    assert readers.read_csv(spark, str(tmp_path / "y.csv")).collect() == []
