"""CSV with line breaks inside fields: many tasks a file, the rows of one."""

import csv
import io
import random

import pytest
from pyspark.sql import types as T

from tradewh.sources.csv_split import ends_inside, read_split_csv, split_starts, _lines
from tradewh.sources.landing import LandingNotFound, read_landing_csv

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "Text A", "b/c")])


@pytest.fixture()
def small_splits(spark):
    was = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in was.items():
        spark.conf.set(k, v)


def written(path, rows, sep=",", end="\n"):
    out = io.StringIO(newline="")
    w = csv.writer(out, delimiter=sep, lineterminator=end)
    w.writerows([SCHEMA.names, *rows])
    path.write_bytes(out.getvalue().encode())


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def same_rows(spark, glob, sep=","):
    many, one = read_landing_csv(spark, glob, sep=sep, schema=SCHEMA, split=True), read_landing_csv(spark, glob, sep=sep, schema=SCHEMA, split=False)
    got = rows_of(many)
    assert got == rows_of(one) and many.schema.names == SCHEMA.names
    return got


def test_states_of_lines():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(['"', '"', ",", "a", " "]) for _ in range(rng.randint(0, 12)))
        open_ = False
        field, at = True, 0  # field: at a field's first character
        while at < len(text):  # character by character
            if open_:
                if text[at] == '"':
                    if text[at + 1:at + 2] == '"':
                        at += 1
                    else:
                        open_ = False
                field = False
            elif text[at] == '"' and field:
                open_, field = True, False
            else:
                field = text[at] == ","
            at += 1
        assert ends_inside(text, False) == open_, text


@pytest.mark.parametrize("sep,end", [(",", "\n"), (";", "\r\n")])
def test_same_rows_as_one_task(spark, tmp_path, small_splits, sep, end):
    rng = random.Random(2)
    odd = ["", "x", 'say ""hi""', "two\nlines", "\n\n", 'a "b" c', sep, f'"{sep}"\n"', "Ñandú\nñ", "long " * 400 + "\nend", "crlf\r\nin", " blank ", '"']
    for k, n in enumerate((0, 1, 150, 150)):
        written(tmp_path / f"f{k}.csv", [[str(k * 1000 + i), rng.choice(odd) + str(rng.choice(["", i])), rng.choice(odd)] for i in range(n)], sep, end)
    got = same_rows(spark, f"{tmp_path}/*.csv", sep)
    assert len(got) == 301
    lines = _lines(spark, f"{tmp_path}/*.csv", "UTF-8")
    begins, size, files = split_starts(lines, sep)
    assert len(begins) > 10 and {f for f, _ in begins} == set(files) and size == 700 and lines.rdd.getNumPartitions() > 100
    assert read_split_csv(spark, f"{tmp_path}/*.csv", sep, schema=SCHEMA).rdd.getNumPartitions() > 100


def test_a_field_over_many_splits_and_blank_lines(spark, tmp_path, small_splits):
    rows = [["1", "x\n" * 3000, "y"], ["2", "z", '""\n' * 500], ["3", "", "last\n"]]
    written(tmp_path / "a.csv", rows)
    (tmp_path / "b.csv").write_text('id,Text A,b/c\n\n4,"q",5" pipe\n\n\n5,6 "mid" x,"7"\n')
    assert [r[0] for r in same_rows(spark, f"{tmp_path}/*.csv")] == ["1", "2", "3", "4", "5"]


def test_a_field_that_is_never_closed_isn_t_lost(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text("id,Text A,b/c\n1,2,3\n4,5,\"open\nto the end")
    assert [r[0] for r in same_rows(spark, f"{tmp_path}/*.csv")] == ["1", "4"]


def test_headers_are_checked_and_missing_files_named(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text("id,Other,b/c\n1,2,3\n")
    with pytest.raises(Exception, match="does not conform"):
        read_landing_csv(spark, f"{tmp_path}/*.csv", schema=SCHEMA, split=True).collect()
    with pytest.raises(LandingNotFound):
        read_landing_csv(spark, f"{tmp_path}/none/*.csv", schema=SCHEMA, split=True)


def test_large_files_are_split_by_themselves(spark, tmp_path, small_splits):
    written(tmp_path / "large.csv", [[str(i), "a\nb", "c"] for i in range(200)])
    assert read_landing_csv(spark, f"{tmp_path}/*.csv", schema=SCHEMA).rdd.getNumPartitions() > 2
    written(tmp_path / "large.csv", [["1", "a\nb", "c"]])
    assert read_landing_csv(spark, f"{tmp_path}/*.csv", schema=SCHEMA).rdd.getNumPartitions() == 1
