import os
import tempfile

import pytest

from tradewh.schemas import RAW_COLUMNS
from tradewh.sources.landing import LandingNotFound, read_landing_csv


def _write(path, header, rows):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(";".join(header) + "\n")
        for r in rows:
            fh.write(";".join(r) + "\n")


def test_landing_reads_all_files_as_strings(spark):
    d = tempfile.mkdtemp(prefix="landing-", dir="/tmp")
    row = ["x"] * len(RAW_COLUMNS)
    row[RAW_COLUMNS.index("FOB DOLAR")] = "12,50"
    _write(os.path.join(d, "a.csv"), RAW_COLUMNS, [row])
    _write(os.path.join(d, "b.csv"), RAW_COLUMNS, [row, row])
    df = read_landing_csv(spark, f"{d}/*.csv", sep=";")
    assert df.count() == 3
    assert {f.dataType.simpleString() for f in df.schema.fields} == {"string"}
    assert df.first()["FOB DOLAR"] == "12,50"


def test_landing_missing_folder(spark):
    with pytest.raises(LandingNotFound):
        read_landing_csv(spark, "/tmp/definitely-not-here-xyz/*.csv").count()


def test_landing_header_mismatch_fails(spark):
    d = tempfile.mkdtemp(prefix="landing-", dir="/tmp")
    bad = list(RAW_COLUMNS)
    bad[0] = "OTHER"
    _write(os.path.join(d, "a.csv"), bad, [["x"] * len(bad)])
    with pytest.raises(Exception):
        read_landing_csv(spark, f"{d}/*.csv", sep=";").collect()


def test_landing_reads_line_breaks_inside_fields(spark):
    d = tempfile.mkdtemp(prefix="landing-", dir="/tmp")
    row = ["x"] * len(RAW_COLUMNS)
    row[RAW_COLUMNS.index("MERCADERIA")] = '"two\nlines; and ""quotes"""'
    _write(os.path.join(d, "a.csv"), RAW_COLUMNS, [row, ["y"] * len(RAW_COLUMNS)])
    rows = read_landing_csv(spark, f"{d}/*.csv", sep=";").collect()
    assert len(rows) == 2 and rows[0]["MERCADERIA"] == 'two\nlines; and "quotes"'


def test_other_errors_are_not_called_missing(spark):
    d = tempfile.mkdtemp(prefix="landing-", dir="/tmp")
    _write(os.path.join(d, "a.csv"), RAW_COLUMNS, [["x"] * len(RAW_COLUMNS)])
    with pytest.raises(Exception) as caught:
        read_landing_csv(spark, f"{d}/*.csv", encoding="no-such-charset").collect()
    assert not isinstance(caught.value, LandingNotFound)
