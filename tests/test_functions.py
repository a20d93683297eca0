"""Normalisers on literal inputs, covering the cross-engine points of the survey."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradewh.functions import (
    date_key, decode_canal, month_name_es, norm_text, normalize_country, parse_date, parse_decimal,
    parse_double, parse_int, quarter_of, repair_enye, round_half_away, semester, to_money,
)


def one(spark, value, fn, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(fn(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("raw,expected", [
    ("  abc ", "ABC"), (" x ", "X"), ("\tx", "\tX"), (None, None), ("ñu", "ÑU"),
])
def test_norm_text(spark, raw, expected):
    assert one(spark, raw, norm_text) == expected


@pytest.mark.parametrize("raw,expected,legacy", [
    ("BR - BRASIL", "BRASIL", "BRASIL"),
    ("br - brasil", "BRASIL", "BRASIL"),
    ("ESPA\\A", "ESPAÑA", "ESPAÑA"),
    ("ESTADOS  UNIDOS", "ESTADOS UNIDOS", "ESTADOS UNIDOS"),
    ("a  b  c  d", "A B C D", "A B  C  D"),
    ("  paraguay ", "PARAGUAY", "PARAGUAY"),
    ("BR - SAO  PAULO", "SAO  PAULO", "SAO  PAULO"),
    (None, None, None),
])
def test_normalize_country(spark, raw, expected, legacy):
    assert one(spark, raw, lambda c: normalize_country(repair_enye(c))) == expected
    assert one(spark, raw, lambda c: normalize_country(repair_enye(c), first_only=True)) == legacy


@pytest.mark.parametrize("raw,expected", [
    ("123,45", 123.45), ("12.5", 12.5), ("-3", -3.0), ("1e2", 100.0), (",5", 0.5),
    ("1.234,56", None), ("nan", None), ("inf", None), ("12.5d", None), ("abc", None), ("", None), (None, None),
])
def test_parse_decimal(spark, raw, expected):
    assert one(spark, raw, parse_decimal) == expected


def test_parse_double_has_no_comma_repair(spark):
    assert one(spark, "12,5", parse_double) is None
    assert one(spark, "12.5", parse_double) == 12.5


@pytest.mark.parametrize("raw,expected", [
    ("2025", 2025), ("2025.0", 2025), ("12.5", 13), ("1e2", 100), ("x", None), (None, None),
])
def test_parse_int(spark, raw, expected):
    assert one(spark, raw, parse_int) == expected


@pytest.mark.parametrize("raw,expected", [
    ("2025-01-05", dt.date(2025, 1, 5)), ("2025-1-5", dt.date(2025, 1, 5)),
    ("2025/01/05", dt.date(2025, 1, 5)), ("2025-01-05 10:11:12", dt.date(2025, 1, 5)),
    ("05/01/2025", None), ("20250105", None), ("2025", None), ("S/D", None), (None, None),
])
def test_parse_date(spark, raw, expected):
    assert one(spark, raw, parse_date) == expected


def test_money_and_rounding(spark):
    assert one(spark, 123.456, to_money, "v double") == Decimal("123.46")
    assert one(spark, 1e30, to_money, "v double") is None
    # scaled rounding: 2.675 * 100 is exactly 267.5 in binary, 1.005 * 100 is below 100.5
    assert one(spark, 2.675, lambda c: round_half_away(c, 2), "v double") == 2.68
    assert one(spark, 1.005, lambda c: round_half_away(c, 2), "v double") == 1.0
    assert one(spark, -2.5, lambda c: round_half_away(c, 0), "v double") == -3.0


def test_calendar(spark):
    rows = spark.createDataFrame([(dt.date(2025, m, 15),) for m in range(1, 13)], "d date").select(
        date_key("d").alias("k"), month_name_es("d").alias("n"), quarter_of("d").alias("q"),
        quarter_of("d", legacy=True).alias("lq"), semester("d").alias("s"),
    ).collect()
    assert [r.k for r in rows][:2] == [20250115, 20250215]
    assert [r.n for r in rows][8] == "Septiembre"
    assert [r.q for r in rows] == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4]
    assert [r.lq for r in rows] == [1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4, 5]
    assert [r.s for r in rows] == [1] * 6 + [2] * 6


@pytest.mark.parametrize("code,name", [
    ("V", "VERDE"), ("R", "ROJO"), ("N", "NARANJA"), ("X", "DESCONOCIDO"), (None, "DESCONOCIDO"),
])
def test_decode_canal(spark, code, name):
    assert one(spark, code, decode_canal) == name


@pytest.mark.parametrize("raw,expected", [
    ("1,005", "1.00"), ("2,125", "2.13"), ("-2,125", "-2.13"), ("2,675", "2.68"), ("901,005", "901.01"), ("7,5", "7.50"), ("1e2", "100.00"),
    ("1e20", None), ("1e400", None), ("x", None), ("9999999999999999", None), ("1234567890123,45", "1234567890123.45"),
])
def test_money_goes_through_double(spark, raw, expected):
    from tradewh.functions import parse_money

    assert one(spark, raw, parse_money) == (Decimal(expected) if expected else None)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sum_money_is_exact_beyond_bigint_cents(spark, ansi):
    from tradewh.functions.numeric import sum_money

    was = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        df = spark.range(20).select(F.lit("9000000000000000.07").cast("decimal(18,2)").alias("x"), (F.col("id") % 2).alias("g"))
        assert df.agg(sum_money("x")).first()[0] == Decimal("180000000000000001.40")
        neg = df.select((F.col("x") * F.when(F.col("g") == 0, -1).otherwise(1)).cast("decimal(18,2)").alias("x"))
        assert neg.agg(sum_money("x")).first()[0] == 0
        assert df.where("false").agg(sum_money("x")).first()[0] is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", was)
