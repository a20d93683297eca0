"""Differential test: the Column normalisers vs a plain-Python statement of the
same rules, on 3,000 seeded dirty values evaluated in one Spark job."""

import datetime as dt
import random
import re
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

from pyspark.sql import functions as F

from tradewh.functions import (
    normalize_country, norm_text, parse_date, parse_int, parse_money, repair_enye,
)

SPACES = "                　"


def py_norm_text(s):
    return None if s is None else s.strip(SPACES).upper()


def py_country(s, first_only=False):
    if s is None:
        return None
    u = py_norm_text(s.replace("\\", "Ñ"))
    if re.match(r"^[A-Z]{2} - .+", u):
        return re.sub(r"^[A-Z]{2} - ", "", u).strip(SPACES)
    # \s of the regex engines involved is ASCII whitespace only (no NBSP)
    ws = r"[ \t\n\x0b\f\r]+"
    if first_only:
        return re.sub(ws, " ", u, count=1).strip(SPACES)
    return re.sub(ws, " ", u).strip(SPACES)


def py_money(s):
    if s is None:
        return None
    t = s.replace(",", ".").strip()
    if not re.fullmatch(r"[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?", t):
        return None
    # DOUBLE first, as the source system does: cents, then half away from zero.
    try:
        cents = Decimal(float(t) * 100.0).quantize(Decimal(1), rounding=ROUND_HALF_UP)
    except (InvalidOperation, OverflowError):
        return None
    return cents / 100 if abs(cents) < Decimal(10) ** 18 else None


def py_int(s):
    if s is None or not re.fullmatch(r"\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*", s):
        return None
    v = Decimal(s.strip()).quantize(Decimal("1"), rounding=ROUND_HALF_UP)
    return int(v) if -2**31 <= v < 2**31 else None


def py_date(s):
    if s is None:
        return None
    m = re.match(r"^\s*(\d{4,})([-/])(\d{1,2})\2(\d{1,2})(.*)$", s)
    if not m:
        return None
    rest = m.group(5).strip()
    if rest:
        if not re.match(r"[ T]", m.group(5)):
            return None
        try:
            dt.time.fromisoformat(rest.lstrip("T"))
        except ValueError:
            return None
    m = re.match(r"^\s*(\d+)[-/](\d+)[-/](\d+)", s)
    try:
        return dt.date(int(m.group(1)), int(m.group(2)), int(m.group(3)))
    except ValueError:
        return None


def gen(rng: random.Random, n: int):
    words = ["brasil", "espa\\a", "estados", "unidos", "paraguay", "CHINA", "sur", "nation_7"]
    out = []
    for _ in range(n):
        sp = lambda: rng.choice(["", " ", "  ", " ", "   ", "\t"])
        name = rng.choice(["", "BR - ", "ar - ", "XX -"]) + f"{sp()}".join(rng.sample(words, rng.randint(1, 3)))
        country = sp() + name + sp()
        whole = rng.randint(0, 10**6)
        money = rng.choice([
            f"{whole},{rng.randint(0, 99):02d}", f"{whole}.{rng.randint(0, 99):02d}", f"{whole}",
            f"{whole},{rng.randint(0, 999):03d}", f"{whole % 50},005", f"-{whole % 9},125", "1e20", f"{whole}e-3", f"{whole}{whole}{whole},1", "1.234,56", "nan", "inf", "12.5d", "", " 7,5 ", "-3,10",
        ])
        integer = rng.choice([str(rng.randint(1990, 2030)), f"{rng.randint(1990, 2030)}.0", "12.5", "x", "1e2"])
        y, mth, d = rng.randint(1995, 2030), rng.randint(1, 13), rng.randint(1, 31)
        date = rng.choice([f"{y}-{mth:02d}-{d:02d}", f"{y}/{mth}/{d}", f"{d:02d}/{mth:02d}/{y}", "S/D",
                           f"{y}-{mth:02d}-{d:02d} 10:00:00", f"{y}-{mth:02d}-{d:02d}T09:05", f"{y}-{mth:02d}-{d:02d}T", f"{y}-{mth:02d}-{d:02d} abc",
                           f"{y}-{mth:02d}-{d:02d} 25:00:00", f"{y}-{mth:02d}/{d:02d}", f"{y}-{mth:02d}-{d:02d}T99", f"{y}{mth:02d}{d:02d}"])
        out.append((country, money, integer, date))
    return out


def test_normalisers_match_python_statement(spark):
    rows = gen(random.Random(7), 3000)
    df = spark.createDataFrame(rows, "country string, money string, integer string, date string")
    got = df.select(
        "country", "money", "integer", "date",
        norm_text("country").alias("t"),
        normalize_country(repair_enye("country")).alias("c"),
        normalize_country(repair_enye("country"), first_only=True).alias("cl"),
        parse_money("money").alias("m"),
        parse_int("integer").alias("i"),
        parse_date("date").alias("d"),
    ).collect()
    bad = []
    for r in got:
        exp = (py_norm_text(r.country), py_country(r.country), py_country(r.country, True),
               py_money(r.money), py_int(r.integer), py_date(r.date))
        got_ = (r.t, r.c, r.cl, r.m, r.i, r.d)
        for field, g, e, raw in zip(["t", "c", "cl", "m", "i", "d"], got_, exp,
                                    [r.country] * 3 + [r.money, r.integer, r.date]):
            if g != e:
                bad.append((field, raw, g, e))
    assert not bad, bad[:8]
