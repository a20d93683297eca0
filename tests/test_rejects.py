"""Reject counts parse few texts."""

from pyspark.sql import functions as F

from tests.test_load_cost import _raw
from tradewh.functions.numeric import parse_money
from tradewh.plans import staging
from tradewh.schemas import STAGING_SOURCES

MONEY = [src for _, src, kind in STAGING_SOURCES if kind in ("money", "qty")]


def test_out_of_range_numbers_are_counted_and_few_texts_parsed(spark):
    good = {"OFICIALIZACION": "2025-03-01", "FOB DOLAR": "10,5"}
    odd = ["1e20", "1E20", "-1E+16", "12345678901234567,5", " 99999999999999999 "]
    fine = ["1e2", "123456789012345", "9999999999999,99", "1,23456789012345678", "abcdefghijklmnopqrst", "e", "", None, "5,", ",5"]
    rows = [good | {"IVA": v} for v in odd + fine] + [good | {"SERVICIO": "1e20", MONEY[0]: "x"}, {"OFICIALIZACION": "2025-03-01", "FOB DOLAR": "0", "IVA": "1e20"}]
    raw = _raw(spark, *rows)
    out = staging.staging_rejects(raw)
    assert out.first()["money_out_of_range"] == len(odd) + 1
    # as by the definition: a number that typing to money turns into NULL
    by_definition = raw.where(" OR ".join(f"`{c}` IS NOT NULL" for c in ("IVA", "SERVICIO"))).where(F.col("`FOB DOLAR`") != "0")
    bad = [staging.parse_decimal(F.col(f"`{c}`")).isNotNull() & parse_money(F.col(f"`{c}`")).isNull() for c in ("IVA", "SERVICIO")]
    assert by_definition.where(bad[0] | bad[1]).count() == len(odd) + 1
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") < len(MONEY)
