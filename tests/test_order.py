"""The order in which reports, charts and previews hand out their rows.

Query comparison sorts rows, so order is tested here, on the collected rows."""

import pytest

from tradewh.operators.parallelism import spread
from tradewh.plans import charts, reports
from tradewh.plans.present import preview


def ordered(rows, *keys):
    """Whether rows follow the keys: a column, or (column or function, -1) for descending."""
    def key(r):
        out = []
        for k in keys:
            k, sign = k if isinstance(k, tuple) else (k, 1)
            v = k(r) if callable(k) else r[k]
            out.append((sign * (v is None), v if isinstance(v, str) else sign * (v or 0)))
        return out

    return len(rows) > 1 and all(key(a) <= key(b) for a, b in zip(rows, rows[1:]))


@pytest.mark.parametrize("report,keys", [
    (reports.r1_yoy, ["tipo_operacion", "anio"]),
    (reports.r2_top_countries, [("fob_total", -1), "pais_origen_desc"]),
    (reports.r3_trend, ["tipo_operacion", "mes_numero"]),
    (reports.r4_offices, ["tipo_operacion", ("fob_anual", -1)]),
    (reports.r5_top_positions, ["tipo_operacion", "ranking"]),
    (reports.r6_channels, ["tipo_operacion", ("total_despachos", -1)]),
    (lambda wh: reports.r7_red_share(wh, min_items=1), [("pct_rojo", -1), "pais_origen_desc"]),
    (reports.sample_top_countries, [("total_fob", -1)]),
    (reports.sample_daily_fob, ["fecha_key"]),
])
def test_reports(wh, report, keys):
    assert ordered(report(wh).collect(), *keys)


def test_charts(wh):
    ops = ["IMPORTACION", "EXPORTACION"]
    stack = charts.CHARTS["chart_office_stack"](wh)
    found = [c for c in stack.columns if c != "aduana"]
    assert ordered(stack.collect(), (lambda r: sum(r[c] for c in found), -1), "aduana")
    matrix = charts.CHARTS["chart_position_matrix"](wh)
    assert ordered(matrix.collect(), *[(c, -1) for c in ops if c in matrix.columns])


def test_previews_keep_the_order(wh):
    rows = reports.r4_offices(wh).collect()
    got = preview(reports.r4_offices(wh), 3)
    assert [tuple(r) for r in got["rows"]] == [tuple(r) for r in rows[:3]] and got["truncated"]


def test_spread_is_not_misled_by_names(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "Exchange hashpartitioning"))
    df = spark.read.parquet(str(tmp_path / "Exchange hashpartitioning")).withColumnRenamed("id", "Exchange")
    assert spread(df, 4).rdd.getNumPartitions() == 4
    grouped = df.groupBy("Exchange").count()
    assert spread(grouped, 400) is grouped
