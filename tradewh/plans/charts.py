"""Chart datasets G1-G6: the data behind the reference's six figures, reshaped
in Spark (pivots with explicit values, top-k, semi-join) instead of pandas.
Only the final handful of rows would reach a plotting client."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tradewh.functions.numeric import round_half_away
from tradewh.operators.pivot import CHANNEL_ORDER, operations, pivot, select_existing
from tradewh.operators.topk import top_k
from tradewh.plans import reports


def chart_share(wh) -> DataFrame:
    """G1: FOB by operation and year with each slice's share of the grand total.

    The share window has no partition but runs over the R1 result
    (operations x years rows), never over fact rows.
    """
    r1 = reports.r1_yoy(wh).select("tipo_operacion", "anio", "fob_anual", "items_totales", "ticket_promedio")
    share = F.col("fob_anual").cast("double") * 100.0 / F.sum("fob_anual").over(Window.partitionBy()).cast("double")
    return r1.withColumn("pct_total", round_half_away(share, 1))


def chart_countries(wh) -> DataFrame:
    """Top-10 origin countries of the latest year (R2 without its rank)."""
    return reports.r2_top_countries(wh).select(
        F.col("pais_origen_desc").alias("pais"), "fob_total", "items", "pct_del_total")


def chart_month_matrix(wh) -> DataFrame:
    """Month x operation matrix of the latest year's FOB (mean, as pandas' default)."""
    r3 = reports.r3_trend(wh)
    return pivot(r3, ["mes_numero", "mes_nombre"], "tipo_operacion", operations(wh), "fob_total", agg="mean")


def chart_office_stack(wh, k: int = 15) -> DataFrame:
    """The k offices with the largest latest-year FOB, one column per
    operation (missing -> 0), ordered by their total."""
    r4 = reports.r4_offices(wh).select(F.col("nombre_aduana").alias("aduana"), "tipo_operacion", "fob_anual")
    totals = r4.groupBy("aduana").agg(F.sum("fob_anual").alias("_total"))
    top = top_k(totals, k, [F.col("_total").desc(), F.col("aduana").asc()]).select("aduana")
    ops = operations(wh)
    m = pivot(r4.join(F.broadcast(top), "aduana", "left_semi"), ["aduana"], "tipo_operacion", ops,
              "fob_anual", agg="sum", fill=0.0)
    return m.orderBy(F.desc(sum(F.col(f"`{c}`") for c in ops)), "aduana")


def chart_position_matrix(wh) -> DataFrame:
    """Top tariff positions (R5 rows) x operation, FOB summed, missing -> 0."""
    r5 = reports.r5_top_positions(wh)
    ops = operations(wh)
    m = pivot(r5, ["posicion"], "tipo_operacion", ops, "fob_total", agg="sum", fill=0.0)
    return m.orderBy(*[F.col(f"`{c}`").desc() for c in ops])


def chart_channel_matrix(wh) -> DataFrame:
    """Operation x channel item counts, in traffic-light order; the
    DESCONOCIDO column is dropped and missing cells stay NULL."""
    r6 = reports.r6_channels(wh)
    m = pivot(r6, ["tipo_operacion"], "canal_nombre", CHANNEL_ORDER, "total_despachos", agg="sum")
    return select_existing(m, ["tipo_operacion"], CHANNEL_ORDER)


CHARTS = {
    "chart_share": chart_share,
    "chart_countries": chart_countries,
    "chart_month_matrix": chart_month_matrix,
    "chart_office_stack": chart_office_stack,
    "chart_position_matrix": chart_position_matrix,
    "chart_channel_matrix": chart_channel_matrix,
}
