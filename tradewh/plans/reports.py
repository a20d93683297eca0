"""Reports R1-R7 and the documentation samples X1-X2.

R1, R2, R4-R6 read materialised marts (small), R3 reads the trend view, R7
and the samples read the fact. "Latest year" is an equi-join to a one-row
aggregate. Re-aggregated DOUBLE mart columns (averages, shares) are first
turned back into DECIMAL at their stored scale, so their sums do not depend on
row order. Where the reference takes ``LIMIT 10`` over ties, the natural key is
added as a tie-break.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewh.functions.numeric import pct_change, round_half_away, safe_div, sum_money, to_millions
from tradewh.functions.text import decode_canal, left
from tradewh.operators.joins import latest_year
from tradewh.operators.topk import top_k
from tradewh.operators.windows import with_lag, with_rank
from tradewh.plans.star import star
from tradewh.plans.views import v_tendencia_mensual


def _avg_of(c: str, scale: int) -> Column:
    """``ROUND(AVG(double mart column), 2)`` computed on its DECIMAL value."""
    d = F.col(c).cast(f"decimal(18,{scale})")
    return round_half_away(safe_div(F.sum(d), F.count(d)), 2)


def _sum_of(c: str, scale: int) -> Column:
    """``ROUND(SUM(double mart column), 2)`` computed on its DECIMAL value."""
    return round_half_away(F.sum(F.col(c).cast(f"decimal(18,{scale})")), 2)


def r1_yoy(wh) -> DataFrame:
    """FOB by operation and year with year-over-year change."""
    m = wh.mart("agg_fob_mensual_operacion")
    df = m.groupBy("tipo_operacion", "anio").agg(
        F.sum("fob_total").alias("fob_anual"),
        F.sum("cantidad_items").alias("items_totales"),
        _avg_of("fob_promedio", 2).alias("ticket_promedio"),
    )
    df = with_lag(df, "fob_anual", ["tipo_operacion"], ["anio"], "fob_anio_anterior")
    df = df.withColumn("variacion_pct_yoy", round_half_away(pct_change("fob_anual", "fob_anio_anterior"), 2))
    return df.orderBy("tipo_operacion", "anio")


def r2_top_countries(wh, k: int = 10) -> DataFrame:
    """Top-k origin countries of the latest year.

    The rank is computed after the top-k cut: every row that outranks a top-k
    row is itself in the top k, so ranking the k rows equals ranking all.
    """
    m = latest_year(wh.mart("agg_fob_pais_anual"))
    df = m.groupBy("pais_origen_desc").agg(
        F.sum("fob_total").alias("fob_total"),
        F.sum("cantidad_items").alias("items"),
        _sum_of("pct_fob_sobre_total", 4).alias("pct_del_total"),
    )
    top = top_k(df, k, [F.col("fob_total").desc(), F.col("pais_origen_desc").asc()])
    return with_rank(top, "fob_total", [], "ranking").orderBy(F.col("fob_total").desc(), "pais_origen_desc")


def r3_trend(wh) -> DataFrame:
    """Monthly trend of the latest year: MoM change and year-to-date, from the trend
    view; the latest year is that of the monthly mart, as in the source system."""
    last = wh.mart("agg_fob_mensual_operacion").agg(F.max("anio").alias("_last"))  # one row
    v = v_tendencia_mensual(wh).join(F.broadcast(last), F.col("anio") == F.col("_last"))
    return v.select(
        "mes_numero", "mes_nombre", "tipo_operacion", "fob_total", "fob_variacion_abs", F.col("fob_variacion_pct").alias("mom_pct"),
        "fob_ytd", "cantidad_items",
    ).orderBy("tipo_operacion", "mes_numero")


def r4_offices(wh) -> DataFrame:
    """Customs offices of the latest year, ranked per operation."""
    m = latest_year(wh.mart("agg_fob_aduana_mensual"))
    df = m.groupBy("nombre_aduana", "tipo_operacion").agg(
        F.sum("fob_total").alias("fob_anual"),
        F.sum("cantidad_items").alias("items_totales"),
        _avg_of("fob_promedio", 2).alias("ticket_promedio"),
        _sum_of("pct_fob", 2).alias("pct_participacion"),
    )
    df = with_rank(df, "fob_anual", ["tipo_operacion"], "ranking")
    return df.orderBy("tipo_operacion", F.col("fob_anual").desc())


def r5_top_positions(wh, k: int = 10, width: int = 45) -> DataFrame:
    """Tariff positions with rank <= k in the latest year (rank per quarter row)."""
    m = latest_year(wh.mart("agg_fob_ncm_anual")).where(F.col("rank_fob") <= k)
    return m.select(
        "posicion", left("descripcion_arancelaria", width).alias("descripcion"), "rubro",
        "tipo_operacion", "fob_total", "cantidad_items", "pct_fob", F.col("rank_fob").alias("ranking"),
    ).orderBy("tipo_operacion", "ranking")


def r6_channels(wh) -> DataFrame:
    """Control-channel mix of the latest year."""
    m = latest_year(wh.mart("agg_canal_mensual"))
    df = m.groupBy("canal_codigo", "canal_nombre", "tipo_operacion").agg(
        F.sum("cantidad_despachos").alias("total_despachos"),
        round_half_away(to_millions(F.sum("fob_total")), 2).alias("fob_millones"),
        round_half_away(to_millions(F.sum("gravamen_total")), 2).alias("gravamen_millones"),
    )
    w = Window.partitionBy("tipo_operacion")
    share = F.col("total_despachos").cast("double") * 100.0 / F.sum("total_despachos").over(w).cast("double")
    return df.withColumn("pct_del_total", round_half_away(share, 2)).orderBy(
        "tipo_operacion", F.col("total_despachos").desc())


def r7_red_share(wh, min_items: int = 100, k: int = 10) -> DataFrame:
    """Origin countries of the latest year with the highest share of RED channel.

    The per-(country, channel) aggregate and the per-country total both come
    from one GROUP BY country here (one shuffle, no join). Rows of the
    latest-year partitions have a date key, so no date-dimension join is
    needed for the year restriction.
    Only countries with at least one RED item and ``min_items`` items remain.
    """
    # Latest year as a scalar subquery: the fact is partitioned by year, so
    # only that year's partitions are listed and read.
    year = wh.mart("agg_fob_pais_anual").agg(F.max("anio")).scalar()
    f = star(wh, ["dim_pais_origen"], fact=wh.fact_in_year(year).where(F.col("canal").isNotNull()))
    red = decode_canal("canal") == "ROJO"
    df = f.groupBy("pais_origen_desc").agg(
        F.count_if(red).alias("despachos_rojos"),
        F.count(F.lit(1)).alias("despachos_totales"),
        sum_money(F.when(red, F.col("fob_dolar"))).alias("_fob_rojo"),
    ).where((F.col("despachos_rojos") > 0) & (F.col("despachos_totales") >= min_items))
    df = df.select(
        "pais_origen_desc", "despachos_rojos", "despachos_totales",
        round_half_away(F.col("despachos_rojos").cast("double") * 100.0 / F.col("despachos_totales").cast("double"), 1)
        .alias("pct_rojo"),
        round_half_away(to_millions("_fob_rojo"), 2).alias("fob_rojo_millones"),
    )
    return top_k(df, k, [F.col("pct_rojo").desc(), F.col("pais_origen_desc").asc()])


def sample_top_countries(wh, k: int = 10) -> DataFrame:
    """Documentation sample: top-k origin countries over all years."""
    df = star(wh, ["dim_pais_origen"]).groupBy("pais_origen_desc").agg(sum_money("fob_dolar").alias("total_fob"))
    return top_k(df, k, [F.col("total_fob").desc(), F.col("pais_origen_desc").asc()])


def sample_daily_fob(wh) -> DataFrame:
    """Documentation sample 'FOB by date key' (X2), built over the fact since
    the mart the sample names has no date key."""
    return wh.fact.groupBy("fecha_key").agg(sum_money("fob_dolar").alias("total")).orderBy("fecha_key")
