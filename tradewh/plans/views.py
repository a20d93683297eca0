"""Logical views V1-V6: lazy DataFrames over the fact (never materialised), for
SQL users as temp views (``register_views``) or, over the named tables, as
persistent views of the catalog (``view_sql``) (S10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradewh.functions.numeric import pct_change, round_half_away, sum_money
from tradewh.operators.distinct import bitmaps
from tradewh.operators.windows import running_total, with_lag, with_rank, with_share
from tradewh.plans.marts import _count, avg_money, canal_grouped
from tradewh.plans.star import star


def v_fob_por_operacion(wh) -> DataFrame:
    """V1: monthly totals by operation."""
    keys = ["anio", "mes_numero", "mes_nombre", "trimestre", "semestre", "tipo_operacion"]
    return star(wh, ["dim_fecha", "dim_operacion"]).groupBy(*keys).agg(
        _count().alias("cantidad_items"),
        sum_money("fob_dolar").alias("fob_total"),
        sum_money("kilo_neto").alias("kilo_neto_total"),
        sum_money("flete_dolar").alias("flete_total"),
        sum_money("seguro_dolar").alias("seguro_total"),
        sum_money("total_gravamen").alias("gravamen_total"),
        avg_money("fob_dolar").alias("fob_promedio"),
    )


def v_top_paises(wh) -> DataFrame:
    """V2: origin and destination halves, each with its own share.

    One scan of the fact: each row gives its origin and its destination key, and
    both halves stay one frame, told apart by the kind of country. Names come from
    one join to the two country dimensions stacked with their kind, and the share's
    window is partitioned by the kind as well. Inner joins, so NULL or unknown keys
    drop out as in a star join. (Grouping sets would do the same, but no filter on
    the year gets through their Expand to the scan.)
    """
    halves = F.inline(F.array(*[F.struct(F.lit(o).alias("_origin"), F.col(k).alias("_country"))
                                for o, k in ((True, "pais_origen_key"), (False, "pais_destino_key"))]))
    base = star(wh, ["dim_fecha"]).select("anio", "trimestre", "operacion_key", "fob_dolar", "kilo_neto", halves)
    agg = base.groupBy("anio", "trimestre", "operacion_key", "_origin", "_country").agg(
        _count().alias("cantidad_items"),
        sum_money("fob_dolar").alias("fob_total"),
        sum_money("kilo_neto").alias("kilo_neto_total"),
    )
    names = wh.dim("dim_pais_origen").select(
        F.lit(True).alias("_origin"), F.lit("ORIGEN").alias("tipo_pais"), F.col("pais_origen_key").alias("_country"),
        F.col("pais_origen_desc").alias("pais"))
    names = names.unionByName(wh.dim("dim_pais_destino").select(
        F.lit(False).alias("_origin"), F.lit("DESTINO").alias("tipo_pais"), F.col("pais_destino_key").alias("_country"),
        F.col("pais_desc_desc").alias("pais")))
    df = agg.join(wh.dim("dim_operacion"), "operacion_key").join(names, ["_origin", "_country"])
    df = with_share(df, "fob_total", ["anio", "tipo_operacion", "tipo_pais"], "pct_fob", 2)
    return df.select("anio", "trimestre", "tipo_operacion", "pais", "tipo_pais",
                     "cantidad_items", "fob_total", "kilo_neto_total", "pct_fob")


def v_tendencia_mensual(wh) -> DataFrame:
    """Monthly series with change vs the previous *existing* month and YTD."""
    keys = ["anio", "mes_numero", "mes_nombre", "trimestre", "semestre", "tipo_operacion"]
    # Distinct countries as bitmaps of their dense keys; buckets don't overlap, so counts add up.
    maps = bitmaps(star(wh, ["dim_fecha", "dim_operacion"]), keys, "pais_origen_key", sum_money("fob_dolar").alias("fob_total"),
                   sum_money("kilo_neto").alias("kilo_neto_total"), _count().alias("cantidad_items"))
    base = maps.groupBy(*keys).agg(
        F.sum("fob_total").cast("decimal(38,2)").alias("fob_total"),
        F.sum("kilo_neto_total").cast("decimal(38,2)").alias("kilo_neto_total"),
        F.sum("cantidad_items").alias("cantidad_items"),
        F.sum(F.bitmap_count("bits")).alias("paises_distintos"),
    )
    df = with_lag(base, "fob_total", ["tipo_operacion"], ["anio", "mes_numero"], "_prev")
    df = running_total(df, "fob_total", ["anio", "tipo_operacion"], ["mes_numero"], "fob_ytd")
    return df.select(
        *keys, "fob_total", "kilo_neto_total", "cantidad_items", "paises_distintos",
        (F.col("fob_total") - F.col("_prev")).alias("fob_variacion_abs"),
        round_half_away(pct_change("fob_total", "_prev"), 2).alias("fob_variacion_pct"),
        "fob_ytd",
    )


def _ranked(wh, dim: str, attrs: list[str], pct_digits: int) -> DataFrame:
    df = star(wh, ["dim_fecha", dim, "dim_operacion"]).groupBy("anio", "trimestre", "tipo_operacion", *attrs).agg(
        _count().alias("cantidad_items"),
        sum_money("fob_dolar").alias("fob_total"),
        sum_money("kilo_neto").alias("kilo_neto_total"),
        avg_money("fob_dolar").alias("fob_promedio"),
    )
    df = with_rank(df, "fob_total", ["anio", "tipo_operacion"], "rank_fob")
    return with_share(df, "fob_total", ["anio", "tipo_operacion"], "pct_fob", pct_digits)


def v_ranking_aduana(wh) -> DataFrame:
    """Offices by (year, quarter); ranked within (year, operation)."""
    return _ranked(wh, "dim_aduana", ["nombre_aduana"], 2)


def v_top_ncm(wh) -> DataFrame:
    return _ranked(wh, "dim_producto", ["rubro", "capitulo", "posicion", "descripcion_arancelaria"], 2)


def v_canal_control(wh) -> DataFrame:
    """V6: channel mix by month and office."""
    return canal_grouped(wh)


VIEWS = {
    "v_fob_por_operacion": v_fob_por_operacion,
    "v_top_paises": v_top_paises,
    "v_tendencia_mensual": v_tendencia_mensual,
    "v_ranking_aduana": v_ranking_aduana,
    "v_top_ncm": v_top_ncm,
    "v_canal_control": v_canal_control,
}


def register_views(spark: SparkSession, wh) -> list[str]:
    """Create or replace the six views as temp views."""
    for name, fn in VIEWS.items():
        fn(wh).createOrReplaceTempView(name)
    return list(VIEWS)
