"""The six logical views as persistent views of the catalog.

Plain SQL text over the named tables of ``dw``: whoever shares the catalog reads
``analytic.v_*`` without this package. The fact joins the date dimension by its
key and by its partition column, so a filter on the year, or on any other date
attribute, prunes the fact's partitions.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _sum(c: str) -> str:
    """Exact sum of a DECIMAL(18,2) as three BIGINT limbs (``numeric.sum_money``)."""
    cents = f"CAST({c} * 100 AS BIGINT)"
    limbs = [(f"{cents} DIV 1000000 DIV 1000000", "CAST(10000000000 AS DECIMAL(11,0))"),
             (f"{cents} DIV 1000000 % 1000000", "CAST(10000 AS DECIMAL(11,0))"), (f"{cents} % 1000000", "0.01BD")]
    return "CAST(" + " + ".join(f"CAST(SUM({x}) AS DECIMAL(20,0)) * {scale}" for x, scale in limbs) + " AS DECIMAL(38,2))"


def _round(x: str, digits: int = 2) -> str:
    return f"ROUND(({x}) * {10 ** digits}D, 0) / {10 ** digits}D"


def _avg(c: str) -> str:
    return _round(f"try_divide(CAST({_sum(c)} AS DOUBLE), CAST(COUNT({c}) AS DOUBLE))")


def _share(value: str, *partition: str) -> str:
    return _round(f"CAST({value} AS DOUBLE) * 100D / CAST(SUM({value}) OVER (PARTITION BY {', '.join(partition)}) AS DOUBLE)")


_DATED = "dw.fact_aduana_item f JOIN dw.dim_fecha df ON f.fecha_key = df.fecha_key AND f.fecha_anio = df.anio"
_STAR = f"{_DATED} JOIN dw.dim_operacion o ON f.operacion_key = o.operacion_key"
_MONTH = "df.anio, df.mes_numero, df.mes_nombre, df.trimestre"


def _ranked(attributes: str, join: str) -> str:
    names = ", ".join(a.split(".")[1] for a in attributes.split(", "))
    return f"""
SELECT anio, trimestre, tipo_operacion, {names}, cantidad_items, fob_total, kilo_neto_total, fob_promedio,
       RANK() OVER (PARTITION BY anio, tipo_operacion ORDER BY fob_total DESC NULLS LAST) AS rank_fob,
       {_share('fob_total', 'anio', 'tipo_operacion')} AS pct_fob
FROM (
  SELECT df.anio, df.trimestre, o.tipo_operacion, {attributes}, COUNT(*) AS cantidad_items, {_sum('f.fob_dolar')} AS fob_total,
         {_sum('f.kilo_neto')} AS kilo_neto_total, {_avg('f.fob_dolar')} AS fob_promedio
  FROM {_STAR} {join}
  GROUP BY df.anio, df.trimestre, o.tipo_operacion, {attributes})"""


VIEW_SQL = {
    "v_fob_por_operacion": f"""
SELECT {_MONTH}, df.semestre, o.tipo_operacion, COUNT(*) AS cantidad_items, {_sum('f.fob_dolar')} AS fob_total,
       {_sum('f.kilo_neto')} AS kilo_neto_total, {_sum('f.flete_dolar')} AS flete_total, {_sum('f.seguro_dolar')} AS seguro_total,
       {_sum('f.total_gravamen')} AS gravamen_total, {_avg('f.fob_dolar')} AS fob_promedio
FROM {_STAR}
GROUP BY {_MONTH}, df.semestre, o.tipo_operacion""",
    # Both halves from one scan: each row gives its origin and its destination.
    "v_top_paises": f"""
SELECT g.anio, g.trimestre, o.tipo_operacion, p.pais, p.tipo_pais, g.cantidad_items, g.fob_total, g.kilo_neto_total,
       {_share('g.fob_total', 'g.anio', 'o.tipo_operacion', 'p.tipo_pais')} AS pct_fob
FROM (
  SELECT f.anio, f.trimestre, f.operacion_key, h.de_origen, h.pais_key, COUNT(*) AS cantidad_items,
         {_sum('f.fob_dolar')} AS fob_total, {_sum('f.kilo_neto')} AS kilo_neto_total
  FROM (SELECT df.anio, df.trimestre, f.operacion_key, f.pais_origen_key, f.pais_destino_key, f.fob_dolar, f.kilo_neto FROM {_DATED}) f
  LATERAL VIEW stack(2, true, f.pais_origen_key, false, f.pais_destino_key) h AS de_origen, pais_key
  GROUP BY f.anio, f.trimestre, f.operacion_key, h.de_origen, h.pais_key
) g
JOIN dw.dim_operacion o ON g.operacion_key = o.operacion_key
JOIN (
  SELECT true AS de_origen, 'ORIGEN' AS tipo_pais, pais_origen_key AS pais_key, pais_origen_desc AS pais FROM dw.dim_pais_origen
  UNION ALL
  SELECT false, 'DESTINO', pais_destino_key, pais_desc_desc FROM dw.dim_pais_destino
) p ON g.de_origen = p.de_origen AND g.pais_key = p.pais_key""",
    "v_tendencia_mensual": f"""
SELECT anio, mes_numero, mes_nombre, trimestre, semestre, tipo_operacion, fob_total, kilo_neto_total, cantidad_items, paises_distintos,
       fob_total - previo AS fob_variacion_abs,
       {_round('try_divide(CAST(fob_total - previo AS DOUBLE) * 100D, NULLIF(CAST(previo AS DOUBLE), 0D))')} AS fob_variacion_pct,
       SUM(fob_total) OVER (PARTITION BY anio, tipo_operacion ORDER BY mes_numero
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fob_ytd
FROM (
  SELECT *, LAG(fob_total) OVER (PARTITION BY tipo_operacion ORDER BY anio, mes_numero) AS previo
  FROM (
    SELECT {_MONTH}, df.semestre, o.tipo_operacion, {_sum('f.fob_dolar')} AS fob_total, {_sum('f.kilo_neto')} AS kilo_neto_total,
           COUNT(*) AS cantidad_items, COUNT(DISTINCT f.pais_origen_key) AS paises_distintos
    FROM {_STAR}
    GROUP BY {_MONTH}, df.semestre, o.tipo_operacion))""",
    "v_ranking_aduana": _ranked("a.nombre_aduana", "JOIN dw.dim_aduana a ON f.aduana_key = a.aduana_key"),
    "v_top_ncm": _ranked("p.rubro, p.capitulo, p.posicion, p.descripcion_arancelaria", "JOIN dw.dim_producto p ON f.producto_key = p.producto_key"),
    "v_canal_control": f"""
SELECT *, {_share('cantidad_despachos', 'anio', 'mes_numero', 'tipo_operacion', 'nombre_aduana')} AS pct_canal
FROM (
  SELECT {_MONTH}, o.tipo_operacion, a.nombre_aduana, f.canal AS canal_codigo, dw.decode_canal(f.canal) AS canal_nombre,
         COUNT(*) AS cantidad_despachos, {_sum('f.fob_dolar')} AS fob_total, {_sum('f.total_gravamen')} AS gravamen_total
  FROM {_STAR} JOIN dw.dim_aduana a ON f.aduana_key = a.aduana_key
  WHERE f.canal IS NOT NULL
  GROUP BY {_MONTH}, o.tipo_operacion, a.nombre_aduana, f.canal)""",
}


def register_catalog_views(spark: SparkSession) -> list[str]:
    """Create or replace ``analytic.v_*``; tables and functions of ``dw`` must be there."""
    for name, text in VIEW_SQL.items():
        spark.sql(f"CREATE OR REPLACE VIEW analytic.{name} AS {text}")
    return [f"analytic.{name}" for name in VIEW_SQL]
