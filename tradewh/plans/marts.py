"""Materialised aggregates M1-M5 (schema ``analytic`` of the reference).

Fact scan -> date attributes -> GROUPING SETS with partial aggregation in the
scan tasks -> one shuffle -> a written table of groups; each mart reads its
grouping set from there (M1 and M3 roll M5's up), attaches names, and runs its
window functions (shares and ranks) over the aggregated rows only.
Money stays DECIMAL (exact, order-independent sums); averages and shares are
DOUBLE rounded half away from zero.

Report-level quirks kept on purpose: M4 ranks (quarter x position) rows inside
(year, operation), so one position can rank several times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tradewh.functions.numeric import cents, from_cents, round_half_away, safe_div, sum_cents, sum_money
from tradewh.functions.text import decode_canal
from tradewh.operators.distinct import bitmaps, distinct_of
from tradewh.operators.windows import with_rank, with_share
from tradewh.plans.star import star


def avg_money(c: str) -> Column:
    """``ROUND(AVG(x), 2)`` as DOUBLE: double(sum) / count(non-NULL)."""
    return round_half_away(safe_div(sum_money(c), F.count(c)), 2)


def _count() -> Column:
    return F.count(F.lit(1))


def canal_grouped(wh) -> DataFrame:
    """Body of V6: fact rows with a channel, by month/office/channel."""
    keys = ["anio", "mes_numero", "mes_nombre", "trimestre", "tipo_operacion", "nombre_aduana"]
    fact = wh.fact_by_year.where(F.col("canal").isNotNull())
    aggs = [
        _count().alias("cantidad_despachos"),
        sum_money("fob_dolar").alias("fob_total"),
        sum_money("total_gravamen").alias("gravamen_total"),
    ]
    df = star(wh, ["dim_fecha", "dim_operacion", "dim_aduana"], fact=fact).groupBy(
        *keys, F.col("canal").alias("canal_codigo"), decode_canal("canal").alias("canal_nombre")
    ).agg(*aggs)
    return with_share(df, "cantidad_despachos", ["anio", "mes_numero", "tipo_operacion", "nombre_aduana"],
                      "pct_canal", 2)


# -- all five marts from one scan of the fact ---------------------------------

GRAIN_KEYS = {
    "agg_fob_mensual_operacion": ["anio", "mes_numero", "mes_nombre", "trimestre", "semestre", "tipo_operacion"],
    "agg_fob_pais_anual": ["anio", "trimestre", "tipo_operacion", "pais_origen_desc", "pais_destino_desc"],
    "agg_fob_aduana_mensual": ["anio", "mes_numero", "mes_nombre", "trimestre", "tipo_operacion", "nombre_aduana"],
    "agg_fob_ncm_anual": ["anio", "trimestre", "tipo_operacion", "rubro", "capitulo", "posicion",
                          "descripcion_arancelaria"],
    "agg_canal_mensual": ["anio", "mes_numero", "mes_nombre", "trimestre", "tipo_operacion", "nombre_aduana",
                          "canal_codigo", "canal_nombre"],
}
#: Each mart's grain in words: its key columns.
GRAINS = {name: " + ".join(keys) for name, keys in GRAIN_KEYS.items()}
SORT_KEYS = {
    "agg_fob_mensual_operacion": ["anio", "mes_numero", "tipo_operacion"],
    "agg_fob_pais_anual": ["anio", "tipo_operacion"],
    "agg_fob_aduana_mensual": ["anio", "mes_numero", "tipo_operacion"],
    "agg_fob_ncm_anual": ["anio", "tipo_operacion"],
    "agg_canal_mensual": ["anio", "mes_numero", "nombre_aduana", "canal_codigo"],
    "paises_mes": ["anio", "mes_numero"],
}
_SUMS = {
    "fob_total": "fob_dolar", "kilo_neto_total": "kilo_neto", "flete_total": "flete_dolar",
    "seguro_total": "seguro_dolar", "derecho_total": "derecho", "isc_total": "isc", "iva_total": "iva",
    "gravamen_total": "total_gravamen",
}


# Integer grouping keys of each mart: the string attributes of its grain are
# functions of these (surrogate keys are 1:1 with natural keys, month names
# and quarters are functions of the month), so grouping by them is the same
# grouping, with narrow fixed-width hash keys.
KEY_GRAINS = {
    "agg_fob_mensual_operacion": ["anio", "mes_numero", "trimestre", "semestre", "operacion_key"],
    "agg_fob_pais_anual": ["anio", "trimestre", "operacion_key", "pais_origen_key", "pais_destino_key"],
    "agg_fob_aduana_mensual": ["anio", "mes_numero", "trimestre", "operacion_key", "aduana_key"],
    "agg_fob_ncm_anual": ["anio", "trimestre", "operacion_key", "producto_key"],
    "agg_canal_mensual": ["anio", "mes_numero", "trimestre", "operacion_key", "aduana_key", "canal"],
}
# The grouping sets that the fact is aggregated by. The first is M5's grain with
# rows of NULL office and channel kept; M1 and M3 are coarser and roll it up.
SETS = {
    "canal": ["anio", "mes_numero", "trimestre", "semestre", "operacion_key", "aduana_key", "canal"],
    "pais": KEY_GRAINS["agg_fob_pais_anual"],
    "ncm": KEY_GRAINS["agg_fob_ncm_anual"],
}
SET_OF = {
    "agg_fob_mensual_operacion": "canal",
    "agg_fob_pais_anual": "pais",
    "agg_fob_aduana_mensual": "canal",
    "agg_fob_ncm_anual": "ncm",
    "agg_canal_mensual": "canal",
}
# Dimensions joined back onto each mart's aggregated rows (inner joins).
ATTACH = {
    "agg_fob_mensual_operacion": ["dim_operacion", "month"],
    "agg_fob_pais_anual": ["dim_operacion", "dim_pais_origen", "dim_pais_destino"],
    "agg_fob_aduana_mensual": ["dim_operacion", "dim_aduana", "month"],
    "agg_fob_ncm_anual": ["dim_operacion", "dim_producto"],
    "agg_canal_mensual": ["dim_operacion", "dim_aduana", "month"],
}


def mart_groups(wh) -> DataFrame:
    """The fact grouped by the three sets of ``SETS``, in ONE scan of it.

    fact ⋈ dim_fecha (integer calendar attributes only), then GROUPING SETS over
    integer keys: the Expand feeds partial aggregation in the scan tasks, so a
    single shuffle carries the partial aggregates of all five marts. ``grain``
    names the set. Counts, sums, minima and maxima all roll up. Money becomes BIGINT
    cents below the Expand, once per fact row and not once per set.
    """
    fecha = wh.dim("dim_fecha").select("fecha_key", "anio", "mes_numero", "trimestre", "semestre")
    base = wh.fact.join(fecha, "fecha_key")
    cols: list[str] = []
    for keys in SETS.values():
        cols += [c for c in keys if c not in cols]
    gid = {n: sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in keys) for n, keys in SETS.items()}
    base = base.select(*cols, *[cents(src).alias(src) for src in _SUMS.values()])
    agg = base.groupingSets(list(SETS.values()), *cols).agg(
        F.grouping_id().alias("_gid"),
        _count().alias("_count"),
        *[sum_cents(src).alias(out) for out, src in _SUMS.items()],
        F.count("fob_dolar").alias("_n_fob"),
        from_cents(F.min("fob_dolar")).alias("fob_minimo"),
        from_cents(F.max("fob_dolar")).alias("fob_maximo"),
    )
    name = F.create_map(*[x for n, g in gid.items() for x in (F.lit(g).cast("long"), F.lit(n))])
    return agg.withColumn("grain", name[F.col("_gid").cast("long")]).drop("_gid")


def _rolled_up(groups: DataFrame, keys: list[str]) -> DataFrame:
    return groups.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("_count", "_n_fob")],
        *[F.sum(c).cast("decimal(38,2)").alias(c) for c in _SUMS],
        F.min("fob_minimo").alias("fob_minimo"),
        F.max("fob_maximo").alias("fob_maximo"),
    )


def paises_mes(wh) -> DataFrame:
    """Origin countries per month and operation as bitmaps of their dense keys, for
    distinct counts at this and every coarser level (A8). Reads three key columns."""
    keys = ["anio", "mes_numero", "trimestre", "semestre", "operacion_key"]
    return bitmaps(star(wh, ["dim_fecha"]).where("operacion_key IS NOT NULL"), keys, "pais_origen_key")


def distinct_countries(wh) -> DataFrame:
    """Distinct origin countries per operation by month, quarter, year and in all,
    rolled up from the stored bitmaps; the fact isn't read."""
    maps = wh.mart("paises_mes").join(wh.dim("dim_operacion"), "operacion_key")
    out = None
    for level, keys in {"mes": ["anio", "mes_numero"], "trimestre": ["anio", "trimestre"], "anio": ["anio"], "todo": []}.items():
        n = distinct_of(maps, [*keys, "tipo_operacion"], "paises")
        period = [F.col(k) if k in keys else F.lit(None).cast("int").alias(k) for k in ("anio", "mes_numero", "trimestre")]
        n = n.select(F.lit(level).alias("nivel"), *period, "tipo_operacion", "paises")
        out = n if out is None else out.unionByName(n)
    return out


def build_marts(wh, folder: str) -> dict[str, DataFrame]:
    """M1-M5 from the table of groups, which is written to ``folder`` first, and the
    bitmaps of countries.

    Per mart: its grain's rows with its keys present (M1 and M3 rolled up), then
    inner joins of the dimensions onto the *aggregated* rows to attach the
    descriptive attributes, then ranks and shares.

    Same rows as each mart's own star join + GROUP BY: an inner join drops
    exactly the fact rows whose key is NULL or unknown, and here those rows
    only form groups that the filter drops.
    """
    # Stored by grain, so a mart reads its own set only.
    path = f"{folder}/mart_groups"
    mart_groups(wh).write.mode("overwrite").partitionBy("grain").parquet(path)
    agg = wh.spark.read.parquet(path)

    months = wh.dim("dim_fecha").select("mes_numero", "mes_nombre").distinct()
    lookups = {
        "dim_operacion": wh.dim("dim_operacion"),
        "dim_pais_origen": wh.dim("dim_pais_origen"),
        "dim_pais_destino": wh.dim("dim_pais_destino").withColumnRenamed("pais_desc_desc", "pais_destino_desc"),
        "dim_aduana": wh.dim("dim_aduana").select("aduana_key", "nombre_aduana"),
        "dim_producto": wh.dim("dim_producto").drop("partida"),
    }
    join_key = {"dim_operacion": "operacion_key", "dim_pais_origen": "pais_origen_key",
                "dim_pais_destino": "pais_destino_key", "dim_aduana": "aduana_key",
                "dim_producto": "producto_key", "month": "mes_numero"}

    def part(n: str) -> DataFrame:
        m = agg.where(F.col("grain") == SET_OF[n])
        for c in KEY_GRAINS[n]:
            m = m.where(F.col(c).isNotNull())
        if KEY_GRAINS[n] != SETS[SET_OF[n]]:
            m = _rolled_up(m, KEY_GRAINS[n])
        for d in ATTACH[n]:
            if d == "month":
                m = m.join(F.broadcast(months), "mes_numero")
            else:
                m = m.join(lookups[d], join_key[d])
        if "canal" in KEY_GRAINS[n]:
            m = m.withColumn("canal_codigo", F.col("canal")).withColumn("canal_nombre", decode_canal("canal"))
        return m.withColumn("fob_promedio", round_half_away(safe_div(F.col("fob_total"), F.col("_n_fob")), 2))

    out = {"paises_mes": paises_mes(wh)}
    m = part("agg_fob_mensual_operacion")
    out["agg_fob_mensual_operacion"] = m.select(
        *GRAIN_KEYS["agg_fob_mensual_operacion"], F.col("_count").alias("cantidad_items"),
        "fob_total", "kilo_neto_total", "flete_total", "seguro_total", "derecho_total", "isc_total", "iva_total",
        "gravamen_total", "fob_promedio", "fob_minimo", "fob_maximo")

    m = part("agg_fob_pais_anual").select(
        *GRAIN_KEYS["agg_fob_pais_anual"], F.col("_count").alias("cantidad_items"),
        "fob_total", "kilo_neto_total", "fob_promedio")
    out["agg_fob_pais_anual"] = with_share(m, "fob_total", ["anio", "tipo_operacion"], "pct_fob_sobre_total", 4)

    m = part("agg_fob_aduana_mensual").select(
        *GRAIN_KEYS["agg_fob_aduana_mensual"], F.col("_count").alias("cantidad_items"),
        "fob_total", "kilo_neto_total", "fob_promedio", "gravamen_total")
    w = ["anio", "mes_numero", "tipo_operacion"]
    out["agg_fob_aduana_mensual"] = with_share(with_rank(m, "fob_total", w, "rank_fob_mes"), "fob_total", w, "pct_fob", 2)

    m = part("agg_fob_ncm_anual").select(
        *GRAIN_KEYS["agg_fob_ncm_anual"], F.col("_count").alias("cantidad_items"),
        "fob_total", "kilo_neto_total", "fob_promedio")
    w = ["anio", "tipo_operacion"]
    out["agg_fob_ncm_anual"] = with_share(with_rank(m, "fob_total", w, "rank_fob"), "fob_total", w, "pct_fob", 4)

    m = part("agg_canal_mensual").select(
        *GRAIN_KEYS["agg_canal_mensual"], F.col("_count").alias("cantidad_despachos"),
        "fob_total", "gravamen_total", "fob_promedio")
    out["agg_canal_mensual"] = with_share(
        m, "cantidad_despachos", ["anio", "mes_numero", "tipo_operacion", "nombre_aduana"], "pct_canal", 2)
    return out
