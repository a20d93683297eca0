"""Dimensions D1-D7, built from staging.

Each comes from the DISTINCT of its own staging columns — map-side partial
aggregation, then a shuffle of the distinct values only — followed by one dense
numbering of all in natural-key order. Dimension sizes are bounded by the business domain
(operations, regimes, countries, offices, tariff positions, calendar days).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tradewh.functions.dates import date_key, month_name_es, quarter_of, semester
from tradewh.operators.keys import dense_keys
from tradewh.operators.materialize import materialize

# Fixed value: the office location the reference stores for every office.
UNSPECIFIED = "NO ESPECIFICADO"


def _calendar(days: DataFrame, legacy_quarter: bool) -> DataFrame:
    """Calendar attributes of a frame of distinct ``fecha_oficializacion`` days."""
    d = F.col("fecha_oficializacion")
    return days.select(
        date_key(d).alias("fecha_key"),
        d,
        F.year(d).alias("anio"),
        month_name_es(d).alias("mes_nombre"),
        F.month(d).alias("mes_numero"),
        quarter_of(d, legacy=legacy_quarter).alias("trimestre"),
        semester(d).alias("semestre"),
    )


def dim_fecha(stg: DataFrame, legacy_quarter: bool = False) -> DataFrame:
    """One row per observed officialisation date; key YYYYMMDD (no numbering needed)."""
    days = stg.select(F.col("oficializacion").alias("fecha_oficializacion")).dropna().distinct()
    return _calendar(days, legacy_quarter)


NAMES = ["dim_fecha", "dim_aduana", "dim_producto", "dim_pais_origen", "dim_pais_destino", "dim_operacion", "dim_regimen"]

# Numbered dimensions: name, staging column, surrogate key, natural-key column.
NUMBERED = [
    ("dim_aduana", "aduana", "aduana_key", "nombre_aduana"),
    ("dim_producto", "posicion", "producto_key", "posicion"),
    ("dim_pais_origen", "pais_origen", "pais_origen_key", "pais_origen_desc"),
    ("dim_pais_destino", "pais_procedencia_destino", "pais_destino_key", "pais_desc_desc"),
    ("dim_operacion", "operacion", "operacion_key", "tipo_operacion"),
    ("dim_regimen", "regimen", "regimen_key", "codigo_regimen"),
]
_PRODUCT_ATTRS = ["rubro", "desc_capitulo", "desc_partida", "desc_posicion"]


def build_dims(stg: DataFrame, legacy_quarter: bool = False) -> dict[str, DataFrame]:
    """All seven dimensions, each staging column read once.

    Every dimension's members are the DISTINCT of its own columns (partial
    aggregation in the scan tasks, so only distinct values are shuffled; no two
    dimensions share a column, so no column is read twice and no row is
    multiplied). They are stacked as (dimension, value[, product attributes]) and
    written as a table (the numbering below samples its input for range bounds
    and must not re-run the staging scan to do so). One dense numbering over
    (dimension, value) is rebased per dimension and written again, so the
    seven table writes read a small, fixed result.

    Returns ``{name: DataFrame}``.
    """
    null = F.lit(None).cast("string")

    # DISTINCT first (a keys-only hash aggregate, partial in the scan tasks);
    # MAX over strings cannot use the hash aggregate, so it runs afterwards on
    # the few distinct tuples instead of on every staging row.
    def members(name: str, src: str) -> DataFrame:
        cols = [src, *_PRODUCT_ATTRS] if name == "dim_producto" else [src]
        found = stg.select(*cols).where(F.col(src).isNotNull()).distinct()
        return found.select(F.lit(name).alias("dim"), F.col(src).cast("string").alias("v"),
                            *[(F.col(a) if a in cols else null).alias(f"a{i}") for i, a in enumerate(_PRODUCT_ATTRS)])

    sources = [(name, src) for name, src, _, _ in NUMBERED] + [("dim_fecha", "oficializacion")]
    distinct = (
        reduce(DataFrame.unionAll, [members(name, src) for name, src in sources])
        .groupBy("dim", "v")
        .agg(*[F.max(f"a{i}").alias(f"a{i}") for i in range(len(_PRODUCT_ATTRS))])
    )
    distinct = materialize(distinct, "dim-members")

    numbered = dense_keys(distinct.where(F.col("dim") != "dim_fecha"), ["dim", "v"], "_g", cast=None)
    first = numbered.groupBy("dim").agg(F.min("_g").alias("_g0"))
    numbered = numbered.join(F.broadcast(first), "dim").select(
        "dim", "v", "a0", "a1", "a2", "a3", (F.col("_g") - F.col("_g0") + 1).cast("int").alias("_k"))
    dates = distinct.where(F.col("dim") == "dim_fecha").select(
        "dim", "v", "a0", "a1", "a2", "a3", F.lit(None).cast("int").alias("_k"))
    keyed = materialize(numbered.unionByName(dates), "dim-keys")

    out = {}
    for name, _, key, natural in NUMBERED:
        d = keyed.where(F.col("dim") == name)
        if name == "dim_producto":
            out[name] = d.select(F.col("_k").alias(key), F.col("a0").alias("rubro"), F.col("a1").alias("capitulo"),
                                 F.col("a2").alias("partida"), F.col("v").alias("posicion"),
                                 F.col("a3").alias("descripcion_arancelaria"))
        elif name == "dim_regimen":
            out[name] = d.select(F.col("_k").alias(key), F.col("v").alias(natural), F.col("v").alias("descripcion_regimen"))
        elif name == "dim_aduana":
            out[name] = d.select(F.col("_k").alias(key), F.col("v").alias(natural),
                                 F.lit(UNSPECIFIED).alias("ubicacion_dependencia"))
        else:
            out[name] = d.select(F.col("_k").alias(key), F.col("v").alias(natural))
    day = keyed.where(F.col("dim") == "dim_fecha").select(F.col("v").cast("date").alias("fecha_oficializacion"))
    out["dim_fecha"] = _calendar(day, legacy_quarter)
    return {name: out[name] for name in NAMES}
