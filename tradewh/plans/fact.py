"""Fact load (L3): one row per declaration item, with seven surrogate keys.

Plan shape: staging scan -> ids from the tags stored with it -> six lookups
(broadcast hash joins while the dimensions are small) -> projection. The ids
are settled before any lookup, so they don't depend on how the lookups run. The
date key needs no lookup at all: the date dimension's key *is* the date as
YYYYMMDD, and the dimension holds every non-NULL staging date, so the key is
computed in place. Row count is preserved: every dimension key is unique (LEFT
joins, J1).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tradewh.functions.dates import date_key
from tradewh.functions.numeric import subitem_value
from tradewh.operators.joins import lookup_join
from tradewh.operators.keys import ids_from_tags
from tradewh.schemas import FACT_COLUMNS

# (dimension, staging natural key, dimension natural key, surrogate key)
LOOKUPS = [
    ("dim_aduana", "aduana", "nombre_aduana", "aduana_key"),
    ("dim_producto", "posicion", "posicion", "producto_key"),
    ("dim_pais_origen", "pais_origen", "pais_origen_desc", "pais_origen_key"),
    ("dim_pais_destino", "pais_procedencia_destino", "pais_desc_desc", "pais_destino_key"),
    ("dim_operacion", "operacion", "tipo_operacion", "operacion_key"),
    ("dim_regimen", "regimen", "codigo_regimen", "regimen_key"),
]


# Column of the written staging table that tags each row (see ``ids_from_tags``).
ROW_TAG = "_row_tag"


def build_fact(stg: DataFrame, dims: dict[str, DataFrame], load_ts: Column | None = None) -> DataFrame:
    """``stg`` is the written staging table with its ``ROW_TAG`` column."""
    f = ids_from_tags(stg, ROW_TAG, "id_fact_key").withColumn("fecha_key", F.when(F.col("oficializacion").isNotNull(), date_key("oficializacion")))
    for dim, stg_key, dim_key, sk in LOOKUPS:
        f = lookup_join(f, dims[dim], stg_key, dim_key, [sk])
    return f.select(
        "id_fact_key",
        "fecha_key", "aduana_key", "producto_key", "pais_origen_key", "pais_destino_key",
        "operacion_key", "regimen_key",
        "kilo_neto", "kilo_bruto", "fob_dolar", "flete_dolar", "seguro_dolar",
        "derecho", "isc", "iva",
        F.col("total").alias("total_gravamen"),
        subitem_value("precio_unitario_subitem", "cantidad_subitem").alias("valor_fob_subitem"),
        F.col("cantidad_subitem").alias("kilo_neto_subitem"),
        "canal", "batch_id",
        (load_ts if load_ts is not None else F.current_timestamp()).alias("fecha_carga"),
    ).select(*FACT_COLUMNS)
