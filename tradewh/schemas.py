"""Fixed schemas: raw source columns, staging layout, dimension and fact layouts.

The raw column names (spaces, '/', 'Ñ', and the 'PRECION' typo) are part of the
source contract and must be kept exactly.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The 47 source columns of a declaration-item extract, as named
# by the source system, in the order the staging load reads them.
RAW_COLUMNS = [
    "DESPACHO CIFRADO", "OPERACION", "DESTINACION", "REGIMEN", "OFICIALIZACION",
    "CANCELACION", "AÑO", "MES", "ADUANA", "COTIZACION", "MEDIO TRANSPORTE",
    "CANAL", "ITEM", "PAIS ORIGEN", "PAIS PROCEDENCIA/DESTINO", "USO",
    "UNIDAD MEDIDA ESTADISTICA", "CANTIDAD ESTADISTICA", "KILO NETO", "KILO BRUTO",
    "FOB DOLAR", "FLETE DOLAR", "SEGURO DOLAR", "IMPONIBLE DOLAR", "IMPONIBLE GS",
    "AJUSTE A INCLUIR", "AJUSTE A DEDUCIR", "POSICION", "RUBRO", "DESC CAPITULO",
    "DESC PARTIDA", "DESC POSICION", "MERCADERIA", "MARCA ITEM", "ACUERDO",
    "NUMERO SUBITEM", "CANTIDAD SUBITEM", "PRECION UNITARIO SUBITEM",
    "DESC SUBITEM", "MARCA SUBITEM", "DERECHO", "ISC", "SERVICIO", "RENTA", "IVA",
    "OTROS", "TOTAL",
]

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

# Staging column -> (source column, treatment). Treatments:
#   text    UPPER(TRIM(x))              money   decimal-comma -> DECIMAL(18,2)
#   int     integer parse               date    date parse
#   country backslash repair + country  raw     passed through as text
#   qty     quantity without comma repair in legacy mode, money otherwise
STAGING_SOURCES = [
    ("despacho_cifrado", "DESPACHO CIFRADO", "text"),
    ("operacion", "OPERACION", "text"),
    ("destinacion", "DESTINACION", "text"),
    ("regimen", "REGIMEN", "text"),
    ("oficializacion", "OFICIALIZACION", "date"),
    ("cancelacion", "CANCELACION", "raw"),
    ("anio", "AÑO", "int"),
    ("mes", "MES", "raw"),
    ("aduana", "ADUANA", "text"),
    ("cotizacion", "COTIZACION", "money"),
    ("medio_transporte", "MEDIO TRANSPORTE", "text"),
    ("canal", "CANAL", "text"),
    ("item", "ITEM", "int"),
    ("pais_origen", "PAIS ORIGEN", "country"),
    ("pais_procedencia_destino", "PAIS PROCEDENCIA/DESTINO", "country"),
    ("uso", "USO", "text"),
    ("unidad_medida_estadistica", "UNIDAD MEDIDA ESTADISTICA", "text"),
    ("cantidad_estadistica", "CANTIDAD ESTADISTICA", "money"),
    ("kilo_neto", "KILO NETO", "money"),
    ("kilo_bruto", "KILO BRUTO", "money"),
    ("fob_dolar", "FOB DOLAR", "money"),
    ("flete_dolar", "FLETE DOLAR", "money"),
    ("seguro_dolar", "SEGURO DOLAR", "money"),
    ("imponible_dolar", "IMPONIBLE DOLAR", "money"),
    ("imponible_gs", "IMPONIBLE GS", "money"),
    ("ajuste_a_incluir", "AJUSTE A INCLUIR", "money"),
    ("ajuste_a_deducir", "AJUSTE A DEDUCIR", "money"),
    ("posicion", "POSICION", "text"),
    ("rubro", "RUBRO", "text"),
    ("desc_capitulo", "DESC CAPITULO", "text"),
    ("desc_partida", "DESC PARTIDA", "text"),
    ("desc_posicion", "DESC POSICION", "text"),
    ("mercaderia", "MERCADERIA", "text"),
    ("marca_item", "MARCA ITEM", "text"),
    ("acuerdo", "ACUERDO", "text"),
    ("numero_subitem", "NUMERO SUBITEM", "int"),
    ("cantidad_subitem", "CANTIDAD SUBITEM", "qty"),
    ("precio_unitario_subitem", "PRECION UNITARIO SUBITEM", "money"),
    ("desc_subitem", "DESC SUBITEM", "text"),
    ("marca_subitem", "MARCA SUBITEM", "text"),
    ("derecho", "DERECHO", "money"),
    ("isc", "ISC", "money"),
    ("servicio", "SERVICIO", "money"),
    ("renta", "RENTA", "money"),
    ("iva", "IVA", "money"),
    ("otros", "OTROS", "money"),
    ("total", "TOTAL", "money"),
]

STAGING_AUDIT = ["batch_id", "fecha_carga", "archivo_origen"]
STAGING_COLUMNS = [t for t, _, _ in STAGING_SOURCES] + STAGING_AUDIT

MONEY_COLUMNS = [t for t, _, k in STAGING_SOURCES if k in ("money", "qty")]

# Dimension natural keys: dim name -> (surrogate key, natural-key column in staging).
DIM_KEYS = {
    "dim_fecha": ("fecha_key", "oficializacion"),
    "dim_aduana": ("aduana_key", "aduana"),
    "dim_producto": ("producto_key", "posicion"),
    "dim_pais_origen": ("pais_origen_key", "pais_origen"),
    "dim_pais_destino": ("pais_destino_key", "pais_procedencia_destino"),
    "dim_operacion": ("operacion_key", "operacion"),
    "dim_regimen": ("regimen_key", "regimen"),
}

FACT_MEASURES = [
    "kilo_neto", "kilo_bruto", "fob_dolar", "flete_dolar", "seguro_dolar",
    "derecho", "isc", "iva", "total_gravamen", "valor_fob_subitem", "kilo_neto_subitem",
]

FACT_COLUMNS = (
    ["id_fact_key"] + [k for k, _ in DIM_KEYS.values()] + FACT_MEASURES
    + ["canal", "batch_id", "fecha_carga"]
)

_MONEY = T.DecimalType(18, 2)
_KINDS = {"text": T.StringType(), "raw": T.StringType(), "country": T.StringType(), "money": _MONEY, "qty": _MONEY,
          "int": T.IntegerType(), "date": T.DateType()}


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


STAGING_SCHEMA = _struct(*[(t, _KINDS[k]) for t, _, k in STAGING_SOURCES],
                         ("batch_id", T.StringType()), ("fecha_carga", T.TimestampType()), ("archivo_origen", T.StringType()))

_INT, _STR = T.IntegerType(), T.StringType()
DIM_SCHEMAS = {
    "dim_fecha": _struct(("fecha_key", _INT), ("fecha_oficializacion", T.DateType()), ("anio", _INT), ("mes_nombre", _STR),
                         ("mes_numero", _INT), ("trimestre", _INT), ("semestre", _INT)),
    "dim_aduana": _struct(("aduana_key", _INT), ("nombre_aduana", _STR), ("ubicacion_dependencia", _STR)),
    "dim_producto": _struct(("producto_key", _INT), ("rubro", _STR), ("capitulo", _STR), ("partida", _STR), ("posicion", _STR),
                            ("descripcion_arancelaria", _STR)),
    "dim_pais_origen": _struct(("pais_origen_key", _INT), ("pais_origen_desc", _STR)),
    "dim_pais_destino": _struct(("pais_destino_key", _INT), ("pais_desc_desc", _STR)),
    "dim_operacion": _struct(("operacion_key", _INT), ("tipo_operacion", _STR)),
    "dim_regimen": _struct(("regimen_key", _INT), ("codigo_regimen", _STR), ("descripcion_regimen", _STR)),
}
FACT_SCHEMA = _struct(("id_fact_key", T.LongType()), *[(k, _INT) for k, _ in DIM_KEYS.values()], *[(m, _MONEY) for m in FACT_MEASURES],
                      ("canal", _STR), ("batch_id", _STR), ("fecha_carga", T.TimestampType()))


def conform(df, schema: T.StructType):
    """``df`` with the schema's columns in its order; a missing column or another
    type is an error before anything is written (S5)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    wrong = [f"{f.name}: {have.get(f.name)} instead of {f.dataType}" for f in schema.fields if have.get(f.name) != f.dataType]
    if wrong or len(have) != len(schema.fields):
        raise TypeError(f"not the declared schema: {wrong or sorted(set(have) - set(schema.names))}")
    return df.select(*schema.names)
