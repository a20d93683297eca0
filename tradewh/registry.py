"""Registry of named queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradewh import oracle
from tradewh.functions.text import normalize_country, repair_enye
from tradewh.plans import dims as dims_mod
from tradewh.plans import marts as marts_mod
from tradewh.plans import charts, exports, namespaces, quality, reports, view_sql, views
from tradewh.plans.staging import build_staging, staging_rejects, typed_rejects
from tradewh.plans.warehouse import FIXTURE_CUTOFF, fixture_warehouse, to_output
from tradewh.schemas import STAGING_SOURCES


def _wh(spark: SparkSession, sf_dir: str):
    return fixture_warehouse(spark, sf_dir)


def staging_typed(spark, sf_dir) -> DataFrame:
    return to_output(_wh(spark, sf_dir).staging.select(*[t for t, _, _ in STAGING_SOURCES]))


def staging_country(spark, sf_dir) -> DataFrame:
    raw = _wh(spark, sf_dir).bronze
    src = F.col("`PAIS ORIGEN`")
    return raw.groupBy(src.alias("raw_value")).agg(F.count(F.lit(1)).alias("rows")).select(
        "raw_value",
        normalize_country(repair_enye("raw_value")).alias("clean_value"),
        normalize_country(repair_enye("raw_value"), first_only=True).alias("clean_value_legacy"),
        "rows",
    )


def staging_rejects_q(spark, sf_dir) -> DataFrame:
    return staging_rejects(_wh(spark, sf_dir).bronze, cutoff=FIXTURE_CUTOFF)


def staging_typed_rejects(spark, sf_dir) -> DataFrame:
    return typed_rejects(_wh(spark, sf_dir).bronze, cutoff=FIXTURE_CUTOFF)


def staging_legacy_qty(spark, sf_dir) -> DataFrame:
    stg = build_staging(_wh(spark, sf_dir).bronze, cutoff=FIXTURE_CUTOFF, legacy=True)
    return to_output(stg.select("despacho_cifrado", "item", "cantidad_subitem"))


def fact_items(spark, sf_dir) -> DataFrame:
    f = _wh(spark, sf_dir).fact
    return to_output(f.drop("id_fact_key", "batch_id", "fecha_carga"))


def load_audit(spark, sf_dir) -> DataFrame:
    """The audit columns (P12, P13): one batch, named by its time, on every row, and
    a load time between the oldest plausible one and now."""
    wh = _wh(spark, sf_dir)
    out = None
    for name, df in (("stg_aduana", wh.staging), ("fact_aduana_item", wh.fact)):
        now = F.col("fecha_carga").between(F.current_timestamp() - F.expr("INTERVAL 7 DAYS"), F.current_timestamp())
        row = df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("batch_id").alias("batches"),
                     F.count_if(F.col("batch_id").rlike(r"^BATCH_\d{8}_\d{6}$")).alias("well_named"),
                     F.count_if(now).alias("recently_loaded")).select(F.lit(name).alias("table_name"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def _dim(name):
    return lambda spark, sf_dir: _wh(spark, sf_dir).dim(name)


def dim_fecha_legacy_quarter(spark, sf_dir) -> DataFrame:
    return dims_mod.dim_fecha(_wh(spark, sf_dir).staging, legacy_quarter=True)


def _mart(name):
    return lambda spark, sf_dir: to_output(_wh(spark, sf_dir).mart(name))


def _legacy_mart(name):
    """The mart of a load that keeps the source system's quirks throughout."""
    return lambda spark, sf_dir: to_output(fixture_warehouse(spark, sf_dir, legacy=True).mart(name))


def _view(fn):
    return lambda spark, sf_dir: to_output(fn(_wh(spark, sf_dir)))


def _catalog_view(name):
    """The persistent view of the catalog, by its schema name."""
    def query(spark, sf_dir) -> DataFrame:
        namespaces.register_tables(spark, _wh(spark, sf_dir), with_marts=False)
        return to_output(spark.sql(f"SELECT * FROM analytic.{name}"))

    return query


def sql_normalizar_pais(spark, sf_dir) -> DataFrame:
    wh = _wh(spark, sf_dir)
    namespaces.register_tables(spark, wh, with_marts=False)
    return spark.sql(r"""
        SELECT raw_value, dw.normalizar_pais(replace(raw_value, r'\', 'Ñ')) AS clean_value,
               dw.normalizar_pais(replace(raw_value, r'\', 'Ñ'), solo_primero => true) AS clean_value_legacy, rows
        FROM (SELECT `PAIS ORIGEN` AS raw_value, COUNT(*) AS rows FROM {bronze} GROUP BY 1)""", bronze=wh.bronze)


def sql_decode_canal(spark, sf_dir) -> DataFrame:
    namespaces.register_tables(spark, _wh(spark, sf_dir), with_marts=False)
    return spark.sql("""
        SELECT canal, dw.decode_canal(canal) AS canal_nombre, COUNT(*) AS rows, dw.norm_text(concat(' ', lower(canal), ' ')) AS otra_vez
        FROM dw.fact_aduana_item GROUP BY canal""")


def _report(fn):
    return lambda spark, sf_dir: to_output(fn(_wh(spark, sf_dir)))


QUERIES = {
    "staging_typed": staging_typed,
    "staging_country": staging_country,
    "staging_rejects": staging_rejects_q,
    "staging_typed_rejects": staging_typed_rejects,
    "staging_legacy_qty": staging_legacy_qty,
    **{name: _dim(name) for name in dims_mod.NAMES},
    "dim_fecha_legacy_quarter": dim_fecha_legacy_quarter,
    "fact_items": fact_items,
    "load_audit": load_audit,
    **{name: _mart(name) for name in marts_mod.KEY_GRAINS},
    **{f"{name}_legacy": _legacy_mart(name) for name in ("agg_fob_pais_anual", "agg_fob_ncm_anual")},
    **{name: _view(fn) for name, fn in views.VIEWS.items()},
    **{f"sql_{name}": _catalog_view(name) for name in view_sql.VIEW_SQL},
    "sql_normalizar_pais": sql_normalizar_pais,
    "sql_decode_canal": sql_decode_canal,
    "distinct_countries": _report(marts_mod.distinct_countries),
    "r1_yoy": _report(reports.r1_yoy),
    "r2_top_countries": _report(reports.r2_top_countries),
    "r3_trend": _report(reports.r3_trend),
    "r4_offices": _report(reports.r4_offices),
    "r5_top_positions": _report(reports.r5_top_positions),
    "r6_channels": _report(reports.r6_channels),
    "r7_red_share": _report(reports.r7_red_share),
    "sample_top_countries": _report(reports.sample_top_countries),
    "sample_daily_fob": _report(reports.sample_daily_fob),
    **{name: _report(fn) for name, fn in charts.CHARTS.items()},
    **{name: _report(fn) for name, fn in quality.CHECKS.items()},
    "bronze_roundtrip": lambda spark, sf_dir: exports.bronze_roundtrip(_wh(spark, sf_dir), _wh(spark, sf_dir).bronze),
    "bronze_split": lambda spark, sf_dir: exports.bronze_split(_wh(spark, sf_dir), _wh(spark, sf_dir).bronze),
    "export_layers": lambda spark, sf_dir: exports.export_layers_q(_wh(spark, sf_dir)),
    "export_flat": lambda spark, sf_dir: exports.export_flat_q(_wh(spark, sf_dir)),
}

ORACLE = oracle.all_queries()
