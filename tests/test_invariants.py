"""Warehouse invariants on the sf0.001 fixture load."""

from pyspark.sql import functions as F

from tradewh.plans import views
from tradewh.plans.warehouse import to_output


def test_fact_preserves_staging_rows(wh):
    assert wh.fact.count() == wh.staging.count() > 0


def test_fact_ids_dense(wh):
    r = wh.fact.agg(F.min("id_fact_key"), F.max("id_fact_key"), F.countDistinct("id_fact_key")).first()
    n = wh.fact.count()
    assert tuple(r) == (1, n, n)


def test_shares_sum_to_100(wh):
    m = wh.mart("agg_fob_pais_anual")
    sums = m.groupBy("anio", "tipo_operacion").agg(F.sum("pct_fob_sobre_total").alias("s")).collect()
    assert sums and all(abs(r.s - 100.0) < 0.01 * 50 for r in sums)
    c = wh.mart("agg_canal_mensual")
    sums = c.groupBy("anio", "mes_numero", "tipo_operacion", "nombre_aduana").agg(F.sum("pct_canal").alias("s"))
    assert sums.where(F.abs(F.col("s") - 100.0) > 0.05).count() == 0


def test_ytd_last_month_is_year_total(wh):
    v = views.v_tendencia_mensual(wh)
    last = v.groupBy("anio", "tipo_operacion").agg(F.max("mes_numero").alias("mes_numero"))
    ytd = v.join(last, ["anio", "tipo_operacion", "mes_numero"]).select("anio", "tipo_operacion", "fob_ytd")
    tot = v.groupBy("anio", "tipo_operacion").agg(F.sum("fob_total").alias("t"))
    assert ytd.join(tot, ["anio", "tipo_operacion"]).where(F.col("fob_ytd") != F.col("t")).count() == 0


def test_view_equals_mart_on_shared_columns(wh):
    cols = ["anio", "mes_numero", "tipo_operacion", "cantidad_items", "fob_total", "fob_promedio"]
    a = to_output(views.v_fob_por_operacion(wh)).select(*cols)
    b = to_output(wh.mart("agg_fob_mensual_operacion")).select(*cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    cols = ["anio", "mes_numero", "nombre_aduana", "canal_codigo", "cantidad_despachos", "pct_canal"]
    a = to_output(views.v_canal_control(wh)).select(*cols)
    b = to_output(wh.mart("agg_canal_mensual")).select(*cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_mart_counts_equal_the_views_themselves(wh):
    from tradewh.plans.quality import mart_counts

    rows = {r["name"]: r["rows"] for r in mart_counts(wh).collect()}
    assert {n: fn(wh).count() for n, fn in views.VIEWS.items()} == {n: rows[n] for n in views.VIEWS}


def test_views_follow_the_fact(spark, wh):
    """Registered views read the live fact, not a mart written before."""
    assert set(views.register_views(spark, wh)) == set(views.VIEWS)
    for name, fn in views.VIEWS.items():
        assert spark.table(name).columns == fn(wh).columns

    class Reloaded(type(wh)):
        @property
        def fact_by_year(self):
            return super().fact_by_year.where("canal = 'V'")

    half = Reloaded(spark, wh.root)
    assert views.v_canal_control(half).select("canal_codigo").distinct().collect()[0][0] == "V"
    items = views.v_fob_por_operacion(half).agg(F.sum("cantidad_items")).first()[0]
    assert 0 < items < views.v_fob_por_operacion(wh).agg(F.sum("cantidad_items")).first()[0]


def test_named_tables(spark, wh):
    from tradewh.plans.namespaces import register_tables

    names = register_tables(spark, wh)
    assert "dw.fact_aduana_item" in names and "analytic.agg_canal_mensual" in names
    assert spark.table("dw.fact_aduana_item").count() == wh.fact.count() > 0
    assert spark.sql("SELECT count(*) FROM analytic.agg_canal_mensual").first()[0] == wh.mart("agg_canal_mensual").count()


def test_tables_have_their_declared_schemas(wh):
    from tradewh import schemas

    assert wh.staging.schema == schemas.STAGING_SCHEMA
    assert wh.fact.schema == schemas.FACT_SCHEMA
    assert {n: d.schema for n, d in wh.dims.items()} == schemas.DIM_SCHEMAS


def test_a_failed_load_leaves_the_last_snapshot(spark, wh, tmp_path):
    import pytest

    from tradewh.plans.warehouse import FIXTURE_CUTOFF, Warehouse

    root = str(tmp_path / "wh")
    first = Warehouse.load(spark, wh.bronze.limit(300), root, cutoff=FIXTURE_CUTOFF)
    with pytest.raises(Exception):
        Warehouse.load(spark, wh.bronze.limit(300).withColumn("ITEM", F.raise_error(F.lit("boom")).cast("string")), root, cutoff=FIXTURE_CUTOFF)
    assert Warehouse.open(spark, root).root == first.root
    second = Warehouse.load(spark, wh.bronze.limit(500), root, cutoff=FIXTURE_CUTOFF, legacy=True)
    assert Warehouse.open(spark, root).root == second.root != first.root
    assert Warehouse.open(spark, root).fact.count() == second.fact.count() and first.fact.count() > 0
    quarters = {r[0] for r in second.dim("dim_fecha").select("trimestre").distinct().collect()}
    assert 5 in quarters


def test_no_local_folder_off_local_masters():
    import pytest

    from tradewh.session import local_folder

    assert local_folder("local[2]") and local_folder("local")
    for master in ("yarn", "spark://host:7077", "k8s://https://host", "local-cluster[2,1,1024]", ""):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            local_folder(master)


def test_union_halves_have_equal_totals_without_orphans(wh):
    v = views.v_top_paises(wh)
    t = {r.tipo_pais: r.n for r in v.groupBy("tipo_pais").agg(F.sum("cantidad_items").alias("n")).collect()}
    nulls = wh.fact.where("pais_destino_key IS NULL AND operacion_key IS NOT NULL").count()
    assert t["ORIGEN"] - t["DESTINO"] == nulls


def test_dims_hold_each_natural_key_once_in_order(wh):
    from tradewh.plans import dims

    built = dims.build_dims(wh.staging)
    for name, src, key, natural in dims.NUMBERED:
        rows = built[name].orderBy(key).select(key, natural).collect()
        want = sorted(r[0] for r in wh.staging.select(src).dropna().distinct().collect())
        assert [r[0] for r in rows] == list(range(1, len(want) + 1)) and [r[1] for r in rows] == want


def test_marts_equal_their_own_star_join(wh):
    """The rolled-up and looked-up marts against a GROUP BY over the star."""
    from tradewh.functions.numeric import sum_money
    from tradewh.plans import marts
    from tradewh.plans.star import star

    dims = {"agg_fob_mensual_operacion": [], "agg_fob_pais_anual": ["dim_pais_origen", "dim_pais_destino"], "agg_fob_aduana_mensual": ["dim_aduana"],
            "agg_fob_ncm_anual": ["dim_producto"]}
    for name, more in dims.items():
        own = star(wh, ["dim_fecha", "dim_operacion", *more]).groupBy(*marts.GRAIN_KEYS[name]).agg(
            F.count(F.lit(1)).alias("cantidad_items"), sum_money("fob_dolar").alias("fob_total"))
        mart = wh.mart(name).select(own.columns)
        assert mart.exceptAll(own).count() == 0 and own.exceptAll(mart).count() == 0 and own.count() > 0, name
