"""Persistent views and SQL functions of the catalog; partition pruning of the views."""

import pytest
from pyspark.sql import functions as F

from tests.test_plans import plan
from tradewh.functions.text import decode_canal, normalize_country, norm_text
from tradewh.plans import namespaces, view_sql, views
from tradewh.plans.warehouse import to_output


@pytest.fixture(scope="module")
def names(spark, wh):
    return namespaces.register_tables(spark, wh)


def test_views_are_found_by_schema_name_in_any_session(spark, wh, names):
    assert {f"analytic.{v}" for v in views.VIEWS} <= set(names) and set(view_sql.VIEW_SQL) == set(views.VIEWS)
    other = spark.newSession()
    for name, fn in views.VIEWS.items():
        mine = other.sql(f"SELECT * FROM analytic.{name}")
        assert mine.columns == fn(wh).columns and [t for _, t in mine.dtypes] == [t for _, t in fn(wh).dtypes]
        rows = lambda df: sorted(map(tuple, to_output(df).collect()), key=repr)
        assert rows(mine) == rows(fn(wh)) != [], name
    assert not other.catalog.listTables("analytic")[0].isTemporary


def test_views_follow_the_registered_tables(spark, wh, names):
    assert spark.sql("SELECT SUM(cantidad_items) FROM analytic.v_fob_por_operacion").first()[0] == \
        views.v_fob_por_operacion(wh).agg(F.sum("cantidad_items")).first()[0]
    again = namespaces.register_tables(spark, wh)
    assert again == names and len(set(names)) == len(names)


def test_sql_functions_equal_their_column_forms(spark, names):
    texts = ["BR - BRASIL", " br - brasil ", "BR -BRASIL", "BRA - X", "a  b   c", " x\t\ty 　", "", None, "XX - ", "XX -  y", "$1 - z", "V", "R", "N", "v"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", F.expr("dw.norm_text(t)"), F.expr("dw.normalizar_pais(t)"), F.expr("dw.normalizar_pais(t, true)"), F.expr("dw.decode_canal(t)"))
    want = df.select("t", norm_text("t"), normalize_country("t"), normalize_country("t", first_only=True), decode_canal("t"))
    assert list(map(tuple, got.collect())) == list(map(tuple, want.collect()))
    assert "PythonUDF" not in plan(got) and "decode_canal" not in plan(got).split("FileScan")[0].replace("decode_canal(t)", "")


def fact_scan(df):
    lines = [ln for ln in plan(df).splitlines() if "FileScan" in ln and "fecha_anio" in ln]
    assert len(lines) == 1
    return lines[0].split("PartitionFilters: [")[1].split("]")[0]


@pytest.mark.parametrize("name", ["v_fob_por_operacion", "v_top_paises", "v_ranking_aduana", "v_top_ncm", "v_canal_control"])
def test_a_year_filter_on_a_view_prunes_the_fact(spark, wh, names, name):
    for df in (views.VIEWS[name](wh), spark.table(f"analytic.{name}")):
        one = df.where("anio = 1997")
        assert "fecha_anio" in fact_scan(one) and "= 1997" in fact_scan(one)
        rows = lambda d: sorted(map(tuple, to_output(d).collect()), key=repr)
        assert rows(one) == [r for r in rows(df) if r[df.columns.index("anio")] == 1997] != []


def test_other_date_filters_prune_dynamically(spark, wh, names):
    """A filter on the month reaches the fact as the years that have such months."""
    late = spark.sql("""SELECT COUNT(*) FROM dw.fact_aduana_item f JOIN dw.dim_fecha df ON f.fecha_key = df.fecha_key AND f.fecha_anio = df.anio
                        WHERE df.fecha_oficializacion >= DATE'1998-06-01'""")
    assert "dynamicpruning" in plan(late)
    months = views.v_fob_por_operacion(wh).where("semestre = 2")
    assert "dynamicpruning" in fact_scan(months)


def test_read_years_only(spark, wh, names):
    """Files of other years aren't opened."""
    one = wh.fact_by_year.where("fecha_anio = 1997")
    files = {f for f in one.select(F.input_file_name().alias("f")).distinct().toPandas()["f"]}
    assert files and all("fecha_anio=1997" in f for f in files)
