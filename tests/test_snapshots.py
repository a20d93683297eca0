"""Write-once mart sets, retention, range layout and exports."""

import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from tests.test_plans import plan
from tradewh.plans.warehouse import FIXTURE_CUTOFF, Warehouse
from tradewh.sources import folders, sinks


@pytest.fixture()
def root(spark, wh, tmp_path):
    path = str(tmp_path / "wh")
    Warehouse.load(spark, wh.bronze.limit(400), path, cutoff=FIXTURE_CUTOFF)
    return path


def files(df):
    return {f.removeprefix("file://") for f in df.inputFiles()}


def test_reopening_reads_the_marts_that_are_there(spark, root):
    first = Warehouse.open(spark, root)
    mart = first.mart("agg_fob_mensual_operacion")
    rows, written = sorted(map(tuple, mart.collect())), {f: os.stat(f).st_mtime_ns for f in files(mart)}
    again = Warehouse.open(spark, root).mart("agg_fob_mensual_operacion")
    assert files(again) == set(written) and {f: os.stat(f).st_mtime_ns for f in written} == written
    assert sorted(map(tuple, mart.collect())) == rows == sorted(map(tuple, again.collect()))


def test_a_refresh_writes_elsewhere_and_old_handles_stay_readable(spark, root):
    wh = Warehouse.open(spark, root)
    mart = wh.mart("agg_canal_mensual")
    rows = mart.count()
    fresh = Warehouse.open(spark, root).materialize_marts()["agg_canal_mensual"]
    assert not files(fresh) & files(mart) and mart.count() == rows == fresh.count()
    assert files(wh.mart("agg_canal_mensual")) == files(mart)  # this handle keeps its set
    assert files(Warehouse.open(spark, root).mart("agg_canal_mensual")) == files(fresh)


def test_a_failed_refresh_changes_nothing(spark, root, monkeypatch):
    from tradewh.plans import marts

    wh = Warehouse.open(spark, root)
    before = files(wh.mart("agg_fob_ncm_anual"))
    build = marts.build_marts

    def broken(wh_, folder):
        out = build(wh_, folder)
        return out | {"agg_fob_ncm_anual": out["agg_fob_ncm_anual"].withColumn("anio", F.raise_error(F.lit("boom")).cast("int"))}

    monkeypatch.setattr(marts, "build_marts", broken)
    with pytest.raises(Exception, match="boom"):
        wh.materialize_marts()
    assert files(wh.mart("agg_fob_ncm_anual")) == before == files(Warehouse.open(spark, root).mart("agg_fob_ncm_anual"))


def names(spark, root, start="load-"):
    return {n for n in folders.children(spark, root) if n.startswith(start)}


def test_expire_spares_readers_and_running_loads(spark, wh, root, monkeypatch):
    first = Warehouse.open(spark, root)
    first.mart("agg_canal_mensual")
    with monkeypatch.context() as m, pytest.raises(RuntimeError, match="lost"):
        m.setattr("tradewh.plans.dims.build_dims", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        Warehouse.load(spark, wh.bronze.limit(50), root, cutoff=FIXTURE_CUTOFF)
    second = Warehouse.load(spark, wh.bronze.limit(500), root, cutoff=FIXTURE_CUTOFF)
    assert len(names(spark, root)) == 3
    # The failed load may be running, the first was replaced only now.
    assert Warehouse.expire(spark, root, keep=1) == [] and len(names(spark, root)) == 3
    with first.pinned():
        gone = Warehouse.expire(spark, root, keep=1, grace_hours=0)
        assert len(gone) == 1 and first.fact.count() > 0 and first.mart("agg_canal_mensual").count() > 0
    assert Warehouse.expire(spark, root, keep=1, grace_hours=0) == [first.root]
    assert names(spark, root) == {second.root.rsplit("/", 1)[1]}
    assert Warehouse.open(spark, root).root == second.root and second.fact.count() > 0
    assert Warehouse.expire(spark, root, keep=5, grace_hours=0) == []


def test_expire_removes_replaced_mart_sets_and_runs(spark, root):
    wh = Warehouse.open(spark, root)
    old = wh.mart_path("agg_canal_mensual").rsplit("/", 1)[0]
    new = Warehouse.open(spark, root)
    new.materialize_marts()
    os.makedirs(wh.path("export-1234"))
    os.makedirs(wh.path("analytic-unfinished"))
    assert Warehouse.expire(spark, root) == []
    time.sleep(0.01)
    assert Warehouse.expire(spark, root, grace_hours=0) == sorted([old, wh.path("export-1234"), wh.path("analytic-unfinished")])
    assert new.mart("agg_canal_mensual").count() > 0 and new.fact.count() > 0


def test_marts_are_laid_out_in_ranges(spark, wh, tmp_path):
    """Files hold ranges of the leading columns, so a filter opens a few of them."""
    mart = wh.mart("agg_fob_aduana_mensual")
    was = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "24")
        sinks.write_parquet(mart, str(tmp_path / "m"), range_by=["anio", "mes_numero", "tipo_operacion"])
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    table = spark.read.parquet(str(tmp_path / "m")).withColumn("file", F.input_file_name())
    spans = sorted((r["lo"], r["hi"]) for r in table.groupBy("file").agg(
        F.min(F.struct("anio", "mes_numero")).alias("lo"), F.max(F.struct("anio", "mes_numero")).alias("hi")).collect())
    assert len(spans) > 10 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert table.where("anio = 1997").select("file").distinct().count() <= len(spans) / 2
    assert table.drop("file").exceptAll(mart).count() == 0 and table.count() == mart.count()
    # the marts of a warehouse are written so
    assert all(len(glob.glob(f"{wh.mart_path(n).removeprefix('file:')}/part-*")) >= 1 for n in ("agg_canal_mensual",))


def test_exports_count_while_they_write(spark, tmp_path, monkeypatch):
    """Rows come from the writing job: what is exported is computed once."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    tables = {f"t{i}": spark.range(100 + i).mapInArrow(counted, "id long") for i in range(6)}
    tables["bad"] = spark.range(3).select((F.lit(1) / (F.col("id") - F.col("id"))).alias("boom"))
    monkeypatch.setattr(type(spark.read), "parquet", lambda *a: pytest.fail("read back"))
    got = sinks.export_flat(spark, tables, str(tmp_path))
    assert [r[:3] for r in got[:6]] == [("flat", f"t{i}", 100 + i) for i in range(6)] and seen.value == sum(100 + i for i in range(6))
    assert got[6][2] is None and "DIVIDE_BY_ZERO" in got[6][3]


def test_view_counts_read_the_views(wh):
    """Counts come from the fact through the views, by their keys only."""
    from tradewh.plans.quality import mart_counts

    p = plan(mart_counts(wh))
    scans = [ln for ln in p.splitlines() if "FileScan" in ln and "fecha_anio" in ln]
    assert len(scans) == 6 and not any("fob_dolar" in ln or "kilo_neto" in ln for ln in scans)
