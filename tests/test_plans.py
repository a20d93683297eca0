"""Physical-plan checks on the builders that run: join strategies, fact scans,
partial aggregation, top-k, pruned scans, file layout."""

import glob
import os

import pytest

from pyspark.sql import functions as F

from tradewh.operators.keys import ids_from_tags
from tradewh.plans import marts, reports, views
from tradewh.plans.fact import ROW_TAG, build_fact
from tradewh.plans.warehouse import FACT, STAGING


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def fact_scans(df, wh):
    """Scans of the fact in the plan before execution."""
    return plan(df).count(f"{wh.path(FACT)}]") or sum("FileScan" in ln and FACT in ln for ln in plan(df).splitlines())


def test_one_fact_scan_and_three_sets_for_all_marts(wh):
    df = marts.mart_groups(wh)
    p = plan(df)
    assert sum("FileScan" in ln and "fob_dolar" in ln for ln in p.splitlines()) == 1
    assert p.count("Expand [") == 1 and len(marts.SETS) == 3
    # map-side partial aggregation, one hash exchange, final aggregation
    assert "partial_sum" in p and p.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" not in p


def test_country_view_scans_the_fact_once(wh):
    p = plan(views.v_top_paises(wh))
    assert sum("FileScan" in ln and "fob_dolar" in ln for ln in p.splitlines()) == 1
    assert p.count("Generate ") == 1


def test_fact_load_looks_each_dimension_up_once(wh):
    p = plan(build_fact(wh.table(STAGING), wh.dims))
    assert sum("FileScan" in ln and "pais_origen_desc" in ln for ln in p.splitlines()) == 1
    # six lookups and the offsets of the ids
    assert p.count("BroadcastHashJoin") + p.count("SortMergeJoin") == 7


def test_ids_of_the_fact_need_no_shuffle_of_staging(wh):
    """The offsets' size is known when the join is planned: they are broadcast like the dimensions."""
    p = plan(build_fact(wh.table(STAGING), wh.dims))
    assert p.count("BroadcastHashJoin") == 7 and "Exchange hashpartitioning" not in p


def test_items_meet_customers_through_their_orders(spark):
    """Customers are joined to the orders, not to the far more items."""
    from tradewh.sources.fixtures import raw_items

    lines = raw_items(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda ln: len(ln) - len(ln.lstrip(" :+-"))
    at = next(k for k, ln in enumerate(lines) if "Join Inner" in ln and "o_custkey" in ln)
    below = []
    for ln in lines[at + 1:]:
        if depth(ln) <= depth(lines[at]):
            break
        below.append(ln)
    assert any("c_custkey" in ln for ln in below) and not any("l_orderkey" in ln for ln in below)


def test_fact_keeps_every_row_when_lookups_shuffle(spark, wh):
    """Joins as they run past any broadcast limit, default adaptive settings."""
    was = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        for advisory in ("64m", "200k"):
            spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", advisory)
            f = build_fact(wh.table(STAGING), wh.dims)
            assert "BroadcastHashJoin" not in plan(f)
            n = wh.staging.count()
            assert tuple(f.agg(F.count("*"), F.min("id_fact_key"), F.max("id_fact_key"), F.countDistinct("id_fact_key")).first()) == (n, 1, n, n)
            keys = [c for c in f.columns if c.endswith("_key") and c != "id_fact_key"]
            assert f.select(*keys, "fob_dolar").exceptAll(wh.fact.select(*keys, "fob_dolar")).count() == 0
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
        for k in ("spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.advisoryPartitionSizeInBytes"):
            spark.conf.unset(k)


def test_a_missing_offset_is_an_error(spark, tmp_path):
    """Offsets that lack a partition of the tagged table stop the load; rows aren't lost."""
    from tradewh.operators.keys import partition_offsets

    spark.range(0, 100, 1, 4).select(F.monotonically_increasing_id().alias(ROW_TAG), "id").write.parquet(str(tmp_path / "t"))
    tagged = spark.read.parquet(str(tmp_path / "t"))
    offsets = partition_offsets(tagged, ROW_TAG)
    assert offsets.count() == 4
    assert sorted(r["k"] for r in ids_from_tags(tagged, ROW_TAG, "k", offsets=offsets).collect()) == list(range(1, 101))
    lost = ids_from_tags(tagged, ROW_TAG, "k", offsets=offsets.where("_tw_part <> 2"))
    with pytest.raises(Exception, match="has no offset"):
        lost.collect()


def test_fact_files_are_bounded_by_year_not_by_task(wh):
    files = glob.glob(f"{wh.path(FACT).removeprefix('file:')}/*/part-*")
    years = {os.path.dirname(f) for f in files}
    assert len(years) > 1 and len(files) == len(years)


def test_top_countries_is_take_ordered(wh):
    p = plan(reports.sample_top_countries(wh))
    assert "TakeOrderedAndProject" in p


def test_scan_is_pruned(wh):
    df = wh.fact.select("fecha_key", "fob_dolar").where("fob_dolar > 100")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(fob_dolar), GreaterThan(fob_dolar" in p
    assert "ReadSchema: struct<fecha_key:int,fob_dolar:decimal(18,2)>" in p


def test_spread_only_when_under_split(spark):
    from tradewh.operators.parallelism import spread

    one = spark.range(0, 1000, 1, 1)
    assert spread(one, 4).rdd.getNumPartitions() == 4
    many = spark.range(0, 1000, 1, 6)
    assert spread(many, 4).rdd.getNumPartitions() == 6


def test_preview_is_bounded(wh):
    from tradewh.plans.present import preview
    from tradewh.plans import reports

    p = preview(reports.r4_offices(wh), 5)
    assert len(p["rows"]) == 5 and p["truncated"] and not p["empty"]


def test_latest_year_report_prunes_fact_partitions(wh):
    p = plan(reports.r7_red_share(wh))
    pruned = [ln for ln in p.splitlines()
              if "PartitionFilters: [" in ln and "fecha_anio" in ln.split("PartitionFilters: [")[1]]
    assert pruned, "fact scan is not restricted by its year partition"
