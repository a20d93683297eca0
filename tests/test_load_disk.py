"""What the load keeps on disk besides its tables."""

from pyspark.sql import functions as F

from tradewh.operators.shuffles import CLEANUP, released_shuffles
from tradewh.plans import warehouse
from tradewh.schemas import RAW_COLUMNS


def _shuffle_files(spark):
    at = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    found = set()
    while at.hasNext():
        name = at.next().getName()
        if name.startswith("shuffle_"):
            found.add(name)
    return found


def _raw(spark, n):
    made = {"DESPACHO CIFRADO": "'d' || id", "OFICIALIZACION": "'2025-0' || (1 + id % 9) || '-01'", "FOB DOLAR": "id + 1 || ',50'",
            "POSICION": "'p' || id % 7", "ADUANA": "'a' || id % 5", "OPERACION": "'o' || id % 2", "CANAL": "'v'", "PAIS ORIGEN": "'x'"}
    return spark.range(0, n, 1, 4).select(*[F.expr(made.get(c, "CAST(NULL AS STRING)")).alias(c) for c in RAW_COLUMNS])


def test_setting_is_put_back(spark):
    before = spark.conf.get(CLEANUP)
    try:
        with released_shuffles(spark), released_shuffles(spark):
            assert spark.conf.get(CLEANUP) == "true"
            raise KeyError
    except KeyError:
        pass
    assert spark.conf.get(CLEANUP) == before


def test_load_and_marts_leave_no_shuffle_files(spark, tmp_path):
    before = _shuffle_files(spark)
    wh = warehouse.Warehouse.load(spark, _raw(spark, 500), str(tmp_path), cutoff="2025-01-01")
    wh.materialize_marts()
    assert not _shuffle_files(spark) - before
    assert wh.fact.count() == 500 and wh.mart("agg_canal_mensual").agg(F.sum("cantidad_despachos")).first()[0] == 500


def test_items_carry_no_country_names_or_offices_through_shuffles(spark):
    """Joins as they run when nothing but the hinted nations is broadcast."""
    from tradewh.sources.fixtures import raw_items

    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = raw_items(spark, "/root/testdata/sf0.001")
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
        assert df.count() == 6000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    depth = lambda ln: len(ln) - len(ln.lstrip(" :+-"))
    for key in ("l_orderkey", "l_partkey"):
        at = next(k for k, ln in enumerate(lines) if f"Exchange hashpartitioning({key}#" in ln)
        below = []
        for ln in lines[at + 1:]:
            if depth(ln) <= depth(lines[at]):
                break
            below.append(ln)
        assert below and not any("n_name" in ln or "s_name" in ln for ln in below), key
