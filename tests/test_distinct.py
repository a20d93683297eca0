"""Bitmaps of dense keys: distinct counts that roll up, uniqueness of ids by blocks."""

import random

from pyspark.sql import functions as F

from tests.test_plans import plan
from tradewh.operators.distinct import bitmaps, distinct_of, id_blocks, repeated_ids
from tradewh.plans import marts, quality


def test_distinct_counts_roll_up(spark):
    rng = random.Random(1)
    rows = [(rng.randint(1, 3), rng.randint(1, 4), rng.choice([None, rng.randint(1, 100_000), 7, 32_768, 32_769])) for _ in range(3000)]
    df = spark.createDataFrame(rows + [(9, 1, None)], "a int, b int, v int").repartition(5)
    maps = bitmaps(df, ["a", "b"], "v", F.count(F.lit(1)).alias("n"))
    for keys in (["a", "b"], ["a"], ["b"], []):
        got = distinct_of(maps, keys, "n").collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, df.groupBy(*keys).agg(F.count_distinct("v")).collect())) and got
    assert maps.agg(F.sum("n")).first()[0] == 3001


def test_stored_bitmaps_answer_without_the_fact(wh):
    df = marts.distinct_countries(wh)
    assert "fecha_anio" not in plan(df)
    years = {(r["anio"], r["tipo_operacion"]): r["paises"] for r in df.where("nivel = 'anio'").collect()}
    from tradewh.plans.star import star

    live = star(wh, ["dim_fecha", "dim_operacion"]).groupBy("anio", "tipo_operacion").agg(F.count_distinct("pais_origen_key").alias("n"))
    assert years == {(r["anio"], r["tipo_operacion"]): r["n"] for r in live.collect()} != {}


def test_repeated_ids_are_found_without_a_shuffle_of_ids(spark, wh):
    ids = spark.range(1, 10_001).withColumnRenamed("id", "k")
    assert repeated_ids(ids, "k").first()[0] == 0
    again = spark.createDataFrame([(5,), (5,), (64,), (9_999,), (20_000,), (20_000,)], "k long")
    assert repeated_ids(ids.unionByName(again), "k").first()[0] == 4
    nulls = spark.createDataFrame([(None,), (None,), (3,)], "k long")
    assert repeated_ids(nulls, "k").first()[0] == 1
    p = plan(id_blocks(wh.fact, "id_fact_key"))
    exchanges = [ln for ln in p.splitlines() if "Exchange" in ln]
    assert len(exchanges) == 1 and "id_fact_key" not in exchanges[0] and "partial_bit_or" in p
    blocks = id_blocks(wh.fact, "id_fact_key").agg(F.count("*"), F.sum("rows")).first()
    assert blocks[0] <= blocks[1] / 60


def test_planted_duplicates_are_counted(wh):
    n = wh.fact.count()
    assert [tuple(r) for r in quality.pk_check_planted(wh).collect()] == [("fact_aduana_item", n // 97)]
    assert {r["duplicate_keys"] for r in quality.pk_check(wh).collect()} == {0}
