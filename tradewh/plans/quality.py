"""Data-quality checks Q1-Q8 (the reference's printed counts and its declared
but unenforced PK / FK / NOT NULL constraints, as queries).

Each check is one aggregate job over the table it inspects; per-table results
are stacked with ``unionByName`` (a handful of rows).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tradewh.operators.distinct import id_blocks, repeated_ids
from tradewh.plans.marts import GRAINS
from tradewh.plans.warehouse import DIM_NAMES, FACT
from tradewh.schemas import DIM_KEYS

FACT_KEYS = [k for k, _ in DIM_KEYS.values()]


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def dim_counts(wh) -> DataFrame:
    """Q1: rows per dimension."""
    return _stack([
        wh.dim(n).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows")
        for n in DIM_NAMES
    ])


def fact_orphans(wh) -> DataFrame:
    """Q2: fact rows with a NULL key, for all seven keys, in one pass."""
    counts = wh.fact.agg(*[F.count_if(F.col(k).isNull()).alias(k) for k in FACT_KEYS])
    pairs = ", ".join(f"'{k}', `{k}`" for k in FACT_KEYS)
    return counts.selectExpr(f"stack({len(FACT_KEYS)}, {pairs}) AS (key_column, null_rows)")


def pk_check(wh, fact: DataFrame | None = None) -> DataFrame:
    """Q5: key values that occur more than once, per dimension and for the fact.

    Dimensions by a GROUP BY on the key. The fact's dense ids by blocks of 64, of
    which partial ones are made in the scan tasks; ids are never shuffled.
    """
    frames = [wh.dim(name).groupBy(key).count().where(F.col("count") > 1).agg(F.count(F.lit(1)).alias("duplicate_keys"))
              .select(F.lit(name).alias("table_name"), "duplicate_keys") for name, (key, _) in DIM_KEYS.items()]
    repeated = repeated_ids(wh.fact if fact is None else fact, "id_fact_key")
    return _stack([*frames, repeated.select(F.lit(FACT).alias("table_name"), "duplicate_keys")])


def pk_check_planted(wh) -> DataFrame:
    """Q5 over a fact in which every 97th id occurs twice and every 970th three times."""
    f = wh.fact.select("id_fact_key")
    again = f.where("id_fact_key % 97 = 0").unionByName(f.where("id_fact_key % 970 = 0"))
    return pk_check(wh, f.unionByName(again)).where(F.col("table_name") == FACT)


def fk_check(wh) -> DataFrame:
    """Q6: fact rows whose non-NULL key is missing from its dimension.

    One scan of the fact for all seven keys: each dimension's key set is
    LEFT-joined with a match marker; one aggregate counts the unmatched
    non-NULL keys.
    """
    f = wh.fact.select(*FACT_KEYS)
    for name, (key, _) in DIM_KEYS.items():
        keys = wh.dim(name).select(F.col(key).alias(f"_m_{key}"), F.lit(True).alias(f"_hit_{key}"))
        f = f.join(keys, F.col(key) == F.col(f"_m_{key}"), "left")
    counts = f.agg(*[
        F.count_if(F.col(key).isNotNull() & F.col(f"_hit_{key}").isNull()).alias(name)
        for name, (key, _) in DIM_KEYS.items()
    ])
    pairs = ", ".join(f"'{FACT}.{key} -> {name}', `{name}`" for name, (key, _) in DIM_KEYS.items())
    return counts.selectExpr(f"stack({len(DIM_KEYS)}, {pairs}) AS (fk, orphan_rows)")


def not_null_check(wh) -> DataFrame:
    """Q7: NULLs in the NOT NULL columns of the date dimension."""
    d = wh.dim("dim_fecha")
    counts = d.agg(F.count_if(F.col("fecha_oficializacion").isNull()).alias("a"),
                   F.count_if(F.col("anio").isNull()).alias("b"))
    return counts.selectExpr(
        "stack(2, 'dim_fecha.fecha_oficializacion', a, 'dim_fecha.anio', b) AS (column_name, null_rows)")


def channel_totals_view(wh) -> DataFrame:
    """Q3: item counts per channel over the channel view."""
    from tradewh.plans.views import v_canal_control

    return v_canal_control(wh).groupBy("canal_codigo", "canal_nombre").agg(
        F.sum("cantidad_despachos").alias("total"))


def channel_totals_mart(wh) -> DataFrame:
    """Q4: item counts and FOB (millions, 1 dp) per channel over the channel mart."""
    from tradewh.functions.numeric import round_half_away, to_millions

    return wh.mart("agg_canal_mensual").groupBy("canal_codigo", "canal_nombre").agg(
        F.sum("cantidad_despachos").alias("total_despachos"),
        round_half_away(to_millions(F.sum("fob_total")), 1).alias("fob_millones"),
    )


def mart_counts(wh) -> DataFrame:
    """Q8: rows per mart (with its grain) and per view.

    Views are counted themselves, so a wrong view shows; of a view nothing but its
    keys is left to compute (sums, ranks and shares don't change the row count).
    """
    from tradewh.plans.views import VIEWS

    frames = [(n, wh.mart(n), g) for n, g in GRAINS.items()] + [(n, fn(wh), "view") for n, fn in VIEWS.items()]
    return _stack([df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("name"), "rows", F.lit(g).alias("grain"))
                   for n, df, g in frames])


def fact_id_density(wh) -> DataFrame:
    """The fact's ids are 1..n: rows, distinct ids, smallest and largest id."""
    return id_blocks(wh.fact, "id_fact_key").agg(
        F.sum("rows").alias("rows"), F.sum(F.bit_count("bits")).cast("long").alias("distinct_ids"),
        F.min("least").cast("long").alias("min_id"), F.max("most").cast("long").alias("max_id"))


CHECKS = {
    "dim_counts": dim_counts,
    "fact_orphans": fact_orphans,
    "pk_check": pk_check,
    "pk_check_planted": pk_check_planted,
    "fk_check": fk_check,
    "not_null_check": not_null_check,
    "channel_totals_view": channel_totals_view,
    "channel_totals_mart": channel_totals_mart,
    "mart_counts": mart_counts,
    "fact_id_density": fact_id_density,
}
