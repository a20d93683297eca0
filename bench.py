"""Benchmark: build the warehouse from the fixture tables and run the reports.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Every step is an action over the whole data (a Parquet write or a collect).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None

    from tradewh.plans import quality, reports, views
    from tradewh.plans.warehouse import Warehouse, FIXTURE_CUTOFF
    from tradewh.session import build_session, ensure_checkpoint_dir
    from tradewh.sources.fixtures import raw_items
    from tradewh.sources.landing import read_bronze, write_bronze

    extra = {"spark.driver.memory": "16g"}
    java_opts = os.environ.get("BENCH_JAVA_OPTS")
    if java_opts:
        extra["spark.driver.extraJavaOptions"] = java_opts
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), extra=extra)
    spark.range(1000).selectExpr("sum(id)").collect()  # JVM / session warm-up, not timed
    # Machine-speed calibration (not part of the value): the container's speed
    # drifts, so record a fixed warm job next to the query times.
    spark.range(200_000_000).selectExpr("sum(id * 2)").collect()
    t_cal = time.perf_counter()
    spark.range(200_000_000).selectExpr("sum(id * 2)").collect()
    calibration = round(time.perf_counter() - t_cal, 3)

    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bench-{uuid.uuid4().hex[:8]}"
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    bronze_path = f"{root}/bronze/aduana_item_raw"
    timed("bronze", lambda: write_bronze(raw_items(spark, sf_dir), bronze_path))
    wh = timed("load", lambda: Warehouse.load(spark, read_bronze(spark, bronze_path), root, cutoff=FIXTURE_CUTOFF))
    timed("marts_all_five_one_scan", wh.materialize_marts)
    for name, fn in [
        ("r1_yoy", reports.r1_yoy), ("r2_top_countries", reports.r2_top_countries),
        ("r3_trend", reports.r3_trend), ("r4_offices", reports.r4_offices),
        ("r5_top_positions", reports.r5_top_positions), ("r6_channels", reports.r6_channels),
        ("r7_red_share", reports.r7_red_share),
        *views.VIEWS.items(),
        ("fact_orphans", quality.fact_orphans), ("fk_check", quality.fk_check), ("pk_check", quality.pk_check),
        ("mart_counts", quality.mart_counts),
    ]:
        if name[0] == "r" and name[1].isdigit():
            timed(name, lambda f=fn: f(wh).collect())  # small report: fetched to the client
        else:
            timed(name, lambda f=fn: f(wh).write.mode("overwrite").format("noop").save())

    # The value adds the same steps in every round; the others are listed only.
    listed = {"v_fob_por_operacion", "v_tendencia_mensual", "v_ranking_aduana", "v_top_ncm", "pk_check", "mart_counts"}
    total = round(sum(t for n, t in times.items() if n not in listed), 3)
    print(json.dumps({
        "metric": "warehouse_load_marts_reports_total",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": cpus,
        "fact_rows": wh.fact.count(),
        "calibration_range_sum_200m_sec": calibration,
        "value_per_calibration": round(total / calibration, 1),
    }))


if __name__ == "__main__":
    main()
