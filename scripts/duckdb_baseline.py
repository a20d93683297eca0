"""Single-node reference timings: the DuckDB oracle statements on the same tables.

Each oracle statement recomputes the whole chain from the raw fixture tables
(6-way join, clean-up, staging, keys, aggregation), so these are end-to-end
times per query, in-process, all cores. Usage: python scripts/duckdb_baseline.py [sf_dir]
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.compare import duck  # noqa: E402
from tradewh import oracle  # noqa: E402

NAMES = ["staging_typed", "fact_items", "agg_fob_mensual_operacion", "agg_fob_pais_anual",
         "agg_fob_aduana_mensual", "agg_fob_ncm_anual", "agg_canal_mensual", "r1_yoy", "r2_top_countries",
         "r3_trend", "r4_offices", "r5_top_positions", "r6_channels", "r7_red_share", "v_top_paises",
         "v_canal_control", "fact_orphans", "fk_check"]

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    con = duck(sf_dir)
    qs = oracle.all_queries()
    out = {}
    for n in NAMES:
        t = time.perf_counter()
        con.execute(f"SELECT count(*) FROM ({qs[n]})").fetchall()
        out[n] = round(time.perf_counter() - t, 3)
    print(json.dumps({"engine": f"duckdb {__import__('duckdb').__version__}", "sf_dir": sf_dir, "sec": out,
                      "total": round(sum(out.values()), 3)}))
