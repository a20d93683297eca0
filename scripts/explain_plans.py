"""Print ``explain("formatted")`` of the key plans into PLANS.md (for review).

Usage: python scripts/explain_plans.py [sf_dir]
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tradewh.session import build_session  # noqa: E402


def formatted(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def summary(text: str) -> str:
    ops = re.findall(r"^\(\d+\) (\w[\w ]*)", text, flags=re.M)
    counts = {}
    for o in ops:
        counts[o.strip()] = counts.get(o.strip(), 0) + 1
    return ", ".join(f"{k} x{v}" for k, v in sorted(counts.items()))


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    from tradewh.operators.distinct import id_blocks
    from tradewh.plans import marts, quality, reports, staging, views
    from tradewh.plans.fact import build_fact
    from tradewh.plans.warehouse import STAGING, fixture_warehouse

    wh = fixture_warehouse(spark, sf)
    plans = {
        "staging (L2)": staging.build_staging(wh.bronze, cutoff="1996-01-01"),
        "fact load (L3, ids and lookups)": build_fact(wh.table(STAGING), wh.dims),
        "mart groups M1-M5 (one fact scan, three grouping sets)": marts.mart_groups(wh),
        "Q8 mart and view counts (views counted by their keys)": quality.mart_counts(wh),
        "R2 top countries (latest year, top-k, rank of k rows)": reports.r2_top_countries(wh),
        "R7 red share (fact, one GROUP BY)": reports.r7_red_share(wh),
        "Q6 FK check (one fact scan)": quality.fk_check(wh),
        "V2 origin/destination view (one fact scan)": views.v_top_paises(wh),
        "V1 of one year (one partition of the fact)": views.v_fob_por_operacion(wh).where("anio = 1997"),
        "V1 of the second halves of years (fact pruned dynamically)": views.v_fob_por_operacion(wh).where("semestre = 2"),
        "V3 trend view (distinct countries by bitmaps)": views.v_tendencia_mensual(wh),
        "Q5 id blocks (no exchange of ids)": id_blocks(wh.fact, "id_fact_key"),
    }
    out = ["# Physical plans (explain formatted)", "",
           f"Generated by `scripts/explain_plans.py` on `{sf}` with AQE on; the operator",
           "summary counts nodes of the initial physical plan.", ""]
    for name, df in plans.items():
        text = formatted(df)
        out += [f"## {name}", "", f"Operators: {summary(text)}", "", "```", text.strip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    print("wrote PLANS.md")
