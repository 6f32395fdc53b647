"""Print the physical plans of every pipeline stage over a published run.

    python tools/show_plans.py <warehouse>

Plans are shown for the staging build, the dimensions, the facts, the
mart, the data-quality checks and the business questions, each read from
the run's own tables exactly as the pipeline builds them. These are the
physical plans before adaptive execution: exchanges, partial/final
aggregates, window limits, explicit (count-checked) broadcasts and pruned
scans are visible; AQE may still coalesce partitions or split skew at run
time.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.operators import mart, quality  # noqa: E402
from ledgerline.plans import business  # noqa: E402
from ledgerline.plans.pipeline import materialized, open_warehouse  # noqa: E402
from ledgerline.session import build_session  # noqa: E402
from ledgerline.sources.feeds import FEEDS  # noqa: E402
from ledgerline.sources.runs import latest_run_dir  # noqa: E402


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def main() -> None:
    warehouse = sys.argv[1]
    spark = build_session(shuffle_partitions=16)
    root = latest_run_dir(spark, warehouse)
    wh = open_warehouse(spark, warehouse)
    raw_only = materialized(spark, root, [f"raw.{f.name}" for f in FEEDS])
    stages = {
        "staging.stg_transactions_unified": raw_only.unified,
        "marts.dim_producto": materialized(spark, root, ["staging.stg_transactions_unified"]).dim_producto,
        "marts.fact_ventas": materialized(spark, root, ["staging.stg_transactions_unified"]).fact_ventas,
        "marts.mart_revenue_producto": mart.mart_revenue_producto(
            wh.fact_ventas, wh.fact_devoluciones, wh.dim_producto, wh.dim_tiempo, wh.dim_pais,
            dim_rows=wh.dim_rows),
        "quality.unique": quality.unique(wh.table),
        "quality.relationships": quality.relationships(wh.table),
        "q4_country_share": business.q4_country_share(wh),
        "q5_guest_vs_identified": business.q5_guest_vs_identified(wh),
        "q3a_top_net_revenue": business.q3a_top_net_revenue(wh),
    }
    print(f"dimension row counts used for broadcast decisions: {wh.dim_rows}\n")
    for name, df in stages.items():
        print(f"## {name}\n\n```")
        print("\n".join(line[:170] for line in plan_text(df).splitlines()))
        print("```\n")


if __name__ == "__main__":
    main()
