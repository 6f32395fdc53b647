"""Command-line entry: one pipeline run, suitable for spark-submit.

    spark-submit run_ledgerline.py run --landing <dir> --warehouse <dir>
    python -m ledgerline run --landing <dir> --warehouse <dir> [--master local[8]]
    python -m ledgerline check --warehouse <dir>
    python -m ledgerline query --warehouse <dir> --name q4_country_share [--out <dir>]
    python -m ledgerline derive --sf-dir <driver tables> --landing <dir>

``run`` reads the two feeds' CSV files from ``<landing>/ecommerce_data`` and
``<landing>/online_retail_ii``, builds every layer under ``<warehouse>``,
runs the data-quality checks and key gates, and prints the run report as
JSON. ``check`` re-runs the declared checks on the newest published run and
exits non-zero when any check flags rows. ``derive`` lands the feeds derived from the TPC-H-style driver tables.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from ledgerline.operators import quality
from ledgerline.plans import business
from ledgerline.plans.pipeline import open_warehouse, run
from ledgerline.plans.present import as_output
from ledgerline.session import SESSION_DEFAULTS, build_session, ensure_checkpoint_dir
from ledgerline.sources.derived_feed import derived_feeds
from ledgerline.plans.catalog import retain_runs
from ledgerline.sources.retention import sweep_scratch
from ledgerline.sources.feeds import FEEDS
from ledgerline.sources.landing import land_feeds, read_landed


BUSINESS = {name: getattr(business, name) for name in business.QUESTIONS}
GROWS = {"q6b_description_variants"}  # one row per product: written, not shown whole


def _session(master: str | None) -> SparkSession:
    if master:
        return build_session(master=master, shuffle_partitions=None)
    # Under spark-submit the cluster settings win; only fill in our defaults.
    spark = SparkSession.builder.getOrCreate()
    for key, value in SESSION_DEFAULTS.items():
        # launch-time settings are the cluster's
        if spark.conf.isModifiable(key) and spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="ledgerline")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="build all layers from landed CSV feeds")
    r.add_argument("--landing", required=True)
    r.add_argument("--warehouse", required=True)
    r.add_argument("--master")
    r.add_argument("--reload", action="append", default=[], choices=[f.name for f in FEEDS],
                   help="load only this feed anew and take the other's raw rows from the newest published run")
    r.add_argument("--no-gates", action="store_true", help="report key violations without failing")
    c = sub.add_parser("check", help="run the declared data-quality checks on the newest published run")
    c.add_argument("--warehouse", required=True)
    c.add_argument("--master")
    qp = sub.add_parser("query", help="run a business question on the newest published run")
    qp.add_argument("--warehouse", required=True)
    qp.add_argument("--name", required=True, choices=sorted(BUSINESS))
    qp.add_argument("--out", help="write the full result here as CSV instead of showing it")
    qp.add_argument("--rows", type=int, help="show only so many rows (default: all)")
    qp.add_argument("--master")
    k = sub.add_parser("retain", help="remove old runs that no reader has open, and old scratch folders")
    k.add_argument("--warehouse", required=True)
    k.add_argument("--keep", type=int, default=3, help="published runs to keep (default 3)")
    k.add_argument("--hours", type=float, default=48.0, help="age of unpublished runs and scratch to remove (default 48)")
    k.add_argument("--master")
    d = sub.add_parser("derive", help="land feeds derived from the driver tables as CSV")
    d.add_argument("--sf-dir", required=True)
    d.add_argument("--landing", required=True)
    d.add_argument("--master")
    args = p.parse_args(argv)

    spark = _session(args.master)
    if args.cmd == "query":
        result = BUSINESS[args.name](open_warehouse(spark, args.warehouse))
        if args.out:
            # Written by the executors; nothing is gathered on the driver.
            as_output(result).write.mode("overwrite").option("header", True).csv(args.out)
            print(json.dumps({"query": args.name, "out": args.out}))
        else:
            if args.rows is None and args.name in GROWS:
                p.error(f"{args.name} grows with the data: give --out, or --rows for a look at it")
            as_output(result).show(args.rows or max(1, result.count()), truncate=False)
        return
    if args.cmd == "check":
        wh = open_warehouse(spark, args.warehouse)
        rows = [r.asDict() for r in quality.declared_checks(wh.table).collect()]   # one row per check
        failing = [r for r in rows if r["failures"]]
        print(json.dumps({"checks": len(rows), "failing": failing}))
        sys.exit(1 if failing else 0)
    if args.cmd == "retain":
        done = retain_runs(spark, args.warehouse, args.keep, unfinished_hours=args.hours)
        print(json.dumps({"removed": done.removed, "held": done.held, "scratch": sweep_scratch(spark, args.hours)}))
        return
    if args.cmd == "derive":
        print(json.dumps(land_feeds(derived_feeds(spark, args.sf_dir), args.landing)))
        return
    feeds = read_landed(spark, args.landing, args.reload)
    report = run(spark, feeds, args.warehouse, gates=not args.no_gates)
    print(json.dumps({"run_id": report.run_id, "run_dir": report.run_dir,
                      "seconds": report.seconds, "load_counters": report.counters,
                      "row_counts": report.row_counts}))


if __name__ == "__main__":
    main()
