"""End-to-end pipeline run: feeds -> raw (+ quarantine) -> staging -> marts.

Each layer is written to Parquet and read back by the next one, which cuts
the lineage at every border (a lost executor recomputes one layer, not the
whole chain) and gives the planner file statistics for the next step. The
run ends with the data-quality checks and the primary/foreign-key gates;
only then is it published (see ``sources/runs.py``).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import SparkContext
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import ingest, mart, quality
from ledgerline.plans.warehouse import MART_TABLES, Warehouse
from ledgerline.sources.feeds import FEEDS, FeedSpec
from ledgerline.sources.manifest import write_manifest
from ledgerline.sources.retention import LEASE_HOURS, lease_run
from ledgerline.sources.runs import latest_run_dir, mark_complete, new_run_id, run_dir
from ledgerline.sources.sinks import (
    read_split,
    read_table,
    setting,
    shuffles_dropped,
    table_path,
    write_rejects,
    write_split,
    write_table,
)

DIMENSIONS = ("dim_producto", "dim_cliente", "dim_tiempo", "dim_pais")
FACTS = ("fact_ventas", "fact_devoluciones")
MART_READS = ("dim_producto", "dim_tiempo", "dim_pais", *FACTS)


@dataclass
class RunReport:
    run_id: str = ""
    run_dir: str = ""
    seconds: dict[str, float] = field(default_factory=dict)
    counters: list[tuple] = field(default_factory=list)
    row_counts: dict[str, int] = field(default_factory=dict)


class _Timer:
    def __init__(self, report: RunReport, name: str):
        self.report, self.name = report, name

    def __enter__(self):
        # Jobs of this step carry its name in the event log and UI history.
        SparkContext.getOrCreate().setJobDescription(f"ledgerline {self.name}")
        self.t = time.perf_counter()

    def __exit__(self, *exc):
        self.report.seconds[self.name] = round(time.perf_counter() - self.t, 3)
        SparkContext.getOrCreate().setJobDescription(None)


def concurrently(label: str, tasks: dict[str, Callable[[], object]]) -> dict[str, object]:
    """Run independent Spark jobs from driver threads so that one job's
    tail of straggling tasks does not leave the cluster idle; the scheduler
    interleaves their tasks. The first failure is raised."""
    def wrapped(name: str, fn: Callable[[], object]):
        def call():
            SparkContext.getOrCreate().setJobDescription(f"ledgerline {label} {name}")
            return fn()
        return call
    with ThreadPoolExecutor(max_workers=max(1, len(tasks))) as pool:
        futures = {name: pool.submit(wrapped(name, fn)) for name, fn in tasks.items()}
        return {name: f.result() for name, f in futures.items()}


def load_feed(spark: SparkSession, feed: DataFrame, root: str, spec: FeedSpec) -> tuple[str, int, int]:
    """Quarantine split and raw load of one feed.

    The load counters are observed metrics of the raw write itself (one
    accumulator-style aggregate per task, merged on the driver), so they
    cost no extra pass over the feed. The feed is read once: accepted and
    rejected rows go to two folders of one write, and the reject records are
    made from the rejected rows as written.
    """
    flagged = ingest.flag_rejects(ingest.feed_cells(feed, spec), spec)
    counters = Observation(f"load_{spec.name}")
    rej = F.col("is_rejected")
    observed = flagged.observe(counters, F.count_if(~rej).alias("loaded"),
                               F.count_if(rej).alias("rejected"))
    path = table_path(root, f"raw.{spec.name}")
    write_split(ingest.split_rows(observed, spec).withColumn("_loaded_at", F.current_timestamp()), path)
    rejects = ingest.reject_records(read_split(spark, path, spec), spec)
    write_rejects(rejects.withColumn("rejected_at", F.current_timestamp()), root, spec.name)
    got = counters.get
    return (spec.name, int(got["loaded"]), int(got["rejected"]))


def load_raw(spark: SparkSession, feeds: dict[str, DataFrame], root: str, report: RunReport) -> None:
    with _Timer(report, "raw.load"), shuffles_dropped(spark):
        # The feeds are independent: load them side by side.
        given = [spec for spec in FEEDS if spec.name in feeds]
        done = concurrently("raw", {spec.name: (lambda spec=spec: load_feed(spark, feeds[spec.name], root, spec)) for spec in given})
    report.counters.extend(done[spec.name] for spec in given)


def row_counts(spark: SparkSession, root: str, names) -> dict[str, int]:
    """Row counts of several written tables in one job (Parquet footers;
    one row per table reaches the driver)."""
    parts = [read_table(spark, root, n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("t"), "n")
             for n in names]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return {r.t: r.n for r in union.collect()}


def materialized(spark: SparkSession, root: str, names, dim_rows: dict[str, int] | None = None,
                 feeds: dict[str, DataFrame] | None = None) -> Warehouse:
    return Warehouse(spark, feeds=feeds, tables={n: read_table(spark, root, n) for n in names}, dim_rows=dim_rows)


def write_counted(wh: Warehouse, name: str, root: str) -> int:
    """Write a mart table; its row count is an observed metric of the write."""
    rows = Observation(f"rows_{name}")
    write_table(getattr(wh, name).observe(rows, F.count(F.lit(1)).alias("n")), root, f"marts.{name}")
    return int(rows.get["n"])


def write_mart(wh: Warehouse, root: str) -> None:
    with setting(wh.spark, mart.CO_PARTITION_CONF, "false"):
        write_table(wh.mart_revenue_producto, root, "marts.mart_revenue_producto")


class LayersOnDemand(Warehouse):
    """Each layer is built by the pipeline's own step and written below
    ``root`` when it is first read, after the layers that it follows; layers
    that nothing reads are not built. ``feed`` gives a feed's frame."""

    def __init__(self, spark: SparkSession, feed: Callable[[FeedSpec], DataFrame], root: str):
        super().__init__(spark)
        self._feed, self._root = feed, root

    def flagged(self, spec: FeedSpec) -> DataFrame:
        self._feeds[spec.name] = self._feed(spec)
        return super().flagged(spec)

    def _given(self, name: str) -> DataFrame:
        if name not in self._tables:
            with shuffles_dropped(self.spark):
                self._build(name)
        return self._tables[name]

    def _load(self, *specs: FeedSpec) -> None:
        left = [s for s in specs if f"raw.{s.name}" not in self._tables]
        feeds = {s.name: self._feed(s) for s in left}
        concurrently("raw", {s.name: (lambda s=s: load_feed(self.spark, feeds[s.name], self._root, s)) for s in left})
        self._written(*[f"raw.{s.name}" for s in left])

    def _written(self, *names: str) -> None:
        self._tables.update({n: read_table(self.spark, self._root, n) for n in names})

    def _marts(self, *names: str) -> None:
        left = [n for n in names if f"marts.{n}" not in self._tables]
        wh = Warehouse(self.spark, tables={"staging.stg_transactions_unified": self.unified})
        counts = concurrently("marts", {n: (lambda n=n: write_counted(wh, n, self._root)) for n in left})
        self.dim_rows.update({n: rows for n, rows in counts.items() if n in DIMENSIONS})
        self._written(*[f"marts.{n}" for n in left])

    def _build(self, name: str) -> None:
        layer, _, table = name.partition(".")
        if layer == "raw" and name != "raw.rejected_records":
            self._load(next(s for s in FEEDS if s.name == table))
        elif layer == "raw":
            self._load(*FEEDS)
            self._written(name)
        elif layer == "staging":
            self._load(*FEEDS)
            wh = Warehouse(self.spark, tables={f"raw.{s.name}": self._given(f"raw.{s.name}") for s in FEEDS})
            write_table(wh.unified, self._root, name)
            self._written(name)
        elif table == "mart_revenue_producto":
            self._marts(*MART_READS)
            wh = Warehouse(self.spark, tables={f"marts.{n}": self._given(f"marts.{n}") for n in MART_READS}, dim_rows=self.dim_rows)
            write_mart(wh, self._root)
            self._written(name)
        else:
            self._marts(table)


def run(spark: SparkSession, feeds: dict[str, DataFrame], warehouse: str, *, gates: bool = True,
        checks: bool = True, run_id: str | None = None) -> RunReport:
    """Build every layer of one run under ``<warehouse>/runs/<run_id>`` and
    publish it. A feed that is not in ``feeds`` is not loaded again: its raw
    rows and rejects are those of the newest published run, whose files the
    run's manifest names. ``gates`` raises on primary/foreign key violations (the run
    then stays unpublished); ``checks`` writes the declared checks' results
    to ``quality/check_results`` of the run."""
    run_id = run_id or new_run_id()
    root = run_dir(warehouse, run_id)
    report = RunReport(run_id=run_id, run_dir=root)
    reuse = [spec.name for spec in FEEDS if spec.name not in feeds]
    if reuse:
        base = latest_run_dir(spark, warehouse)
        lease = lease_run(spark, base)  # until this run is published and holds the files itself
        if lease is None:
            raise FileNotFoundError(f"{base} is being removed")
        write_manifest(spark, root, base, reuse)
    load_raw(spark, feeds, root, report)
    raw_names = [f"raw.{s.name}" for s in FEEDS] + ["raw.rejected_records"]

    with _Timer(report, "staging.stg_transactions_unified"), shuffles_dropped(spark):
        wh = materialized(spark, root, raw_names)
        write_table(wh.unified, root, "staging.stg_transactions_unified")

    done = raw_names + ["staging.stg_transactions_unified"]
    with _Timer(report, "marts.dimensions_and_facts"), shuffles_dropped(spark):
        # Six independent writes, each reading only its columns of the
        # unified lines.
        wh = materialized(spark, root, done)
        written = concurrently("marts", {name: (lambda name=name: write_counted(wh, name, root)) for name in DIMENSIONS + FACTS})
    done += [f"marts.{n}" for n in DIMENSIONS + FACTS]

    with _Timer(report, "marts.mart_revenue_producto"), shuffles_dropped(spark):
        # Dimension sizes (observed while writing them) decide broadcasts.
        dim_rows = {n: written[n] for n in DIMENSIONS}
        wh = materialized(spark, root, done, dim_rows=dim_rows)
        write_mart(wh, root)
    done.append("marts.mart_revenue_producto")

    wh = materialized(spark, root, done, dim_rows=dim_rows)
    if checks:
        # The declared checks report (they do not stop the run). The three
        # families run as concurrent jobs; their results are one row per
        # declared check (58), so they are gathered, written once, and the
        # key gates are read off them.
        with _Timer(report, "quality.check_results"):
            families = concurrently("quality", {name: (lambda build=build: build().collect())
                                                for name, build in quality.check_families(wh.table).items()})
            rows = [tuple(r) for part in families.values() for r in part]
            results = spark.createDataFrame(rows, quality.RESULT_SCHEMA)
            write_table(results.coalesce(1), root, "quality.check_results")
        if gates:
            with _Timer(report, "quality.key_gates"):
                quality.enforce(quality.key_violations(results))
    elif gates:
        with _Timer(report, "quality.key_gates"):
            quality.enforce(quality.primary_keys(wh.table).unionByName(quality.foreign_keys(wh.table)))

    report.row_counts = row_counts(spark, root, [n for n in done if n != "raw.rejected_records"])
    mark_complete(spark, warehouse, run_id, {"counters": report.counters, "row_counts": report.row_counts})
    if reuse:
        lease.release(spark)
    return report


def open_warehouse(spark: SparkSession, warehouse: str, run_id: str | None = None,
                   feeds: dict[str, DataFrame] | None = None, lease_hours: float = LEASE_HOURS) -> Warehouse:
    """Warehouse over a published run (the newest unless ``run_id`` is
    given), for the business queries. ``feeds``: the feeds it was built from,
    for steps that precede the raw layer. The run is leased for
    ``lease_hours`` (0: not at all), so that retention leaves it alone;
    ``lease.release(spark)`` gives it up earlier."""
    lease, tried = None, set()
    while True:
        root = run_dir(warehouse, run_id) if run_id else latest_run_dir(spark, warehouse)
        lease = lease_run(spark, root, lease_hours) if lease_hours > 0 else None
        if lease is not None or lease_hours <= 0:
            break
        if root in tried:
            raise FileNotFoundError(f"{root} is being removed")
        tried.add(root)
    names = ([f"raw.{s.name}" for s in FEEDS] + ["raw.rejected_records", "staging.stg_transactions_unified"]
             + [f"marts.{n}" for n in MART_TABLES])
    counted = row_counts(spark, root, [f"marts.{n}" for n in DIMENSIONS])
    opened = materialized(spark, root, names, dim_rows={n: counted[f"marts.{n}"] for n in DIMENSIONS}, feeds=feeds)
    opened.lease = lease
    return opened
