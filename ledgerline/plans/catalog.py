"""SQL access: published runs behind permanent views and one pointer.

Every layer is a view (``marts.mart_revenue_producto``, ``raw.ecommerce_data``,
``staging.stg_ecommerce`` ...) over a table of all registered runs, partitioned
by run. The views take the run that the warehouse's pointer names. Registering
a run first adds its partitions, which no view shows yet, and then adds one
row to the pointer: one file that is there or not. So all layers change
together, and a query, whatever layers it joins, sees one run.

The databases live in the warehouse, beside the runs; nothing is copied.
"""

from __future__ import annotations

import os
import time

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators.staging import stage_feed
from ledgerline.plans import business
from ledgerline.plans.pipeline import open_warehouse
from ledgerline.plans.warehouse import MART_TABLES
from ledgerline.sources.feeds import ECOMMERCE, FEEDS, ONLINE_RETAIL
from ledgerline.sources.files import children
from ledgerline.sources.manifest import REJECTS, raw_files
from ledgerline.sources.retention import Retention, retain
from ledgerline.sources.runs import latest_run_dir, run_dir
from ledgerline.sources.sinks import RAW_TABLES, accepted_path, raw_schema, read_table, table_path

LAYER_TABLES = (
    [f"raw.{f.name}" for f in FEEDS] + ["raw.rejected_records", "staging.stg_transactions_unified"]
    + [f"marts.{n}" for n in MART_TABLES] + ["quality.check_results"]
)
STAGING_VIEWS = {"staging.stg_ecommerce": ECOMMERCE, "staging.stg_online_retail": ONLINE_RETAIL}
RUNS = "ledgerline_runs"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _of_runs(name: str) -> str:
    return f"{RUNS}.{name.replace('.', '__')}"


def _pointer(warehouse: str) -> str:
    return os.path.join(warehouse, "_catalog", "pointer")


def current_run(spark: SparkSession, warehouse: str) -> str | None:
    """The run that the views show."""
    if not children(spark, _pointer(warehouse)):
        return None
    return spark.read.parquet(_pointer(warehouse)).selectExpr("max_by(run_id, moved)").first()[0]


def _move_pointer(spark: SparkSession, warehouse: str, run_id: str) -> None:
    spark.createDataFrame([(time.time_ns(), run_id)], "moved bigint, run_id string").coalesce(1).write.mode("append").parquet(
        _pointer(warehouse))


def select_text(df: DataFrame, source: str) -> str:
    """The projections and filters of ``df`` over its one relation, aliased
    ``r``, as SQL over the table ``source``: a view states the rules that the
    DataFrame code states, without a second copy of them."""
    node, columns, conditions = df._jdf.queryExecution().analyzed(), None, []
    while node.nodeName() in ("Project", "Filter"):
        if node.nodeName() == "Filter":
            conditions.append(node.condition().sql())
        elif columns is None and not conditions:
            listed = node.projectList()
            columns = [listed.apply(i).sql() for i in range(listed.size())]
        else:
            raise ValueError("a view takes one projection over filters")
        node = node.child()
    where = f" WHERE {' AND '.join(conditions)}" if conditions else ""
    return f"SELECT {', '.join(columns or ['*'])} FROM {source} AS r{where}"


def _view(spark: SparkSession, warehouse: str, name: str, body: str) -> None:
    """Create a view unless the one of that name is over this warehouse."""
    if spark.catalog.tableExists(name):
        if spark.catalog.getTable(name).description == warehouse:
            return
        spark.sql(f"DROP VIEW {name}")
    spark.sql(f"CREATE VIEW {name} COMMENT {_text(warehouse)} AS {body}")


def _add_run(spark: SparkSession, warehouse: str, run_id: str, tables) -> None:
    """Make a run's tables partitions of the tables of all runs."""
    root = run_dir(warehouse, run_id)
    files = raw_files(spark, root)
    place = lambda *parts: _text(os.path.join(warehouse, "_catalog", *parts))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {RUNS} LOCATION {place(f'{RUNS}.db')}")
    for name in tables:
        table = _of_runs(name)
        by_feed = name == REJECTS
        if not spark.catalog.tableExists(table):
            fields = read_table(spark, root, name).schema.fields
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
            by = "run_id, source_table" if by_feed else "run_id"
            spark.sql(f"CREATE TABLE {table} ({columns}, run_id string) USING parquet PARTITIONED BY ({by}) "
                      f"LOCATION {place('tables', name)}")
        if by_feed:
            parts = [(f", source_table = {_text(feed)}", folder) for (of, feed), folder in files.items() if of == REJECTS]
        elif name in RAW_TABLES:
            parts = [("", accepted_path(files[name, RAW_TABLES[name].name]))]
        else:
            parts = [("", table_path(root, name))]
        for also, folder in parts:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (run_id = {_text(run_id)}{also}) LOCATION {_text(folder)}")


def register_tables(spark: SparkSession, warehouse: str, tables=LAYER_TABLES,
                    run_id: str | None = None) -> list[str]:
    """Show a published run (the newest unless ``run_id``) in the catalog.
    Returns the layers' names, the feeds' staging views among them."""
    run_id = run_id or os.path.basename(latest_run_dir(spark, warehouse))
    _add_run(spark, warehouse, run_id, tables)
    _move_pointer(spark, warehouse, run_id)
    for db in sorted({t.split(".")[0] for t in [*tables, *STAGING_VIEWS]}):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION {_text(os.path.join(warehouse, '_catalog', f'{db}.db'))}")
    pointer = _pointer(warehouse).replace("`", "``")
    for name in tables:
        columns = ", ".join(f"`{c.name}`" for c in spark.table(_of_runs(name)).schema if c.name != "run_id")
        _view(spark, warehouse, name, f"SELECT {columns} FROM {_of_runs(name)} WHERE run_id = "
                                      f"(SELECT max_by(run_id, moved) FROM parquet.`{pointer}`)")
    staged = [n for n, spec in STAGING_VIEWS.items() if f"raw.{spec.name}" in tables]
    for name in staged:
        spec = STAGING_VIEWS[name]
        shape = stage_feed(spark.createDataFrame([], raw_schema(spec)).alias("r"), spec)
        _view(spark, warehouse, name, select_text(shape, f"raw.{spec.name}"))
    return [*tables, *staged]


def retain_runs(spark: SparkSession, warehouse: str, keep: int = 3, **options) -> Retention:
    """:func:`retain`, sparing the run that the views show, and take removed
    runs out of the catalog."""
    shown = current_run(spark, warehouse)
    done = retain(spark, warehouse, keep, also=(shown,) if shown else (), **options)
    for name in LAYER_TABLES:
        if done.removed and spark.catalog.tableExists(_of_runs(name)):
            for run_id in done.removed:
                spark.sql(f"ALTER TABLE {_of_runs(name)} DROP IF EXISTS PARTITION (run_id = {_text(run_id)})")
    return done


def register_staging(spark: SparkSession, warehouse: str, run_id: str | None = None) -> list[str]:
    """The typed lines of each feed over a published run's raw tables, as the
    temporary views ``stg_ecommerce`` and ``stg_online_retail``."""
    wh = open_warehouse(spark, warehouse, run_id)
    names = ["stg_ecommerce", "stg_online_retail"]
    for name in names:
        wh.table(f"staging.{name}").createOrReplaceTempView(name)
    return names


def register_questions(spark: SparkSession, warehouse: str, run_id: str | None = None) -> list[str]:
    """Each business question over a published run as a temporary view of its
    name, so that ``SELECT * FROM q4_country_share`` gives its result."""
    wh = open_warehouse(spark, warehouse, run_id)
    for name in business.QUESTIONS:
        getattr(business, name)(wh).createOrReplaceTempView(name)
    return list(business.QUESTIONS)
