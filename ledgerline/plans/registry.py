"""Registry of every operator and query as ``(spark, sf_dir) -> DataFrame``.

Each entry reads the driver tables (through the derived feeds) and runs the
operator over the whole data. The first use of a layer of a data directory in
a session writes it below spark.checkpoint.dir, by the pipeline's own step and
after the layers it follows; steps read the written layers, and a layer's own
entry is that layer as written. Outputs pass through ``present.as_output``:
exact decimals become DOUBLE and dates midnight timestamps at this boundary.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.numbers import (
    is_return_invoice,
    python_float_nonpositive,
    safe_integer,
    safe_numeric,
)
from ledgerline.functions.text import normalize_code, normalize_description
from ledgerline.functions.timestamps import parse_feed_timestamp
from ledgerline.operators import dimensions, ingest, mart, quality, staging
from ledgerline.plans import business
from ledgerline.plans.pipeline import LayersOnDemand
from ledgerline.plans.present import as_output
from ledgerline.plans.warehouse import Warehouse
from ledgerline.session import ensure_checkpoint_dir
from ledgerline.sources.csv_feed import read_feed_csv
from ledgerline.sources.derived_feed import derived_feeds
from ledgerline.sources.feeds import ECOMMERCE, ONLINE_RETAIL, FeedSpec
from ledgerline.sources.landing import write_feed_csv
from ledgerline.sources.sinks import read_table, shuffles_dropped, write_table
from ledgerline.streaming.landing_ingest import run_feed_ingest_once

_MADE: dict[tuple[str, ...], object] = {}


def _once(spark: SparkSession, sf_dir: str, what: str, make: Callable[[str], object]):
    """``make(folder)`` once per session, data directory and purpose."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _MADE:
        _MADE[key] = make(os.path.join(ensure_checkpoint_dir(spark), "registry", f"{what}-{uuid.uuid4().hex}"))
    return _MADE[key]


def landed_feed(spark: SparkSession, sf_dir: str, spec: FeedSpec) -> DataFrame:
    """A derived feed as a written table, the stand-in for its landed files."""
    def make(root: str) -> DataFrame:
        with shuffles_dropped(spark):
            write_table(derived_feeds(spark, sf_dir)[spec.name], root, f"feeds.{spec.name}")
        return read_table(spark, root, f"feeds.{spec.name}")
    return _once(spark, sf_dir, f"feed-{spec.name}", make)


def landed_csv(spark: SparkSession, sf_dir: str, spec: FeedSpec) -> str:
    """Folder of a derived feed as header CSV (the feed's own encoding,
    whitespace kept, quotes doubled)."""
    return _once(spark, sf_dir, f"landing-{spec.name}",
                 lambda path: write_feed_csv(landed_feed(spark, sf_dir, spec), path, spec))


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The pipeline's layers over the derived feeds, one warehouse per session
    and directory. A query builds the layers up to those it reads; the key
    gates have keys of their own, and the feeds hold faults on purpose."""
    return _once(spark, sf_dir, "warehouse", lambda root: LayersOnDemand(
        spark, lambda spec: landed_feed(spark, sf_dir, spec), root))


def _wh(fn: Callable[[Warehouse], DataFrame], as_double: tuple[str, ...] = ()) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return as_output(fn(warehouse(spark, sf_dir)), as_double=as_double)
    run.__name__ = getattr(fn, "__name__", "query")
    return run


# ---- sources ---------------------------------------------------------------

def _csv_roundtrip(spec: FeedSpec) -> Callable[[SparkSession, str], DataFrame]:
    """Land the derived feed as CSV, scan it back with the feed reader and
    return the raw cells."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return ingest.feed_cells(read_feed_csv(spark, landed_csv(spark, sf_dir, spec), spec), spec)
    run.__name__ = f"csv_ingest_{spec.name}"
    return run


def landed_crossing(spark: SparkSession, sf_dir: str, spec: FeedSpec) -> list[str]:
    """The derived feed with line ends and quotes in its descriptions, as two
    folders of CSV whose columns are in different orders."""
    def make(path: str) -> list[str]:
        feed = landed_feed(spark, sf_dir, spec)
        name, code = spec.header_for("description"), F.col(f"`{spec.header_for('stock_code')}`")
        text, kind = F.col(f"`{name}`"), F.length(F.col(f"`{name}`")) % 3
        feed = feed.withColumn(name, F.when(kind == 0, F.replace(text, F.lit(" "), F.lit("\n")))
                               .when(kind == 1, F.concat(F.lit('"'), text, F.lit('",\n'))).otherwise(text))
        odd = F.length(code) % 2 == 1
        return [write_feed_csv(feed.where(~odd), os.path.join(path, "straight"), spec),
                write_feed_csv(feed.where(odd).select(*[f"`{c}`" for c in reversed(feed.columns)]), os.path.join(path, "reversed"), spec)]
    return _once(spark, sf_dir, f"crossing-{spec.name}", make)


def _csv_crossing(spec: FeedSpec) -> Callable[[SparkSession, str], DataFrame]:
    """Scan files whose quoted cells go over line ends and whose columns are
    in different orders; the raw cells."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return ingest.feed_cells(read_feed_csv(spark, landed_crossing(spark, sf_dir, spec), spec), spec)
    run.__name__ = f"csv_quoted_lines_{spec.name}"
    return run


def _stream_ingest(spec: FeedSpec) -> Callable[[SparkSession, str], DataFrame]:
    """Land the derived feed as CSV files and load it with the streaming
    ingest (availableNow); the result must equal the batch raw table."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        landing = landed_csv(spark, sf_dir, spec)
        raw = _once(spark, sf_dir, f"stream-{spec.name}", lambda base: run_feed_ingest_once(
            spark, landing, os.path.join(base, "out"), spec, checkpoint=os.path.join(base, "checkpoint")))
        return raw.drop("_loaded_at")
    run.__name__ = f"stream_ingest_{spec.name}"
    return run


def _per_feed(build: Callable[[Warehouse, FeedSpec], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    def fn(wh: Warehouse) -> DataFrame:
        return build(wh, ECOMMERCE).unionByName(build(wh, ONLINE_RETAIL))
    return fn


# ---- column functions over both feeds ----------------------------------------

def _parse_price(wh: Warehouse, spec: FeedSpec) -> DataFrame:
    f = wh.flagged(spec)
    return f.select(
        F.lit(spec.name).alias("source_table"),
        F.col(spec.invoice_column).alias("invoice_no"),
        F.col(spec.price_column).alias("price_text"),
        python_float_nonpositive(F.col(spec.price_column)).alias("price_nonpositive"),
        is_return_invoice(F.col(spec.invoice_column)).alias("is_return_invoice"),
    )


def _normalize_code(wh: Warehouse, spec: FeedSpec) -> DataFrame:
    r = wh.raw(spec)
    inv = F.col(spec.invoice_column)
    return r.select(F.lit(spec.name).alias("source_table"), inv.alias("invoice_text"),
                    F.col("stock_code").alias("stock_text"),
                    normalize_code(inv).alias("invoice_no"),
                    normalize_code(F.col("stock_code")).alias("stock_code"))


def _normalize_description(wh: Warehouse, spec: FeedSpec) -> DataFrame:
    r = wh.raw(spec)
    return r.select(F.lit(spec.name).alias("source_table"),
                    F.col("description").alias("description_text"),
                    F.col("country").alias("country_text"),
                    normalize_description(F.col("description")).alias("description"),
                    normalize_description(F.col("country")).alias("country"))


def _safe_integer(wh: Warehouse, spec: FeedSpec) -> DataFrame:
    r = wh.raw(spec)
    return r.select(F.lit(spec.name).alias("source_table"), F.col("quantity").alias("quantity_text"),
                    safe_integer(F.col("quantity")).alias("quantity"))


def _safe_numeric(wh: Warehouse, spec: FeedSpec) -> DataFrame:
    r = wh.raw(spec)
    return r.select(F.lit(spec.name).alias("source_table"), F.col(spec.price_column).alias("price_text"),
                    safe_numeric(F.col(spec.price_column)).alias("unit_price"))


def _parse_ts(spec: FeedSpec) -> Callable[[Warehouse], DataFrame]:
    def fn(wh: Warehouse) -> DataFrame:
        r = wh.raw(spec)
        return r.select(F.col("invoice_date").alias("invoice_date_text"),
                        parse_feed_timestamp(F.col("invoice_date"), spec.date_layout).alias("invoice_date_utc"))
    return fn


def _classify(wh: Warehouse, spec: FeedSpec) -> DataFrame:
    s = wh.staged(spec)
    return s.select("source_file", "quantity", "transaction_type")


def _reject_split(spec: FeedSpec) -> Callable[[Warehouse], DataFrame]:
    def fn(wh: Warehouse) -> DataFrame:
        return wh.flagged(spec)
    return fn


def _load_counters(wh: Warehouse) -> DataFrame:
    return ingest.load_counters(wh.flagged(ECOMMERCE), ECOMMERCE).unionByName(
        ingest.load_counters(wh.flagged(ONLINE_RETAIL), ONLINE_RETAIL))


# ---- staging sub-steps ---------------------------------------------------------

def _staged_pairs(wh: Warehouse):
    return [(wh.staged(f), f.priority) for f in (ECOMMERCE, ONLINE_RETAIL)]


def _required_fields(wh: Warehouse) -> DataFrame:
    return staging.required_fields_filter(wh.staged(ECOMMERCE)).unionByName(
        staging.required_fields_filter(wh.staged(ONLINE_RETAIL)))


def _union_sources(wh: Warehouse) -> DataFrame:
    return staging.union_sources(_staged_pairs(wh))


def _dedupe(wh: Warehouse) -> DataFrame:
    # as the pipeline does it: incomplete lines ranked last, not filtered first
    return staging.dedupe_transactions(staging.tag_sources(_staged_pairs(wh)), require=staging.REQUIRED_COLUMNS).drop(
        "source_priority")


def _transaction_key(wh: Warehouse) -> DataFrame:
    return wh.unified.select("transaction_key", "invoice_no", "stock_code", "invoice_date_utc",
                             "customer_id", "country")


def _table(name: str) -> Callable[[Warehouse], DataFrame]:
    def fn(wh: Warehouse) -> DataFrame:
        return wh.table(name).drop("_loaded_at", "rejected_at")  # the time of the load
    return fn


def _quality(check) -> Callable[[Warehouse], DataFrame]:
    def fn(wh: Warehouse) -> DataFrame:
        return check(wh.table)
    return fn


# Outputs whose parsed quantity is NULL for unparseable text (see present.py).
NULLABLE_QTY = ("quantity",)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        # sources, ingest and quarantine
        "csv_ingest_ecommerce": _csv_roundtrip(ECOMMERCE),
        "csv_ingest_online_retail": _csv_roundtrip(ONLINE_RETAIL),
        "csv_quoted_lines_ecommerce": _csv_crossing(ECOMMERCE),
        "csv_quoted_lines_online_retail": _csv_crossing(ONLINE_RETAIL),
        "stream_ingest_ecommerce": _stream_ingest(ECOMMERCE),
        "stream_ingest_online_retail": _stream_ingest(ONLINE_RETAIL),
        "raw_ecommerce": _wh(_table("raw.ecommerce_data")),
        "raw_online_retail": _wh(_table("raw.online_retail_ii")),
        "parse_price": _wh(_per_feed(_parse_price)),
        "reject_split_ecommerce": _wh(_reject_split(ECOMMERCE)),
        "reject_split_online_retail": _wh(_reject_split(ONLINE_RETAIL)),
        "rejected_records": _wh(_table("raw.rejected_records")),
        "load_counters": _wh(_load_counters),
        # column functions
        "normalize_code": _wh(_per_feed(_normalize_code)),
        "normalize_description": _wh(_per_feed(_normalize_description)),
        "safe_integer": _wh(_per_feed(_safe_integer), NULLABLE_QTY),
        "safe_numeric": _wh(_per_feed(_safe_numeric)),
        "parse_ts_us": _wh(_parse_ts(ECOMMERCE)),
        "parse_ts_iso": _wh(_parse_ts(ONLINE_RETAIL)),
        "classify_transaction": _wh(_per_feed(_classify), NULLABLE_QTY),
        # staging
        "stg_ecommerce": _wh(_table("staging.stg_ecommerce"), NULLABLE_QTY),
        "stg_online_retail": _wh(_table("staging.stg_online_retail"), NULLABLE_QTY),
        "required_fields_filter": _wh(_required_fields),
        "union_sources": _wh(_union_sources),
        "dedupe_transactions": _wh(_dedupe),
        "transaction_key": _wh(_transaction_key),
        "stg_transactions_unified": _wh(_table("staging.stg_transactions_unified")),
        # dimensions
        "description_frequency": _wh(lambda wh: dimensions.description_frequency(wh.unified)),
        "canonical_description": _wh(lambda wh: dimensions.canonical_description(
            dimensions.description_frequency(wh.unified))),
        "categorize_products": _wh(lambda wh: dimensions.categorize_products(
            dimensions.canonical_description(dimensions.description_frequency(wh.unified)))),
        "dim_producto": _wh(_table("marts.dim_producto")),
        "dim_cliente": _wh(_table("marts.dim_cliente")),
        "dim_tiempo": _wh(_table("marts.dim_tiempo")),
        "dim_pais": _wh(_table("marts.dim_pais")),
        # facts and mart
        "fact_ventas": _wh(_table("marts.fact_ventas")),
        "fact_devoluciones": _wh(_table("marts.fact_devoluciones")),
        "sales_by_day": _wh(lambda wh: mart.text_keys(mart.sales_by_day(mart.byte_keys(wh.fact_ventas)))),
        "returns_by_day": _wh(lambda wh: mart.text_keys(mart.returns_by_day(mart.byte_keys(wh.fact_devoluciones)))),
        "sales_returns_merge": _wh(lambda wh: mart.text_keys(mart.merged_by_day(
            wh.fact_ventas, wh.fact_devoluciones, mart.heavy_buckets(wh.fact_ventas)))),
        "mart_revenue_producto": _wh(_table("marts.mart_revenue_producto")),
        # business questions and row-count reports
        "q1_monthly_net_sales": _wh(business.q1_monthly_net_sales),
        "q1b_monthly_net_short": _wh(business.q1b_monthly_net_short),
        "q2_category_returns": _wh(business.q2_category_returns),
        "q3a_top_net_revenue": _wh(business.q3a_top_net_revenue),
        "q3b_top_return_rate": _wh(business.q3b_top_return_rate),
        "q4_country_share": _wh(business.q4_country_share),
        "q5_guest_vs_identified": _wh(business.q5_guest_vs_identified),
        "q6a_distinct_products": _wh(business.q6a_distinct_products),
        "q6b_description_variants": _wh(business.q6b_description_variants),
        "q7_quality_candidates": _wh(business.q7_quality_candidates),
        "v1_layer_counts": _wh(business.v1_layer_counts),
        "v2_layer_counts_short": _wh(business.v2_layer_counts_short),
        # data quality
        "dq_not_null": _wh(_quality(quality.not_null)),
        "dq_unique": _wh(_quality(quality.unique)),
        "dq_accepted_values": _wh(_quality(quality.accepted_values)),
        "dq_relationships": _wh(_quality(quality.relationships)),
        "dq_primary_keys": _wh(_quality(quality.primary_keys)),
        "dq_foreign_keys": _wh(_quality(quality.foreign_keys)),
    }
    return q
