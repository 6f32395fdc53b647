"""The layered warehouse as lazily built DataFrames.

``Warehouse`` wires the operators into the raw -> staging -> marts chain.
Each layer is built once per object and memoised, so one query plan refers
to a single DataFrame per layer. A layer can also be supplied already
materialised (read back from Parquet after a pipeline run), in which case
everything downstream starts from that table instead of recomputing it.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators import dimensions, facts, ingest, mart, staging
from ledgerline.sources.feeds import ECOMMERCE, FEEDS, ONLINE_RETAIL, FeedSpec

FEED_BY_NAME = {f.name: f for f in FEEDS}


class Warehouse:
    def __init__(self, spark: SparkSession, feeds: dict[str, DataFrame] | None = None,
                 tables: dict[str, DataFrame] | None = None,
                 dim_rows: dict[str, int] | None = None):
        """``feeds``: feed name -> all-STRING frame with CSV header names.
        ``tables``: already materialised layers by table name (optional).
        ``dim_rows``: known row counts of materialised dimensions, used to
        decide broadcasts."""
        self.spark = spark
        self._feeds = feeds or {}
        self._tables = dict(tables or {})
        self.dim_rows = dict(dim_rows or {})
        self._per_feed: dict[tuple[str, str], DataFrame] = {}
        self.lease = None  # what keeps the run from being removed while it is open

    def _given(self, name: str) -> DataFrame | None:
        return self._tables.get(name)

    # ---- raw -------------------------------------------------------------
    def _memo(self, kind: str, spec: FeedSpec, build) -> DataFrame:
        key = (kind, spec.name)
        if key not in self._per_feed:
            self._per_feed[key] = build()
        return self._per_feed[key]

    def flagged(self, spec: FeedSpec) -> DataFrame:
        return self._memo("flagged", spec, lambda: ingest.flag_rejects(
            ingest.feed_cells(self._feeds[spec.name], spec), spec))

    def raw(self, spec: FeedSpec) -> DataFrame:
        given = self._given(f"raw.{spec.name}")
        return given if given is not None else ingest.raw_rows(self.flagged(spec), spec)

    def rejects(self, spec: FeedSpec) -> DataFrame:
        return ingest.reject_records(self.flagged(spec), spec)

    @cached_property
    def rejected_records(self) -> DataFrame:
        given = self._given("raw.rejected_records")
        if given is not None:
            return given
        return self.rejects(ECOMMERCE).unionByName(self.rejects(ONLINE_RETAIL))

    # ---- staging ---------------------------------------------------------
    def staged(self, spec: FeedSpec) -> DataFrame:
        return self._memo("staged", spec, lambda: staging.stage_feed(self.raw(spec), spec))

    @cached_property
    def unified(self) -> DataFrame:
        given = self._given("staging.stg_transactions_unified")
        if given is not None:
            return given
        return staging.unified_transactions(
            [(self.staged(f), f.priority) for f in (ECOMMERCE, ONLINE_RETAIL)])

    # ---- marts -----------------------------------------------------------
    def _mart_table(self, name: str, build) -> DataFrame:
        given = self._given(f"marts.{name}")
        return given if given is not None else build(self.unified)

    @cached_property
    def dim_producto(self) -> DataFrame:
        return self._mart_table("dim_producto", dimensions.dim_producto)

    @cached_property
    def dim_cliente(self) -> DataFrame:
        return self._mart_table("dim_cliente", dimensions.dim_cliente)

    @cached_property
    def dim_tiempo(self) -> DataFrame:
        return self._mart_table("dim_tiempo", dimensions.dim_tiempo)

    @cached_property
    def dim_pais(self) -> DataFrame:
        return self._mart_table("dim_pais", dimensions.dim_pais)

    @cached_property
    def fact_ventas(self) -> DataFrame:
        return self._mart_table("fact_ventas", facts.fact_ventas)

    @cached_property
    def fact_devoluciones(self) -> DataFrame:
        return self._mart_table("fact_devoluciones", facts.fact_devoluciones)

    @cached_property
    def mart_revenue_producto(self) -> DataFrame:
        given = self._given("marts.mart_revenue_producto")
        if given is not None:
            return given
        return mart.mart_revenue_producto(
            self.fact_ventas, self.fact_devoluciones, self.dim_producto,
            self.dim_tiempo, self.dim_pais, dim_rows=self.dim_rows,
            written="marts.fact_ventas" in self._tables)

    def table(self, qualified: str) -> DataFrame:
        """Look a layer up by its qualified name (raw.x / staging.x / marts.x)."""
        schema, _, name = qualified.partition(".")
        if schema == "raw":
            if name == "rejected_records":
                return self.rejected_records
            return self.raw(FEED_BY_NAME[name])
        if schema == "staging":
            if name == "stg_transactions_unified":
                return self.unified
            spec = {"stg_ecommerce": ECOMMERCE, "stg_online_retail": ONLINE_RETAIL}[name]
            return self.staged(spec)
        return getattr(self, name)


# Mart-layer tables in build order (dimensions, facts, mart).
MART_TABLES = ("dim_producto", "dim_cliente", "dim_tiempo", "dim_pais",
               "fact_ventas", "fact_devoluciones", "mart_revenue_producto")
