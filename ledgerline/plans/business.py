"""Business questions over the mart and facts, plus layer row counts.

Each function takes the ``Warehouse`` and returns a DataFrame; money and
ratios stay exact decimals (see :func:`ledgerline.plans.present.as_output`
for the presentation cast).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.ratios import round_ratio
from ledgerline.functions.text import trim_spaces
from ledgerline.operators.joins import join_dimension
from ledgerline.plans.warehouse import Warehouse
from ledgerline.sources.feeds import ECOMMERCE

PRODUCT = ("codigo_producto", "nombre_canonico", "categoria")


def q1_monthly_net_sales(wh: Warehouse) -> DataFrame:
    return (
        wh.mart_revenue_producto.groupBy("anio_mes", "anio", "mes")
        .agg(
            F.sum("revenue_ventas").alias("total_revenue_ventas"),
            F.sum("revenue_devoluciones").alias("total_devoluciones"),
            F.sum("revenue_neto").alias("total_revenue_neto"),
            F.sum("cantidad_vendida").alias("total_unidades_vendidas"),
            F.sum("num_facturas").alias("total_facturas"),
        )
        .orderBy("anio", "mes")
    )


def q1b_monthly_net_short(wh: Warehouse) -> DataFrame:
    return (
        wh.mart_revenue_producto.groupBy("anio_mes")
        .agg(F.sum("revenue_neto").alias("ventas_netas"))
        .orderBy("anio_mes")
    )


def q2_category_returns(wh: Warehouse) -> DataFrame:
    rev, dev = F.sum("revenue_ventas"), F.sum("revenue_devoluciones")
    return (
        wh.mart_revenue_producto.groupBy("categoria")
        .agg(
            rev.alias("revenue_bruto_total"),
            dev.alias("devoluciones_total"),
            F.sum("revenue_neto").alias("revenue_neto_total"),
        )
        .withColumn("porcentaje_devolucion", round_ratio(
            F.col("devoluciones_total"), F.col("revenue_bruto_total"), 2,
            percent=True, den_is_money=True))
        .orderBy(F.col("revenue_bruto_total").desc(), "categoria")
    )


def _by_product(wh: Warehouse) -> DataFrame:
    """Mart rolled up per product (partial aggregate before the shuffle)."""
    return wh.mart_revenue_producto.groupBy(*PRODUCT).agg(
        F.sum("revenue_ventas").alias("revenue_bruto"),
        F.sum("revenue_devoluciones").alias("devoluciones"),
        F.sum("revenue_neto").alias("revenue_neto"),
        F.sum("cantidad_vendida").alias("unidades_vendidas"),
        F.sum("cantidad_devuelta").alias("unidades_devueltas"),
    )


def q3a_top_net_revenue(wh: Warehouse, k: int = 10) -> DataFrame:
    """Top-k by net revenue; the limit is the feature. Ties broken by code."""
    return (
        _by_product(wh)
        .select(*PRODUCT, F.col("revenue_neto").alias("revenue_neto_total"), "unidades_vendidas")
        .orderBy(F.col("revenue_neto_total").desc(), F.col("codigo_producto").asc())
        .limit(k)
    )


def q3b_top_return_rate(wh: Warehouse, k: int = 10, min_units: int = 5) -> DataFrame:
    return (
        _by_product(wh)
        .filter(F.col("unidades_vendidas") >= min_units)
        .select(*PRODUCT, "unidades_vendidas", "unidades_devueltas",
                round_ratio(F.col("unidades_devueltas"), F.col("unidades_vendidas"), 2,
                            percent=True).alias("tasa_devolucion_pct"))
        .orderBy(F.col("tasa_devolucion_pct").desc_nulls_first(), F.col("codigo_producto").asc())
        .limit(k)
    )


def q4_country_share(wh: Warehouse) -> DataFrame:
    """Share of all invoices per country. The grand total is a window over
    the per-country rows (one row per country, whatever the mart's size), so
    the mart is read once."""
    per_country = wh.mart_revenue_producto.groupBy("nombre_pais").agg(
        F.sum("num_facturas").alias("total_facturas"),
        F.sum("cantidad_vendida").alias("total_unidades"),
        F.sum("revenue_ventas").alias("revenue_total"),
    )
    grand = F.sum("total_facturas").over(Window.partitionBy())
    return (
        per_country.select(
            "nombre_pais", "total_facturas", "total_unidades", "revenue_total",
            round_ratio(F.col("revenue_total"), F.col("total_facturas"), 2).alias("ticket_promedio"),
            round_ratio(F.col("total_facturas"), grand, 2, percent=True).alias("pct_del_total"),
        )
        .orderBy(F.col("total_facturas").desc(), "nombre_pais")
    )


def q5_guest_vs_identified(wh: Warehouse) -> DataFrame:
    """Identified customers vs GUEST. Sales are first combined per
    (customer key, invoice) so the GUEST hot key reaches the join as one row
    per invoice, then joined to the customer dimension (checked broadcast
    or AQE skew-split sort-merge join)."""
    per_invoice = wh.fact_ventas.groupBy("cliente_key", "invoice_no").agg(
        F.sum("cantidad").alias("cantidad"),
        F.sum("revenue_bruto").alias("revenue_bruto"),
    )
    dim = wh.dim_cliente.select("cliente_key", "es_cliente_identificado")
    joined = join_dimension(per_invoice, dim, "cliente_key", dim_rows=wh.dim_rows.get("dim_cliente"))
    agg = joined.groupBy("es_cliente_identificado").agg(
        F.countDistinct("invoice_no").alias("num_facturas"),
        F.sum("cantidad").alias("total_unidades"),
        F.sum("revenue_bruto").alias("revenue_total"),
    )
    return agg.select(
        "es_cliente_identificado", "num_facturas", "total_unidades", "revenue_total",
        round_ratio(F.col("revenue_total"), F.col("num_facturas"), 2).alias("ticket_promedio_por_factura"),
        round_ratio(F.col("revenue_total"), F.col("total_unidades"), 2).alias("precio_promedio_unitario"),
    ).orderBy(F.col("es_cliente_identificado").desc())


def q6a_distinct_products(wh: Warehouse) -> DataFrame:
    return wh.dim_producto.agg(F.countDistinct("codigo_producto").alias("total_codigos_unicos"))


def q6b_description_variants(wh: Warehouse) -> DataFrame:
    """Stock codes whose raw feed-A descriptions differ after upper(trim())."""
    raw = wh.raw(ECOMMERCE).filter(F.col("stock_code").isNotNull())
    d = F.upper(trim_spaces(F.col("description")))
    return (
        raw.select("stock_code", d.alias("d"))
        .groupBy("stock_code")
        .agg(
            F.countDistinct("d").alias("variantes_descripcion"),
            F.min("d").alias("variante_1"),
            F.max("d").alias("variante_2"),
        )
        .filter(F.col("variantes_descripcion") > 1)
        .orderBy(F.col("variantes_descripcion").desc(), "stock_code")
    )


def q7_quality_candidates(wh: Warehouse, k: int = 15) -> DataFrame:
    return (
        _by_product(wh)
        .filter(F.col("revenue_bruto") > 0)
        .select(*PRODUCT, "revenue_bruto", "devoluciones", "revenue_neto",
                round_ratio(F.col("devoluciones"), F.col("revenue_bruto"), 2,
                            percent=True, den_is_money=True).alias("tasa_devolucion_pct"))
        .orderBy(F.col("devoluciones").desc(), F.col("revenue_bruto").desc(), F.col("codigo_producto").asc())
        .limit(k)
    )


# The tables listed by the two row-count reports.
LAYER_COUNT_TABLES = (
    "raw.ecommerce_data", "raw.online_retail_ii", "raw.rejected_records",
    "marts.fact_ventas", "marts.fact_devoluciones", "marts.dim_producto", "marts.dim_cliente",
)
LAYER_COUNT_TABLES_SHORT = (
    "raw.ecommerce_data", "raw.online_retail_ii", "marts.fact_ventas", "marts.dim_producto",
)


def _layer_counts(wh: Warehouse, tables, count_name: str) -> DataFrame:
    out = None
    for name in tables:
        one = wh.table(name).agg(F.count(F.lit(1)).alias(count_name)).select(
            F.lit(name).alias("tabla"), count_name)
        out = one if out is None else out.unionByName(one)
    return out.orderBy("tabla")


def v1_layer_counts(wh: Warehouse) -> DataFrame:
    return _layer_counts(wh, LAYER_COUNT_TABLES, "registros")


def v2_layer_counts_short(wh: Warehouse) -> DataFrame:
    return _layer_counts(wh, LAYER_COUNT_TABLES_SHORT, "count")


QUESTIONS = (
    "q1_monthly_net_sales", "q1b_monthly_net_short", "q2_category_returns", "q3a_top_net_revenue",
    "q3b_top_return_rate", "q4_country_share", "q5_guest_vs_identified", "q6a_distinct_products",
    "q6b_description_variants", "q7_quality_candidates", "v1_layer_counts", "v2_layer_counts_short",
)
