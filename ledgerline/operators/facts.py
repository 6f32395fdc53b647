"""Fact tables. Surrogate keys are the same MD5 hashes the dimensions use,
so facts need no lookup join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.staging import RETURN, SALE


def _keys() -> list:
    return [
        F.col("transaction_key"),
        F.col("invoice_no"),
        F.md5(F.col("stock_code")).alias("producto_key"),
        F.md5(F.col("customer_id")).alias("cliente_key"),
        F.to_date(F.col("invoice_date_utc")).cast("string").alias("tiempo_key"),
        F.md5(F.col("country")).alias("pais_key"),
    ]


def fact_ventas(unified: DataFrame) -> DataFrame:
    """Sales: VENTA lines with quantity > 0 and unit price > 0."""
    q, p = F.col("quantity"), F.col("unit_price")
    return unified.filter((F.col("transaction_type") == F.lit(SALE)) & (q > 0) & (p > 0)).select(
        *_keys(),
        q.alias("cantidad"),
        p.alias("unit_price"),
        (q * p).alias("revenue_bruto"),
        "invoice_date_utc",
        "source_file",
    )


def fact_devoluciones(unified: DataFrame) -> DataFrame:
    """Returns and adjustments (quantity <= 0), measures stored positive."""
    q, p = F.col("quantity"), F.col("unit_price")
    return unified.filter((F.col("transaction_type") == F.lit(RETURN)) & (q <= 0)).select(
        *_keys(),
        F.abs(q).alias("cantidad_devuelta"),
        p.alias("unit_price"),
        F.abs(q * p).alias("revenue_devolucion"),
        "invoice_date_utc",
        "source_file",
    )
