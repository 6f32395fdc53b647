"""Star-schema dimensions derived from the unified lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.categories import categorize
from ledgerline.functions.text import GUEST, trim_spaces


def description_frequency(unified: DataFrame) -> DataFrame:
    """Lines per (stock code, normalised description); map-side combined."""
    return (
        unified.filter(F.col("stock_code").isNotNull() & F.col("description").isNotNull())
        .groupBy("stock_code", "description")
        .agg(F.count(F.lit(1)).alias("frecuencia"))
    )


def canonical_description(freq: DataFrame) -> DataFrame:
    """Per stock code: the most frequent description, then the longest, then
    the smallest in binary order. Runs on the (code, description) counts, so
    the window sees one row per distinct description, not per line."""
    w = Window.partitionBy("stock_code").orderBy(
        F.col("frecuencia").desc(), F.length("description").desc(), F.col("description").asc())
    return (
        freq.withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") == 1)
        .select("stock_code", F.col("description").alias("nombre_canonico"))
    )


def categorize_products(canonical: DataFrame) -> DataFrame:
    return canonical.withColumn("categoria", categorize(F.col("nombre_canonico")))


def dim_producto(unified: DataFrame) -> DataFrame:
    cat = categorize_products(canonical_description(description_frequency(unified)))
    return cat.select(
        F.md5(F.col("stock_code")).alias("producto_key"),
        F.col("stock_code").alias("codigo_producto"),
        "nombre_canonico",
        "categoria",
    )


def dim_cliente(unified: DataFrame) -> DataFrame:
    """Distinct customers (GUEST included). The GUEST hot key collapses in
    the partial aggregate before the shuffle."""
    ids = unified.filter(F.col("customer_id").isNotNull()).select("customer_id").distinct()
    return ids.select(
        F.md5(F.col("customer_id")).alias("cliente_key"),
        "customer_id",
        (F.col("customer_id") != F.lit(GUEST)).alias("es_cliente_identificado"),
    )


def dim_tiempo(unified: DataFrame) -> DataFrame:
    fechas = (
        unified.filter(F.col("invoice_date_utc").isNotNull())
        .select(F.to_date(F.col("invoice_date_utc")).alias("fecha"))
        .distinct()
    )
    return fechas.select(
        F.col("fecha").cast("string").alias("tiempo_key"),
        "fecha",
        F.year("fecha").alias("anio"),
        F.month("fecha").alias("mes"),
        F.dayofmonth("fecha").alias("dia"),
        F.quarter("fecha").alias("trimestre"),
        F.format_string("%04d-%02d", F.year("fecha"), F.month("fecha")).alias("anio_mes"),
        F.date_format("fecha", "MMMM").alias("nombre_mes"),
    )


def dim_pais(unified: DataFrame) -> DataFrame:
    """Distinct non-blank countries. A blank country stays in the facts and is
    reported by the foreign-key check instead of being defaulted."""
    paises = (
        unified.filter(F.col("country").isNotNull() & (trim_spaces(F.col("country")) != F.lit("")))
        .select("country")
        .distinct()
    )
    return paises.select(F.md5(F.col("country")).alias("pais_key"), F.col("country").alias("nombre_pais"))
