"""Hot keys: a third of all rows on one key must be cut down before the
shuffle and still give exact results."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators import mart, staging


def _executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_hot_key_is_limited_before_shuffle(spark):
    n = 30_000
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("I"), F.col("id").cast("string"))).alias("invoice_no"),
        F.lit("S1").alias("stock_code"),
        F.lit("D").alias("description"),
        (F.col("id") % 7 + 1).cast("int").alias("quantity"),
        F.lit(dt.datetime(2010, 12, 1, 8, 26)).cast("timestamp_ntz").alias("invoice_date_utc"),
        F.lit(1).cast("decimal(18,4)").alias("unit_price"),
        F.lit("GUEST").alias("customer_id"),
        F.lit("FRANCE").alias("country"),
        F.lit("VENTA").alias("transaction_type"),
        F.lit("ecommerce_data").alias("source_file"),
        F.lit(1).alias("source_priority"),
    ).repartition(8)
    out = staging.dedupe_transactions(base, require=staging.REQUIRED_COLUMNS)
    plan = _executed(out)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    rows = out.filter(F.col("invoice_no") == "HOT").collect()
    assert len(rows) == 1 and rows[0].quantity == 1      # smallest quantity wins the tie
    assert out.count() == 1 + (n - n // 3)


def test_hot_mart_key_aggregates_exactly(spark):
    n = 30_000
    facts = spark.range(n).select(
        F.lit("P").alias("producto_key"), F.lit("2010-12-01").alias("tiempo_key"), F.lit("C").alias("pais_key"),
        (F.col("id") % 100).cast("string").alias("invoice_no"),
        F.lit(2).alias("cantidad"), F.lit(1.5).cast("decimal(29,4)").alias("revenue_bruto"),
    ).repartition(8)
    got = mart.sales_by_day(facts).collect()
    assert len(got) == 1
    assert (got[0].cantidad_vendida, got[0].num_facturas) == (2 * n, 100)
    plan = _executed(mart.sales_by_day(facts))
    assert plan.count("HashAggregate") >= 4                # partial + final on both levels
