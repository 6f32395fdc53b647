"""Planted faults: every data-quality check must flag its bad row."""

import datetime as dt

import pytest

from ledgerline.operators import quality


def _tables(spark):
    t = {
        "staging.stg_ecommerce": spark.createDataFrame(
            [("1", "A", "VENTA"), (None, "B", "OTRO"), ("3", None, None)],
            "invoice_no string, stock_code string, transaction_type string"),
        "staging.stg_online_retail": spark.createDataFrame(
            [("1", "A", "DEVOLUCION")], "invoice_no string, stock_code string, transaction_type string"),
        "staging.stg_transactions_unified": spark.createDataFrame(
            [("k1", "1", "A", 1, dt.datetime(2010, 1, 1), 1.0, "VENTA"),
             ("k1", "2", "B", 1, dt.datetime(2010, 1, 1), 1.0, "VENTA"),
             ("k3", "3", "C", None, dt.datetime(2010, 1, 1), 1.0, "MAL")],
            "transaction_key string, invoice_no string, stock_code string, quantity int, "
            "invoice_date_utc timestamp_ntz, unit_price double, transaction_type string"),
        "marts.dim_producto": spark.createDataFrame(
            [("p1", "A", "X", "General"), ("p1", "B", "Y", "General")],
            "producto_key string, codigo_producto string, nombre_canonico string, categoria string"),
        "marts.dim_cliente": spark.createDataFrame(
            [("c1", "GUEST", False)], "cliente_key string, customer_id string, es_cliente_identificado boolean"),
        "marts.dim_tiempo": spark.createDataFrame(
            [("2010-01-01", dt.date(2010, 1, 1), 2010, 1)], "tiempo_key string, fecha date, anio int, mes int"),
        "marts.dim_pais": spark.createDataFrame([("n1", "FRANCE")], "pais_key string, nombre_pais string"),
        "marts.fact_ventas": spark.createDataFrame(
            [("t1", "p1", "c1", "2010-01-01", "n1", 1.0), ("t2", "p9", "c1", "2010-01-01", "nX", 1.0)],
            "transaction_key string, producto_key string, cliente_key string, tiempo_key string, "
            "pais_key string, revenue_bruto double"),
        "marts.fact_devoluciones": spark.createDataFrame(
            [("t1", "p1", "c1", "2010-01-01", None, None)],
            "transaction_key string, producto_key string, cliente_key string, tiempo_key string, "
            "pais_key string, revenue_devolucion double"),
        "marts.mart_revenue_producto": spark.createDataFrame([(1.0,)], "revenue_neto double"),
    }
    return t.__getitem__


def _failures(df):
    return {(r.table_name, r.column_name): r.failures for r in df.collect() if r.failures}


def test_not_null_flags(spark):
    got = _failures(quality.not_null(_tables(spark)))
    assert got == {("staging.stg_ecommerce", "invoice_no"): 1, ("staging.stg_ecommerce", "stock_code"): 1,
                   ("staging.stg_transactions_unified", "quantity"): 1,
                   ("marts.fact_devoluciones", "pais_key"): 1,
                   ("marts.fact_devoluciones", "revenue_devolucion"): 1}


def test_unique_flags(spark):
    got = _failures(quality.unique(_tables(spark)))
    assert got == {("staging.stg_transactions_unified", "transaction_key"): 1,
                   ("marts.dim_producto", "producto_key"): 1}


def test_accepted_values_flags(spark):
    got = _failures(quality.accepted_values(_tables(spark)))
    assert got == {("staging.stg_ecommerce", "transaction_type"): 1,
                   ("staging.stg_transactions_unified", "transaction_type"): 1}


def test_relationships_flags(spark):
    got = _failures(quality.relationships(_tables(spark)))
    assert got == {("marts.fact_ventas", "producto_key"): 1, ("marts.fact_ventas", "pais_key"): 1}


def test_key_gates_raise(spark):
    t = _tables(spark)
    pk = _failures(quality.primary_keys(t))
    assert pk == {("marts.dim_producto", "producto_key"): 1}
    with pytest.raises(quality.DataQualityError):
        quality.enforce(quality.foreign_keys(t))


def test_digests_that_collide_are_no_duplicates(spark):
    """However badly the digest mixes values, only equal values count."""
    import random
    from collections import Counter

    from pyspark.sql import functions as F

    r = random.Random(3)
    values = [r.choice([None, *map(str, range(60))]) for _ in range(70)] + [f"only{i}" for i in range(40)] + ["hot"] * 200
    df = spark.createDataFrame([(v, str(i)) for i, v in enumerate(values)], "a string, b string")
    checks = (("t", "a"), ("t", "b"))
    count = Counter(v for v in values if v is not None)
    twice, extra = sum(n > 1 for n in count.values()), sum(n - 1 for n in count.values()) + values.count(None)
    for of in (quality.digest, lambda c: F.when(c.isNotNull(), F.length(c).cast("bigint")), lambda c: F.when(c.isNotNull(), F.lit(1).cast("bigint"))):
        assert _failures(quality.unique({"t": df}.__getitem__, checks, of)) == {("t", "a"): twice}
        assert _failures(quality.primary_keys({"t": df}.__getitem__, checks, of)) == {("t", "a"): extra}
    clean = {"t": df.select("b", F.col("b").alias("a"))}.__getitem__
    assert [r.failures for r in quality.unique(clean, checks).collect()] == [0, 0] == [r.failures for r in quality.primary_keys(clean, checks).collect()]
    none = {"t": df.limit(0)}.__getitem__
    assert [tuple(r) for r in quality.unique(none, checks).orderBy("column_name").collect()] == [("t", "a", "unique", 0), ("t", "b", "unique", 0)]
