"""Product/day/country revenue mart.

Both facts are aggregated on the same three keys before they meet, so the
full outer join consumes two inputs that are already hash-partitioned on
those keys and adds no exchange of its own. On the way the keys that are
digests are bytes (:func:`byte_keys`), and of written facts the sales are
shuffled by their keys at once (:func:`merged_by_day`), or both facts by
product if the products are too many to be broadcast (:func:`merged_by_product`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.keys import pack_key, unpack_key
from ledgerline.functions.ratios import round_ratio
from ledgerline.operators.joins import join_dimension, may_broadcast

MART_KEYS = ("producto_key", "tiempo_key", "pais_key")
DIGEST_KEYS = ("producto_key", "pais_key")
# Keys are weighed together in so many buckets of their hash for each shuffle
# partition. A bucket of more lines than a mean partition is heavy, but none
# of so few that a task has them in a moment.
BUCKETS, LIGHT_LINES = 32, 100_000
# With "false" a join is planned on inputs that are partitioned by some of its
# keys. It guards against few values of these, which weighing does here.
CO_PARTITION_CONF = "spark.sql.requireAllClusterKeysForCoPartition"
PRODUCT_COLUMNS = ("codigo_producto", "nombre_canonico", "categoria")
MART_COLUMNS = (
    "codigo_producto", "nombre_canonico", "categoria", "fecha", "anio_mes", "anio",
    "mes", "trimestre", "nombre_pais", "cantidad_vendida", "revenue_ventas",
    "num_facturas", "cantidad_devuelta", "revenue_devoluciones", "revenue_neto",
    "tasa_devolucion", "ticket_promedio",
)


def byte_keys(facts: DataFrame) -> DataFrame:
    return facts.withColumns({k: pack_key(F.col(k)) for k in DIGEST_KEYS})


def text_keys(rollup: DataFrame) -> DataFrame:
    """Undoes :func:`byte_keys`."""
    return rollup.withColumns({k: unpack_key(F.col(k)) for k in DIGEST_KEYS})


def sales_by_day(ventas: DataFrame) -> DataFrame:
    """Distinct invoices are counted per (product, day, country). Spark
    expands the distinct count into a (keys, invoice) aggregate first, so a
    hot key is spread over invoices before the final merge."""
    return ventas.groupBy(*MART_KEYS).agg(
        F.sum("cantidad").alias("cantidad_vendida"),
        F.sum("revenue_bruto").alias("revenue_ventas"),
        F.countDistinct("invoice_no").alias("num_facturas"),
    )


def returns_by_day(devoluciones: DataFrame) -> DataFrame:
    return devoluciones.groupBy(*MART_KEYS).agg(
        F.sum("cantidad_devuelta").alias("cantidad_devuelta"),
        F.sum("revenue_devolucion").alias("revenue_devoluciones"),
    )


def sales_returns_merge(sales: DataFrame, returns: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """FULL OUTER JOIN on the three keys; missing measures become 0. Rows
    with a NULL key never match (SQL equality) and stay separate. ``carry``:
    columns of both sides that hang on the keys."""
    s, r = sales.alias("s"), returns.alias("r")
    cond = [F.col(f"s.{k}") == F.col(f"r.{k}") for k in MART_KEYS]
    joined = s.join(r, on=cond, how="full")
    zero_money = F.lit(0).cast("decimal(38,4)")
    return joined.select(
        *[F.coalesce(F.col(f"s.{k}"), F.col(f"r.{k}")).alias(k) for k in MART_KEYS],
        F.coalesce(F.col("s.cantidad_vendida"), F.lit(0).cast("bigint")).alias("cantidad_vendida"),
        F.coalesce(F.col("s.revenue_ventas"), zero_money).alias("revenue_ventas"),
        F.coalesce(F.col("s.num_facturas"), F.lit(0).cast("bigint")).alias("num_facturas"),
        F.coalesce(F.col("r.cantidad_devuelta"), F.lit(0).cast("bigint")).alias("cantidad_devuelta"),
        F.coalesce(F.col("r.revenue_devoluciones"), zero_money).alias("revenue_devoluciones"),
        *[F.coalesce(F.col(f"s.{c}"), F.col(f"r.{c}")).alias(c) for c in carry],
    )


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def heavy_buckets(lines: DataFrame, keys: tuple[str, ...] = MART_KEYS) -> list[int]:
    """The heavy buckets of the ``keys`` of written lines: fewer than there
    are partitions. All lines are counted; a row for each task and bucket is
    shuffled."""
    most = max(lines.count() // _partitions(lines), LIGHT_LINES)
    counted = lines.groupBy(_bucket(lines, keys).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return [row.bucket for row in counted.where(F.col("n") > most).collect()]


def _bucket(rows: DataFrame, keys: tuple[str, ...] = MART_KEYS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS * _partitions(rows)))


def _sold(ventas: DataFrame) -> DataFrame:
    return byte_keys(ventas.select(*MART_KEYS, "invoice_no", "cantidad", "revenue_bruto"))


def _returned(devoluciones: DataFrame) -> DataFrame:
    return byte_keys(devoluciones.select(*MART_KEYS, "cantidad_devuelta", "revenue_devolucion"))


def merged_by_day(ventas: DataFrame, devoluciones: DataFrame, heavy: list[int] | None = None) -> DataFrame:
    """:func:`sales_returns_merge` of the two rollups, its digest keys as bytes.

    ``heavy`` (None: not known, any key may be): sales of other keys than
    those in these buckets are shuffled by their keys before they are counted,
    and not first by key and invoice and then again by key. Heavy keys, which
    one task should not have, go the longer way."""
    def merged(sold: DataFrame, returned: DataFrame, by_key: bool) -> DataFrame:
        sold = _sold(sold).repartition(*MART_KEYS) if by_key else _sold(sold)
        return sales_returns_merge(sales_by_day(sold), returns_by_day(_returned(returned)))
    if not heavy:
        return merged(ventas, devoluciones, by_key=heavy is not None)
    v, d = (_bucket(facts).isin(heavy) for facts in (ventas, devoluciones))
    return merged(ventas.where(~v), devoluciones.where(~d), True).unionByName(merged(ventas.where(v), devoluciones.where(d), False))


def merged_by_product(ventas: DataFrame, devoluciones: DataFrame, prod: DataFrame) -> DataFrame:
    """:func:`merged_by_day` with the products' columns. Written facts are
    shuffled once, by product: rollups, products and merge (CO_PARTITION_CONF)
    need no other exchange. Products of heavy buckets go the longer way."""
    key = ("producto_key",)
    heavy = heavy_buckets(ventas.select(*key).unionByName(devoluciones.select(*key)), key)
    v, d, p = ((_bucket(rows, key).isin(heavy) if heavy else F.lit(False)) for rows in (ventas, devoluciones, prod))
    sides = (sales_by_day(_sold(ventas.where(~v)).repartition(*key)), returns_by_day(_returned(devoluciones.where(~d)).repartition(*key)))
    light = sales_returns_merge(*[join_dimension(side, prod, *key, key=pack_key) for side in sides], carry=PRODUCT_COLUMNS)
    if not heavy:
        return light
    return light.unionByName(join_dimension(merged_by_day(ventas.where(v), devoluciones.where(d)), prod.where(p), *key, key=pack_key))


def mart_revenue_producto(ventas: DataFrame, devoluciones: DataFrame, dim_prod: DataFrame,
                          dim_time: DataFrame, dim_country: DataFrame,
                          dim_rows: dict[str, int] | None = None, written: bool = False) -> DataFrame:
    """``written``: the facts are written tables, whose keys are weighed."""
    dim_rows = dim_rows or {}
    prod = dim_prod.select("producto_key", *PRODUCT_COLUMNS)
    time = dim_time.select("tiempo_key", "fecha", "anio_mes", "anio", "mes", "trimestre")
    country = dim_country.select("pais_key", "nombre_pais")
    n = dim_rows.get("dim_producto")
    if written and not may_broadcast(ventas, prod, n) and ventas.sparkSession.conf.get(CO_PARTITION_CONF) == "false":
        j = merged_by_product(ventas, devoluciones, prod)
    else:
        base = merged_by_day(ventas, devoluciones, heavy_buckets(ventas) if written else None)
        j = join_dimension(base, prod, "producto_key", dim_rows=n, key=pack_key)
    j = join_dimension(j, time, "tiempo_key", dim_rows=dim_rows.get("dim_tiempo"))
    j = join_dimension(j, country, "pais_key", dim_rows=dim_rows.get("dim_pais"), key=pack_key)
    sold, returned = F.col("cantidad_vendida"), F.col("cantidad_devuelta")
    return j.select(
        *MART_COLUMNS[:14],
        (F.col("revenue_ventas") - F.col("revenue_devoluciones")).alias("revenue_neto"),
        round_ratio(returned, sold, 4, zero_as=0).alias("tasa_devolucion"),
        round_ratio(F.col("revenue_ventas"), F.col("num_facturas"), 2, zero_as=0).alias("ticket_promedio"),
    )
