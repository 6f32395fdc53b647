"""Declarative data-quality checks and the key gates.

Every check returns rows ``(table_name, column_name, check_name, failures)``
where ``failures`` is the number of rows (not_null, relationships,
foreign_key), distinct values (unique, accepted_values) or offending rows
(primary_key) the check flags. Checks aggregate before they shuffle: a
uniqueness test is a partial count per value, a relationship test first
collapses the child keys (so a hot key such as GUEST crosses the exchange
once per task) and then looks them up in the parent. Checks travel as their
numbers; the names come back with the result.

Uniqueness is decided by 64-bit digests: only numbers and digests are
shuffled, and whole values are read and compared only for digests that occur
more than once, so two values of one digest are never taken for a duplicate.
"""

from __future__ import annotations

import os
import uuid
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.session import ensure_checkpoint_dir

# The declared checks (table -> columns), as the original
# model declarations list them.
NOT_NULL = (
    ("staging.stg_ecommerce", ("invoice_no", "stock_code")),
    ("staging.stg_online_retail", ("invoice_no", "stock_code")),
    ("staging.stg_transactions_unified", ("transaction_key", "invoice_no", "stock_code",
                                          "quantity", "invoice_date_utc", "unit_price")),
    ("marts.dim_producto", ("producto_key", "codigo_producto", "nombre_canonico", "categoria")),
    ("marts.dim_cliente", ("cliente_key", "customer_id", "es_cliente_identificado")),
    ("marts.dim_tiempo", ("tiempo_key", "fecha", "anio", "mes")),
    ("marts.dim_pais", ("pais_key", "nombre_pais")),
    ("marts.fact_ventas", ("transaction_key", "producto_key", "cliente_key", "tiempo_key",
                           "pais_key", "revenue_bruto")),
    ("marts.fact_devoluciones", ("transaction_key", "producto_key", "cliente_key", "tiempo_key",
                                 "pais_key", "revenue_devolucion")),
    ("marts.mart_revenue_producto", ("revenue_neto",)),
)
UNIQUE = (
    ("staging.stg_transactions_unified", "transaction_key"),
    ("marts.dim_producto", "producto_key"),
    ("marts.dim_producto", "codigo_producto"),
    ("marts.dim_cliente", "cliente_key"),
    ("marts.dim_cliente", "customer_id"),
    ("marts.dim_tiempo", "tiempo_key"),
    ("marts.dim_tiempo", "fecha"),
    ("marts.dim_pais", "pais_key"),
    ("marts.dim_pais", "nombre_pais"),
    ("marts.fact_ventas", "transaction_key"),
    ("marts.fact_devoluciones", "transaction_key"),
)
ACCEPTED_VALUES = (
    ("staging.stg_ecommerce", "transaction_type", ("VENTA", "DEVOLUCION")),
    ("staging.stg_online_retail", "transaction_type", ("VENTA", "DEVOLUCION")),
    ("staging.stg_transactions_unified", "transaction_type", ("VENTA", "DEVOLUCION")),
)
RELATIONSHIPS = (
    ("marts.fact_ventas", "producto_key", "marts.dim_producto", "producto_key"),
    ("marts.fact_ventas", "cliente_key", "marts.dim_cliente", "cliente_key"),
    ("marts.fact_ventas", "tiempo_key", "marts.dim_tiempo", "tiempo_key"),
    ("marts.fact_ventas", "pais_key", "marts.dim_pais", "pais_key"),
    ("marts.fact_devoluciones", "producto_key", "marts.dim_producto", "producto_key"),
    ("marts.fact_devoluciones", "cliente_key", "marts.dim_cliente", "cliente_key"),
    ("marts.fact_devoluciones", "tiempo_key", "marts.dim_tiempo", "tiempo_key"),
    ("marts.fact_devoluciones", "pais_key", "marts.dim_pais", "pais_key"),
)
PRIMARY_KEYS = (
    ("marts.dim_producto", "producto_key"),
    ("marts.dim_cliente", "cliente_key"),
    ("marts.dim_tiempo", "tiempo_key"),
    ("marts.dim_pais", "pais_key"),
    ("marts.fact_ventas", "transaction_key"),
    ("marts.fact_devoluciones", "transaction_key"),
)

Lookup = Callable[[str], DataFrame]


class DataQualityError(RuntimeError):
    pass


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _scan_checks(table: Lookup, not_null_checks=(), accepted_checks=()) -> DataFrame:
    """not_null and accepted_values checks, one aggregate per table: NULL
    counts and distinct counts of disallowed values side by side, then
    unpivoted to one row per check."""
    per_table: dict[str, list] = {}
    for name, cols in not_null_checks:
        for c in cols:
            per_table.setdefault(name, []).append(("not_null", c, None))
    for name, c, allowed in accepted_checks:
        per_table.setdefault(name, []).append(("accepted_values", c, allowed))
    parts = []
    for name, items in per_table.items():
        aggs, labels = [], []
        for i, (check, c, allowed) in enumerate(items):
            if check == "not_null":
                aggs.append(F.count_if(F.col(c).isNull()).cast("bigint").alias(f"_{i}"))
            else:
                bad = F.when(F.col(c).isNotNull() & ~F.col(c).isin(*allowed), F.col(c))
                aggs.append(F.count_distinct(bad).cast("bigint").alias(f"_{i}"))
            labels.append((check, c))
        counts = table(name).agg(*aggs)
        rows = counts.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.lit(check).alias("check_name"), F.col(f"_{i}").alias("failures"))
            for i, (check, c) in enumerate(labels)])).alias("x"))
        parts.append(rows.select(F.lit(name).alias("table_name"), "x.column_name", "x.check_name", "x.failures"))
    return _union(parts)


def not_null(table: Lookup, checks=NOT_NULL) -> DataFrame:
    return _scan_checks(table, not_null_checks=checks)


def accepted_values(table: Lookup, checks=ACCEPTED_VALUES) -> DataFrame:
    """Distinct non-NULL values outside the accepted list."""
    return _scan_checks(table, accepted_checks=checks)


RESULT_SCHEMA = "table_name string, column_name string, check_name string, failures bigint"


def check_families(table: Lookup) -> dict[str, Callable[[], DataFrame]]:
    """The declared checks as three independent jobs, each built when called:
    column checks (not_null, accepted_values), uniqueness, relationships.
    Every table is scanned once per family that concerns it."""
    return {"columns": lambda: _scan_checks(table, NOT_NULL, ACCEPTED_VALUES),
            "unique": lambda: unique(table),
            "relationships": lambda: relationships(table)}


def declared_checks(table: Lookup) -> DataFrame:
    """All declared checks (not_null, unique, accepted_values, relationships)
    as one DataFrame, one row per check."""
    return _union([build() for build in check_families(table).values()])


def _by_table(checks) -> dict[str, list[tuple]]:
    """table -> [(number of the check, *the rest of it)]"""
    grouped: dict[str, list] = {}
    for number, (name, *rest) in enumerate(checks):
        grouped.setdefault(name, []).append((number, *rest))
    return grouped


def _exploded(df: DataFrame, rows: list[dict[str, Column]]) -> DataFrame:
    """Each of ``rows`` for every row of ``df``, from a single scan: a table
    is read once however many of its columns are checked."""
    return df.select(F.explode(F.array(*[F.struct(*[c.alias(n) for n, c in r.items()]) for r in rows])).alias("x")).select("x.*")


def _complete(found: DataFrame, checks, check_name: str) -> DataFrame:
    """One row per declared check from (id, failures): checks with nothing
    flagged (or on an empty table) get failures = 0."""
    zeros = found.sparkSession.range(len(checks)).select(F.col("id").cast("int"), F.lit(0).cast("bigint").alias("failures"))
    name = lambda at: F.get(F.array(*[F.lit(c[at]) for c in checks]), F.col("id"))
    return (found.select("id", F.col("failures").cast("bigint")).unionByName(zeros)
            .groupBy("id").agg(F.sum("failures").alias("failures"))
            .select(name(0).alias("table_name"), name(1).alias("column_name"), F.lit(check_name).alias("check_name"),
                    F.col("failures").cast("bigint").alias("failures")))


def digest(value: Column) -> Column:
    """64 bits of a value's text; null for null."""
    return F.when(value.isNotNull(), F.xxhash64(value.cast("string")))


def _repeated(table: Lookup, checks, of: Callable[[Column], Column] = digest) -> tuple[DataFrame, DataFrame | None]:
    """The missing and the repeated values of every checked column: (id, n)
    for columns with nulls, and (id, k, n) for each value whose digest occurs
    more than once (None: there is no such digest)."""
    parts = [_exploded(table(name), [{"id": F.lit(i), "d": of(F.col(c))} for i, c in items])
             for name, items in _by_table(checks).items()]
    counted = _union(parts).groupBy("id", "d").agg(F.count(F.lit(1)).alias("n")).where("d is null or n > 1")
    spark = counted.sparkSession
    # written: what is looked at again is small, and the tables are not counted twice
    folder = os.path.join(ensure_checkpoint_dir(spark), "quality", uuid.uuid4().hex)
    counted.write.parquet(folder)
    counted = spark.read.parquet(folder)
    nulls, twice = counted.where("d is null").select("id", "n"), counted.where("d is not null").select("id", "d")
    if twice.limit(1).count() == 0:
        return nulls, None
    parts = [_exploded(table(name), [{"id": F.lit(i), "d": of(F.col(c)), "k": F.col(c).cast("string")} for i, c in items])
             for name, items in _by_table(checks).items()]
    values = _union(parts).join(twice, ["id", "d"], "left_semi")
    return nulls, values.groupBy("id", "k").agg(F.count(F.lit(1)).alias("n"))


def unique(table: Lookup, checks=UNIQUE, of: Callable[[Column], Column] = digest) -> DataFrame:
    """Distinct non-NULL values that occur more than once, per column."""
    nulls, values = _repeated(table, checks, of)
    found = nulls.select("id", F.lit(0).alias("failures")) if values is None else (
        values.groupBy("id").agg(F.count_if(F.col("n") > 1).alias("failures")))
    return _complete(found, checks, "unique")


def relationships(table: Lookup, checks=RELATIONSHIPS, check_name: str = "relationships") -> DataFrame:
    """Child rows whose non-NULL key is missing from the parent.

    Every child table is scanned once for all its foreign keys; child keys
    are combined per (check, key) before the shuffle, so a hot key (GUEST)
    crosses it once per task. All parents' keys are numbered and the whole
    check is one join.
    """
    parents = sorted({(pt, pc) for _, _, pt, pc in checks})
    children = [_exploded(table(name), [{"id": F.lit(i), "p": F.lit(parents.index((pt, pc))), "k": F.col(cc).cast("string")}
                                        for i, cc, pt, pc in items]) for name, items in _by_table(checks).items()]
    child_keys = (_union(children).filter(F.col("k").isNotNull())
                  .groupBy("id", "p", "k").agg(F.count(F.lit(1)).alias("n")))
    parent_keys = _union([table(pt).select(F.lit(i).alias("p"), F.col(pc).cast("string").alias("k"))
                          for i, (pt, pc) in enumerate(parents)]).withColumn("_hit", F.lit(True))
    # A left join plus IS NULL rather than a left-anti join: the optimizer
    # pushes anti joins below aggregates, which would shuffle every child
    # row (hot keys included) whenever the parents are too large to
    # broadcast; an outer join stays above the child-key aggregation.
    missing = child_keys.join(parent_keys, on=["p", "k"], how="left").filter(F.col("_hit").isNull())
    return _complete(missing.groupBy("id").agg(F.sum("n").alias("failures")), checks, check_name)


def primary_keys(table: Lookup, checks=PRIMARY_KEYS, of: Callable[[Column], Column] = digest) -> DataFrame:
    """Rows that break a primary key: NULL keys plus every extra copy of a
    duplicated key."""
    nulls, values = _repeated(table, checks, of)
    found = nulls.select("id", F.col("n").alias("failures"))
    if values is not None:
        found = found.unionByName(values.select("id", (F.col("n") - 1).alias("failures")))
    return _complete(found, checks, "primary_key")


def foreign_keys(table: Lookup, checks=RELATIONSHIPS) -> DataFrame:
    return relationships(table, checks, check_name="foreign_key")


def key_violations(declared: DataFrame) -> DataFrame:
    """Primary/foreign-key violations read off the declared checks: every
    primary key is declared not_null and unique, and every foreign key is a
    relationships check, so the gates need no extra pass over the data."""
    pk = F.lit(False)
    for table, col in PRIMARY_KEYS:
        pk = pk | ((F.col("table_name") == table) & (F.col("column_name") == col))
    is_key = (pk & F.col("check_name").isin("not_null", "unique")) | (F.col("check_name") == "relationships")
    return declared.filter(is_key)


def enforce(results: DataFrame) -> list[tuple]:
    """Gate: raise when any check flags rows. ``results`` holds one row per
    check, so collecting it is bounded by the number of declared checks."""
    failing = [tuple(r) for r in results.filter(F.col("failures") > 0).collect()]
    if failing:
        raise DataQualityError(f"data-quality gate failed: {failing}")
    return failing
