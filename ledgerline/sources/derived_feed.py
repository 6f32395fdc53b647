"""Retail order feeds derived from the driver's TPC-H-style tables.

lineitem ⋈ orders ⋈ part ⋈ customer ⋈ nation gives one order line per
lineitem row. Every row lands in feed A (even order keys and multiples of 5)
or feed B (odd order keys) -- odd multiples of 5 in both, which exercises
cross-source de-duplication. The text columns are built so that the cleaning
rules have something to do: case and spacing variants, return invoices,
blank customers, unparseable quantities and dates, zero and comma prices.

The frames come out exactly like a CSV scan would: all STRING, named by the
feed's CSV headers, so the same ingest path handles both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.feeds import ECOMMERCE, ONLINE_RETAIL, FeedSpec
from ledgerline.sources.tables import read_table, spread

# Fixed values of the fixture recipe: word appended to the product name by
# part key modulo 7.
_SUFFIX_BY_PART_MOD7 = (" lamp", " Bag", " clock", " HEART", " postage", " heart box", "")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joined order lines with only the columns the feeds need.

    The joins are left to the planner: a side is broadcast only when its
    size (file statistics, then AQE's measured shuffle size) is under the
    threshold, otherwise it is a sort-merge join whose hot keys AQE splits.
    lineitem is spread over the cores when its scan yields too few splits.
    Orders meet their customers and nations before the lines, which so go
    through two joins, not four. The orders come last: an order's lines are
    then side by side, and the written feeds and raw tables smaller.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag")
    li = spread(li)
    li = li.select("*", (F.col("l_returnflag") == F.lit("R")).alias("is_return")).drop("l_returnflag")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    pt = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    na = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customers = cu.join(na, cu.c_nationkey == na.n_nationkey).select("c_custkey", "n_name")
    orders = od.join(customers, od.o_custkey == customers.c_custkey).select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_day"), "n_name")
    return li.join(pt, li.l_partkey == pt.p_partkey).join(orders, li.l_orderkey == orders.o_orderkey)


def _text(c: Column) -> Column:
    return c.cast("string")


def _lpad2(c: Column) -> Column:
    return F.lpad(_text(c), 2, "0")


def _when(cond: Column, a, b) -> Column:
    a = F.lit(a) if isinstance(a, str) else a
    b = F.lit(b) if isinstance(b, str) else b
    return F.when(cond, a).otherwise(b)


def _feed_columns(spec: FeedSpec) -> list[Column]:
    k, p, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    is_r = F.col("is_return")

    invoice = F.concat(_when(is_r, "c", ""), _text(k), _when(k % 11 == 0, " ", ""))
    stock = F.concat(_when(ln % 2 == 0, "p", " P"), _text(p))

    name = F.col("p_name")
    name_variant = (
        F.when(ln % 3 == 0, name)
        .when(ln % 3 == 1, F.upper(name))
        .otherwise(F.concat(F.lit("  "), F.replace(name, F.lit(" "), F.lit("   "))))
    )
    suffix = F.element_at(F.array(*[F.lit(s) for s in _SUFFIX_BY_PART_MOD7]), (p % 7 + 1).cast("int"))
    type_tail = _when(ln == 7, F.concat(F.lit(" "), F.col("p_type")), "")
    description = _when(k % 17 == 0, "", F.concat(name_variant, suffix, type_tail))

    quantity = _when(
        k % 101 == 0, "n/k",
        F.concat(_when(is_r, "-", ""), _text(F.col("l_quantity").cast("int")), _when(ln == 3, ".0", "")),
    )

    od = F.col("o_day")
    hh, mm = k % 24, k % 60
    if spec.date_layout == "mdy_hm":
        stamp = F.concat_ws("", _text(F.month(od)), F.lit("/"), _text(F.dayofmonth(od)), F.lit("/"),
                            _text(F.year(od)), F.lit(" "), _text(hh), F.lit(":"), _lpad2(mm))
    else:
        stamp = F.concat_ws("", _text(F.year(od)), F.lit("-"), _lpad2(F.month(od)), F.lit("-"),
                            _lpad2(F.dayofmonth(od)), F.lit(" "), _lpad2(hh), F.lit(":"),
                            _lpad2(mm), F.lit(":"), _lpad2(ln * 7))
    invoice_date = _when(k % 211 == 0, "unknown", stamp)

    price = (
        F.when((p + k) % 50 == 0, F.lit("0.00"))
        .when(k % 103 == 0, F.lit("1,234.50"))
        .otherwise(_text(F.col("l_extendedprice").cast("decimal(18,2)")))
    )
    customer = _when(F.col("o_custkey") % 10 == 0, "", _text(F.col("o_custkey")))
    country = _when(ln == 5, F.concat(F.lower(F.col("n_name")), F.lit(" ")), F.col("n_name"))

    values = (invoice, stock, description, quantity, invoice_date, price, customer, country)
    return [v.alias(h) for v, h in zip(values, spec.headers)]


def derive_feed(lines: DataFrame, spec: FeedSpec) -> DataFrame:
    k = F.col("l_orderkey")
    if spec is ECOMMERCE:
        selected = lines.filter((k % 2 == 0) | (k % 5 == 0))
    elif spec is ONLINE_RETAIL:
        selected = lines.filter(k % 2 == 1)
    else:
        raise ValueError(f"no derivation rule for feed {spec.name}")
    return selected.select(*_feed_columns(spec))


def derived_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    lines = order_lines(spark, sf_dir)
    return {spec.name: derive_feed(lines, spec) for spec in (ECOMMERCE, ONLINE_RETAIL)}
