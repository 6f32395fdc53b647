"""Staging: typed per-feed views and the unified, de-duplicated lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.numbers import safe_integer, safe_numeric
from ledgerline.functions.text import (
    blank_to_null,
    customer_or_guest,
    normalize_code,
    normalize_description,
)
from ledgerline.functions.timestamps import minute_number, minute_text, parse_feed_timestamp
from ledgerline.sources.feeds import FEEDS, FeedSpec

REQUIRED_COLUMNS = ("invoice_no", "stock_code", "quantity", "invoice_date_utc", "unit_price")
DEDUPE_KEYS = ("invoice_no", "stock_code", "_minute")
UNIFIED_COLUMNS = (
    "transaction_key", "invoice_no", "stock_code", "description", "quantity",
    "invoice_date_utc", "unit_price", "revenue_bruto", "customer_id", "country",
    "transaction_type", "source_file",
)

# Transaction types.
SALE, RETURN = "VENTA", "DEVOLUCION"


def classify_transaction(quantity):
    """NULL quantity -> NULL; <= 0 -> DEVOLUCION; else VENTA."""
    return (
        F.when(quantity.isNull(), F.lit(None).cast("string"))
        .when(quantity <= 0, F.lit(RETURN))
        .otherwise(F.lit(SALE))
    )


def stage_feed(raw: DataFrame, spec: FeedSpec) -> DataFrame:
    """Typed, cleaned lines of one feed. Drops only lines with a blank
    invoice or stock code; unparseable fields become NULL."""
    inv, stock = F.col(spec.invoice_column), F.col("stock_code")
    qty = safe_integer(F.col("quantity"))
    return (
        raw.filter(blank_to_null(inv).isNotNull() & blank_to_null(stock).isNotNull())
        .select(
            normalize_code(inv).alias("invoice_no"),
            normalize_code(stock).alias("stock_code"),
            normalize_description(F.col("description")).alias("description"),
            qty.alias("quantity"),
            parse_feed_timestamp(F.col("invoice_date"), spec.date_layout).alias("invoice_date_utc"),
            safe_numeric(F.col(spec.price_column)).alias("unit_price"),
            customer_or_guest(F.col("customer_id")).alias("customer_id"),
            normalize_description(F.col("country")).alias("country"),
            classify_transaction(qty).alias("transaction_type"),
            F.lit(spec.name).alias("source_file"),
        )
    )


def required_fields_filter(staged: DataFrame) -> DataFrame:
    return staged.dropna(subset=list(REQUIRED_COLUMNS))


def tag_sources(staged_by_priority: list[tuple[DataFrame, int]]) -> DataFrame:
    """UNION ALL of the feeds, each tagged with its priority."""
    out = None
    for df, priority in staged_by_priority:
        tagged = df.withColumn("source_priority", F.lit(priority))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def union_sources(staged_by_priority: list[tuple[DataFrame, int]]) -> DataFrame:
    """:func:`tag_sources` of the feeds' complete lines."""
    return tag_sources([(required_fields_filter(df), priority) for df, priority in staged_by_priority])


_TIE_BREAK = ("source_priority", "invoice_date_utc", "quantity", "unit_price",
              "customer_id", "country", "description")


def dedupe_transactions(unioned: DataFrame, require: tuple[str, ...] = ()) -> DataFrame:
    """Keep one line per (invoice, stock code, minute): the higher-priority
    source, then the earliest timestamp; remaining ties are broken by the
    other columns so reruns pick the same line.

    ``row_number() == 1`` is planned with a partial WindowGroupLimit before
    the shuffle, so a key repeated millions of times is cut to one row per
    map task before it is exchanged.

    ``require``: columns that must be non-NULL. Filtering them out first and
    ranking the rest is the same as ranking complete rows ahead of
    incomplete ones and keeping the first row only if it is complete; the
    latter keeps the test above the window, where the optimizer cannot copy
    the parsing expressions into a pushed-down filter and evaluate them twice.

    The minute is shuffled as a number; its text is that of the lines kept.
    """
    keyed = unioned.withColumn("_minute", minute_number(F.col("invoice_date_utc")))
    order = [F.col(c).asc_nulls_last() for c in _TIE_BREAK]
    keep = F.col("_rn") == 1
    if require:
        complete = F.lit(True)
        for c in require:
            complete = complete & F.col(c).isNotNull()
        keyed = keyed.withColumn("_complete", complete)
        order = [F.col("_complete").desc()] + order
        keep = keep & F.col("_complete")
    w = Window.partitionBy(*DEDUPE_KEYS).orderBy(*order)
    out = keyed.withColumn("_rn", F.row_number().over(w)).filter(keep).drop("_rn", "_minute")
    out = out.withColumn("dedupe_minute", minute_text(F.col("invoice_date_utc")))
    return out.drop("_complete") if require else out


def transaction_key(deduped: DataFrame) -> DataFrame:
    """MD5 of invoice|stock|minute|customer|country."""
    key = F.md5(F.concat(
        F.col("invoice_no"), F.lit("|"), F.col("stock_code"), F.lit("|"),
        F.col("dedupe_minute"), F.lit("|"),
        F.coalesce(F.col("customer_id"), F.lit("GUEST")), F.lit("|"),
        F.coalesce(F.col("country"), F.lit("")),
    ))
    return deduped.withColumn("transaction_key", key)


def unified_transactions(staged_by_priority: list[tuple[DataFrame, int]]) -> DataFrame:
    """Required-field filter, union, de-duplication, key and revenue, with
    the required-field test fused into the de-duplication window. What the
    quantity and the priority tell is not shuffled but set for the lines kept."""
    narrow = [(df.drop("transaction_type", "source_file"), priority) for df, priority in staged_by_priority]
    deduped = dedupe_transactions(tag_sources(narrow), require=REQUIRED_COLUMNS)
    source = F.lit(None).cast("string")
    for spec in FEEDS:
        source = F.when(F.col("source_priority") == spec.priority, F.lit(spec.name)).otherwise(source)
    return transaction_key(deduped).select(
        *UNIFIED_COLUMNS[:7],
        (F.col("quantity") * F.col("unit_price")).alias("revenue_bruto"),
        "customer_id", "country",
        classify_transaction(F.col("quantity")).alias("transaction_type"),
        source.alias("source_file"),
    )
