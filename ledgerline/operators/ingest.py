"""Raw ingest: header mapping, missing-value tokens, quarantine split.

A feed frame (all STRING, CSV header names) becomes
  * ``cells``  -- raw column names, NA tokens and NULLs as NULL (what the
    quarantine record serialises), plus the ``is_rejected`` flag;
  * ``raw``    -- accepted rows, every missing cell stored as '';
  * ``rejects``-- quarantined rows as reject records.
The split is one boolean column: a load writes every row once, partitioned
by it (``split_rows``), and takes the reject records from the small part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.numbers import is_return_invoice, python_float_nonpositive
from ledgerline.sources.feeds import NA_TOKENS, RAW_FIELDS, FeedSpec

def feed_cells(frame: DataFrame, spec: FeedSpec) -> DataFrame:
    """Select the feed's columns by header name; a header missing from the
    file yields an all-missing column instead of an error."""
    present = set(frame.columns)
    cols = []
    for field in RAW_FIELDS:
        header = spec.header_for(field)
        if header in present:
            c = frame[header].cast("string")
            c = F.when(c.isNull() | c.isin(*NA_TOKENS), F.lit(None).cast("string")).otherwise(c)
        else:
            c = F.lit(None).cast("string")
        cols.append(c.alias(spec.raw_for(field)))
    return frame.select(*cols)


def flag_rejects(cells: DataFrame, spec: FeedSpec) -> DataFrame:
    """Add ``is_rejected``: the price parses as a number <= 0 and the invoice
    is not a return ('C...') invoice. Unparseable prices are kept."""
    rejected = python_float_nonpositive(F.col(spec.price_column)) & ~is_return_invoice(F.col(spec.invoice_column))
    return cells.withColumn("is_rejected", rejected)


def raw_rows(flagged: DataFrame, spec: FeedSpec) -> DataFrame:
    """Accepted rows with missing cells stored as '' (not NULL)."""
    return flagged.filter(~F.col("is_rejected")).select(
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in spec.raw_columns],
        F.lit(spec.name).alias("_source"),
    )


def split_rows(flagged: DataFrame, spec: FeedSpec) -> DataFrame:
    """Every row as a load stores it, with ``is_rejected``: accepted rows as in
    :func:`raw_rows`, rejected ones as they came (a missing cell is NULL)."""
    cells = [F.when(F.col("is_rejected"), F.col(c)).otherwise(F.coalesce(F.col(c), F.lit(""))).alias(c)
             for c in spec.raw_columns]
    return flagged.select(*cells, F.lit(spec.name).alias("_source"), "is_rejected")


# The two-character escapes of a JSON string, as Python's json
# module writes them; every other character below space, and everything from
# DEL up, is written as a lowercase \uXXXX escape (surrogate pairs above U+FFFF).
_SHORT_ESCAPES = (('"', '\\"'), ("\\", "\\\\"), ("\b", "\\b"), ("\f", "\\f"),
                  ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"))


def _u(code: Column) -> Column:
    return F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(code)), 4, "0"))


def _escape_char(ch: Column) -> Column:
    code = F.ascii(ch)                      # code point of the character
    out = None
    for raw, esc in _SHORT_ESCAPES:
        out = F.when(ch == F.lit(raw), F.lit(esc)) if out is None else out.when(ch == F.lit(raw), F.lit(esc))
    astral = code - F.lit(0x10000)
    pair = F.concat(_u(F.lit(0xD800) + F.shiftright(astral, 10)), _u(F.lit(0xDC00) + astral.bitwiseAND(0x3FF)))
    return (out.when((code >= 32) & (code < 127), ch)
            .when(code < 0x10000, _u(code))
            .otherwise(pair))


def _json_value(c: Column) -> Column:
    """JSON text of one string cell with ASCII-only output ("..." or null)."""
    body = F.array_join(F.transform(F.split(c, ""), _escape_char), "")
    return (F.when(c.isNull(), F.lit("null"))
            .when(c == F.lit(""), F.lit('""'))
            .otherwise(F.concat(F.lit('"'), body, F.lit('"'))))


def row_json(columns) -> Column:
    """The row as a JSON object in the original loader's layout and escaping:
    {"key": "value", "key2": null} -- ', ' and ': ' separators, columns in raw
    order, missing cells as null, non-ASCII text as \\u escapes."""
    fields = [F.concat(F.lit(f'"{c}": '), _json_value(F.col(c))) for c in columns]
    return F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}"))


def reject_records(flagged: DataFrame, spec: FeedSpec) -> DataFrame:
    """Quarantine records: source, invoice, stock code, reason and the row
    as JSON (missing cells as null)."""
    return flagged.filter(F.col("is_rejected")).select(
        F.lit(spec.name).alias("source_table"),
        F.col(spec.invoice_column).alias("invoice_no"),
        F.col("stock_code"),
        F.lit(spec.reject_reason).alias("rejection_reason"),
        row_json(spec.raw_columns).alias("raw_row"),
    )


def load_counters(flagged: DataFrame, spec: FeedSpec) -> DataFrame:
    """One row per feed: rows loaded into raw and rows quarantined."""
    rej = F.col("is_rejected")
    return flagged.agg(
        F.count_if(~rej).alias("loaded"),
        F.count_if(rej).alias("rejected"),
    ).select(F.lit(spec.name).alias("source_table"), "loaded", "rejected")
