"""Tolerant numeric parsing.

All parsers use full-string anchors (\\A ... \\z): Java's `$` also matches
before a trailing newline, which would let '6\\n' through.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.text import trim_spaces

# Whitespace Python's float() and str.strip() remove: every character for
# which str.isspace() holds, as the plain character set btrim() takes.
PY_WS_CHARS = "".join(map(chr, filter(lambda c: chr(c).isspace(), range(0x10000))))
_DIGITS = r"\d(?:_?\d)*"                      # digits, single '_' between them
_PY_FLOAT = (
    rf"\A[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})"
    rf"(?:[eE][+-]?{_DIGITS})?\z"
)
_NEG_INFINITY = r"(?i)\A-(?:inf|infinity)\z"


def python_float_nonpositive(c: Column) -> Column:
    """True when the text parses as a float (the grammar of Python's
    ``float()``: surrounding whitespace, sign, '_' digit groups, exponent,
    inf/nan words) and the value is <= 0. Unparseable text, NaN and +inf give
    False; NULL gives False."""
    s = F.btrim(F.coalesce(c, F.lit("")), F.lit(PY_WS_CHARS))
    numeric = s.rlike(_PY_FLOAT)
    value = F.replace(s, F.lit("_"), F.lit("")).try_cast("double")
    return F.coalesce(
        (numeric & (value <= F.lit(0.0))) | s.rlike(_NEG_INFINITY),
        F.lit(False),
    )


def is_return_invoice(c: Column) -> Column:
    """Invoice text whose upper-cased, stripped form starts with 'C'."""
    return F.upper(F.btrim(F.coalesce(c, F.lit("")), F.lit(PY_WS_CHARS))).startswith("C")


def safe_integer(c: Column) -> Column:
    """'12' / '-3' -> int; '6.0' / '6.000' -> 6; blank, '6.5', '+6', '6\\n'
    and out-of-range values -> NULL."""
    # One match: the integer part of '12' or '12.000'; '' (no match) -> NULL.
    return F.regexp_extract(trim_spaces(c), r"\A(-?\d+)(?:\.0+)?\z", 1).try_cast("int")


def safe_numeric(c: Column, precision: int = 18, scale: int = 4) -> Column:
    """Decimal text, thousands commas allowed ('1,234.50' -> 1234.5000),
    rounded half-up to ``scale``; anything else (exponents, blanks,
    overflow) -> NULL."""
    s = F.replace(trim_spaces(c), F.lit(","), F.lit(""))
    target = f"decimal({precision},{scale})"
    return (
        F.when(s.rlike(r"\A-?\d+(?:\.\d+)?\z"), s.try_cast(target))
        .otherwise(F.lit(None).cast(target))
    )
