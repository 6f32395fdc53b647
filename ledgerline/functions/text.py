"""Text cleaning: code / description / country normalisation, guest default."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as the SQL `\s` class defines it (space, tab, LF, VT, FF, CR),
# spelled out so every regex engine agrees on it.
WS = r"[ \t\n\x0B\f\r]"


def trim_spaces(c: Column) -> Column:
    """Trim spaces at both ends (only the space character, like BTRIM)."""
    return F.trim(c)


def blank_to_null(c: Column) -> Column:
    """NULL when the value is NULL or only spaces, else the trimmed text."""
    t = trim_spaces(c)
    return F.when(t == F.lit(""), F.lit(None).cast("string")).otherwise(t)


def normalize_code(c: Column) -> Column:
    """Invoice / stock code: trim, delete every whitespace run, upper-case."""
    return F.upper(F.regexp_replace(trim_spaces(c), WS + "+", ""))


def normalize_description(c: Column) -> Column:
    """Free text (description, country): trim, collapse whitespace runs to
    one space, upper-case."""
    return F.upper(F.regexp_replace(trim_spaces(c), WS + "+", " "))


# Fixed value: the customer id given to lines without one.
GUEST = "GUEST"


def customer_or_guest(c: Column) -> Column:
    """Trimmed customer id, or GUEST when blank. Only trimmed: no case or
    '.0' normalisation."""
    return F.coalesce(blank_to_null(c), F.lit(GUEST))
