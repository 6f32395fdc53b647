"""Column -> Column building blocks (all JVM-side built-ins, no UDFs)."""

from ledgerline.functions.text import (
    blank_to_null,
    customer_or_guest,
    normalize_code,
    normalize_description,
    trim_spaces,
)
from ledgerline.functions.numbers import (
    is_return_invoice,
    python_float_nonpositive,
    safe_integer,
    safe_numeric,
)
from ledgerline.functions.timestamps import minute_text, parse_feed_timestamp
from ledgerline.functions.ratios import round_ratio
from ledgerline.functions.categories import CATEGORY_RULES, categorize

__all__ = [
    "blank_to_null", "customer_or_guest", "normalize_code", "normalize_description",
    "trim_spaces", "is_return_invoice", "python_float_nonpositive", "safe_integer",
    "safe_numeric", "minute_text", "parse_feed_timestamp", "round_ratio",
    "CATEGORY_RULES", "categorize",
]
