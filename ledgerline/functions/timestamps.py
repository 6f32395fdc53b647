"""Guarded timestamp parsing for the two feed date layouts.

Timestamps are cast as TIMESTAMP_NTZ from the matched text, so the
result is the UTC wall clock regardless of the session time zone, and an
impossible date that passes the shape check (13/45/2010) becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.text import trim_spaces

# layout -> (shape regex, the same instant as year-month-day text)
_LAYOUTS = {
    "mdy_hm": (r"\A(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}):(\d{2})\z", "$3-$1-$2 $4:$5:00"),
    "iso_hms": (r"\A\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z", None),
}


def parse_feed_timestamp(c: Column, layout: str) -> Column:
    pattern, iso = _LAYOUTS[layout]
    t = trim_spaces(c)
    # One cast of a text whose shape is checked: impossible days and times
    # give NULL, and nothing is taken apart field by field.
    text = t if iso is None else F.regexp_replace(t, pattern, iso)
    return F.when(t.rlike(pattern), text.try_cast("timestamp_ntz")).otherwise(F.lit(None).cast("timestamp_ntz"))


def minute_number(ts: Column) -> Column:
    """Minutes from 1970 to the timestamp truncated to the minute: the same
    for the timestamps of one :func:`minute_text`; NULL for NULL."""
    at = ts.cast("timestamp_ntz")
    return F.unix_date(F.to_date(at)) * F.lit(1440).cast("bigint") + F.hour(at) * 60 + F.minute(at)


def minute_text(ts: Column) -> Column:
    """'yyyy-MM-dd HH:mm:00' text of the timestamp truncated to the minute
    (the text form of a minute-truncated timestamp without time zone); NULL
    for NULL."""
    return F.concat(F.substring(ts.cast("timestamp_ntz").cast("string"), 1, 16), F.lit(":00"))
