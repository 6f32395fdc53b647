"""Digest keys as bytes while they are shuffled.

A key of the star schema is an MD5 digest in hexadecimal, which Spark's
shuffle compression (LZ4) leaves as long as it is. As bytes it takes half.
Any other text is a key too and comes back as it was.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _mark(byte: int) -> Column:
    """Last byte of a packed key: 0 for a text's own bytes, 1 for those that
    its digits stand for."""
    return F.lit(bytes([byte]))


def pack_key(key: Column) -> Column:
    """Bytes of a text key, different for different keys; NULL for NULL."""
    digits = F.unhex(key)
    return (F.when(F.lower(F.hex(digits)) == key, F.concat(digits, _mark(1)))
            .otherwise(F.concat(key.cast("binary"), _mark(0))))


def unpack_key(packed: Column) -> Column:
    """The text that :func:`pack_key` was given."""
    body = F.substring(packed, F.lit(1), F.length(packed) - 1)
    return (F.when(F.substring(packed, -1, 1) == _mark(1), F.lower(F.hex(body)))
            .otherwise(body.cast("string")))
