"""Exact, half-away-from-zero rounded ratios.

Double division misrounds ties (2328061.57 / 2 = 1164030.785 must round to
.79). Both operands are cast to decimals wide enough that Spark keeps at
least 12 fractional digits in the quotient, then ``round`` (HALF_UP) is
applied. The result stays a decimal; callers turn it into a double only when
presenting it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_ratio(num: Column, den: Column, scale: int, *, percent: bool = False,
                den_is_money: bool = False, zero_as: int | None = None) -> Column:
    """ROUND(num / den [* 100], scale) as decimal(30, scale).

    ``den`` = 0 gives NULL (NULLIF semantics), or ``zero_as`` when given.
    ``num`` may be an integer count or a money decimal with <= 4 decimals.
    """
    out_type = f"decimal(30,{scale})"
    n = num.cast("decimal(24,4)")
    if percent:
        n = (n * F.lit(100)).cast("decimal(26,4)")
    d = den.cast("decimal(24,4)") if den_is_money else den.cast("decimal(20,0)")
    q = F.round(n / d, scale).cast(out_type)
    fallback = F.lit(zero_as) if zero_as is not None else F.lit(None)
    return F.when(den == F.lit(0), fallback.cast(out_type)).otherwise(q)
