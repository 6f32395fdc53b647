"""Dimension joins with a checked broadcast."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A dimension is broadcast only below this many rows (checked, not assumed).
# A product row is ~120 bytes hashed, so 1 M rows is ~120 MB per executor.
# Override per session with the conf key below.
BROADCAST_ROWS_CONF = "ledgerline.dimension.broadcastMaxRows"
DEFAULT_BROADCAST_ROWS = 1_000_000
# ... and only below this size by the planner's statistics (for a written
# table: the file bytes of the columns in use).
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def broadcast_row_cap(fact: DataFrame) -> int:
    return int(fact.sparkSession.conf.get(BROADCAST_ROWS_CONF, str(DEFAULT_BROADCAST_ROWS)))


def planned_bytes(df: DataFrame) -> int:
    """Size of ``df`` by the optimizer's statistics."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def may_broadcast(fact: DataFrame, dim: DataFrame, dim_rows: int | None, max_broadcast_rows: int | None = None) -> bool:
    cap = max_broadcast_rows if max_broadcast_rows is not None else broadcast_row_cap(fact)
    return dim_rows is not None and dim_rows <= cap and planned_bytes(dim) <= MAX_BROADCAST_BYTES


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "inner",
                   max_broadcast_rows: int | None = None,
                   dim_rows: int | None = None,
                   key: Callable[[Column], Column] | None = None) -> DataFrame:
    """Equi-join a (many-to-one) dimension. ``key``: what the fact holds for
    a key of the dimension, if not the key itself.

    When ``dim_rows`` is known (a materialised dimension, whose count comes
    from Parquet footers) and is under the cap, and the planner knows it to be under MAX_BROADCAST_BYTES,
    it is broadcast.
    Otherwise the join is left to the planner: AQE re-plans it as a
    broadcast from the measured shuffle size when that is small, and keeps a
    sort-merge join -- with skew-split of hot keys -- when it is not.
    """
    if may_broadcast(fact, dim, dim_rows, max_broadcast_rows):
        dim = F.broadcast(dim)
    if key is not None:
        dim = dim.withColumn(on, key(F.col(on)))
    return fact.join(dim, on=on, how=how)
