"""Sharding by jump consistent hashing (Lamping and Veach, 2014).

A row's shard follows from its doc_id and the number of shards alone, with
no ring table to keep: adding a shard moves only the 1/(n+1) of the rows
that go to the new one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from ledgerline.llm.common import order_key, parallelism, range_bounds, range_of, ship_package, stage

MULTIPLIER = np.uint64(2862933555777941757)  # fixed value of the published method


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard, 0 to shards - 1, of each 64-bit key."""
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    open_ = np.arange(len(state))
    while len(open_):
        state[open_] = state[open_] * MULTIPLIER + np.uint64(1)
        draw = (state[open_] >> np.uint64(33)).astype(np.float64) + 1.0
        jump = ((shard[open_] + 1) * (2147483648.0 / draw)).astype(np.int64)
        inside = jump < shards
        open_ = open_[inside]
        shard[open_] = jump[inside]
    return shard.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """Shard of a 64-bit key column; a null key counts as -1."""

    def assign(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(jump_hash(batch.to_numpy(np.int64).view(np.uint64), shards))

    return F.pandas_udf(assign, IntegerType())(F.coalesce(key.cast("bigint"), F.lit(-1).cast("bigint")))


def assign_shards(docs: DataFrame, shards: int) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot, grown_shard for every row.

    ``size`` is the UTF-8 length of the text (null: none) plus 8, ``slot`` the
    row's place in its shard by ascending doc_id (then CRC and size; a null id
    comes first), ``grown_shard`` the shard with one shard more. Rows that
    repeat a doc_id share its shard and take slots of their own. An empty
    table gives an empty result.

    Slots are counted in ranges of doc_id: a range's rows are numbered in one
    task, and the counts of the ranges before it (at most ranges x shards
    numbers) are added. Only digests are exchanged, never texts.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("bigint").alias("size"),
                       F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    rows = stage(rows.withColumn("shard", shard_of(F.col("doc_id"), shards))
                 .withColumn("grown_shard", shard_of(F.col("doc_id"), shards + 1)), "sharded")
    key = order_key("doc_id")
    bounds = range_bounds(rows, key, max(8, parallelism(spark) // 4))
    rows = rows.withColumn("range", range_of(key, bounds))
    counts = rows.groupBy("range", "shard").count()
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("range").alias("r"), F.col("shard").alias("s"),
                            F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    # at most ranges x shards rows: a few thousand, whatever the input
    placed = rows.join(F.broadcast(offsets), (F.col("range") == F.col("r")) & (F.col("shard") == F.col("s")))
    within = Window.partitionBy("range", "shard").orderBy(key, "text_crc32", "size")
    return placed.select("doc_id", "size", "text_crc32", "shard",
                         (F.row_number().over(within) - 1 + F.col("before")).alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int, files_per_shard: int = 8) -> None:
    """Write whole rows as ``path/shard=k/``; rows of a shard are spread over
    ``files_per_shard`` files, so no task writes a whole shard."""
    ship_package(docs.sparkSession)
    spread = F.pmod(F.xxhash64(*docs.columns), F.lit(files_per_shard))
    (docs.withColumn("shard", shard_of(F.col("doc_id"), shards)).withColumn("__file", spread)
     .repartition(shards * files_per_shard, "shard", "__file").drop("__file")
     .write.partitionBy("shard").parquet(path))
