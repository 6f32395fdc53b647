"""Layer sinks: Parquet tables under a warehouse folder.

Layout: ``<root>/raw/<feed>/is_rejected=<flag>`` (the raw table is the part
with ``false``), ``<root>/raw/rejected_records/source_table=<feed>``,
``<root>/staging/<table>``, ``<root>/marts/<table>``. Every table is rebuilt
in full on each run (overwrite), like the truncate-and-load of the original
pipeline; a job only ever overwrites its own output and reads upstream
paths, so no path is read while it is being replaced.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.feeds import FEEDS, FeedSpec
from ledgerline.sources.manifest import REJECTS, raw_files

RAW_TABLES = {f"raw.{f.name}": f for f in FEEDS}
# With this many open files per task a write partitioned by a flag needs no
# sort by it; beyond, Spark falls back to sorting.
OPEN_FILES_CONF = "spark.sql.maxConcurrentOutputFileWriters"
# With this a query deletes its shuffle files when it ends.
DROP_SHUFFLES_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, conf: str, value: str) -> Iterator[None]:
    before = spark.conf.get(conf, None)
    spark.conf.set(conf, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(conf)
        else:
            spark.conf.set(conf, before)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Each write inside deletes what it has shuffled when it ends. Otherwise
    these files stay until the driver happens to collect its garbage, so that
    a layer's lie on the disk while the layers after it are built."""
    with setting(spark, DROP_SHUFFLES_CONF, "true"):
        yield


def table_path(root: str, qualified: str) -> str:
    layer, _, name = qualified.partition(".")
    return os.path.join(root, layer, name)


def write_table(df: DataFrame, root: str, qualified: str) -> str:
    """zstd: half the bytes of the default for the hexadecimal keys."""
    path = table_path(root, qualified)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return path


def raw_schema(spec: FeedSpec) -> str:
    return ", ".join(f"{c} string" for c in (*spec.raw_columns, "_source")) + ", _loaded_at timestamp"


def accepted_path(folder: str) -> str:
    """The part of a feed's load that is its raw table."""
    return os.path.join(folder, "is_rejected=false")


def write_split(df: DataFrame, path: str) -> None:
    """One write of a feed's accepted and rejected rows, a folder for each."""
    conf = df.sparkSession.conf
    if int(conf.get(OPEN_FILES_CONF, "0")) < 2:
        conf.set(OPEN_FILES_CONF, "2")
    df.write.mode("overwrite").option("compression", "zstd").partitionBy("is_rejected").parquet(path)


def read_split(spark: SparkSession, path: str, spec: FeedSpec) -> DataFrame:
    """What :func:`write_split` wrote, with ``is_rejected``; a filter on it
    prunes files. The schema is given, since a part without rows has no file."""
    return spark.read.schema(raw_schema(spec) + ", is_rejected boolean").parquet(path)


def write_rejects(df: DataFrame, root: str, source_table: str) -> str:
    """Replace one feed's quarantine partition, leaving the other feed's
    intact. The partition folder is overwritten explicitly, so a run with
    zero rejects still clears the previous run's rows."""
    path = os.path.join(table_path(root, "raw.rejected_records"), f"source_table={source_table}")
    df.drop("source_table").write.mode("overwrite").option("compression", "zstd").parquet(path)
    return path


def read_table(spark: SparkSession, root: str, qualified: str) -> DataFrame:
    """A layer table of the run in ``root``; raw tables from the files that
    its manifest names."""
    if qualified == REJECTS:
        return union_all([spark.read.parquet(folder).withColumn("source_table", F.lit(feed))
                          for (name, feed), folder in raw_files(spark, root).items() if name == REJECTS])
    if qualified in RAW_TABLES:
        spec = RAW_TABLES[qualified]
        return read_split(spark, raw_files(spark, root)[qualified, spec.name], spec).where(~F.col("is_rejected")).drop("is_rejected")
    return spark.read.parquet(table_path(root, qualified))


def union_all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
