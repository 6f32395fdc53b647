"""Reading the driver's Parquet tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table as a DataFrame; select only what you need downstream so the
    scan's ReadSchema stays pruned."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan that yields fewer splits than the cluster has
    cores (a file written as one row group cannot be split); leave it alone
    otherwise. Round-robin has no key, so a hot key cannot pile up in one
    task; on a cluster reading many files this is a no-op."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df
