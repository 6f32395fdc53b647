"""Landing zone: the order feeds as header CSV files, one folder per feed."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ledgerline.sources.csv_feed import read_feed_csv
from ledgerline.sources.feeds import FEEDS, FeedSpec


def write_feed_csv(df: DataFrame, path: str, spec: FeedSpec) -> str:
    """Header CSV in the feed's encoding; whitespace kept, quotes doubled."""
    (df.write.option("header", True).option("encoding", spec.encoding)
     .option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .mode("overwrite").csv(path))
    return path


def land_feeds(feeds: dict[str, DataFrame], landing_dir: str) -> dict[str, str]:
    return {spec.name: write_feed_csv(feeds[spec.name], os.path.join(landing_dir, spec.name), spec)
            for spec in FEEDS}


def read_landed(spark: SparkSession, landing_dir: str, only: Sequence[str] = ()) -> dict[str, DataFrame]:
    """The landed feeds (of the names ``only``, if any), by name."""
    return {spec.name: read_feed_csv(spark, os.path.join(landing_dir, spec.name), spec)
            for spec in FEEDS if not only or spec.name in only}
