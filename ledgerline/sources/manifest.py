"""Which files a run's raw layer consists of.

A run that reloads one feed takes the other feed's raw table and rejects as an
earlier run wrote them. Its manifest, written once before anything is loaded,
names the folder of every (raw table, feed); a run without one has all of them
in its own folder. Entries name the run that wrote the files, never a run that
only refers to them, so a chain of reloads needs no chain of look-ups.
"""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import SparkSession

from ledgerline.sources.feeds import FEEDS
from ledgerline.sources.files import exists

MANIFEST = "_MANIFEST"
REJECTS = "raw.rejected_records"


def _own(root: str, feed: str) -> tuple[str, str]:
    return os.path.join(root, "raw", feed), os.path.join(root, "raw", "rejected_records", f"source_table={feed}")


def raw_files(spark: SparkSession, root: str) -> dict[tuple[str, str], str]:
    """(table, feed) -> folder, for the raw tables of the run in ``root``: two
    entries a feed."""
    files = {}
    for feed in FEEDS:
        table, rejects = _own(root, feed.name)
        files |= {(f"raw.{feed.name}", feed.name): table, (REJECTS, feed.name): rejects}
    path = os.path.join(root, MANIFEST)
    if exists(spark, path):
        runs = os.path.dirname(root.rstrip("/"))
        for r in spark.read.schema("name string, feed string, run_id string").json(path).collect():
            table, rejects = _own(os.path.join(runs, r.run_id), r.feed)
            files[r.name, r.feed] = rejects if r.name == REJECTS else table
    return files


def write_manifest(spark: SparkSession, root: str, base: str, reuse: Iterable[str]) -> None:
    """Let the run in ``root`` take the raw files of the feeds ``reuse`` from
    the run in ``base``, wherever that has them."""
    held = raw_files(spark, base)
    entries = []
    for (name, feed), folder in held.items():
        if feed in set(reuse):
            above = os.path.dirname(os.path.dirname(folder))
            entries.append((name, feed, os.path.basename(os.path.dirname(above) if name == REJECTS else above)))
    spark.createDataFrame(entries, "name string, feed string, run_id string").coalesce(1).write.mode("errorifexists").json(
        os.path.join(root, MANIFEST))


def runs_used(spark: SparkSession, root: str) -> set[str]:
    """Ids of other runs whose files the run in ``root`` uses."""
    path = os.path.join(root, MANIFEST)
    if not exists(spark, path):
        return set()
    return {r.run_id for r in spark.read.schema("name string, feed string, run_id string").json(path).select("run_id").distinct().collect()}
