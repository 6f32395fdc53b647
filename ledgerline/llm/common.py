"""Helpers shared by the operators: reading, staging, shipping code, ranges.

Conventions every operator follows:

* it selects the columns it needs first, so other columns of its input, even
  ones that carry the names of its own outputs, cannot clash;
* a missing table row is nothing, a null text is the empty text;
* whatever is read twice, or must not change when a task is repeated, is
  written to the cluster's shared folder and read back (:func:`stage`).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import ensure_checkpoint_dir

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()
_staged: dict[str, list[str]] = {}


# Rows that a Python worker gets at once: some 3 MB of ordinary documents.
ARROW_ROWS = 1000


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that the
    functions run there import it (and keep their caches between tasks), and
    keep the batches they get small."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= ARROW_ROWS:
        spark.conf.set(rows, str(ARROW_ROWS))
    app = spark.sparkContext.applicationId
    if app in _shipped or not os.path.isdir(_PACKAGE):
        return
    folder = tempfile.mkdtemp(prefix="ledgerline-code-")
    archive = os.path.join(folder, "ledgerline_code.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for top, _, names in os.walk(_PACKAGE):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(_PACKAGE)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; ``sf_dir`` may be any path Spark's readers open."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below spark.checkpoint.dir and read it back
    (``codec``: compression, by default the session's).

    Cuts lineage at a copy that every executor reaches: a lost executor
    rereads files instead of recomputing, and values that depend on task
    order are fixed once.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what :func:`stage` wrote inside; results built on it
    must be written by then."""
    paths = _staged.setdefault(spark.sparkContext.applicationId, [])
    before = len(paths)
    try:
        yield
    finally:
        for path in paths[before:]:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        del paths[before:]


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row: inside nested
    array functions an ordinary expression would be evaluated per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def texts(docs: DataFrame, *keep: str) -> DataFrame:
    """``doc_id`` (and ``keep``) with the whole text, null read as empty."""
    return docs.select("doc_id", *keep, F.coalesce(F.col("text"), F.lit("")).alias("text"))


LOWEST = -(2 ** 63)


def order_key(column: str) -> Column:
    """An id as an ordering key without nulls (a null id comes first)."""
    return F.coalesce(F.col(column).cast("bigint"), F.lit(LOWEST).cast("bigint"))


def range_bounds(df: DataFrame, key: Column, n: int) -> list[int]:
    """At most ``n`` ascending values of ``key`` that cut ``df`` into about
    equal ranges; the first is the smallest key. Empty for an empty table."""
    n = max(1, n)
    row = df.select(key.alias("k")).agg(
        F.min("k"), F.percentile_approx("k", [i / n for i in range(n)], max(1000, 10 * n))).first()
    return sorted({row[0], *row[1]}) if row[0] is not None else []


def range_of(key: Column, bounds: Sequence[int]) -> Column:
    """Index of the last bound that is <= ``key`` (0 below the first), found
    in two steps of sqrt(n) comparisons each."""
    if len(bounds) < 2:
        return F.lit(0)
    step = max(2, int(len(bounds) ** 0.5))
    heads, every = F.lit([int(b) for b in bounds[::step]]), F.lit([int(b) for b in bounds])
    below = lambda array: F.size(F.filter(array, lambda b: b <= key))
    head = F.greatest(below(heads) - 1, F.lit(0)) * step
    return F.greatest(head + below(F.slice(every, head + 1, step)) - 1, F.lit(0))
