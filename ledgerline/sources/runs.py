"""Run folders: each pipeline run writes ``<root>/runs/<run_id>/`` and is
published by a ``_RUN_COMPLETE`` marker written after its gates pass.

Readers open the newest completed run, so a run that fails half-way, or
fails its key gates, is never seen, and nobody reads a table while it is
being replaced. Older runs stay in place for rollback until
:mod:`ledgerline.sources.retention` removes them.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARKER = "_RUN_COMPLETE"
RETIRED = "_RETIRED"  # a run that is about to be removed


def new_run_id() -> str:
    """Sortable by start time, unique across concurrent starts."""
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%fZ") + "-" + uuid.uuid4().hex[:8]


def run_dir(root: str, run_id: str) -> str:
    return os.path.join(root, "runs", run_id)


def mark_complete(spark: SparkSession, root: str, run_id: str, summary: dict) -> None:
    row = {"run_id": run_id, "summary": json.dumps(summary, sort_keys=True, default=str)}
    spark.createDataFrame([row], "run_id string, summary string").coalesce(1).write.mode(
        "errorifexists").json(os.path.join(run_dir(root, run_id), MARKER))


def _markers(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema("run_id string").json(os.path.join(root, "runs", "*", MARKER))
    except AnalysisException:
        return None


def completed_runs(spark: SparkSession, root: str) -> list[str]:
    """Ids of published runs, oldest first (one small row per run)."""
    markers = _markers(spark, root)
    return sorted(r.run_id for r in markers.distinct().collect()) if markers is not None else []


def latest_run_dir(spark: SparkSession, root: str) -> str:
    markers = _markers(spark, root)
    newest = markers.agg(F.max("run_id")).first()[0] if markers is not None else None
    if newest is None:
        raise FileNotFoundError(f"no completed pipeline run under {root}")
    return run_dir(root, newest)
