"""Which runs are kept, and how readers hold on to one.

A reader leases the run it opens: a file in ``<run>/_READERS`` whose name says
until when. A run is removed in three steps: a mark that it is retired, a look
at its leases, and, only if none is live, the deletion (else the mark is taken
back). A reader leases first and looks for the mark then, so of a reader and a
removal at the same time at least one sees the other and steps back.
"""

from __future__ import annotations

import datetime as dt
import os
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from ledgerline.session import ensure_checkpoint_dir
from ledgerline.sources.files import children, delete, exists, touch
from ledgerline.sources.manifest import runs_used
from ledgerline.sources.runs import RETIRED, completed_runs, run_dir

READERS = "_READERS"
LEASE_HOURS = 24.0
# Folders below spark.checkpoint.dir that hold what one session wrote for itself.
SCRATCH = ("registry", "csv_splits", "quality", "llm", "corpus")


@dataclass
class Lease:
    path: str

    def release(self, spark: SparkSession) -> None:
        delete(spark, self.path)


def lease_run(spark: SparkSession, root: str, hours: float = LEASE_HOURS) -> Lease | None:
    """Hold the run in folder ``root`` for ``hours``; None if it is retired."""
    until = int((time.time() + hours * 3600) * 1000)
    lease = Lease(os.path.join(root, READERS, f"{until}-{uuid.uuid4().hex}"))
    touch(spark, lease.path)
    if exists(spark, os.path.join(root, RETIRED)):
        lease.release(spark)
        return None
    return lease


def live_leases(spark: SparkSession, root: str) -> int:
    now = time.time() * 1000
    return sum(int(name.split("-")[0]) > now for name, _ in children(spark, os.path.join(root, READERS)))


@dataclass
class Retention:
    removed: list[str] = field(default_factory=list)
    held: list[str] = field(default_factory=list)     # a reader has them open
    scratch: list[str] = field(default_factory=list)


def _started(run_id: str) -> float:
    stamp = run_id.split("-")[0]
    return dt.datetime.strptime(stamp, "%Y%m%dT%H%M%S%fZ").replace(tzinfo=dt.timezone.utc).timestamp()


def retain(spark: SparkSession, warehouse: str, keep: int = 3, *, unfinished_hours: float = 48.0,
           also: tuple[str, ...] = ()) -> Retention:
    """Remove all published runs but the newest ``keep``, and runs that were
    never published and began over ``unfinished_hours`` ago. Runs that a
    reader leases, those named in ``also`` (a catalog's), and those whose raw
    files another run that stays uses, stay."""
    if keep < 1:
        raise ValueError("the newest published run is always kept")
    done, report = Retention(), completed_runs(spark, warehouse)
    stay, published = {*report[-keep:], *also}, set(report)
    runs = [name for name, _ in children(spark, os.path.join(warehouse, "runs"))]
    # whatever runs that stay, are leased, or may still be written take their raw files from stays too
    used = {run_id: runs_used(spark, run_dir(warehouse, run_id)) for run_id in runs}
    for run_id, others in used.items():
        if run_id in stay or run_id not in published or live_leases(spark, run_dir(warehouse, run_id)):
            stay |= others
    for run_id in runs:
        if run_id in stay:
            continue
        root = run_dir(warehouse, run_id)
        retired = os.path.join(root, RETIRED)
        if run_id not in published and not exists(spark, retired):
            try:
                if _started(run_id) > time.time() - unfinished_hours * 3600:
                    continue  # it may still be writing
            except ValueError:
                continue      # not a run's folder
        touch(spark, retired)
        if live_leases(spark, root):
            delete(spark, retired)
            done.held.append(run_id)
        else:
            delete(spark, root)
            done.removed.append(run_id)
    return done


def sweep_scratch(spark: SparkSession, hours: float = 48.0) -> list[str]:
    """Remove scratch folders below spark.checkpoint.dir that nothing has been
    added to for ``hours``: what ended sessions left behind."""
    base, gone = ensure_checkpoint_dir(spark), []
    for kind in SCRATCH:
        for name, changed in children(spark, os.path.join(base, kind)):
            path = os.path.join(base, kind, name)
            newest = max([changed, *(at for _, at in children(spark, path))])
            if newest < (time.time() - hours * 3600) * 1000:
                delete(spark, path)
                gone.append(path)
    return gone
