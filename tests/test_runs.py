"""Run folders, publication and concurrent job submission."""

import pytest

from ledgerline.plans.pipeline import concurrently
from ledgerline.sources.runs import completed_runs, latest_run_dir, mark_complete, new_run_id, run_dir


def test_run_ids_sort_by_start_time():
    first = new_run_id()
    second = new_run_id()
    assert first < second and first != second


def test_unpublished_folder_has_no_runs(spark, tmp_path):
    assert completed_runs(spark, str(tmp_path)) == []
    with pytest.raises(FileNotFoundError):
        latest_run_dir(spark, str(tmp_path))


def test_latest_published_run_wins(spark, tmp_path):
    root = str(tmp_path)
    ids = [new_run_id() for _ in range(3)]
    for rid in ids[:2]:
        mark_complete(spark, root, rid, {"ok": True})
    # the third run never got its marker (failed or still writing)
    assert completed_runs(spark, root) == ids[:2]
    assert latest_run_dir(spark, root) == run_dir(root, ids[1])


def test_concurrently_returns_results_and_raises_failures():
    assert concurrently("t", {"a": lambda: 1, "b": lambda: 2}) == {"a": 1, "b": 2}

    def boom():
        raise ValueError("failed job")

    with pytest.raises(ValueError):
        concurrently("t", {"ok": lambda: 1, "bad": boom})
