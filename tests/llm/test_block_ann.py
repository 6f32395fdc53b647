"""Nearest neighbours against all pairs."""

import math
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import block_ann
from llm_data import SF


def brute(rows, k=20, step=20):
    """rows: (vec_id, vector). Every pair, in the order of the components."""
    good = [(i, v, n) for n, (i, v) in enumerate(rows)
            if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    out = Counter()
    for i, q, n in good:
        if i % step:
            continue
        found = []
        for j, x, m in good:
            if m != n:
                total = 0.0
                for a, b in zip(q, x):
                    total += a * b
                found.append((-total, j))
        for rank, (score, j) in enumerate(sorted(found)[:k], 1):
            out[i, rank, j, -score] += 1
    return out


def table_of(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>, query_id string, score int, rank int")


def test_given_vectors(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in df.collect()])
    assert Counter(map(tuple, block_ann.nearest(df).collect())) == want


@pytest.mark.parametrize("kind", ["float", "double"])
def test_odd_vectors(spark, kind):
    r = np.random.default_rng(4)
    base = r.normal(size=(90, 8)).astype(np.float32)
    vectors = [v.tolist() for v in base] + [base[3].tolist()] * 70 + [(base[5] + 1e-6 * r.normal(size=8)).astype(np.float32).tolist() for _ in range(60)]
    vectors += [None, [0.0] * 8, [None] + [1.0] * 7, [math.nan] + [1.0] * 7, [math.inf] * 8, [-0.0] * 8,
                [1e-30] * 8, [3e18, *[0.0] * 7], (base[7] * 1000).tolist(), [1.0, 2.0, 3.0], [], [0.5] * 11]
    rows = [(i, v, "q", 1, 2) for i, v in enumerate(vectors)]
    rows += [(40, base[40].tolist(), "q", 1, 2), (40, base[41].tolist(), "q", 1, 2), (None, base[1].tolist(), "q", 1, 2), (-20, base[2].tolist(), "q", 1, 2)]
    df = table_of(spark, rows, kind)
    want = brute([(r.vec_id, r.embedding) for r in df.collect()])
    assert Counter(map(tuple, block_ann.nearest(df).collect())) == want


def test_few_and_none(spark):
    assert block_ann.nearest(table_of(spark, [])).count() == 0
    assert block_ann.nearest(table_of(spark, [(0, [1.0], "", 1, 1)])).count() == 0
    got = block_ann.nearest(table_of(spark, [(0, [1.0, 2.0], "", 1, 1), (1, [1.0, 0.0], "", 1, 1), (2, [1.0, 0.0], "", 1, 1)])).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1, 1.0), (0, 2, 2, 1.0)]


def test_bounds_hold():
    r = np.random.default_rng(5)
    q, x = r.normal(size=(50, 64)) * r.lognormal(0, 3, (50, 1)), r.normal(size=(300, 64)) * r.lognormal(0, 3, (300, 1))
    q[0, 0] *= 1e4
    near, off = block_ann.bounded_tile(block_ann.Quantised(q), slice(None), block_ann.Quantised(x), slice(0, 300))
    assert (np.abs(near - q @ x.T) <= off).all()
    typical = np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(x, axis=1)[None]
    assert np.median(off / typical) < 0.05
    wide = r.integers(-127, 128, (3, 2500)).astype(np.int8)
    assert (block_ann.product_tile(wide, wide) == wide.astype(np.int64) @ wide.astype(np.int64).T).all()


def test_cells_and_tiles(spark, monkeypatch):
    # several slabs of queries and strips of candidates
    monkeypatch.setattr(block_ann, "CELL", 16)
    monkeypatch.setattr(block_ann, "LEAST", 4)
    r = np.random.default_rng(6)
    rows = [(i, v.tolist(), "", 1, 1) for i, v in enumerate(r.normal(size=(120, 5)).astype(np.float32))]
    df = table_of(spark, rows)
    want = brute([(r.vec_id, r.embedding) for r in df.collect()], 6, 3)
    assert Counter(map(tuple, block_ann.nearest(df, 6, 3).collect())) == want
