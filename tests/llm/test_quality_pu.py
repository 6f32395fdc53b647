"""The classifier's risk, prior and passes over all rows, against plain ones."""

import math

import numpy as np
import pytest

from ledgerline.llm import quality_pu
from ledgerline.llm.quality_pu import _fit, _sigmoid


@pytest.fixture(scope="module")
def samples():
    r = np.random.default_rng(5)
    good, bad = r.normal(0, 1, (3000, 5)), r.normal(0, 1, (3000, 5)) + np.array([4, 4, 0, 0, 0])
    return good.astype(np.float32), bad.astype(np.float32)


@pytest.mark.parametrize("prior", [0.3, 0.9])
def test_direction_is_the_gradient_of_the_risk(samples, prior):
    good, bad = samples
    unlabelled = np.concatenate([good[1500:1800], bad[:200]])
    model, at = _fit(good[:300], unlabelled, prior)
    p_rows, u_rows, decay = model.design(good[:300]), model.design(unlabelled), 0.01
    r = np.random.default_rng(1)

    def risk(w):
        sp, su = _sigmoid(w[p_rows].sum(axis=1)), _sigmoid(w[u_rows].sum(axis=1))
        slope = quality_pu.push(u_rows, su * (1 - su) / len(su), len(w))
        clipped = su.mean() < prior * sp.mean()
        return quality_pu.pu_risk(w, p_rows, su.mean(), slope, prior, decay), clipped, su.mean() - prior * sp.mean()

    for w in (at.w, r.normal(0, 0.3, len(at.w)), np.zeros(len(at.w))):
        (value, grad), clipped, below = risk(w)
        for i in r.integers(0, len(w), 12):
            step = np.zeros(len(w))
            step[i] = 1e-5
            (up, _), _, below_up = risk(w + step)
            (down, _), _, below_down = risk(w - step)
            if clipped:  # the direction takes the risk of bad documents up
                assert grad[i] - decay * w[i] == pytest.approx(-(below_up - below_down) / 2e-5, abs=1e-6)
            else:
                assert grad[i] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_places_and_ratio_against_thresholds_one_by_one():
    r = np.random.default_rng(2)
    for n in (1, 2, 7, 300):
        positive = [np.sort(r.normal(1, 1, n).round(1)) for _ in range(2)]
        unlabelled = [r.normal(0, 1, 5 * n).round(1) for _ in range(2)]
        halves = [quality_pu.places(u, p) for u, p in zip(unlabelled, positive)]
        for u, p, h in zip(unlabelled, positive, halves):
            assert h.tolist() == [sum(np.searchsorted(p, x, side="right") == k for x in u) for k in range(n + 1)]
        slack = quality_pu.MARGIN * (1 / math.sqrt(2 * n) + 1 / math.sqrt(10 * n))
        best = None
        for k in range(1, n + 1):
            above = sum(int((u >= p[n - k]).sum()) for u, p in zip(unlabelled, positive)) / (10 * n)
            if k / n > 0.02 and (best is None or (above + slack) / (k / n) < best[0] - 1e-12):
                best = (above + slack) / (k / n), min(1.0, above / (k / n))
        assert quality_pu.smallest_ratio(halves) == pytest.approx(best[1])


@pytest.mark.parametrize("share", [0.04, 0.5, 0.9, 1.0])
def test_prior_of_known_shares(samples, share):
    good, bad = samples
    k = int(2000 * share)
    model = quality_pu.fit_local(good[:1000], np.concatenate([good[1000:1000 + k], bad[:2000 - k]]))
    assert model.prior == pytest.approx(share, abs=0.05)


def test_passes_over_all_rows_equal_local_sums(spark, samples):
    good, bad = samples
    unlabelled = np.concatenate([good[1000:1700], bad[:300]])
    part = np.arange(1000) % 3 % 2
    rows = spark.createDataFrame([(int(p), [float(v) for v in x]) for p, x in zip(part, unlabelled)], "part int, x array<float>").repartition(7)
    positive = [good[:150], good[150:400]]
    edges = quality_pu.bins(np.quantile(unlabelled, [0.1, 0.3, 0.5, 0.7, 0.9], axis=0))
    models = [_fit(positive[i], unlabelled[part == i], None, edges)[0] for i in (0, 1)]
    halves = [quality_pu.places(models[1 - i].margin(unlabelled[part == i]), np.sort(models[1 - i].margin(positive[i]))) for i in (0, 1)]
    prior = quality_pu.prior_of(rows, positive, models)
    assert prior == pytest.approx(quality_pu.smallest_ratio(halves))

    def risk(m):
        sp, su = m.score(good[:400]).mean(), m.score(unlabelled).mean()
        return prior * (1 - sp) + max(0, su - prior * sp) + 0.0005 * (m.weights @ m.weights)

    model, at = _fit(good[:400], unlabelled, prior, edges, models)
    before = risk(model)
    assert risk(quality_pu.descend(rows, good[:400], model, at, 0.001)) <= before + 1e-9


def test_rows_at_the_edges(spark):
    text = "A plain sentence about the weather, written by {} on a calm day."
    rows = [(i, text.format(i), "x", i) for i in range(60)] + [(None, None, "x", 0), (None, "", "y", 1), (3, text.format(3), "z", 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, part string, x int")
    labels = spark.createDataFrame([(i, 1) for i in range(0, 60, 2)] + [(None, 1), (2, 1)], "doc_id bigint, quality int")
    got = quality_pu.score_documents(docs, labels).collect()
    assert len(got) == 63 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 3}) == len({r.score for r in got if r.doc_id is None}) == 1
    kept = quality_pu.keep_good(docs, labels)
    predicted = {r.doc_id for r in got if r.predicted}
    assert kept.columns == docs.columns
    assert sorted(kept.collect(), key=str) == sorted((r for r in docs.collect() if r.doc_id in predicted), key=str)
    none = labels.where("quality = 0")
    assert quality_pu.keep_good(docs, none).count() == 63
    assert {r.score for r in quality_pu.score_documents(docs, none).collect()} == {0.5}
    assert quality_pu.keep_good(docs.limit(0), labels).count() == 0
