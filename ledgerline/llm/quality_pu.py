"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled good, the unlabelled set is web text
as it comes. The class prior is estimated from both (Garg et al., "Mixture
Proportion Estimation and PU Learning", 2021: the smallest ratio of tail
masses), and an additive model minimises the non-negative unbiased risk under
the sigmoid loss (Kiryo et al., 2017). Bad documents need no labels.

Features come from the text alone: character classes, word and line shapes,
repetition. They are computed once for each document and staged. All
unlabelled rows outside the held-out fold count: their quantiles are the
bins, the prior is the ratio of their tail counts, and ``PASSES`` gradient
steps go over them all; each of these is one small aggregate over the staged
features. Only the labelled positives are bounded (``MAX_POSITIVES``, the
smallest hashes of doc_id). ``START_ROWS`` unlabelled rows serve the driver
for the weights from which the passes start.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ship_package, stage, texts

MAX_POSITIVES = 4_000
START_ROWS = 8_000
PASSES = 10
FOLDS, HELD_OUT = 3, 1
STEPS, BATCH, RATE = 1_500, 1_024, 0.03
# Weight decay over the number of unlabelled rows: of the model that tells the
# samples apart, and of the PU model.
DECAY_APART, DECAY = 2.0, 2.0
MARGIN = 1.0  # of the sampling error, in the estimate of the prior
SEED = 7

_SIGNS = b"|!#$%&*<>{}=_/\\@~^+"
_ENDS = b".,;:?'\"()-"
_LEVELS = (0.01, 0.03, 0.06, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.9, 0.94, 0.97, 0.99)


def features(text: str) -> list[float]:
    """Style of a text as numbers; an empty text gives zeros."""
    raw = text.encode()
    n = max(1, len(raw))
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = lambda chars: float(count[list(chars)].sum()) / n
    lower, upper, digit = count[97:123].sum() / n, count[65:91].sum() / n, count[48:58].sum() / n
    words = raw.split()
    w = max(1, len(words))
    seen = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    signed = sum(1 for x in words if x[-1] in _SIGNS)
    shouted = sum(1 for x in words if len(x) > 1 and x.isupper())
    return [
        math.log1p(len(raw)), math.log1p(len(words)), float(lower), float(upper), float(digit),
        float(count[128:].sum()) / n, share(b" \t"), share(b"\n"), share(_SIGNS), share(_ENDS),
        *(share(bytes([c])) for c in b"|!#$%&*.,"), len(raw) / w, len(seen) / w, max(seen.values(), default=0) / w,
        pairs / max(1, len(words) - 1), sum(a == b for a, b in zip(words, words[1:])) / w,
        signed / w, shouted / w, len(set(lines)) / max(1, len(lines)), len(words) / max(1, len(lines)),
        sum(1 for x in words if len(x) == 1) / w,
    ]


@dataclass
class Model:
    """An additive model: one weight for each bin of each feature."""

    edges: list[np.ndarray]
    weights: np.ndarray
    prior: float

    def design(self, x: np.ndarray) -> np.ndarray:
        """Column numbers of the bins that each row falls into."""
        at, columns = 0, []
        for i, e in enumerate(self.edges):
            columns.append(np.searchsorted(e, x[:, i], side="right") + at)
            at += len(e) + 1
        return np.stack(columns + [np.full(len(x), at)], axis=1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.weights[self.design(x)].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Adam:
    """A model's weights on their way, with the moments of their gradient."""

    w: np.ndarray
    m: np.ndarray
    v: np.ndarray
    step: int = 0

    def move(self, grad: np.ndarray) -> None:
        self.step += 1
        self.m, self.v = 0.9 * self.m + 0.1 * grad, 0.999 * self.v + 0.001 * grad * grad
        self.w = self.w - RATE * (self.m / (1 - 0.9 ** self.step)) / (np.sqrt(self.v / (1 - 0.999 ** self.step)) + 1e-8)


def push(rows: np.ndarray, by: np.ndarray, width: int) -> np.ndarray:
    """The sum of ``by`` over the rows that each weight has a part in."""
    return np.bincount(rows.ravel(), np.repeat(by, rows.shape[1]), width)


def pu_risk(w: np.ndarray, p_rows: np.ndarray, u_good: float, u_slope: np.ndarray, prior: float, decay: float) -> tuple[float, np.ndarray]:
    """The non-negative PU risk and the direction to descend, given the mean
    score ``u_good`` of the unlabelled rows and its gradient ``u_slope``. The
    loss of a good document is 1 - s, that of a bad one s: it is bounded, so
    that the difference of two means in it does not hang on how far out a few
    good documents lie. Where the risk of bad documents (that of the
    unlabelled less that of the good among them) is below zero, the direction
    takes it back up instead (Kiryo et al.)."""
    sp = _sigmoid(w[p_rows].sum(axis=1))
    p_slope = push(p_rows, sp * (1 - sp) / len(sp), len(w))
    bad = u_good - prior * sp.mean()
    grad = u_slope - 2 * prior * p_slope if bad >= 0 else prior * p_slope - u_slope
    return float(prior * (1 - sp.mean()) + max(0.0, bad) + decay / 2 * (w @ w)), grad + decay * w


def bins(*quantiles: np.ndarray) -> list[np.ndarray]:
    """Edges of each feature's bins from quantiles (levels by features)."""
    return [np.unique(np.concatenate([q[:, i] for q in quantiles])) for i in range(quantiles[0].shape[1])]


def _fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, edges: list[np.ndarray] | None = None,
         apart: list[Model] | None = None) -> tuple[Model, Adam]:
    """Minimise with Adam the PU risk for a given ``prior`` or, without one,
    the logistic risk of telling the two samples apart. The PU risk starts
    from models that tell them ``apart``: their odds are those of the
    positive to the unlabelled density, so a document is as likely good as
    bad where they are a half to the prior."""
    edges = edges or bins(np.quantile(positive, _LEVELS, axis=0), np.quantile(unlabelled, _LEVELS, axis=0))
    width = sum(len(e) + 1 for e in edges) + 1
    model = Model(edges, np.zeros(width), prior if prior is not None else 0.5)
    p_rows, u_rows = model.design(positive), model.design(unlabelled)
    rng = np.random.default_rng(SEED)
    at = Adam(np.zeros(width), np.zeros(width), np.zeros(width))
    if apart:
        at.w = np.mean([m.weights for m in apart], axis=0)
        at.w[-1] += math.log(2 * max(prior, 1 / len(unlabelled)))
    for _ in range(STEPS):
        u = u_rows[rng.integers(0, len(u_rows), BATCH)]
        p = p_rows[rng.integers(0, len(p_rows), BATCH)]
        su = _sigmoid(at.w[u].sum(axis=1))
        if prior is None:
            sp = _sigmoid(at.w[p].sum(axis=1))
            grad = push(p, (sp - 1) / BATCH, width) + push(u, su / BATCH, width) + DECAY_APART / len(u_rows) * at.w
        else:
            grad = pu_risk(at.w, p, su.mean(), push(u, su * (1 - su) / BATCH, width), prior, DECAY / len(u_rows))[1]
        at.move(grad)
    model.weights = at.w
    return model, at


def places(margin: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """How many rows have a margin of at least 0, 1, ... and no more of the
    ``positive`` margins (ascending)."""
    return np.bincount(np.searchsorted(positive, margin, side="right"), minlength=len(positive) + 1)


def smallest_ratio(halves: list[np.ndarray]) -> float:
    """The class prior: the smallest ratio, over thresholds, of the unlabelled
    to the positive share above the threshold, chosen with a margin for the
    sampling error of both, from the :func:`places` of each half's unlabelled
    rows among its positives. Halves are pooled at equal positive shares."""
    halves = [h for h in halves if len(h) > 1]
    most, every = max(len(h) - 1 for h in halves), sum(int(h.sum()) for h in halves)
    share = np.arange(1, most + 1) / most
    above = np.zeros(most)
    for half in halves:
        n = len(half) - 1
        # rows at or above the k-th positive from the top
        above += np.cumsum(half[::-1])[np.ceil(share * n - 1e-9).astype(int) - 1]
    qu = above / max(1, every)
    slack = MARGIN * (1 / math.sqrt(sum(len(h) - 1 for h in halves)) + 1 / math.sqrt(max(1, every)))
    at = int(np.argmin(np.where(share > 0.02, (qu + slack) / share, np.inf)))
    return min(1.0, float(qu[at] / share[at]))


def fit_local(positive: np.ndarray, unlabelled: np.ndarray) -> Model:
    """What :func:`train` does over all rows of a table, for rows that the
    driver holds: the prior from halves that are each ranked by a model,
    fitted on the other, that tells the samples apart; then the PU model."""
    edges = bins(np.quantile(positive, _LEVELS, axis=0), np.quantile(unlabelled, _LEVELS, axis=0))
    sides = [[rows[[zlib.crc32(r.tobytes()) % 2 == part for r in rows]] for part in (0, 1)] for rows in (positive, unlabelled)]
    apart = [_fit(sides[0][part], sides[1][part], None, edges)[0] for part in (0, 1)]
    halves = [places(apart[1 - part].margin(sides[1][part]), np.sort(apart[1 - part].margin(sides[0][part]))) for part in (0, 1)]
    return _fit(positive, unlabelled, smallest_ratio(halves), edges, apart)[0]


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo FOLDS (a null id: the empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(FOLDS))


def feature_rows(docs: DataFrame) -> DataFrame:
    """doc_id, part (null in the held-out fold and without an id, else 0 or 1
    by the text, so that copies are on one side) and the features of every
    document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), pa.array([features(t.as_py()) for t in batch.column("text")], pa.list_(pa.float32()))],
                names=["doc_id", "part", "x"])

    doc_id = F.col("doc_id").cast("bigint")
    part = F.when((fold(doc_id) != HELD_OUT) & doc_id.isNotNull(), F.pmod(F.xxhash64("text"), F.lit(2)).cast("int"))
    return texts(docs).select(doc_id.alias("doc_id"), part.alias("part"), "text").mapInArrow(run, "doc_id bigint, part int, x array<float>")


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of features, in single precision as they are staged."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _first(rows: DataFrame, most: int) -> list[np.ndarray]:
    """Features of the ``most`` rows with the smallest hashes of doc_id, one
    for each doc_id, by part."""
    chosen = rows.select("doc_id", "part", "x").orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(most).collect()
    seen = {r.doc_id: r for r in chosen}.values()
    width = len(chosen[0].x) if chosen else 1
    return [np.array([r.x for r in seen if r.part == part], np.float32).reshape(-1, width) for part in (0, 1)]


def _summed(rows: DataFrame, count) -> dict[int, float]:
    """The sums of ``count(part, x)``, an array for each batch, by place: a
    few thousand numbers, whatever the number of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            if batch.num_rows:
                total = total + count(batch.column("part").to_numpy(), _matrix(batch.column("x")))
        if np.ndim(total):
            place = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total[place].astype(float))], names=["place", "value"])

    found = rows.select("part", "x").mapInArrow(run, "place bigint, value double")
    return {r.place: r.value for r in found.groupBy("place").agg(F.sum("value").alias("value")).collect()}


def _dense(sums: dict[int, float], width: int) -> np.ndarray:
    out = np.zeros(width)
    out[list(sums)] = list(sums.values())
    return out


def prior_of(rows: DataFrame, positive: list[np.ndarray], models: list[Model]) -> float:
    """The class prior over all ``rows``: those of a part, and its positives,
    are ranked by the model of the other part."""
    ranked = [np.sort(models[1 - part].margin(positive[part])) for part in (0, 1)]
    cut = len(ranked[0]) + 1

    def count(part: np.ndarray, x: np.ndarray) -> np.ndarray:
        return np.concatenate([places(models[1 - own].margin(x[part == own]), ranked[own]) for own in (0, 1)])

    total = _dense(_summed(rows, count), cut + len(ranked[1]) + 1)
    return smallest_ratio([total[:cut], total[cut:]])


def descend(rows: DataFrame, positive: np.ndarray, model: Model, at: Adam, decay: float) -> Model:
    """``PASSES`` steps down the PU risk over all ``rows``; of the weights met
    the ones of the smallest risk stay."""
    p_rows, width, best = model.design(positive), len(at.w), math.inf
    for _ in range(PASSES):
        w = at.w

        def count(part: np.ndarray, x: np.ndarray, w: np.ndarray = w) -> np.ndarray:
            u_rows = model.design(x)
            su = _sigmoid(w[u_rows].sum(axis=1))
            return np.concatenate([push(u_rows, su * (1 - su), width), [su.sum(), len(su)]])

        total = _dense(_summed(rows, count), width + 2)
        risk, grad = pu_risk(w, p_rows, total[width] / total[-1], total[:width] / total[-1], model.prior, decay)
        if risk < best:
            best, kept = risk, w
        at.move(grad)
    return Model(model.edges, kept, model.prior)


def fit_rows(rows: DataFrame, good: DataFrame) -> Model | None:
    """Fit on :func:`feature_rows` and the ids of trusted positives; None
    without a trusted positive and another document in each part."""
    rows = rows.where("part is not null")
    few = good.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    few = few.where(fold(F.col("doc_id")) != HELD_OUT).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_POSITIVES)
    # at most MAX_POSITIVES ids are broadcast; of a repeated id one row counts
    known = rows.join(F.broadcast(few), "doc_id", "left_semi").groupBy("doc_id", "part").agg(F.min("x").alias("x"))
    positive, start = _first(known, MAX_POSITIVES), _first(rows, START_ROWS)
    if min(map(len, positive + start)) < 1:
        return None
    width = positive[0].shape[1]
    levels = rows.agg(*(F.percentile_approx(F.col("x")[i], list(_LEVELS), 1000).alias(f"q{i}") for i in range(width))).first()
    both = np.concatenate(positive), np.concatenate(start)
    edges = bins(np.quantile(both[0], _LEVELS, axis=0, method="lower"), np.array(levels, np.float32).T)
    apart = [_fit(positive[part], start[part], None, edges)[0] for part in (0, 1)]
    model, at = _fit(*both, prior_of(rows, positive, apart), edges, apart)
    return descend(rows, both[0], model, at, DECAY / len(both[1]))


def train(docs: DataFrame, labels: DataFrame) -> tuple[Model | None, DataFrame]:
    """The model, fitted on rows outside the held-out fold, and the staged
    features of all rows."""
    ship_package(docs.sparkSession)
    rows = stage(feature_rows(docs), "features")
    return fit_rows(rows, labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull())), rows


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (1 if score >= 0.5) for every row.

    Equal texts get equal scores; a null text is empty and scored like any
    other. Without trusted positives every score is 0.5, so nothing is
    rejected. Repeated rows get repeated results; an empty table gives an
    empty result.
    """
    model, rows = train(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(_matrix(batch.column("x"))) if model is not None and batch.num_rows else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    scored = rows.select("doc_id", "x").mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier predicts to be good, decided
    row by row where the text is, without a join."""
    model, _ = train(docs, labels)
    if model is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.array([features(t.as_py() or "") for t in batch.column("text")], np.float32)
                yield batch.filter(pa.array(model.score(x) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
