"""A quality classifier learned from positives and unlabelled text.

Trusted positives are documents labelled 1; everything else is unlabelled web
text, whatever its label.  A small network minimises the non-negative unbiased
risk

    prior * E_positive[loss(+)] + max(0, E_unlabelled[loss(-)] - prior * E_positive[loss(-)])

with the logistic loss; where the bracket turns negative in a batch, the step
goes against it, so the network cannot gain by overfitting the positives.

The class prior is estimated from positives and unlabelled rows alone: a first
network tells the two apart on one half of each sample; on the other half, the
share of unlabelled rows above a score, over the share of positives above it, is
an upper bound of the prior at every score, and the bound with the least
confidence limit is taken (best bin).  Labels other than 1 are never looked at.

Inputs are measures of the text alone (character classes, word repetition,
lengths); labels, language, source and doc_id are never inputs.  Training uses
at most about ``SAMPLE`` positives and as many unlabelled rows, picked by a hash
of doc_id over the whole table; scoring covers every row.

Defined results: null and empty texts are scored like any other (all measures
0); a doc_id with several labels counts as positive when all are 1; labels of
documents that do not exist count for nothing; without a positive to learn from
every score is ``NO_PRIOR``; repeated rows give repeated results; an empty table
gives an empty one.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import small_batches, text_or_empty

#: bound on the sampled positives and on the sampled unlabelled rows
SAMPLE = 20_000
FOLDS = 5
THRESHOLD = 0.3
HIDDEN = 24
STEPS = 1500
BATCH = 2048
SEED = 7
#: score where nothing can be learned
NO_PRIOR = 0.5
#: probability of error of the confidence limits, and their weight
PRIOR_ERROR, PRIOR_WEIGHT = 0.1, 1.01
#: rows of a sample that may be split in halves for the prior
MIN_HALVES = 20

_KINDS = np.zeros(256, np.uint8)
for _i, _set in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n",
                           b".,;:?'\"()-", b"!", b"#*$%&|<>@^~=+_/\\{}[]`", bytes(range(128, 256)))):
    _KINDS[list(_set)] = _i + 1
N_FEATURES = 10 + 9


def measures(text: str) -> list[float]:
    """Measures of a text, each on a scale of about 0 to 1."""
    data = np.frombuffer(text.encode(), np.uint8)
    kinds = np.bincount(_KINDS[data], minlength=10) / max(1, len(data))
    words = text.split()
    n = max(1, len(words))
    counts = Counter(words)
    pairs = max(1, len(words) - 1)
    lines = [x for x in text.split("\n") if x.strip()]
    return [
        *kinds.tolist(),
        np.log1p(len(words)) / 10,
        len(counts) / n,
        np.log1p(len(counts)) / max(1.0, np.log1p(n)),
        max(counts.values(), default=0) / n,
        sum(map(operator.eq, words, words[1:])) / pairs,
        len(set(zip(words, words[1:], strict=False))) / pairs,
        sum(map(str.isupper, words)) / n,
        min(1.0, len(text) / n / 20),
        1 - len(set(lines)) / max(1, len(lines)),
    ]


@dataclass
class Network:
    """One hidden layer over standardised measures."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float

    def score(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1)
        return 1 / (1 + np.exp(-np.clip(hidden @ self.w2 + self.b2, -30, 30)))


def risk(weights: list[np.ndarray], p: np.ndarray, u: np.ndarray, prior: float) -> tuple[float, float, list[np.ndarray], list[np.ndarray]]:
    """(prior * E_p[loss(+)], the bracket, and their gradients by ``weights``) over
    standardised rows ``p`` (positive) and ``u`` (unlabelled)."""
    x = np.concatenate([p, u])
    hidden = np.tanh(x @ weights[0] + weights[1])
    out = np.clip(hidden @ weights[2] + weights[3], -30, 30)
    up = 1 / (1 + np.exp(-out))                           # d loss(-) / d out
    gp, gu = np.zeros(len(x)), np.zeros(len(x))
    gp[: len(p)] = prior * (up[: len(p)] - 1) / len(p)    # prior * loss(+) on positives
    gu[: len(p)] = -prior * up[: len(p)] / len(p)         # the bracket
    gu[len(p) :] = up[len(p) :] / len(u)
    minus = np.logaddexp(0, out)

    def by_weights(g: np.ndarray) -> list[np.ndarray]:
        back = np.outer(g, weights[2]) * (1 - hidden**2)
        return [x.T @ back, back.sum(axis=0), hidden.T @ g, np.array([g.sum()])]

    return (prior * np.logaddexp(0, -out[: len(p)]).mean(), minus[len(p) :].mean() - prior * minus[: len(p)].mean(),
            by_weights(gp), by_weights(gu))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Network:
    """Minimise the non-negative risk by Adam over random batches."""
    rng = np.random.default_rng(SEED)
    pool = np.concatenate([positive, unlabelled])
    mean, scale = pool.mean(axis=0), pool.std(axis=0) + 1e-3
    positive, unlabelled = (positive - mean) / scale, (unlabelled - mean) / scale
    d = positive.shape[1]
    weights = [rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    moment, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, STEPS + 1):
        p = positive[rng.integers(0, len(positive), BATCH)]
        u = unlabelled[rng.integers(0, len(unlabelled), BATCH)]
        _, bracket, gp, gu = risk(weights, p, u, prior)
        grads = [a + b if bracket >= 0 else -b for a, b in zip(gp, gu, strict=True)]
        grads[0], grads[2] = grads[0] + 1e-5 * weights[0], grads[2] + 1e-5 * weights[2]
        rate = 0.01 * (1 - step / (STEPS + 1))
        for k, grad in enumerate(grads):
            moment[k] = 0.9 * moment[k] + 0.1 * grad
            square[k] = 0.99 * square[k] + 0.01 * grad**2
            weights[k] = weights[k] - rate * (moment[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
    return Network(mean, scale, weights[0], weights[1], weights[2], float(weights[3][0]))


def best_bin(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The prior from scores of positives and of unlabelled rows that no fit has seen."""
    cuts = np.unique(positive)
    above = [1 - np.searchsorted(np.sort(s), cuts, side="left") / len(s) for s in (positive, unlabelled)]
    slack = PRIOR_WEIGHT * sum(np.sqrt(np.log(4 / PRIOR_ERROR) / (2 * len(s))) for s in (positive, unlabelled))
    at = int(np.argmin((above[1] + slack) / above[0]))
    return float(np.clip(above[1][at] / above[0][at], 0.01, 0.99))


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled rows; ``NO_PRIOR`` below ``MIN_HALVES`` rows."""
    if min(len(positive), len(unlabelled)) < MIN_HALVES:
        return NO_PRIOR
    apart = fit(positive[::2], unlabelled[::2], 0.5)
    return best_bin(apart.score(positive[1::2]), apart.score(unlabelled[1::2]))


def held_out() -> Column:
    """Whether a row belongs to the fold whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS, F.lit(0)) == 0


def measured(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series([measures(t) for t in s], dtype=object)

    return of(text)


def _share(rows: int) -> Column:
    """Picks about ``SAMPLE`` of ``rows`` rows by a hash of doc_id."""
    return F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1_000_000)) < int(1_000_000 * min(1.0, SAMPLE / max(1, rows)))


def samples(docs: DataFrame, labels: DataFrame) -> list[np.ndarray]:
    """Measures of the sampled positives and of the sampled unlabelled rows."""
    known = labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(
        F.min("quality").alias("quality")).where("quality = 1")
    trusted = known.where(_share(known.count())).select("doc_id")
    text = text_or_empty()
    open_rows = docs.where(~held_out() & F.col("doc_id").isNotNull()).select("doc_id", text.alias("text"))
    rows = open_rows.count()
    # the sampled numbers are bounded by SAMPLE, so they may be broadcast
    p = open_rows.join(F.broadcast(trusted), "doc_id").select(measured(F.col("text")).alias("x"))
    u = open_rows.where(_share(rows)).select(measured(F.col("text")).alias("x"))
    xs = [np.array(s.toPandas()["x"].tolist(), float).reshape(-1, N_FEATURES) for s in (p, u)]
    # a sample comes in any order: sort it, so that runs agree
    return [x[np.lexsort(x.T)] for x in xs]


def learn(docs: DataFrame, labels: DataFrame) -> Network | float:
    """The fitted network, or ``NO_PRIOR`` where there is nothing to learn from."""
    positive, unlabelled = samples(docs, labels)
    if not len(positive) or not len(unlabelled):
        return NO_PRIOR
    return fit(positive, unlabelled, class_prior(positive, unlabelled))


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    small_batches(docs)
    model = learn(docs, labels)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            if isinstance(model, float):
                yield pd.Series(np.full(len(s), model))
            else:
                yield pd.Series(model.score(np.array([measures(t) for t in s], float).reshape(-1, N_FEATURES)))

    return docs.select("doc_id", held_out().alias("held_out"), score(text_or_empty()).alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))
