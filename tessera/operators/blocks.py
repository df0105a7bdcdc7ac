"""Trainers on blocks of rows: networks and kernel machines.

Spark ML's network keeps every copy of a minority row and works on few
partitions, one Java loop per neuron; its linear machine keeps the kernel features
of all rows (64 doubles a row).  Here the training rows are written once as blocks
(matrices of ``BLOCK_ROWS`` rows, single precision) over enough partitions and held
as bytes (in memory, on disk where that is short), which a job hands to Python as
they are.  An evaluation of loss and gradient is one Spark job: NumPy on each block,
sums in double precision per task, then over the tasks, so the driver gets a bounded
number of gradients whatever the number of rows.  L-BFGS on the driver keeps ten
pairs of vectors.  Rows that count several times are weighted, which is the loss of
their copies.

Models that learn from different rows of one table (folds) are trained side by side:
a row has a weight for each of them, 0 where it is not theirs, and one job evaluates
all models at their points.  Each takes the steps it would take alone.

A trained network is Spark ML's own model, started from Spark's own first weights.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Callable, Generator, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage, release

BLOCK_ROWS = 1024
#: bytes of blocks in one task, at most
PART_BYTES = 32 << 20
#: tasks whose sums go to the driver as they are
DIRECT_TASKS = 32


def parts_of(rows: DataFrame, n: int, row_bytes: int) -> int:
    """At least two tasks a core, the same number for each core."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return cores * max(2, math.ceil(n * row_bytes / PART_BYTES / cores))


def spread(rows: DataFrame, key: str, n: int, row_bytes: int) -> DataFrame:
    """Rows over at least two tasks a core, in an order that depends on them only."""
    return rows.repartition(parts_of(rows, n, row_bytes), key).sortWithinPartitions(key)


def pack(rows: DataFrame, key: str = "key", label: str = "label", weight: Column | Sequence[Column] | None = None,
         by: str | None = None) -> DataFrame:
    """(n, x, y, w): the training rows as blocks, written once.  Several weights, one
    for each model, are the columns of ``w``; a block has rows of one value of ``by``."""
    weight = F.lit(1.0) if weight is None else weight
    weights = [weight] if isinstance(weight, Column) else list(weight)
    many = len(weights)
    flat = rows.select(F.col(key).alias("key"), (F.lit(0) if by is None else F.col(by).cast("int")).alias("b"),
                       vector_to_array("features", "float32").alias("x"), F.col(label).cast("int").alias("y"),
                       F.array(*[w.cast("float") for w in weights]).alias("w"))
    first = flat.select("x").first()
    if first is None:
        raise ValueError("no training rows")
    if flat.rdd.getNumPartitions() < flat.sparkSession.sparkContext.defaultParallelism:
        flat = spread(flat, "key", flat.count(), 4 * len(first[0]) + 4 + 4 * many)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if any(batch.column(i).null_count for i in range(4)) or batch.column(3).flatten().null_count:
                raise ValueError("training rows need features, a label and a weight")
            n = batch.num_rows
            b, x, y, w = (batch.column(i).flatten().to_numpy().reshape(n, -1) if i in (1, 3) else batch.column(i).to_numpy() for i in range(4))
            order = np.argsort(b, kind="stable")
            edges = np.r_[0, np.flatnonzero(np.diff(b[order])) + 1, n]
            for lo, hi in ((at, min(at + BLOCK_ROWS, end)) for start, end in zip(edges, edges[1:], strict=False) for at in range(start, end, BLOCK_ROWS)):
                part = order[lo:hi]
                yield pa.RecordBatch.from_pydict({"n": pa.array([len(part)], pa.int32()), **{
                    k: pa.array([np.ascontiguousarray(v[part]).tobytes()], pa.binary()) for k, v in (("x", x), ("y", y), ("w", w))}})

    laid = flat.select("b", "x", "y", "w")
    return cut_lineage(laid.mapInArrow(blocks, "n int, x binary, y binary, w binary"))


BlockLoss = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[float, np.ndarray]]
Sums = dict[int, tuple[float, float, np.ndarray]]


class Held:
    """Packed blocks for many passes: dealt evenly, kept as bytes."""

    def __init__(self, blocks: DataFrame):
        self.blocks = blocks
        flat = blocks.select("n", "x", "y", "w").rdd.map(lambda r: (r[0], bytes(r[1]), bytes(r[2]), bytes(r[3])))
        parts = flat.context.defaultParallelism
        # as many for each core, whatever the splits of the files
        parts *= max(2, math.ceil(flat.getNumPartitions() / parts))
        self.rdd = flat.repartition(parts).persist(StorageLevel.MEMORY_AND_DISK)

    def totals(self, losses: Mapping[int, BlockLoss], prepare: Callable[[np.ndarray], np.ndarray] | None = None) -> Sums:
        """Per model (the number of its weight) the sums over all blocks of its loss
        (X, y, w) -> (loss, vector), and of its weights; ``prepare`` makes X of a
        block's features, once for all models."""

        def task(held: Iterator[tuple]) -> Iterator[tuple]:
            sums: Sums = {}
            for n, x, y, w in held:
                X, y, w = np.frombuffer(x, np.float32).reshape(n, -1), np.frombuffer(y, np.int32), np.frombuffer(w, np.float32).reshape(n, -1)
                made = None
                for k, of in losses.items():
                    wk = np.ascontiguousarray(w[:, k])
                    if not wk.any():
                        continue
                    if made is None:
                        made = X if prepare is None else prepare(X)
                    loss, g = of(made, y, wk)
                    l0, w0, v = sums.get(k, (0.0, 0.0, 0.0))
                    sums[k] = (l0 + loss, w0 + float(wk.sum(dtype=np.float64)), v + g.astype(np.float64))
            for k, (loss, weight, vector) in sums.items():
                yield k, loss, weight, vector.tobytes()

        def joined(found: Iterator[tuple]) -> Iterator[tuple]:
            by: dict = {}
            for k, *rest in found:
                by.setdefault(k, []).append(tuple(rest))
            for k, rows in by.items():
                vector = np.zeros(len(rows[0][2]) // 8)
                for row in sorted(rows):    # the order of the tasks' ends does not count
                    vector += np.frombuffer(row[2])
                yield k, math.fsum(r[0] for r in rows), math.fsum(r[1] for r in rows), vector.tobytes()

        found, parts = self.rdd.mapPartitions(task), self.rdd.getNumPartitions()
        if parts > DIRECT_TASKS:
            deal = math.isqrt(parts)
            found = found.mapPartitionsWithIndex(lambda i, rows: ((i % deal, r) for r in rows)).partitionBy(
                deal, lambda i: i).values().mapPartitions(joined)
        return {k: (loss, weight, np.frombuffer(v)) for k, loss, weight, v in joined(iter(found.collect()))}

    def release(self) -> None:
        self.rdd.unpersist()
        release(self.blocks)


def total(blocks: DataFrame, of: BlockLoss) -> tuple[float, float, np.ndarray]:
    """Sums over all blocks of ``of`` (X, y, w) -> (loss, vector), and of the weights."""
    return Held(blocks).totals({0: of})[0]


Value = tuple[float, np.ndarray]


def descend(x: np.ndarray, max_iter: int, tol: float = 1e-6, memory: int = 10) -> Generator[np.ndarray, Value, tuple[np.ndarray, list[float]]]:
    """L-BFGS with a Wolfe line search: it asks for the value and the slope at a point
    and is sent them.  It stops when the last 20 values lie within ``tol`` of the first
    value, the gradient is as small, or no step goes down.  Returns the point and the
    value after each iteration."""
    f, g = yield x
    values, pairs = [f], []
    for it in range(max_iter):
        if np.linalg.norm(g) <= max(tol * abs(f), 1e-8):
            break
        d, alphas = -g, []
        for s, y, rho in reversed(pairs):
            a = rho * (s @ d)
            alphas.append(a)
            d = d - a * y
        if pairs:
            s, y, _ = pairs[-1]
            d = d * ((s @ y) / (y @ y))
        for (s, y, rho), a in zip(pairs, reversed(alphas), strict=True):
            d = d + s * (a - rho * (y @ d))
        slope = g @ d
        if slope >= 0:
            d, slope, pairs = -g, -(g @ g), []
        step, lo, hi, found = (1.0 if pairs else 1.0 / np.linalg.norm(d)), 0.0, math.inf, None
        for _ in range(20):
            fn, gn = yield x + step * d
            if not fn <= f + 1e-4 * step * slope:
                hi = step
            else:
                found = (step, fn, gn)
                if gn @ d >= 0.9 * slope:
                    break
                lo = step
            step = (lo + hi) / 2 if hi < math.inf else 2 * lo
        if found is None:
            break
        step, fn, gn = found
        s, y = step * d, gn - g
        if s @ y > 1e-10 * (y @ y):
            pairs = [*pairs, (s, y, 1.0 / (s @ y))][-memory:]
        x, f, g = x + s, fn, gn
        values.append(f)
        if max(values[-20:]) - f <= tol * abs(values[0]):
            break
    return x, values


def minimise(value: Callable[[np.ndarray], Value], x: np.ndarray, max_iter: int,
             tol: float = 1e-6, memory: int = 10) -> tuple[np.ndarray, list[float]]:
    """``descend`` by a function of one point."""
    return minimise_all(lambda at: {0: value(at[0])}, {0: x}, max_iter, tol, memory)[0]


def minimise_all(values: Callable[[dict[int, np.ndarray]], Mapping[int, Value]], starts: Mapping[int, np.ndarray], max_iter: int,
                 tol: float = 1e-6, memory: int = 10) -> dict[int, tuple[np.ndarray, list[float]]]:
    """Several models descend side by side: ``values`` is asked once for the points of
    all that still go on."""
    runs = {k: descend(x, max_iter, tol, memory) for k, x in starts.items()}
    at, done = {k: next(run) for k, run in runs.items()}, {}
    while at:
        asked, at = values(at), {}
        for k, found in asked.items():
            try:
                at[k] = runs[k].send(found)
            except StopIteration as end:
                done[k] = end.value
    return done


# ---- networks --------------------------------------------------------------------

def network_loss(layers: Sequence[int], weights: np.ndarray) -> BlockLoss:
    """Cross entropy and its gradient of a network with sigmoid hidden layers and a
    softmax, its weights in Spark ML's order.  Inside, a row is a column: a layer's
    numbers lie together, with a line of ones for the biases, and are changed in place."""
    mats, at = [], 0
    for a, b in zip(layers, layers[1:], strict=False):
        mats.append(weights[at : at + (a + 1) * b].reshape(a + 1, b).astype(np.float32))
        at += (a + 1) * b
    forth = [np.ascontiguousarray(-m.T) for m in mats[:-1]] + [np.ascontiguousarray(mats[-1].T)]
    back = [np.ascontiguousarray(m[:-1]) for m in mats]
    space: dict[int, tuple] = {}

    def of(X: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray]:
        n = len(y)
        if n and not 0 <= y.min() <= y.max() < layers[-1]:
            raise ValueError(f"labels outside 0 to {layers[-1] - 1}")
        if n not in space:
            space.clear()
            space[n] = ([np.ones((h + 1, n), np.float32) for h in layers[:-1]],
                        *([np.empty((h, n), np.float32) for h in layers[:-1]] for _ in range(2)), np.arange(n))
        acts, deltas, spare, rows = space[n]
        acts[0][:-1] = X.T
        with np.errstate(over="ignore"):
            for i, W in enumerate(forth[:-1]):
                z = np.matmul(W, acts[i], out=acts[i + 1][:-1])
                np.exp(z, out=z)
                z += 1
                np.reciprocal(z, out=z)
        z = forth[-1] @ acts[-1]
        z -= z.max(axis=0)
        right = z[y, rows]
        delta = np.exp(z, out=z)
        s = delta.sum(axis=0)
        loss = float(((np.log(s) - right) * w).sum(dtype=np.float64))
        delta /= s
        delta[y, rows] -= 1
        delta *= w
        parts = []
        for i in range(len(mats) - 1, -1, -1):
            parts.append((acts[i] @ delta.T).ravel())
            if i:
                a, delta = acts[i][:-1], np.matmul(back[i], delta, out=deltas[i])
                delta *= a      # times a (1 - a)
                delta -= np.multiply(delta, a, out=spare[i])
        return loss, np.concatenate(parts[::-1])

    return of


class Network:
    """A multilayer perceptron: ``fit`` trains it on blocks and returns Spark ML's
    model.  ``weight`` (a column) counts a row several times."""

    def __init__(self, layers: Sequence[int], max_iter: int = 100, seed: int = 42, weight: Callable[[DataFrame], Column] | None = None):
        self.layers, self.max_iter, self.seed, self.weight = list(layers), max_iter, seed, weight

    def fit(self, train: DataFrame):
        models, (self.values,) = self._fit(train, [F.lit(1.0) if self.weight is None else self.weight(train)])
        return models[0]

    def fit_folds(self, train: DataFrame, fold: str, folds: Sequence[int]) -> dict[int, object]:
        """For each fold the model of ``fit`` on the rows of the others, trained side by side."""
        models, self.fold_values = self._fit(train, fold_weights(train, fold, folds, self.weight), fold)
        return dict(zip(folds, models, strict=True))

    def _fit(self, train: DataFrame, weights: Sequence[Column], by: str | None = None) -> tuple[list, list]:
        spark = train.sparkSession
        # the form of the data is all that Spark needs for its first weights and its model
        form = spark.range(2).select(array_to_vector(F.array_repeat(F.lit(0.0), self.layers[0])).alias("features"), F.col("id").cast("double").alias("label"))
        shell = MultilayerPerceptronClassifier(layers=self.layers, maxIter=0, seed=self.seed)
        start = shell.fit(form).weights.toArray()
        held = Held(pack(train, weight=weights, by=by))

        def values(at: dict[int, np.ndarray]) -> dict[int, Value]:
            sums = held.totals({k: network_loss(self.layers, x) for k, x in at.items()})
            missing = sorted(set(at) - set(sums))
            if missing:
                raise ValueError("no training rows")
            return {k: (loss / n, g / n) for k, (loss, n, g) in sums.items()}

        found = minimise_all(values, dict.fromkeys(range(len(weights)), start), self.max_iter)
        held.release()
        return ([shell.copy().setInitialWeights(Vectors.dense(found[k][0])).fit(form) for k in range(len(weights))],
                [found[k][1] for k in range(len(weights))])


def fold_weights(train: DataFrame, fold: str, folds: Sequence[int], weight: Callable[[DataFrame], Column] | None = None) -> list[Column]:
    """For each fold the rows' weights in the model that learns from the others."""
    own = [F.col(fold) == k for k in folds]
    return [F.when(x, F.lit(0.0)).otherwise(F.lit(1.0) if weight is None else weight(train.where(~x))) for x in own]


# ---- kernel machines -------------------------------------------------------------

def fourier(x: np.ndarray, turn: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Random Fourier features of a block's rows: sqrt(2/D) cos(W x + b)."""
    z = x @ turn.T
    z += shift
    np.cos(z, out=z)
    z *= np.float32(math.sqrt(2.0 / len(shift)))
    return z


class FourierMachine:
    """A linear support vector machine (hinge loss, ``reg`` on the coefficients of
    standardised features, as Spark ML's) on random Fourier features that each
    evaluation computes from the raw features: 64 numbers a row are never kept."""

    def __init__(self, turn: np.ndarray, shift: np.ndarray, max_iter: int, reg: float, weight: str = "weight"):
        self.turn, self.shift, self.max_iter, self.reg, self.weight = turn, shift, max_iter, reg, weight

    def fit(self, train: DataFrame) -> FourierMachine:
        return self._fit(train, [F.col(self.weight)])[0]

    def fit_folds(self, train: DataFrame, fold: str, folds: Sequence[int]) -> dict[int, FourierMachine]:
        """For each fold the machine of ``fit`` on the rows of the others, trained side
        by side: a row's kernel features are computed once for all."""
        return dict(zip(folds, self._fit(train, fold_weights(train, fold, folds, lambda _: F.col(self.weight)), fold), strict=True))

    def _fit(self, train: DataFrame, weights: Sequence[Column], by: str | None = None) -> list[FourierMachine]:
        held = Held(pack(train, weight=weights, by=by))
        turn, shift, d = self.turn.astype(np.float32), self.shift.astype(np.float32), len(self.shift)
        kernel = lambda x: fourier(x, turn, shift)

        def moments(z, y, w):
            return 0.0, np.r_[w @ z, w @ (z * z)]

        mean, scale, total = {}, {}, {}
        for k, (_, n, sums) in held.totals(dict.fromkeys(range(len(weights)), moments), kernel).items():
            mean[k], total[k] = sums[:d] / n, n
            std = np.sqrt(np.maximum(sums[d:] / n - mean[k] ** 2, 0.0))
            scale[k] = np.divide(1.0, std, out=np.zeros(d), where=std > 1e-6)
        if len(total) < len(weights):
            raise ValueError("no training rows")

        def hinge(k: int, at: np.ndarray) -> BlockLoss:
            beta = (at[:d] * scale[k]).astype(np.float32)
            offset = np.float32(at[d] - (at[:d] * scale[k]) @ mean[k])

            def of(z, y, w):
                sign = np.where(y > 0, np.float32(1), np.float32(-1))
                slack = 1 - sign * (z @ beta + offset)
                pull = np.where(slack > 0, -sign * w, np.float32(0))
                return float((np.maximum(slack, 0) * w).sum(dtype=np.float64)), np.r_[pull @ z, pull.sum()]

            return of

        def values(at: dict[int, np.ndarray]) -> dict[int, Value]:
            out = {}
            for k, (loss, _, g) in held.totals({k: hinge(k, x) for k, x in at.items()}, kernel).items():
                n, x = total[k], at[k]
                slope = np.r_[(g[:d] - mean[k] * g[d]) * scale[k] + self.reg * n * x[:d], g[d]] / n
                out[k] = (loss / n + self.reg / 2 * float(x[:d] @ x[:d]), slope)
            return out

        found = minimise_all(values, dict.fromkeys(range(len(weights)), np.zeros(d + 1)), self.max_iter)
        held.release()
        machines = [self if len(weights) == 1 else copy.copy(self) for _ in weights]
        for k, machine in enumerate(machines):
            at, machine.values = found[k]
            machine.coefficients = at[:d] * scale[k]
            machine.intercept = float(at[d] - machine.coefficients @ mean[k])
        return machines

    def transform(self, rows: DataFrame) -> DataFrame:
        """Rows with ``rawPrediction`` (minus the margin, the margin) and ``prediction``."""
        turn, shift, coefficients, intercept = self.turn, self.shift, self.coefficients, self.intercept

        @F.pandas_udf("double")
        def margin(x: pd.Series) -> pd.Series:
            return pd.Series(fourier(np.stack(x), turn, shift) @ coefficients + intercept if len(x) else [], dtype="float64")

        out = rows.withColumn("__m", margin(vector_to_array("features")))
        return out.withColumn("rawPrediction", array_to_vector(F.array(-F.col("__m"), F.col("__m")))).withColumn(
            "prediction", (F.col("__m") > 0).cast("double")).drop("__m")
