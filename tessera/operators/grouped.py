"""Trees of Spark ML fitted on groups of rows.

A tree sees of a feature only between which of at most ``BINS - 1`` cuts it lies.  Rows
with the same bins and label are one row to it, with the sum of their weights.  So the
rows are binned and counted in one pass, and Spark ML's own estimators are fitted on
the counted groups, at most as many as rows: few where features are few, since 32 bins
of two numbers and the levels of two categories have 25,600 combinations whatever the
rows.  Cuts: halfway between a feature's values if there are at most ``BINS``, else
its quantiles over all training rows (Spark takes them from a sample of rows).

What counts rows still does: ``minInstancesPerNode`` (a group enters as that many rows
of its weight, if it holds as many), and the bootstrap of a forest.  There a row
counts Poisson(1) times in a tree, so a group of n equal rows Poisson(n) times; each
tree is fitted on counts of its own.
"""

from __future__ import annotations

import hashlib
import math
import threading
from collections.abc import Iterator
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage, release

#: Spark ML's ``maxBins``
BINS = 32
#: trees of a forest fitted side by side
PARALLEL_TREES = 8
#: groups in one task
PART_GROUPS = 1 << 17


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def cuts_of(train: DataFrame, bins: int = BINS) -> list[np.ndarray]:
    """Per feature the cuts between its bins: x is in bin b if b cuts lie below it."""
    x = train.select(vector_to_array("features").alias("x"))

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: list | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            m = _matrix(batch.column(0))
            known = [np.zeros(0)] * m.shape[1] if known is None else known
            for f in range(m.shape[1]):
                if len(known[f]) <= bins:
                    known[f] = np.union1d(known[f], m[:, f])[: bins + 1]
        for f, values in enumerate(known or []):
            yield pa.RecordBatch.from_pydict({"f": pa.array([f] * len(values), pa.int32()), "v": pa.array(values, pa.float64())})

    # at most bins + 1 values of a feature and task
    found = x.mapInArrow(distinct, "f int, v double").distinct().toPandas()
    if not len(found):
        raise ValueError("no training rows")
    values = {f: np.sort(v.to_numpy()) for f, v in found.groupby("f")["v"]}
    many = [f for f in sorted(values) if len(values[f]) > bins]
    cuts = {f: (v[:-1] + v[1:]) / 2 for f, v in values.items() if len(v) <= bins}
    if many:
        share = [i / bins for i in range(1, bins)]
        at = x.agg(*[F.percentile_approx(F.get("x", F.lit(f)), share, 10000).alias(str(f)) for f in many]).first()
        cuts.update({f: np.unique(at[str(f)]) for f in many})
    return [cuts[f] for f in range(len(cuts))]


def _bin(x: Column, cuts: np.ndarray, lo: int = 0) -> Column:
    """How many cuts lie below x, by halving."""
    if not len(cuts):
        return F.lit(float(lo))
    mid = len(cuts) // 2
    return F.when(x <= F.lit(float(cuts[mid])), _bin(x, cuts[:mid], lo)).otherwise(_bin(x, cuts[mid + 1 :], lo + mid + 1))


class Groups:
    """Training rows by bins and label: ``rows`` has bins (as ``features``), label, n and weight."""

    def __init__(self, train: DataFrame, weight: str = "weight", bins: int = BINS):
        self.cuts = cuts_of(train, bins)
        cuts = self.cuts

        def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                m = _matrix(batch.column(0))
                code = np.empty((batch.num_rows, len(cuts)), np.uint8)
                for f, c in enumerate(cuts):
                    code[:, f] = np.searchsorted(c, m[:, f]) if len(c) != 1 else m[:, f] > c[0]
                at = np.arange(0, code.size + 1, len(cuts), dtype=np.int32)
                binary = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(at), pa.py_buffer(code)])
                yield pa.RecordBatch.from_arrays([binary, batch.column(1), batch.column(2)], names=["code", "label", "weight"])

        @F.pandas_udf("array<double>")
        def decoded(code: pd.Series) -> pd.Series:
            return pd.Series([np.frombuffer(c, np.uint8).astype(np.float64) for c in code], dtype=object)

        flat = train.select(vector_to_array("features").alias("x"), F.col("label").cast("double").alias("label"),
                            F.col(weight).cast("double").alias("weight"))
        found = flat.mapInArrow(coded, "code binary, label double, weight double").groupBy("code", "label").agg(
            F.count("*").alias("n"), F.sum("weight").alias("weight"))
        laid = cut_lineage(found)
        # few tasks for few groups: a fit is a series of small jobs
        parts = math.ceil(laid.count() / PART_GROUPS)
        self.rows = cut_lineage(laid.repartition(max(1, parts), "code", "label").sortWithinPartitions("code", "label").withColumn(
            "features", array_to_vector(decoded("code"))))
        release(laid)

    def vector(self, features: str = "features") -> Column:
        """The bins of a row's features."""
        x = vector_to_array(features)
        return array_to_vector(F.array(*[_bin(F.get(x, F.lit(f)), c) for f, c in enumerate(self.cuts)]))

    def fit(self, estimator):
        """A tree, a forest or a boosted ensemble fitted on the groups."""
        if not isinstance(estimator, RandomForestClassifier):
            return Binned(estimator.copy({estimator.weightCol: "weight"}).fit(_as_rows(self.rows, F.col("n"), estimator)), self)
        trees = estimator.getNumTrees()
        drawn = cut_lineage(bootstrapped(self.rows, trees, estimator.getSeed()))

        def tree(b: int):
            count = F.get("counts", F.lit(b))
            rows = drawn.where(count > 0).withColumn("weight", F.col("weight") * count / F.col("n"))
            one = estimator.copy({estimator.weightCol: "weight", estimator.numTrees: 1, estimator.bootstrap: False,
                                  estimator.seed: estimator.getSeed() + 7919 * b})
            return one.fit(_as_rows(rows, count, estimator))

        with ThreadPool(PARALLEL_TREES) as pool:
            fitted = pool.map(inheritable_thread_target(self.rows.sparkSession)(tree), range(trees), chunksize=1)
        return Binned(_forest(fitted, estimator), self)


def _as_rows(rows: DataFrame, n: Column, estimator) -> DataFrame:
    """Groups as as many rows as ``minInstancesPerNode`` can tell from more."""
    least = estimator.getMinInstancesPerNode()
    if least <= 1:
        return rows
    copies = F.least(n, F.lit(least)).cast("int")
    return rows.withColumn("weight", F.col("weight") / copies).withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))


def bootstrapped(rows: DataFrame, trees: int, seed: int) -> DataFrame:
    """Groups with ``counts``: per tree a Poisson(n) number, from the group and the seed alone."""

    @F.pandas_udf("array<long>")
    def counts(code: pd.Series, label: pd.Series, n: pd.Series) -> pd.Series:
        out = []
        for c, y, k in zip(code, label, n, strict=True):
            key = int.from_bytes(hashlib.blake2b(bytes(c) + np.array([y, seed], np.float64).tobytes(), digest_size=8).digest())
            out.append(np.random.Generator(np.random.Philox(key=key)).poisson(k, trees))
        return pd.Series(out, dtype=object)

    return rows.withColumn("counts", counts("code", "label", "n"))


def _forest(models: list, estimator: RandomForestClassifier) -> RandomForestClassificationModel:
    """Forests of one tree as one forest."""
    first, sc = models[0]._java_obj, SparkContext._active_spark_context
    kind = sc._jvm.org.apache.spark.ml.classification
    trees = sc._gateway.new_array(kind.DecisionTreeClassificationModel, len(models))
    for i, m in enumerate(models):
        trees[i] = m._java_obj.trees()[0]
    whole = kind.RandomForestClassificationModel(first.uid(), trees, first.numFeatures(), first.numClasses())
    estimator._transfer_params_to_java()
    return RandomForestClassificationModel(estimator._java_obj.copyValues(whole, estimator._java_obj.extractParamMap()))


class Binned:
    """A model fitted on groups, for rows: ``model`` is Spark ML's, over bins."""

    def __init__(self, model, groups: Groups):
        self.model, self.groups = model, groups
        # a feature's importance does not depend on how its values are numbered
        self.featureImportances = model.featureImportances

    def transform(self, rows: DataFrame) -> DataFrame:
        found = self.model.transform(rows.withColumnRenamed("features", "__raw").withColumn("features", self.groups.vector("__raw")))
        return found.drop("features").withColumnRenamed("__raw", "features")


class Shared:
    """Makes estimators that are fitted on groups; those of the same training rows
    share them.  ``shared(estimator).fit(train)``."""

    def __init__(self):
        self.lock, self.found = threading.Lock(), []

    def groups(self, train: DataFrame) -> Groups:
        with self.lock:
            entry = next((e for e in self.found if e[0].sameSemantics(train)), None)
            if entry is None:
                entry = (train, threading.Lock(), [])
                self.found.append(entry)
        with entry[1]:
            if not entry[2]:
                entry[2].append(Groups(train))
        return entry[2][0]

    def __call__(self, estimator) -> _OnGroups:
        return _OnGroups(self, estimator)


class _OnGroups:
    def __init__(self, shared: Shared, estimator):
        self.shared, self.estimator = shared, estimator

    def fit(self, train: DataFrame) -> Binned:
        return self.shared.groups(train).fit(self.estimator)
