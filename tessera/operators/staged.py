"""Curves against a hyper-parameter from one fitted ensemble and one scan.

An ensemble of B trees contains the ensembles of its first 1 .. B trees, and a tree
of depth D contains, cut off, the trees of depth 0 .. D (a greedy tree grows the
same splits whatever its final depth).  The nodes are read from the model's own
files; every row walks all trees once and leaves with the score of every stage.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.exprs import THRESHOLD, safe_div
from tessera.operators import metrics as M
from tessera.session import cut_lineage
from tessera.sources.files import scratch_path

#: nodes of a model that reach the driver
MAX_NODES = 1 << 20


class Trees:
    """Nodes of a fitted tree or ensemble as arrays, trees one behind the other."""

    def __init__(self, spark: SparkSession, model):
        path = scratch_path(spark, "trees")
        model.write().overwrite().save(path)
        rows = spark.read.parquet(f"{path}/data")
        node = "nodeData." if "nodeData" in rows.columns else ""
        tree = F.col("treeID") if node else F.lit(0)
        names = ("id", "prediction", "impurityStats", "leftChild", "rightChild")
        nodes = rows.select(tree.alias("tree"), *[F.col(node + x).alias(x) for x in names],
                            F.col(f"{node}split.featureIndex").alias("feature"), F.col(f"{node}split.numCategories").alias("categories"),
                            F.col(f"{node}split.leftCategoriesOrThreshold").alias("at")).limit(MAX_NODES + 1).toPandas()
        if len(nodes) > MAX_NODES:
            raise ValueError(f"more than {MAX_NODES} nodes")
        nodes = nodes.sort_values(["tree", "id"], ignore_index=True)
        inner = nodes["leftChild"] >= 0
        if (nodes.loc[inner, "categories"] >= 0).any():
            raise ValueError("splits on categories are not followed")
        self.roots = np.flatnonzero(nodes["id"] == 0)
        base = np.repeat(self.roots, np.diff(np.r_[self.roots, len(nodes)]))
        self.inner, self.feature = inner.to_numpy(), np.where(inner, nodes["feature"], 0).astype(int)
        self.at = np.array([x[0] if i else 0.0 for x, i in zip(nodes["at"], inner, strict=True)])
        self.left, self.right = (np.where(inner, nodes[x], 0) + base for x in ("leftChild", "rightChild"))
        classes = hasattr(model, "numClasses") and not hasattr(model, "trees") or type(model).__name__.startswith("RandomForestClass")
        if classes:
            stats = np.stack(nodes["impurityStats"].to_numpy())
            self.value = stats[:, 1] / stats.sum(axis=1)
        else:
            self.value = nodes["prediction"].to_numpy(float)
        self.weights = np.array(getattr(model, "treeWeights", [1.0]), float)
        self.mean = classes               # probabilities are averaged, boosting steps are added
        depth, level = 0, self.roots
        while self.inner[level].any():
            level = np.r_[self.left[level[self.inner[level]]], self.right[level[self.inner[level]]]]
            depth += 1
        self.depth = depth

    def levels(self, x: np.ndarray, root: int) -> list[np.ndarray]:
        """The node of every row at depth 0, 1, ... of the tree at ``root``."""
        here = np.full(len(x), root)
        out = [here]
        for _ in range(self.depth):
            go = np.where(x[np.arange(len(x)), self.feature[here]] <= self.at[here], self.left[here], self.right[here])
            here = np.where(self.inner[here], go, here)
            out.append(here)
        return out

    def by_trees(self, x: np.ndarray) -> np.ndarray:
        """Score of every row (first axis) after 1, 2, ... trees."""
        steps = np.stack([w * self.value[self.levels(x, r)[-1]] for r, w in zip(self.roots, self.weights, strict=True)], axis=1)
        total = np.cumsum(steps, axis=1)
        return total / np.cumsum(self.weights) if self.mean else total

    def by_depth(self, x: np.ndarray) -> np.ndarray:
        """Score of every row with all trees cut off at depth 0, 1, ..."""
        total = np.zeros((len(x), self.depth + 1))
        for r, w in zip(self.roots, self.weights, strict=True):
            total += w * np.stack([self.value[n] for n in self.levels(x, r)], axis=1)
        return total / self.weights.sum() if self.mean else total


def stage_scores(spark: SparkSession, model, rows: DataFrame, over: str) -> DataFrame:
    """(key, y, stage, p) of rows (key, features, label): ``over`` is ``trees``
    (stages from 1) or ``depth`` (from 0).  Boosting scores are margins."""
    trees = Trees(spark, model)

    @F.pandas_udf("array<double>")
    def stages(x: pd.Series) -> pd.Series:
        values = np.stack(x.to_numpy()) if len(x) else np.zeros((0, 1))
        return pd.Series(list(trees.by_trees(values) if over == "trees" else trees.by_depth(values)))

    scored = rows.select("key", F.col("label").cast("int").alias("y"), F.posexplode(stages(vector_to_array("features"))).alias("stage", "p"))
    return scored.withColumn("stage", F.col("stage") + 1) if over == "trees" else scored


def curve(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(stage, auc, f1) from stage scores: one table of counts per stage and score."""
    counts = cut_lineage(M.score_counts(scored, "p", "y", ["stage"]))
    k = M.counts_at_threshold(counts, "p", ["stage"], threshold)
    f1 = safe_div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    return M.auc_from_score_counts(counts, "p", ["stage"]).join(k, "stage").select("stage", "auc", f1.alias("f1"))
