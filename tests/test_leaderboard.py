"""The leaderboard's candidates: groups shared by fold, folds trained side by side."""
import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tessera.operators import models as ML
from tessera.plans import model_plans as MP

SF = "/root/testdata/sf0.001"


def test_adaboost_on_counted_rows_is_adaboost_on_the_rows(spark):
    x = np.random.default_rng(6).integers(0, 4, (240, 3))
    y = (x[:, 0] + x[:, 1] > 3) ^ (x[:, 2] == 0)
    rows = spark.createDataFrame([(i, [float(v) for v in x[i]], float(y[i])) for i in range(240)], "key long, v array<double>, label double").select(
        "key", array_to_vector("v").alias("features"), "label")
    groups = rows.groupBy("features", "label").agg(F.count("*").alias("n"), F.min("key").alias("key"))
    assert groups.count() < 130
    log, _ = ML.adaboost(rows, "key", rounds=4)
    counted, _ = ML.adaboost(groups, "key", rounds=4, count="n")
    assert len(log) == len(counted) == 4
    assert np.allclose([r[1:] for r in log], [r[1:] for r in counted], atol=1e-9)


def test_candidates_of_a_fold_share_its_groups(spark, monkeypatch):
    """Trees, boosting and AdaBoost of a fold bin its rows once, the test fold's never."""
    frame, _ = MP.prospect_frame(spark, SF)
    built, real = [], MP.GR.Groups.__init__
    monkeypatch.setattr(MP.GR.Groups, "__init__", lambda self, *a: real(self, *a) or built.append(self))
    some = {k: v for k, v in MP._candidates().items() if k in ("CART", "AdaBoost")}
    scored = ML.score_folds(frame, some, "fold", [0, 2], test_fold=0)
    assert len(built) == 2
    rows = frame.groupBy("fold").count().toPandas().set_index("fold")["count"]
    n = sorted(g.rows.agg(F.sum("n")).first()[0] for g in built)
    assert n == [rows[[1, 3, 4]].sum(), rows[1:].sum()]
    assert scored.count() == 2 * (rows[0] + rows[2]) and scored.where("p is null or pred is null").count() == 0


@pytest.mark.parametrize("name", ["MLP", "SVM (RBF)"])
def test_folds_side_by_side_score_every_row_once(spark, monkeypatch, name):
    frame, _ = MP.prospect_frame(spark, SF)
    packed, real = [], MP.BL.pack
    monkeypatch.setattr(MP.BL, "pack", lambda *a, **b: packed.append(1) or real(*a, **b))
    scored = ML.score_folds(frame, {name: MP._candidates()[name]}, "fold", [0, 1, 2, 3, 4], test_fold=0)
    assert len(packed) == 1      # one table of blocks for all folds: five before
    found = scored.groupBy("fold").agg(F.count("*").alias("n"), F.countDistinct("key").alias("k"), F.count("p").alias("p"))
    want = {r["fold"]: r["count"] for r in frame.groupBy("fold").count().collect()}
    assert {r["fold"]: (r["n"], r["k"], r["p"]) for r in found.collect()} == {k: (n, n, n) for k, n in want.items()}
