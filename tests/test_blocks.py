"""Trainers on blocks: against Spark ML's own, and against plain NumPy."""

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tessera.operators import blocks as BL
from tessera.operators import models as ML


@pytest.fixture(scope="module")
def rows(spark):
    x = np.random.default_rng(0).normal(size=(600, 3))
    y = x[:, 0] * x[:, 1] + 0.3 * x[:, 2] > 0.3
    data = [(i, [float(v) for v in x[i]], float(y[i]), 1.0 + i % 3) for i in range(600)]
    return spark.createDataFrame(data, "key long, v array<double>, label double, weight double").select(
        "key", array_to_vector("v").alias("features"), "label", "weight").coalesce(1)


def test_network_reaches_the_loss_of_sparks_own(rows):
    net = BL.Network([3, 8, 2], 40, 7, ML.class_copies)
    model = net.fit(rows)
    # blocks of one row: Spark gives a short last block the weight of a full one
    own = MultilayerPerceptronClassifier(layers=[3, 8, 2], maxIter=40, seed=7, blockSize=1).fit(ML.balance_by_replication(rows))
    theirs = own.summary().objectiveHistory
    assert net.values[0] == pytest.approx(theirs[0], rel=1e-5)      # same first weights, copies counted by weight
    assert net.values[-1] < 0.25 * net.values[0] and abs(net.values[-1] - theirs[-1]) < 0.1
    right = model.transform(rows).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert right > 0.9


def test_training_rows_are_spread_and_none_is_lost(rows):
    packed = BL.pack(rows, weight=F.col("weight"))
    assert packed.agg(F.sum("n")).first()[0] == 600
    assert packed.count() >= min(8, rows.sparkSession.sparkContext.defaultParallelism)   # one file came in
    _, n, _ = BL.total(packed, BL.network_loss([3, 2], np.zeros(8)))
    assert n == rows.agg(F.sum("weight")).first()[0]


def test_gradient_is_the_slope_of_the_loss(rows):
    packed, w = BL.pack(rows), np.random.default_rng(1).normal(size=26)
    _, n, g = BL.total(packed, BL.network_loss([3, 4, 2], w))
    for i in (0, 7, 13, 25):
        e = np.zeros(26)
        e[i] = 1e-2
        up, down = (BL.total(packed, BL.network_loss([3, 4, 2], w + s * e))[0] for s in (1, -1))
        assert g[i] / n == pytest.approx((up - down) / 2e-2 / n, abs=1e-4)


def test_rows_a_network_cannot_learn_from_fail(rows):
    with pytest.raises(ValueError, match="no training rows"):
        BL.Network([3, 2]).fit(rows.where("false"))
    with pytest.raises(Exception, match="labels outside"):
        BL.Network([3, 2], 2).fit(rows.withColumn("label", F.lit(2.0)))


def test_fourier_machine_is_the_linear_machine_on_kept_features(rows):
    from pyspark.ml.functions import vector_to_array

    machine = BL.FourierMachine(*ML.fourier_weights(3, 16, 0.3, 5), max_iter=12, reg=0.01).fit(rows)
    kept = rows.withColumn("features", ML.fourier_vector(vector_to_array("features"), 3, 16, 0.3, 5))
    own = LinearSVC(weightCol="weight", maxIter=12, regParam=0.01).fit(kept)
    assert machine.values[-1] <= 1.05 * own.summary().objectiveHistory[-1]
    both = machine.transform(rows).select("key", "prediction", F.element_at(vector_to_array("rawPrediction"), 2).alias("m")).join(
        own.transform(kept).select("key", F.col("prediction").alias("p"), F.element_at(vector_to_array("rawPrediction"), 2).alias("n")), "key")
    same, corr = both.agg(F.avg((F.col("prediction") == F.col("p")).cast("double")), F.corr("m", "n")).first()
    assert same > 0.95 and corr > 0.98


def test_folds_side_by_side_are_the_single_fits(rows):
    """One job an evaluation for all folds; each model is that of its rows alone."""
    rows = rows.withColumn("fold", (F.col("key") % 3).cast("int"))
    net = BL.Network([3, 4, 2], 6, 7, ML.class_copies)
    machine = BL.FourierMachine(*ML.fourier_weights(3, 16, 0.3, 5), max_iter=5, reg=0.01)
    passes, real = [], BL.Held.totals
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(BL.Held, "totals", lambda self, losses, *a: passes.append(len(losses)) or real(self, losses, *a))
        nets, machines = net.fit_folds(rows, "fold", [0, 1, 2]), machine.fit_folds(rows, "fold", [0, 1, 2])
    assert max(passes) == 3 and len(passes) < 30
    for k in (0, 2):
        train = rows.where(F.col("fold") != k)
        alone, single = BL.Network([3, 4, 2], 6, 7, ML.class_copies), BL.FourierMachine(*ML.fourier_weights(3, 16, 0.3, 5), max_iter=5, reg=0.01)
        assert np.allclose(alone.fit(train).weights.toArray(), nets[k].weights.toArray(), atol=1e-3)
        single.fit(train)
        assert np.allclose(single.coefficients, machines[k].coefficients, atol=1e-3)
        assert alone.values[-1] == pytest.approx(net.fold_values[k][-1], rel=1e-4)
