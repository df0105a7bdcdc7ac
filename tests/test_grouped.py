"""Trees on groups of rows against Spark ML's own on all rows."""
import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tessera.operators import grouped as GR
from tessera.plans import model_plans as MP


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = np.c_[rng.integers(0, 6, 1500) / 3, rng.integers(0, 2, (1500, 2)), np.full(1500, 7.0)]
    y = (x[:, 0] > 0.9) ^ (x[:, 1] * x[:, 2] > 0) ^ (rng.random(1500) < 0.1)
    data = [(i, [float(v) for v in x[i]], float(y[i]), 1.0 + float(y[i])) for i in range(1500)]
    return spark.createDataFrame(data, "key long, v array<double>, label double, weight double").select(
        "key", array_to_vector("v").alias("features"), "label", "weight").repartition(3)


def scores(model, rows):
    found = model.transform(rows)
    assert {"key", "features", "label"} <= set(found.columns)
    p = F.element_at(vector_to_array("probability"), 2)
    return np.array([r[1] for r in found.select("key", p.alias("p")).orderBy("key").collect()])


@pytest.mark.parametrize("kind,options", [(DecisionTreeClassifier, {"maxDepth": 5, "minInstancesPerNode": 25}),
                                          (GBTClassifier, {"maxIter": 4, "maxDepth": 3})])
def test_equals_the_fit_on_all_rows(rows, kind, options):
    shared, estimator = GR.Shared(), kind(weightCol="weight", seed=1, **options)
    ours, own = shared(estimator).fit(rows.where("key % 3 > 0")), estimator.fit(rows.where("key % 3 > 0"))
    assert np.allclose(scores(ours, rows), scores(own, rows), atol=1e-9)
    assert np.allclose(ours.featureImportances.toArray(), own.featureImportances.toArray(), atol=1e-9)
    shared(estimator).fit(rows.where("key % 3 > 0"))
    assert len(shared.found) == 1 and ours.groups.rows.count() <= 48      # 6 x 2 x 2 x 1 bins, 2 labels


def test_groups_do_not_grow_with_equal_rows_and_hold_all(rows):
    few = GR.Groups(rows).rows
    more = GR.Groups(rows.unionAll(rows).unionAll(rows)).rows
    assert few.count() == more.count() < 50
    assert more.agg(F.sum("n"), F.sum("weight")).first() == (4500, 3 * few.agg(F.sum("weight")).first()[0])


def test_cuts_of_many_values_are_quantiles(spark):
    x = np.random.default_rng(4).permutation(3200)
    train = spark.createDataFrame([(float(v), float(v % 2)) for v in x], "a double, label double").select(
        array_to_vector(F.array("a")).alias("features"), "label", F.lit(1.0).alias("weight"))
    g = GR.Groups(train)
    assert len(g.cuts[0]) == GR.BINS - 1
    n = [r[0] for r in g.rows.groupBy("features").agg(F.sum("n")).select(F.col("sum(n)")).collect()]
    assert len(n) == GR.BINS and min(n) > 80 and max(n) < 120
    # rows are dealt to the bins that the groups count
    own = train.groupBy(g.vector().alias("features")).count()
    assert own.join(g.rows.groupBy("features").agg(F.sum("n").alias("n")), "features").where("count <> n").count() == 0


def test_forest_counts_rows_as_a_bootstrap_does(rows):
    groups = GR.Groups(rows)
    drawn = GR.bootstrapped(groups.rows, 400, 5)
    again = {(bytes(r["code"]), r["label"]): r["counts"] for r in GR.bootstrapped(groups.rows.repartition(5), 400, 5).collect()}
    for r in drawn.collect():
        c = np.array(r["counts"])
        assert list(c) == again[bytes(r["code"]), r["label"]]
        assert abs(c.mean() - r["n"]) < 5 * (r["n"] / 400) ** 0.5 and 0.6 * r["n"] < c.var() < 1.5 * r["n"]
    est = RandomForestClassifier(weightCol="weight", numTrees=6, maxDepth=5, featureSubsetStrategy="all", seed=2)
    ours, own = groups.fit(est), est.fit(rows)
    assert ours.model.getNumTrees == 6 and len({t.toDebugString for t in ours.model.trees}) > 1
    assert ours.featureImportances.toArray().sum() == pytest.approx(1)
    assert np.abs(scores(ours, rows) - scores(own, rows)).mean() < 0.08


def test_importances_are_those_of_groups(spark, monkeypatch):
    """The tuned trees are fitted on counted groups, whatever the rows."""
    frame, feats = MP.prospect_frame(spark, "/root/testdata/sf0.001")
    found = []
    real = GR.Groups.fit
    monkeypatch.setattr(GR.Groups, "fit", lambda self, est: found.append(self) or real(self, est))
    monkeypatch.setattr(MP, "_tuned", lambda: {"t": DecisionTreeClassifier(weightCol="weight", maxDepth=2, seed=1),
                                               "u": DecisionTreeClassifier(weightCol="weight", maxDepth=3, seed=1)})
    assert len(MP._importances(frame, feats)) == 2 * len(feats)
    assert len(found) == 2 and found[0] is found[1] and found[0].rows.agg(F.sum("n")).first()[0] == frame.where("split = 'train'").count()


def test_top10_prepares_its_rows_once(spark, monkeypatch):
    """Trees and network read one prospect frame."""
    made, real = [], MP.prospect_frame
    monkeypatch.setattr(MP, "prospect_frame", lambda *a: made.append(1) or real(*a))
    monkeypatch.setattr(MP, "_tuned", lambda: {"t": DecisionTreeClassifier(weightCol="weight", maxDepth=2, seed=1)})
    network = MP.BL.Network
    monkeypatch.setattr(MP.BL, "Network", lambda layers, iterations, *a: network(layers, 1, *a))
    assert MP.ml_mlp_top10(spark, "/root/testdata/sf0.001").first()["model"] == "ANN Top10" and len(made) == 1
