import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import models as ML

SF = "/root/testdata/sf0.001"


def test_knn_exact_matches_bruteforce(spark):
    rng = np.random.default_rng(6)
    tr = rng.normal(size=(120, 4))
    te = rng.normal(size=(30, 4))
    lab = rng.integers(0, 3, 120)
    train = spark.createDataFrame([(i, tr[i].tolist(), int(lab[i])) for i in range(120)],
                                  "id long, v array<double>, label int")
    test = spark.createDataFrame([(1000 + i, te[i].tolist(), 0) for i in range(30)],
                                 "id long, v array<double>, label int")
    # tiny blocks force several (block, chunk) cells
    got = {r["id"]: r["pred"] for r in ML.knn_exact(train, test, "v", "id", "label", k=5, block_rows=25).collect()}
    # sub-batches of 2 query rows inside each cell give the same answer
    small = {r["id"]: r["pred"] for r in ML.knn_exact(train, test, "v", "id", "label", k=5, block_rows=25,
                                                      max_distances=60).collect()}
    assert small == got
    for i in range(30):
        d = ((tr - te[i]) ** 2).sum(1)
        nn = sorted(range(120), key=lambda j: (d[j], j))[:5]
        votes = np.bincount(lab[nn], minlength=3)
        assert got[1000 + i] == int(np.argmax(votes))


def test_gaussian_nb_matches_numpy(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(200, 2)) + np.repeat([[0, 0], [1.5, 1]], 100, axis=0)
    y = np.repeat([0, 1], 100)
    df = spark.createDataFrame([(i, float(x[i, 0]), float(x[i, 1]), int(y[i])) for i in range(200)],
                               "k long, a double, b double, y int")
    m = ML.gaussian_nb_fit(df, ["a", "b"], "y")
    got = {r["k"]: r["pred"] for r in ML.gaussian_nb_predict(df, m, ["a", "b"], ["k"]).collect()}
    eps = 1e-9 * x.var(0).max()
    jll = []
    for c in (0, 1):
        mu, var = x[y == c].mean(0), x[y == c].var(0) + eps
        jll.append(np.log(0.5) - 0.5 * np.log(2 * np.pi * var).sum() - ((x - mu) ** 2 / (2 * var)).sum(1))
    exp = np.argmax(np.stack(jll, 1), 1)
    assert all(got[i] == exp[i] for i in range(200))


def test_stream_score_equals_batch(spark):
    from tessera.plans.scoring_plans import rounded_scores, scored_prospects
    from tessera.plans.stream_plans import stream_score

    s = stream_score(spark, SF)
    b = rounded_scores(scored_prospects(spark, SF))
    assert s.count() == b.count()
    assert s.exceptAll(b.select(*s.columns)).count() == 0


def test_model_save_load_same_predictions(spark):
    from tessera.plans.model_plans import model_save_load

    r = model_save_load(spark, SF).first()
    assert r["rows"] > 0 and r["differences"] == 0
