"""Scores as computed, correlation over complete pairs, files by column name."""
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera.functions.exprs import safe_corr
from tessera.operators.features import FeatureSpec
from tessera.operators.scoring import PRED_COL, PROBA_COL, LinearModel, score_batch
from tessera.sources import files as FS


def test_prediction_follows_the_raw_score(spark):
    # sigmoid(-1e-6) is just below one half; rounded it would reach it
    df = spark.createDataFrame([(-1e-6,), (1e-6,), (0.0,)], "x double")
    spec = FeatureSpec(numeric=["x"], levels={}, mean={"x": 0.0}, std={"x": 1.0})
    rows = score_batch(df, spec, LinearModel(0.0, {"x": 1.0}), target=None).orderBy("x").collect()
    assert [r[PRED_COL] for r in rows] == [0, 1, 1]
    assert 0.49999 < rows[0][PROBA_COL] < 0.5


def test_correlation_uses_complete_pairs(spark):
    rows = [(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (None, -50.0), (90.0, None)]
    df = spark.createDataFrame(rows, "x double, y double")
    assert df.agg(safe_corr(F.col("x"), F.col("y"))).first()[0] == pytest.approx(1.0)
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert flat.agg(safe_corr(F.col("x"), F.col("y"))).first()[0] is None


def test_csv_columns_by_name_and_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('b;extra;a;t\n2;z;1;"say ""hi""; ok"\n')
    df = FS.read_delimited(spark, str(tmp_path / "a.csv"), "a INT, b INT, t STRING, gone DOUBLE", sep=";")
    assert [tuple(r) for r in df.collect()] == [(1, 2, 'say "hi"; ok', None)]


def test_csv_bad_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\nx,3\n4,5\n")
    path = str(tmp_path / "a.csv")
    with pytest.raises((PySparkException, Py4JJavaError)):
        FS.read_delimited(spark, path, "a INT, b INT").collect()
    good, bad = FS.read_with_rejects(spark, path, "a INT, b INT")
    assert sorted(tuple(r) for r in good.collect()) == [(1, 2), (4, 5)]
    assert [r["line"] for r in bad.collect()] == ["x,3"]


def test_absent_table_is_none_and_files_with_other_headers_are_refused(spark, tmp_path):
    assert FS.load_csv(spark, str(tmp_path / "none.csv"), "a INT") is None
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "d" / "2.csv").write_text("b,a\n1,2\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        FS.read_delimited(spark, str(tmp_path / "d"), "a INT, b INT").collect()


def test_knn_far_from_the_origin(spark):
    import numpy as np

    from tessera.operators.models import knn_exact

    rng = np.random.default_rng(0)
    for shift in (0.0, 1e8):
        t, q = rng.normal(0, 1, (60, 5)) + shift, rng.normal(0, 1, (20, 5)) + shift
        label = rng.integers(0, 3, 60)
        train = spark.createDataFrame([(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(t, label))], "id long, v array<double>, l long")
        test = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "id long, v array<double>")
        got = {r["id"]: (r["pred"], r["share"]) for r in knn_exact(train, test, "v", "id", "l", k=5, block_rows=16).collect()}
        for i, v in enumerate(q):
            near = sorted(range(60), key=lambda j: (((v - t[j]) ** 2).sum(), j))[:5]
            votes = np.bincount(label[near], minlength=3)
            assert got[i] == (int(votes.argmax()), votes.max() / 5)


def test_adaboost_against_numpy(spark):
    import numpy as np
    from pyspark.ml.linalg import Vectors

    from tessera.operators.models import adaboost

    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (300, 3)).round(2)
    y = (x[:, 0] + 0.5 * x[:, 1] > 0.2).astype(float)
    rows = [(i, Vectors.dense(v), float(k)) for i, (v, k) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, ["key", "features", "label"])
    log, score = adaboost(df, "key", rounds=4)
    from pyspark.ml.functions import vector_to_array
    got = np.array([r[0] for r in df.orderBy("key").select(vector_to_array("features").alias("x")).select(score).collect()])
    assert len(log) == 4 and all(0 < e < 0.5 and a > 0 for _, e, a in log)
    # the first round's error is that of its stump; the sum of votes separates better than chance
    first = 1 - log[0][1]
    assert ((got > 0) == (y == 1)).mean() >= first > 0.7


def test_bounded_broadcast(spark):
    from tessera.operators.features import bounded_broadcast

    df = spark.range(10)
    plan = lambda d: spark.range(5).join(d, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(bounded_broadcast(df, 10)) and "broadcast" not in plan(bounded_broadcast(df, 9))
