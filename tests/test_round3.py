"""Persisted pipelines, registry, folds, stages, calibration, Gram matrices, nulls."""
import json
import os
import subprocess
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tessera.operators import features as FE
from tessera.operators import gram
from tessera.operators import metrics as M
from tessera.operators import models as ML
from tessera.operators import pipeline as PL
from tessera.operators import staged as ST
from tessera.operators.profile import histogram
from tessera.sources.registry import ModelRegistry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def raw_rows(spark, n=300):
    rng = np.random.default_rng(5)
    x, k = rng.normal(size=n) * 10, rng.integers(0, 4, n)
    y = (x / 10 + k - 1.5 + rng.normal(size=n) > 0).astype(int)
    levels = ["a", "b", "c", None]
    return spark.createDataFrame([(i, float(x[i]), float(i % 7), levels[k[i]], int(y[i])) for i in range(n)],
                                 "key long, x double, z double, g string, y int").withColumn("label", F.col("y").cast("double"))


@pytest.fixture(scope="module")
def fitted(spark):
    raw = raw_rows(spark)
    stages = [PL.FitEncoding(numeric=["x", "z"], categorical=["g"]), LogisticRegression(maxIter=20)]
    return raw, Pipeline(stages=stages).fit(raw)


def test_pipeline_scores_raw_rows_in_a_fresh_session(spark, fitted, tmp_path):
    raw, model = fitted
    model.write().save(str(tmp_path / "model"))
    raw.drop("label", "y").write.parquet(str(tmp_path / "raw"))
    code = f"""
import sys; sys.path.insert(0, {ROOT!r})
from pyspark.ml import PipelineModel
from tessera.session import build_session
from tessera.operators import pipeline as PL
spark = build_session("local[2]")
model = PipelineModel.load({str(tmp_path / "model")!r})
PL.score_raw(model, spark.read.parquet({str(tmp_path / "raw")!r})).write.parquet({str(tmp_path / "out")!r})
"""
    subprocess.run([sys.executable, "-c", code], check=True, capture_output=True, timeout=300)
    want = {r["key"]: (r["prediction"], r["score_souscription"]) for r in PL.score_raw(model, raw).collect()}
    got = {r["key"]: (r["prediction"], r["score_souscription"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == want and len(got) == 300
    assert PL.features_of(model) == ["x", "z", "g_b", "g_c"]


def test_pipeline_equals_the_encoder(spark, fitted):
    raw, model = fitted
    spec = FE.fit_spec(raw, ["x", "z"], ["g"])
    want = {r["key"]: [r[f] for f in spec.features] for r in FE.encode(raw, spec, keep=["key"]).collect()}
    got = {r["key"]: list(r["v"]) for r in model.stages[0].transform(raw).select("key", vector_to_array("features").alias("v")).collect()}
    assert all(got[k] == pytest.approx(want[k]) for k in want)
    # absent columns and unseen levels give what alignment gives; a null number is no number
    odd = spark.createDataFrame([(1, "zz")], "key long, g string")
    assert list(model.stages[0].stages[0].transform(odd).first()["aligned"]) == [0.0, 0.0, 0.0, 0.0]
    null = spark.createDataFrame([(1, None, 2.0, "b")], "key long, x double, z double, g string")
    assert np.isnan(model.stages[0].stages[0].transform(null).first()["aligned"][0])
    with pytest.raises(Exception, match="no training value"):
        PL.FitEncoding(numeric=["x"], categorical=["g"]).fit(raw.limit(0))


def test_score_without_probability(spark):
    raw = raw_rows(spark, 60)
    model = Pipeline(stages=[PL.FitEncoding(numeric=["x"], categorical=["g"]), LinearSVC(maxIter=5)]).fit(raw)
    assert PL.score_raw(model, raw).columns == [*raw.columns, "prediction"]


def test_registry(spark, fitted, tmp_path):
    raw, model = fitted
    tree = Pipeline(stages=[PL.FitEncoding(numeric=["x"], categorical=["g"]), DecisionTreeClassifier(maxDepth=2)]).fit(raw)
    registry = ModelRegistry(spark, str(tmp_path / "registry"))
    assert registry.manifests().count() == 0
    with pytest.raises(FileNotFoundError):
        registry.best()
    assert registry.publish("logreg", model, 0.8, raw, "y", {"maxIter": 20}) == 1
    assert registry.publish("tree", tree, 0.9, raw, "y") == 1
    assert registry.publish("logreg", model, 0.7, raw.withColumn("y", F.when(F.col("key") > 9, F.col("y"))), "y") == 2
    rows = {(r["name"], r["version"]): r for r in registry.manifests().collect()}
    assert set(rows) == {("logreg", 1), ("logreg", 2), ("tree", 1)}
    one = rows["logreg", 1]
    assert one["rows"] == 300 and sum(one["classes"].values()) == 300 and set(one["classes"]) == {"0", "1"}
    assert one["features"] == ["x", "z", "g_b", "g_c"] and one["parameters"] == {"maxIter": "20"} and one["type"] == "LogisticRegressionModel"
    assert rows["logreg", 2]["classes"]["null"] == 10
    assert registry.best() == ("tree", 1) and registry.best(["logreg"]) == ("logreg", 1)
    assert registry.load("tree").uid == tree.uid and registry.versions("logreg") == [1, 2]
    # a version whose files are gone is refused and no longer offered
    os.rename(str(tmp_path / "registry/tree/v000001/model/stages"), str(tmp_path / "elsewhere"))
    with pytest.raises(FileNotFoundError):
        registry.load("tree")
    assert registry.best() == ("logreg", 1)
    with pytest.raises(FileNotFoundError):
        registry.load("logreg", 7)
    # the rename refuses a number that another writer has taken
    assert not registry._appears(str(tmp_path / "registry/logreg/v000001"), str(tmp_path / "registry/logreg/v000002"))
    with pytest.raises(ValueError):
        registry.publish("../x", model, 0.1, raw, "y")


@pytest.fixture(scope="module")
def vectors(spark, fitted):
    raw, model = fitted
    return model.stages[0].transform(raw).select("key", "features", "label", (F.col("key") % 3).cast("int").alias("fold"))


def test_stages_by_trees(spark, vectors):
    forest = RandomForestClassifier(numTrees=6, maxDepth=4, seed=3).fit(vectors)
    stages = ST.stage_scores(spark, forest, vectors, "trees")
    last = {r["key"]: r["p"] for r in stages.where("stage = 6").collect()}
    want = {r["key"]: r["p"] for r in ML.positive_proba(forest.transform(vectors)).collect()}
    assert all(last[k] == pytest.approx(want[k]) for k in want)
    first = forest.trees[0].transform(vectors).select("key", F.element_at(vector_to_array("probability"), 2).alias("p"))
    got = {r["key"]: r["p"] for r in stages.where("stage = 1").collect()}
    assert all(got[r["key"]] == pytest.approx(r["p"]) for r in first.collect())
    boost = GBTClassifier(maxIter=5, maxDepth=2, seed=3).fit(vectors)
    last = {r["key"]: r["p"] for r in ST.stage_scores(spark, boost, vectors, "trees").where("stage = 5").collect()}
    margin = boost.transform(vectors).select("key", F.element_at(vector_to_array("rawPrediction"), 2).alias("m"))
    assert all(last[r["key"]] == pytest.approx(r["m"]) for r in margin.collect())


def test_stages_by_depth_are_the_shallower_trees(spark, vectors):
    deep = DecisionTreeClassifier(maxDepth=5, seed=3).fit(vectors)
    stages = ST.stage_scores(spark, deep, vectors, "depth")
    for d in (0, 1, 3, 5):
        shallow = ML.positive_proba(DecisionTreeClassifier(maxDepth=d, seed=3).fit(vectors).transform(vectors))
        got = {r["key"]: r["p"] for r in stages.where(F.col("stage") == d).collect()}
        assert all((got[r["key"]] >= 0.5) == (r["p"] >= 0.5) for r in shallow.collect())
        if d in (0, 1):
            assert all(got[r["key"]] == pytest.approx(r["p"]) for r in shallow.collect())
    found = {r["stage"]: r for r in ST.curve(stages).collect()}
    assert set(found) == set(range(6)) and found[0]["auc"] == pytest.approx(0.5) and found[5]["auc"] > found[1]["auc"]


def test_folds_are_scored_once_and_measured_together(spark, vectors):
    def constant(train, rows):
        return rows.select("key", "label", F.lit(0.25).alias("p"), F.lit(0.0).alias("prediction"))

    seconds = {}
    scored = ML.score_folds(vectors, {"lr": LogisticRegression(maxIter=5), "none": constant}, "fold", [0, 1, 2], seconds)
    assert scored.count() == 600 and set(seconds) == {(m, k) for m in ("lr", "none") for k in (0, 1, 2)}
    pdf = scored.toPandas()
    for r in ML.fold_metrics(scored).collect():
        part = pdf[(pdf.model == r["model"]) & (pdf.fold == r["fold"])]
        pos, neg = part.p[part.y == 1].to_numpy(), part.p[part.y == 0].to_numpy()
        auc = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
        tp, wrong = ((part.y == 1) & (part.pred == 1)).sum(), (part.y != part.pred).sum()
        assert r["n"] == len(part) and r["auc"] == pytest.approx(auc)
        assert r["f1"] == pytest.approx(2 * tp / (2 * tp + wrong) if 2 * tp + wrong else 0.0)
        assert r["accuracy"] == pytest.approx(1 - wrong / len(part))
    board = {r["model"]: r for r in ML.fold_summary(ML.fold_metrics(scored), 0).collect()}
    assert board["none"]["cv_auc_mean"] == 0.5 and board["none"]["cv_f1_std"] == 0.0 and board["lr"]["test_auc"] > 0.5


def test_calibrated_margins(spark):
    rng = np.random.default_rng(8)
    margin = np.round(rng.normal(size=4000) * 2, 2)
    y = (rng.random(4000) < 1 / (1 + np.exp(-1.5 * margin))).astype(int)
    rows = spark.createDataFrame(pd.DataFrame({"margin": margin, "label": y.astype(float), "y": y})).repartition(5)
    out = ML.calibrated(ML.calibrate(rows), rows).toPandas().sort_values("margin")
    assert (np.diff(out.p) >= -1e-12).all() and out.p.between(0, 1).all()     # never decreasing in the margin
    fresh = ML.calibrated(ML.calibrate(rows), spark.createDataFrame([(-99.0,), (0.0,), (99.0,)], "margin double")).collect()
    assert [r["p"] for r in fresh] == sorted(r["p"] for r in fresh)
    found = ML.calibration(spark.createDataFrame(out[["p", "y"]])).first()
    q = np.clip(out.p, 1e-7, 1 - 1e-7)
    assert found["log_loss"] == pytest.approx(-np.mean(out.y * np.log(q) + (1 - out.y) * np.log(1 - q)))
    assert found["brier"] == pytest.approx(np.mean((out.p - out.y) ** 2)) and found["calibration_error"] < 0.01


def test_gram_against_pandas(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 12)) @ rng.normal(size=(12, 12)) + rng.normal(size=12) * 1e5
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 5] = 3.0
    x[:, 6] = np.nan
    x[:200, 7], x[200:, 8] = np.nan, np.nan
    cols = [f"c.{i}" for i in range(12)]
    pdf = pd.DataFrame(x, columns=cols)
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], ", ".join(f"`{c}` double" for c in cols))
    df = df.repartition(4)
    want = pdf.corr(min_periods=2)
    for block in (512, 5):
        got = {(r["a"], r["b"]): r["r"] for r in gram.correlations(df, cols, block).collect()}
        assert len(got) == 144
        for a in cols:
            for b in cols:
                w = want.loc[a, b]
                assert got[a, b] is None if np.isnan(w) else got[a, b] == pytest.approx(w, abs=1e-9), (a, b)
    for r in gram.lines(df, cols, 5).collect():
        both = pdf[[r["x_col"], r["y_col"]]].dropna()
        if len(both) < 2 or both[r["x_col"]].nunique() < 2:
            assert r["slope"] is None and r["r2"] is None
            continue
        slope, intercept = np.polyfit(both[r["x_col"]] - both[r["x_col"]].mean(), both[r["y_col"]], 1)
        assert r["slope"] == pytest.approx(slope, rel=1e-6, abs=1e-9)
        assert r["intercept"] == pytest.approx(intercept - slope * both[r["x_col"]].mean(), rel=1e-6, abs=1e-4)


def test_gram_of_a_wide_table(spark):
    """500 columns: no expression per pair in the plan."""
    k = 500
    df = spark.range(200).select(*[F.xxhash64("id", F.lit(i)).cast("double").alias(f"c{i}") for i in range(k)])
    found = gram.correlations(df, df.columns, 256)
    assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 2_000_000
    assert found.where("r IS NOT NULL").count() == k * k


def test_confusion_and_report_keep_nulls(spark):
    rows = [(None, 1, 1), (None, 0, 1), ("a", 1, 1), ("a", 0, 0), ("a", None, 0), ("a", 1, None)]
    df = spark.createDataFrame(rows, "seg string, y int, pred int")
    got = {(r["seg"], r["label"], r["pred"]): r["n"] for r in M.confusion(df, by=["seg"]).collect()}
    assert sum(got.values()) == 6 and got[None, 0, 1] == 1 and got[None, 0, 0] == 0 and len(got) == 4 + 9
    assert got["a", None, 0] == 1 and got["a", 1, None] == 1 and got["a", None, None] == 0
    report = {r["class"]: r for r in M.class_report(df).collect()}
    assert report["accuracy"]["support"] == 6 and report["null"]["support"] == 1 and report["1"]["support"] == 3


def test_feature_names_and_limits(spark):
    spec = FE.FeatureSpec(["n"], {"job": ["x"], "job_type": ["b"]}, {"n": 1.0}, {"n": 2.0})
    back = FE.FeatureSpec.from_df(spec.to_df(spark), ["n"], ["job", "job_type"])
    assert back == spec
    df = spark.createDataFrame([("b_x", "x")], "a string, a_b string")
    with pytest.raises(ValueError, match="one name"):
        FE.onehot(df, {"a": ["b_x"], "a_b": ["x"]})
    two = spark.createDataFrame([("p", "q", 1.0), ("r", "s", 2.0), (None, None, 3.0)], "u string, v string, x double")
    assert FE.fit_spec(two, ["x"], ["u", "v"], max_levels=2).levels == {"u": ["r"], "v": ["s"]}
    with pytest.raises(ValueError):
        FE.fit_spec(two, ["x"], ["u", "v"], max_levels=1)


def test_empty_and_null_inputs(spark):
    empty = spark.createDataFrame([], "label double, features array<double>")
    assert ML.balance_by_replication(empty).collect() == []
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    bins = histogram(df, ["a", "b"], 4).collect()
    assert sum(r["count"] for r in bins if r["column"] == "b") == 0 and sum(r["column"] == "b" for r in bins) == 4
    assert json.dumps([r["bin_lo"] for r in bins if r["column"] == "b"]) == "[null, null, null, null]"
    assert isinstance(PL.from_spec(FE.FeatureSpec([], {}, {}, {})), PipelineModel)
