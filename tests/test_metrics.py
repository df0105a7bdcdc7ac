import math

import numpy as np
import pandas as pd
import pytest

from tessera.operators import metrics as M


def _auc_bruteforce(y, p):
    pos = [s for s, t in zip(p, y) if t == 1]
    neg = [s for s, t in zip(p, y) if t == 0]
    tot = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return tot / (len(pos) * len(neg))


def test_auc_exact_ties_and_bruteforce(spark):
    y = [0, 0, 1, 1, 1, 0, 1, 0]
    p = [0.1, 0.4, 0.35, 0.8, 0.4, 0.4, 0.9, 0.2]
    df = spark.createDataFrame(list(zip(y, p)), "y int, p double")
    got = M.auc_exact(df, "p", "y", n_buckets=3).first()["auc"]
    assert got == pytest.approx(_auc_bruteforce(y, p), abs=1e-12)


def test_auc_properties(spark):
    rng = np.random.default_rng(3)
    n = 2000
    y = rng.integers(0, 2, n)
    p = np.round(rng.random(n) * 0.6 + 0.3 * y, 3)
    pdf = pd.DataFrame({"y": y, "p": p, "segment": rng.choice(["x", "y"], n)})
    df = spark.createDataFrame(pdf)
    a = M.auc_exact(df, "p", "y").first()["auc"]
    assert a == pytest.approx(_auc_bruteforce(list(y), list(p)), abs=1e-12)
    neg = M.auc_exact(df.selectExpr("y", "-p AS p"), "p", "y").first()["auc"]
    assert a == pytest.approx(1 - neg, abs=1e-12)
    mono = M.auc_exact(df.selectExpr("y", "exp(3 * p) AS p"), "p", "y").first()["auc"]
    assert a == pytest.approx(mono, abs=1e-12)
    by = {r["segment"]: r["auc"] for r in M.auc_exact(df, "p", "y", by=["segment"]).collect()}
    for s in ("x", "y"):
        sub = pdf[pdf.segment == s]
        assert by[s] == pytest.approx(_auc_bruteforce(list(sub.y), list(sub.p)), abs=1e-12)
    binned = M.auc_binned(df, "p", "y").first()["auc"]
    assert abs(binned - a) < 0.02


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.3)], "y int, p double")
    assert M.auc_exact(df, "p", "y").first()["auc"] is None


def test_confusion_f1_report(spark):
    rows = [(1, 1), (1, 0), (0, 0), (0, 0), (0, 1), (1, 1)]
    df = spark.createDataFrame(rows, "y int, pred int")
    cm = {(r["label"], r["pred"]): r["n"] for r in M.confusion(df, "y", "pred", classes=[0, 1]).collect()}
    assert cm == {(0, 0): 2, (0, 1): 1, (1, 0): 1, (1, 1): 2}
    assert sum(cm.values()) == len(rows)
    f1 = M.f1_binary(df, "y", "pred").first()["f1"]
    assert f1 == pytest.approx(2 * 2 / (2 * 2 + 1 + 1))
    rep = {r["class"]: r for r in M.class_report(df, "y", "pred", names={0: "no", 1: "yes"}).collect()}
    assert rep["yes"]["precision"] == pytest.approx(2 / 3)
    assert rep["accuracy"]["f1"] == pytest.approx(4 / 6)
    assert rep["weighted avg"]["support"] == 6
    # no positive predicted at all -> F1 0, not an error
    z = spark.createDataFrame([(1, 0), (0, 0)], "y int, pred int")
    assert M.f1_binary(z, "y", "pred").first()["f1"] == 0.0


def test_logloss_clip(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 0.0), (1, 0.5)], "y int, p double")
    got = M.logloss_binary(df, "y", "p").first()["logloss"]
    eps = 1e-7
    exp = -(math.log(1 - eps) + math.log(1 - eps) + math.log(0.5)) / 3
    assert got == pytest.approx(exp)


def test_roc_points(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1)], "y int, p double")
    pts = sorted((r["fpr"], r["tpr"]) for r in M.roc_points(df, "p", "y", n_buckets=2).collect())
    assert pts == [(0.0, 0.0), (0.0, 0.5), (0.5, 0.5), (0.5, 1.0), (1.0, 1.0)]
