import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import history as HI
from tessera.operators import images as IM


def test_early_stop_hand_case(spark):
    # values by epoch: best at epoch 2; patience 2 -> stop at epoch 4
    vals = [0.5, 0.7, 0.6, 0.65, 0.9]
    df = spark.createDataFrame([(1, i + 1, v) for i, v in enumerate(vals)], "run int, epoch int, val double")
    r = HI.early_stop(df, "val", patience=2).first()
    assert (r["stop_epoch"], r["best_epoch"], r["best_value"]) == (4, 2, 0.7)


def _lr_reference(vals, start=1e-3, factor=0.5, patience=5, min_lr=1e-6, delta=1e-4):
    lr, best, wait, out = start, math.inf, 0, []
    for v in vals:
        if v < best - delta:
            best, wait = v, 0
        else:
            wait += 1
            if wait >= patience and lr > min_lr:
                lr, wait = max(lr * factor, min_lr), 0
        out.append(lr)
    return out


def test_lr_schedule_matches_replay(spark):
    rng = np.random.default_rng(2)
    vals = list(np.round(1.0 - np.cumsum(rng.random(40)) / 60 + rng.random(40) * 0.05, 4))
    df = spark.createDataFrame([(7, i, float(v)) for i, v in enumerate(vals)], "run int, epoch int, value double")
    got = [r["lr"] for r in HI.lr_schedule(df).orderBy("epoch").collect()]
    assert got == pytest.approx(_lr_reference(vals))


def _conv_ref(img, kernel, bias, padding):
    k = kernel.shape[0]
    h, w = img.shape
    pad = (k - 1) // 2 if padding == "same" else 0
    ho, wo = (h, w) if padding == "same" else (h - k + 1, w - k + 1)
    p = np.zeros((h + k, w + k))
    p[pad:pad + h, pad:pad + w] = img
    out = np.zeros((ho, wo))
    for r in range(ho):
        for c in range(wo):
            out[r, c] = (p[r:r + k, c:c + k] * kernel).sum() + bias
    return out


@pytest.mark.parametrize("padding", ["same", "valid"])
def test_conv2d_matches_numpy(spark, padding):
    rng = np.random.default_rng(4)
    img = rng.normal(size=(6, 5))
    kern = rng.normal(size=(3, 3))
    df = spark.createDataFrame([(img.reshape(-1).tolist(),)], "px array<double>")
    got = np.array(df.select(IM.conv2d(F.col("px"), 6, 5, [kern.tolist()], [0.3], padding).alias("o"))
                   .first()["o"])
    exp = _conv_ref(img, kern, 0.3, padding).reshape(-1)
    assert np.allclose(got, exp)


def test_pooling_and_residual(spark):
    img = np.arange(16, dtype=float).reshape(4, 4)
    df = spark.createDataFrame([(img.reshape(-1).tolist(),)], "px array<double>")
    r = df.select(IM.pool2d(F.col("px"), 4, 4, "avg").alias("a"), IM.pool2d(F.col("px"), 4, 4, "max").alias("m"),
                  IM.global_avg_pool(F.col("px")).alias("g"),
                  IM.residual_add(F.col("px"), F.transform("px", lambda v: -v * 2)).alias("res")).first()
    assert r["a"] == [2.5, 4.5, 10.5, 12.5]
    assert r["m"] == [5.0, 7.0, 13.0, 15.0]
    assert r["g"] == pytest.approx(7.5)
    assert r["res"] == [0.0] * 16


def test_dense_expression_equals_numpy_fast_path(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(20, 6))
    W = rng.normal(size=(4, 6))
    b = rng.normal(size=4)
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(20)], "id long, v array<double>")
    expr = {r["id"]: r["z"] for r in df.select("id", IM.dense(F.col("v"), W.tolist(), b.tolist(), "softmax")
                                                  .alias("z")).collect()}
    fast = {r["id"]: r["out"] for r in IM.dense_forward_pandas(df, "v", [(W, b, "softmax")], ["id"]).collect()}
    for i in range(20):
        assert np.allclose(expr[i], fast[i])
        assert sum(expr[i]) == pytest.approx(1.0)


@pytest.mark.parametrize("padding", ["same", "valid"])
def test_conv2d_fast_path_equals_expression(spark, padding):
    rng = np.random.default_rng(12)
    imgs = rng.normal(size=(7, 36))
    kern = rng.normal(size=(2, 3, 3)).tolist()
    df = spark.createDataFrame([(i, imgs[i].tolist()) for i in range(7)], "id long, px array<double>")
    a = {r["id"]: r["o"] for r in df.select("id", IM.conv2d_lambda(F.col("px"), 6, 6, kern, [0.1, -0.2], padding)
                                            .alias("o")).collect()}
    b = {r["id"]: r["out"] for r in IM.conv2d_pandas(df, "px", 6, 6, kern, [0.1, -0.2], padding, keep=["id"]).collect()}
    u = {r["id"]: r["o"] for r in df.select("id", IM.conv2d(F.col("px"), 6, 6, kern, [0.1, -0.2], padding)
                                            .alias("o")).collect()}
    for i in range(7):
        assert np.allclose(a[i], b[i]) and np.allclose(a[i], u[i])
