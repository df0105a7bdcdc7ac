import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import features as FE
from tessera.operators import history as HI
from tessera.operators import metrics as M
from tessera.operators import models as ML

SF = "/root/testdata/sf0.001"


def test_stream_bucket_auc_equals_batch(spark):
    from tessera.plans.stream_plans import POSITIVE_EVENT, stream_auc_binned

    s = {r["day"]: r for r in stream_auc_binned(spark, SF).collect()}
    ev = spark.read.parquet(f"{SF}/events.parquet").select(
        F.to_date("ts").alias("day"), (F.col("value") / 500).alias("p"),
        (F.col("event_type") == POSITIVE_EVENT).cast("int").alias("y"))
    b = {r["day"]: r for r in M.auc_binned(ev, "p", "y", by=["day"]).collect()}
    assert set(s) == set(b)
    for d in s:
        assert s[d]["n_pos"] == b[d]["n_pos"] and s[d]["n_neg"] == b[d]["n_neg"]
        if b[d]["auc"] is None:
            assert s[d]["auc"] is None
        else:
            assert s[d]["auc"] == pytest.approx(round(b[d]["auc"], 6), abs=1e-9)


def test_best_checkpoint_first_epoch_on_tie(spark):
    df = spark.createDataFrame([(1, 1, 0.5), (1, 2, 0.9), (1, 3, 0.9), (2, 1, 0.2)],
                               "run int, epoch int, value double")
    r = {x["run"]: (x["epoch"], x["value"]) for x in HI.best_checkpoint(df).collect()}
    assert r == {1: (2, 0.9), 2: (1, 0.2)}


def test_confusion_grid_from_seen_classes(spark):
    df = spark.createDataFrame([(0, 2), (1, 1), (2, 2)], "y int, pred int")
    cm = {(r["label"], r["pred"]): r["n"] for r in M.confusion(df, "y", "pred").collect()}
    assert len(cm) == 9 and cm[(0, 2)] == 1 and cm[(2, 0)] == 0 and sum(cm.values()) == 3


def test_class_weight_map(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "y int")
    m = FE.class_weight_map(df, "y").first()["class_weight"]
    assert m == {0: pytest.approx(8 / 12), 1: pytest.approx(8 / 4)}


def test_knn_vote_tie_goes_to_smallest_class(spark):
    # 4 neighbours: two of class 3, two of class 1 (k = 4) -> class 1
    train = spark.createDataFrame([(1, [0.0], 3), (2, [0.1], 1), (3, [0.2], 3), (4, [0.3], 1), (5, [9.0], 0)],
                                  "id long, v array<double>, label int")
    test = spark.createDataFrame([(100, [0.05], 0)], "id long, v array<double>, label int")
    got = ML.knn_exact(train, test, "v", "id", "label", k=4).first()
    assert got["pred"] == 1


def test_bootstrap_weights_are_poisson_like(spark):
    w = spark.range(20000).select(ML.bootstrap_weight(F.col("id"), 3).alias("w"))
    stats = w.agg(F.avg("w"), F.avg((F.col("w") == 0).cast("double"))).first()
    assert stats[0] == pytest.approx(1.0, abs=0.03)
    assert stats[1] == pytest.approx(np.exp(-1), abs=0.02)


def test_release_deletes_one_cut_table(spark):
    from tessera.session import cut_lineage, release

    a, b = cut_lineage(spark.range(5)), cut_lineage(spark.range(6))
    release(a)
    assert b.count() == 6
    with pytest.raises(Exception, match="(?i)not exist"):
        a.count()
    release(a)   # a table that is gone is left alone
    assert b.count() == 6
