"""Prospects written once; folds of the leaderboard."""
import pytest
from pyspark.sql import functions as F

from tessera.plans import model_plans as MP

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("query", ["score_model_choice", "sink_model_manifest"])
def test_prospects_are_joined_once(spark, monkeypatch, query):
    """Every row of the join is made once, whatever the fits and passes over it."""
    made = spark.sparkContext.accumulator(0)
    real = MP.SI.prospects

    def counted(spark, sf_dir):
        @F.udf("long")
        def seen(key):
            made.add(1)
            return key
        return real(spark, sf_dir).withColumn("key", seen.asNondeterministic()("key"))

    want = real(spark, SF).count()
    monkeypatch.setattr(MP.SI, "prospects", counted)
    found = getattr(MP, query)(spark, SF).collect()
    assert found and made.value == want


def test_all_folds_of_knn_equal_single_folds(spark):
    """One search over all folds scores as one search a fold, the test fold's rows
    being nobody's neighbours; the index is built once."""
    frame, _ = MP.prospect_frame(spark, SF)
    frame = frame.where("key % 3 = 0")
    folds = [0, 1, 2]

    def single(train, rows):
        return MP._knn(train, rows, "fold")

    built, build = [], MP.knn.build_index
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(MP.knn, "build_index", lambda *a, **b: built.append(1) or build(*a, **b))
        seconds = {}
        one = MP.ML.score_folds(frame, {"k": MP.ML.AllFolds(MP._knn)}, "fold", folds, seconds, test_fold=0)
    each = MP.ML.score_folds(frame, {"k": single}, "fold", folds, test_fold=0)
    assert len(built) == 1 and set(seconds) == {("k", k) for k in folds}
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(one) == rows(each) and len(rows(one)) == frame.where("fold < 3").count()
    # as before: the test fold held back by hand
    before = MP.ML.score_folds(frame.where("fold <> 0"), {"k": single}, "fold", [1, 2]).unionAll(
        MP.ML.score_folds(frame, {"k": single}, "fold", [0]))
    assert rows(before) == rows(one)
