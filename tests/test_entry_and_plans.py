import duckdb
import pytest

import __spark_entry__ as E
from tessera.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["segment", "n", "auc", "f1", "accuracy"]


def test_every_query_has_callable_and_sql_names_match():
    q, o = E.queries(), E.oracle_sql()
    assert len(q) >= 130
    assert set(o) <= set(q)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


ORACLE_SAMPLE = ["eval_segment_scoring", "score_batch", "prof_describe", "eval_auc_by_segment",
                 "eval_roc_points", "feat_onehot_drop_first", "split_stratified", "img_conv2d_same",
                 "knn_exact", "hist_early_stop", "hist_lr_schedule", "eval_cv_summary"]


def _canon(cols, rows):
    from tools.oracle_check import canon
    return canon(cols, rows)


@pytest.mark.parametrize("key", ORACLE_SAMPLE)
def test_oracle_at_small_scale(spark, duck, key):
    sdf = E.queries()[key](spark, SF)
    rel = duck.sql(E.oracle_sql()[key])
    c1, r1 = _canon(sdf.columns, [tuple(r) for r in sdf.collect()])
    c2, r2 = _canon(rel.columns, rel.fetchall())
    assert c1 == c2
    assert r1 == r2


PLAN_CHECKS = ["eval_segment_scoring", "score_batch", "prof_describe", "eval_auc_exact", "split_stratified",
               "img_conv2d_same", "feat_onehot_drop_first"]


@pytest.mark.parametrize("key", PLAN_CHECKS)
def test_plan_shape(spark, key):
    df = E.queries()[key](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # rows may only be gathered into one partition after they were aggregated
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = lines[i + 1]
            assert "Aggregate" in below, f"{key}: single-partition exchange over {below.strip()}"
