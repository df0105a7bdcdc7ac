import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators.prefix import RANGE, global_position, laid_out, running_totals


@pytest.mark.parametrize("n", [1, 7, 64])
def test_running_totals_match_pandas_with_hot_and_null_groups(spark, n):
    rng = np.random.default_rng(1)
    rows = 3000
    # one group holds most rows (skew), one group is null; keys unique in a group
    g = np.where(rng.random(rows) < 0.7, "hot", rng.choice(["a", "b", None], rows))
    pdf = pd.DataFrame({"g": g, "k": rng.permutation(rows).astype(float), "v": rng.integers(0, 5, rows)})
    df = spark.createDataFrame(pdf)
    out = running_totals(df, ["k"], ["v"], partition_by=["g"], n_buckets=n).toPandas()
    exp = pdf.sort_values(["g", "k"]).assign(cum_v=lambda d: d.groupby("g", dropna=False)["v"].cumsum())
    got = out.sort_values("k")["cum_v"].tolist()
    assert len(out) == rows
    assert got == exp.sort_values("k")["cum_v"].tolist()


def test_exclusive_totals_and_position(spark):
    df = spark.createDataFrame([(float(i), 1) for i in range(100)], "k double, v int")
    ex = running_totals(df, ["k"], ["v"], inclusive=False, n_buckets=4).orderBy("k").collect()
    assert [r["cum_v"] for r in ex] == list(range(100))
    pos = global_position(df, "k", n_buckets=5).orderBy("k").collect()
    assert [r["pos"] for r in pos] == list(range(1, 101))


@pytest.mark.parametrize("n", [1, 7, 64])
def test_null_order_key_keeps_its_row(spark, n):
    df = spark.createDataFrame([(None,), (3.0,), (1.0,), (2.0,)], "k double")
    got = {r["k"]: r["pos"] for r in global_position(df, "k", n_buckets=n).collect()}
    assert got == {None: 1, 1.0: 2, 2.0: 3, 3.0: 4}


def test_empty_input(spark):
    df = spark.createDataFrame([], "g string, k double, v int")
    assert running_totals(df, ["k"], ["v"], partition_by=["g"]).collect() == []


def test_no_single_partition_window(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("k"), F.lit(1).alias("v"))
    plan = running_totals(df, ["k"], ["v"], n_buckets=4)._jdf.queryExecution().executedPlan().toString()
    # only the per-range totals may meet in one partition
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "HashAggregate(keys=[__range" in lines[i + 1]


def test_hot_group_in_narrow_range_is_split(spark):
    rows = [("hot", 0.5 + i * 1e-9) for i in range(4000)] + [("cold", float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "g string, k double")
    b = laid_out(df, ["g", "k"], 8).where("g = 'hot'").groupBy(RANGE).count().collect()
    assert len(b) >= 6 and max(r["count"] for r in b) < 1000


def test_cut_tables_are_released(spark):
    import os

    from tessera.session import cut_lineage, release_cut_tables

    path = cut_lineage(spark.range(5)).inputFiles()[0].removeprefix("file:")
    assert os.path.exists(path)
    assert release_cut_tables(spark) >= 1
    assert not os.path.exists(path)
