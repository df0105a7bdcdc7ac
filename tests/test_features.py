import pytest
from pyspark.sql import functions as F

from tessera.operators import features as FE
from tessera.operators.profile import describe, histogram, long_numeric
from tessera.operators.quantiles import exact_quantiles
from tessera.operators.rules import check_rules


def test_onehot_null_unknown_unseen_are_zero(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",), ("unknown",)], "job string")
    levels = FE.drop_first_levels(FE.distinct_levels(train, ["job"]))
    assert levels == {"job": ["b", "c"]}  # 'unknown' removed, then the smallest level
    spec = FE.FeatureSpec([], levels)
    rows = spark.createDataFrame([("a",), ("b",), (None,), ("unknown",), ("zzz",)], "job string")
    out = FE.encode(rows, spec, keep=["job"], scale=False).collect()
    vec = {r["job"]: (r["job_b"], r["job_c"]) for r in out}
    assert vec["b"] == (1, 0)
    for k in ("a", None, "unknown", "zzz"):
        assert vec[k] == (0, 0)


def test_align_is_idempotent_and_fills_zero(spark):
    df = spark.createDataFrame([(1, 2.0, 9)], "x_a int, n double, extra int")
    feats = ["n", "x_a", "x_missing"]
    a1 = FE.align(df, feats)
    a2 = FE.align(a1, feats)
    assert a1.columns == feats and a2.columns == feats
    assert a1.first().asDict() == {"n": 2.0, "x_a": 1, "x_missing": 0}
    assert a2.first().asDict() == a1.first().asDict()


def test_class_weights_average_one(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(1,)] * 3, "y int")
    w = FE.attach_row_weight(df, "y")
    assert w.agg(F.avg("weight")).first()[0] == pytest.approx(1.0)
    by = {r["y"]: r["weight"] for r in FE.class_weights(df, "y").collect()}
    assert by[1] == pytest.approx(12 / (2 * 3))


def test_splits(spark):
    df = spark.range(1, 101).select(F.col("id").alias("key"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    h = FE.holdout_split(df, "key").where("split = 'test'").count()
    assert h == 20
    s = FE.stratified_split(df, "key", "y").groupBy("y", "split").count().collect()
    counts = {(r["y"], r["split"]): r["count"] for r in s}
    assert counts[(1, "test")] == 33 // 5 and counts[(0, "test")] == 67 // 5
    v = FE.validation_tail(df, "key", 0.15)
    assert v.where("split = 'val'").agg(F.min("key")).first()[0] == 86


def test_exact_quantiles_match_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    vals = np.round(rng.normal(size=1001) * 10, 1)  # many duplicates
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    q = exact_quantiles(long_numeric(df, ["x"]), [0.1, 0.25, 0.5, 0.9]).first()
    for i, p in enumerate([0.1, 0.25, 0.5, 0.9]):
        assert q[f"q{i}"] == pytest.approx(float(np.quantile(vals, p)), abs=1e-9)
    d = describe(df, ["x"], decimals=None).first()
    assert d["std"] == pytest.approx(float(np.std(vals, ddof=1)))


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,), (10.0,)], "x double")
    h = {r["bin"]: r["count"] for r in histogram(df, ["x"], bins=10).collect()}
    assert h[10] == 2 and h[1] == 1 and h[6] == 1 and sum(h.values()) == 4


def test_domain_rules(spark):
    df = spark.createDataFrame([(1, 50.0, "x"), (2, -1.0, "y"), (3, None, "x")], "k int, a double, c string")
    r = {row["k"]: row for row in check_rules(df, [("a", "range", (0.0, 100.0)),
                                                   ("c", "levels", ["x"])], keep=["k"]).collect()}
    assert r[1]["valid"] == 1 and r[2]["broken"] == "a,c" and r[3]["broken"] == "a"


def test_top_k_per_group_two_phase(spark):
    import pandas as pd

    from tessera.operators.lookups import top_k_per_group

    rows = [("hot", i, float((i * 7919) % 1000)) for i in range(3000)] + \
           [("cold", i, float(i)) for i in range(5)]
    df = spark.createDataFrame(rows, "g string, k long, v double")
    got = top_k_per_group(df, ["g"], [F.desc("v"), F.asc("k")], 3, salt_buckets=16).toPandas()
    pdf = pd.DataFrame(rows, columns=["g", "k", "v"]).sort_values(["g", "v", "k"], ascending=[True, False, True])
    exp = pdf.groupby("g").head(3)
    assert sorted(zip(got.g, got.k)) == sorted(zip(exp.g, exp.k))
    assert sorted(got["rank"]) == [1, 1, 2, 2, 3, 3]


def test_split_valid(spark):
    from tessera.operators.rules import split_valid

    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None)], "k int, a double")
    ok, bad = split_valid(df, [("a", "range", (0.0, 10.0))])
    assert [r["k"] for r in ok.collect()] == [1]
    assert sorted(r["k"] for r in bad.collect()) == [2, 3]


def test_quantiles_by_selection(spark):
    """Ties, several groups, nulls, and brackets narrowed over several rounds."""
    import numpy as np

    from tessera.operators import quantiles as Q

    rng = np.random.default_rng(12)
    n = 40_000
    cols = {"ties": rng.integers(0, 5, n).astype(float), "wide": rng.normal(size=n) * 1e6,
            "half": np.where(rng.random(n) < 0.5, 7.0, rng.normal(size=n)), "edge": np.repeat([1.0, 2.0], n // 2),
            "signed": rng.choice([0.0, -0.0, 1.0], n), "few": np.r_[rng.normal(size=3), np.full(n - 3, np.nan)]}
    import pandas as pd
    long = spark.createDataFrame(pd.DataFrame({"column": np.repeat(list(cols), n), "value": np.concatenate(list(cols.values()))}))
    long = long.withColumn("value", F.nanvl("value", F.lit(None).cast("double"))).repartition(6)
    probs = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]
    for limit in (1 << 16, 30):
        got = {r["column"]: r for r in Q.exact_quantiles(long, probs, limit=limit).collect()}
        for name, values in cols.items():
            want = np.quantile(values[~np.isnan(values)], probs)
            assert [got[name][f"q{i}"] for i in range(len(probs))] == pytest.approx(list(want), rel=1e-12, abs=1e-12), (name, limit)
        assert not any(np.signbit(got["signed"][f"q{i}"]) for i in range(len(probs)))


def test_quantile_brackets_are_small(spark):
    from tessera.operators import quantiles as Q

    rows = spark.range(300_000).selectExpr("'x' AS column", "CAST(hash(id) AS DOUBLE) AS value")
    found = Q.brackets(rows, [0.25, 0.5, 0.75], "column", limit=500).collect()
    for r in found:
        inside = rows.where((F.col("value") >= r["lo"]) & (F.col("value") <= r["hi"])).count()
        assert 0 < inside <= 502 and r["n"] == 300_000
    assert Q.exact_quantiles(rows.limit(0), [0.5]).collect() == []
