"""Feature-preparation plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import features as FE
from tessera.operators.features import fit_spec
from tessera.plans import standins as SI
from tessera.plans.expr_plans import _ONEHOT_SQL, FROZEN, _q, full_onehot_prospects
from tessera.plans.registry import plan
from tessera.plans.scoring_plans import train_rows
from tessera.sources.tables import table


@plan("feat_onehot_full", uses=("P",), sql=_ONEHOT_SQL)
def feat_onehot_full(spark, sf_dir):
    return full_onehot_prospects(spark, sf_dir)


_DROP_FIRST_SQL = "SELECT key, o_totalprice, c_acctbal, y, " + ", ".join(
    f"CAST(({c} IS NOT DISTINCT FROM '{lv}') AS INT) AS \"{c}_{lv}\""
    for c in SI.CAT_COLS for lv in SI.LEVELS[c][1:]) + " FROM P"


@plan("feat_onehot_drop_first", uses=("P",), sql=_DROP_FIRST_SQL)
def feat_onehot_drop_first(spark, sf_dir):
    return FE.onehot_drop_first(SI.prospects(spark, sf_dir), SI.CAT_COLS)


_PRESENT = {"key", "o_totalprice", "c_acctbal", "y"} | {
    f"{c}_{lv}" for c in SI.CAT_COLS for lv in SI.LEVELS[c]}


@plan("feat_align", uses=("P",), sql=f"""
WITH oh AS ({_ONEHOT_SQL})
SELECT key, {", ".join((_q(f) if f in _PRESENT else f"0 AS {_q(f)}") for f in FROZEN)} FROM oh""")
def feat_align(spark, sf_dir):
    return FE.align(full_onehot_prospects(spark, sf_dir), FROZEN, keep=["key"])


def actual_feature_names(spark, sf_dir):
    """Names a full one-hot of the data produces: numeric names plus
    ``col_level`` for every level present (a distinct over all rows)."""
    p = SI.prospects(spark, sf_dir)
    dummies = p.select(F.explode(F.array(*[
        F.concat(F.lit(col + "_"), F.col(col)) for col in SI.CAT_COLS])).alias("feature")).distinct()
    numeric = spark.createDataFrame([(x,) for x in SI.NUM_COLS], "feature string")
    return dummies.unionByName(numeric)


_ACTUAL_SQL = " UNION ".join(
    [f"SELECT DISTINCT '{c}_' || {c} AS feature FROM P" for c in SI.CAT_COLS]
    + [f"SELECT '{x}' AS feature" for x in SI.NUM_COLS])
_FROZEN_VALUES = ", ".join(f"({i}, '{f}')" for i, f in enumerate(FROZEN))


@plan("set_missing_features", uses=("P",), sql=f"""
SELECT feature FROM (VALUES {_FROZEN_VALUES}) t(pos, feature)
EXCEPT SELECT feature FROM ({_ACTUAL_SQL}) a""")
def set_missing_features(spark, sf_dir):
    expected = spark.createDataFrame([(f,) for f in FROZEN], "feature string")
    return expected.subtract(actual_feature_names(spark, sf_dir))


@plan("join_anti_missing", uses=("P",), sql=f"""
SELECT pos, feature FROM (VALUES {_FROZEN_VALUES}) t(pos, feature)
WHERE feature NOT IN (SELECT feature FROM ({_ACTUAL_SQL}) a)""")
def join_anti_missing(spark, sf_dir):
    expected = spark.createDataFrame([(i, f) for i, f in enumerate(FROZEN)], "pos int, feature string")
    return expected.join(actual_feature_names(spark, sf_dir), "feature", "left_anti").select(
        "pos", "feature")


_STATS_SQL = """st AS (SELECT AVG(o_totalprice) AS m0, STDDEV_POP(o_totalprice) AS s0,
                   AVG(c_acctbal) AS m1, STDDEV_POP(c_acctbal) AS s1 FROM P WHERE key % 5 <> 0)"""


@plan("feat_standard_scale", uses=("P",), sql=f"""
WITH {_STATS_SQL}
SELECT key, ROUND((o_totalprice - m0) / CASE WHEN s0 = 0 THEN 1 ELSE s0 END, 6) AS o_totalprice,
       ROUND((c_acctbal - m1) / CASE WHEN s1 = 0 THEN 1 ELSE s1 END, 6) AS c_acctbal FROM P, st""")
def feat_standard_scale(spark, sf_dir):
    p = SI.prospects(spark, sf_dir)
    mean, std = FE.scaler_stats(train_rows(p), SI.NUM_COLS)
    z = FE.standard_scale(p.select("key", *SI.NUM_COLS), mean, std)
    return z.select("key", *[F.round(x, 6).alias(x) for x in SI.NUM_COLS])


_CW_SQL = """cw AS (SELECT toxic, COUNT(*) AS n_c,
                 SUM(COUNT(*)) OVER () / (COUNT(*) OVER () * COUNT(*)) AS weight
          FROM labels WHERE toxic IS NOT NULL GROUP BY toxic)"""


@plan("feat_class_weights", sql=f"WITH {_CW_SQL} SELECT toxic, n_c, ROUND(weight, 6) AS weight FROM cw")
def feat_class_weights(spark, sf_dir):
    w = FE.class_weights(table(spark, sf_dir, "labels"), "toxic")
    return w.select("toxic", "n_c", F.round("weight", 6).alias("weight"))


@plan("feat_class_weight_map", sql=f"WITH {_CW_SQL} SELECT toxic AS class, ROUND(weight, 6) AS weight FROM cw")
def feat_class_weight_map(spark, sf_dir):
    m = FE.class_weight_map(table(spark, sf_dir, "labels"), "toxic")
    return m.select(F.explode("class_weight").alias("class", "weight")).select(
        F.col("class").cast("int").alias("class"), F.round("weight", 6).alias("weight"))


@plan("feat_row_weight", sql=f"""
WITH {_CW_SQL}
SELECT l.doc_id, l.toxic, ROUND(cw.weight, 6) AS weight FROM labels l LEFT JOIN cw ON l.toxic = cw.toxic""")
def feat_row_weight(spark, sf_dir):
    w = FE.attach_row_weight(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "toxic")
    return w.select("doc_id", "toxic", F.round("weight", 6).alias("weight"))


TOP10_SQL = """m AS (SELECT feature, ROUND(AVG(importance), 6) AS mean FROM IMP GROUP BY feature),
top10 AS (SELECT feature, mean FROM m ORDER BY mean DESC, feature LIMIT 10)"""


def top10_features(spark, sf_dir):
    imp = SI.importances(spark, sf_dir)
    mean = imp.groupBy("feature").agg(F.round(F.avg("importance"), 6).alias("mean"))
    return mean.orderBy(F.desc("mean"), "feature").limit(10)


@plan("feat_top10_mean_importance", uses=("IMP",), sql=f"WITH {TOP10_SQL} SELECT * FROM top10")
def feat_top10_mean_importance(spark, sf_dir):
    return top10_features(spark, sf_dir)


def _assemble_sql():
    terms = ["ROUND((o_totalprice - m0) / CASE WHEN s0 = 0 THEN 1 ELSE s0 END, 6)",
             "ROUND((c_acctbal - m1) / CASE WHEN s1 = 0 THEN 1 ELSE s1 END, 6)"]
    for c in SI.CAT_COLS:
        for lv in SI.LEVELS[c][1:]:
            terms.append(f"CAST(({c} IS NOT DISTINCT FROM '{lv}') AS DOUBLE)")
    return f"WITH {_STATS_SQL} SELECT key, [{', '.join(terms)}] AS features FROM P, st"


@plan("feat_assemble_array", uses=("P",), sql=_assemble_sql())
def feat_assemble_array(spark, sf_dir):
    p = SI.prospects(spark, sf_dir)
    spec = fit_spec(train_rows(p), SI.NUM_COLS, SI.CAT_COLS)
    enc = FE.encode(p, spec, keep=["key"])
    arr = FE.assemble_array(enc, spec.features, keep=["key"])
    return arr.select("key", F.transform("features", lambda v: F.round(v, 6)).alias("features"))


@plan("split_holdout", uses=("P",), sql="""
SELECT key, y, CASE WHEN key % 5 = 0 THEN 'test' ELSE 'train' END AS split FROM P""")
def split_holdout(spark, sf_dir):
    return FE.holdout_split(SI.prospects(spark, sf_dir).select("key", "y"), "key", 5)


@plan("split_stratified", uses=("P",), sql="""
SELECT key, y, CASE WHEN ROW_NUMBER() OVER (PARTITION BY y ORDER BY key) % 5 = 0
                    THEN 'test' ELSE 'train' END AS split FROM P""")
def split_stratified(spark, sf_dir):
    return FE.stratified_split(SI.prospects(spark, sf_dir).select("key", "y"), "key", "y", 5)


@plan("split_stratified_null_class", uses=("SR",), sql="""
SELECT key, segment, CASE WHEN ROW_NUMBER() OVER (PARTITION BY segment ORDER BY key) % 5 = 0
                          THEN 'test' ELSE 'train' END AS split FROM SR""")
def split_stratified_null_class(spark, sf_dir):
    """Rows without a class are a class of their own."""
    return FE.stratified_split(SI.scored_raw(spark, sf_dir).select("key", "segment"), "key", "segment", 5)


@plan("split_validation_tail_null_key", uses=("P",), sql="""
WITH k AS (SELECT NULLIF(key, (SELECT MAX(key) FROM P)) AS key FROM P)
SELECT key, CASE WHEN ROW_NUMBER() OVER (ORDER BY key NULLS FIRST)
                      <= FLOOR(COUNT(*) OVER () * (CAST(1.0 AS DOUBLE) - CAST(0.15 AS DOUBLE)))
                 THEN 'train' ELSE 'val' END AS split FROM k""")
def split_validation_tail_null_key(spark, sf_dir):
    """A row without a key stands first and is kept."""
    p = SI.prospects(spark, sf_dir)
    last = p.agg(F.max("key")).first()[0]
    keys = p.select(F.when(F.col("key") != last, F.col("key")).alias("key"))
    return FE.validation_tail(keys, "key", 0.15)


@plan("split_validation_tail", uses=("P",), sql="""
SELECT key, CASE WHEN ROW_NUMBER() OVER (ORDER BY key)
                      <= FLOOR(COUNT(*) OVER () * (CAST(1.0 AS DOUBLE) - CAST(0.15 AS DOUBLE)))
                 THEN 'train' ELSE 'val' END AS split FROM P""")
def split_validation_tail(spark, sf_dir):
    return FE.validation_tail(SI.prospects(spark, sf_dir).select("key"), "key", 0.15)
