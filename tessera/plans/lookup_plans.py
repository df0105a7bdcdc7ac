"""Joins, sorts, best-of and ranking plans over the
leaderboards derived from the scored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import lookups as LK
from tessera.plans import standins as SI
from tessera.plans.feature_plans import TOP10_SQL, top10_features
from tessera.plans.registry import plan
from tessera.plans.scoring_plans import SEGMENT_EVAL_CTES, segment_evaluation
from tessera.plans.standins import with_standins


def family_p(spark, sf_dir):
    """Second report family: the flagship's per-segment evaluation."""
    e = segment_evaluation(spark, sf_dir)
    return e.select(F.col("segment").alias("model"), F.round("auc", 4).alias("auc"),
                    F.round("f1", 4).alias("f1"), "n")


_FAM_P_SQL = "famp AS (SELECT segment AS model, ROUND(auc, 4) AS auc, ROUND(f1, 4) AS f1, n FROM segeval)"


@plan("join_semi_top10", uses=("IMP",), sql=f"""
WITH {TOP10_SQL} SELECT feature, model, importance FROM IMP WHERE feature IN (SELECT feature FROM top10)""")
def join_semi_top10(spark, sf_dir):
    imp = SI.importances(spark, sf_dir)
    # the top-10 side has at most 10 rows: broadcast
    return imp.join(F.broadcast(top10_features(spark, sf_dir).select("feature")), "feature", "left_semi")


@plan("join_best_model_rows", uses=("LBW",), sql="""
WITH best AS (SELECT model FROM LBW ORDER BY auc DESC, model LIMIT 1)
SELECT key, segment, y, p FROM S WHERE segment IN (SELECT model FROM best)""")
def join_best_model_rows(spark, sf_dir):
    lbw = SI.leaderboard_wide(spark, sf_dir)
    best = lbw.orderBy(F.desc("auc"), "model").limit(1).select(F.col("model").alias("segment"))
    # one-row winner: broadcast join with the scored table
    return SI.scored(spark, sf_dir).join(F.broadcast(best), "segment").select(
        "key", "segment", "y", "p")


@plan("join_compare_reports", sql=with_standins(SEGMENT_EVAL_CTES + f""", {_FAM_P_SQL}
SELECT COALESCE(s.model, f.model) AS model, s.auc AS auc_s, f.auc AS auc_p, s.f1 AS f1_s, f.f1 AS f1_p
FROM LBW s FULL OUTER JOIN famp f ON s.model = f.model""", "P", "LBW"))
def join_compare_reports(spark, sf_dir):
    s = SI.leaderboard_wide(spark, sf_dir).select(
        "model", F.col("auc").alias("auc_s"), F.col("f1").alias("f1_s"))
    p = family_p(spark, sf_dir).select("model", F.col("auc").alias("auc_p"), F.col("f1").alias("f1_p"))
    return s.join(p, "model", "full_outer").select("model", "auc_s", "auc_p", "f1_s", "f1_p")


@plan("set_union_leaderboards", sql=with_standins(SEGMENT_EVAL_CTES + f""", {_FAM_P_SQL}
SELECT 'S' AS source, model, auc, f1, accuracy, CAST(NULL AS BIGINT) AS n FROM LBW
UNION ALL SELECT 'P', model, auc, f1, CAST(NULL AS DOUBLE), n FROM famp""", "P", "LBW"))
def set_union_leaderboards(spark, sf_dir):
    s = SI.leaderboard_wide(spark, sf_dir).withColumn("source", F.lit("S"))
    p = family_p(spark, sf_dir).withColumn("source", F.lit("P"))
    return s.unionByName(p, allowMissingColumns=True).select(
        "source", "model", "auc", "f1", "accuracy", "n")


@plan("sort_desc", uses=("LBW",), sql="SELECT * FROM LBW ORDER BY accuracy DESC, model")
def sort_desc(spark, sf_dir):
    return SI.leaderboard_wide(spark, sf_dir).orderBy(F.desc("accuracy"), "model")


@plan("sort_asc", uses=("LBW",), sql="SELECT * FROM LBW ORDER BY accuracy, model")
def sort_asc(spark, sf_dir):
    return SI.leaderboard_wide(spark, sf_dir).orderBy("accuracy", "model")


@plan("top1_first_on_tie", uses=("S",), sql="SELECT key, segment, y, p FROM S ORDER BY p DESC, key LIMIT 1")
def top1_first_on_tie(spark, sf_dir):
    return LK.first_max_row(SI.scored(spark, sf_dir), "p", "key")


@plan("agg_best_per_family", sql=with_standins(SEGMENT_EVAL_CTES + f""", {_FAM_P_SQL}
SELECT source, metric, MAX(value) AS best FROM (
  SELECT source, metric, value FROM LB
  UNION ALL SELECT 'P', 'auc', auc FROM famp UNION ALL SELECT 'P', 'f1', f1 FROM famp) t
GROUP BY source, metric""", "P", "LB"))
def agg_best_per_family(spark, sf_dir):
    s = SI.leaderboard_long(spark, sf_dir, "S")
    p = family_p(spark, sf_dir).unpivot(["model"], ["auc", "f1"], "metric", "value").select(
        F.lit("P").alias("source"), "model", "metric", "value")
    return s.unionByName(p).groupBy("source", "metric").agg(F.max("value").alias("best"))


@plan("topk_first16", uses=("S",), sql="SELECT key, segment, y, p FROM S ORDER BY key LIMIT 16")
def topk_first16(spark, sf_dir):
    return SI.scored(spark, sf_dir).orderBy("key").limit(16)


@plan("win_rank_models", uses=("LB",), sql="""
SELECT source, model, metric, value,
       RANK() OVER (PARTITION BY metric ORDER BY value DESC) AS rank,
       DENSE_RANK() OVER (PARTITION BY metric ORDER BY value DESC) AS dense_rank FROM LB""")
def win_rank_models(spark, sf_dir):
    lb = SI.leaderboard_long(spark, sf_dir)
    return LK.rank_within(lb, ["metric"], [F.desc("value")]).select(
        "source", "model", "metric", "value", F.col("rank").cast("bigint").alias("rank"),
        F.col("dense_rank").cast("bigint").alias("dense_rank"))
