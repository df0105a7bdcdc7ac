"""Headline panel: model count and the best score of
three report families in one row, "—" where a family has nothing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.exprs import DASH, fmt
from tessera.plans import standins as SI
from tessera.plans.image_plans import _LOGITS_SQL, _SOFTMAX_SQL, eval_accuracy_multi
from tessera.plans.lookup_plans import _FAM_P_SQL, family_p
from tessera.plans.registry import plan
from tessera.plans.scoring_plans import SEGMENT_EVAL_CTES
from tessera.plans.standins import with_standins


@plan("lb_headline", sql=with_standins(SEGMENT_EVAL_CTES + f""", {_FAM_P_SQL}, {_LOGITS_SQL}, {_SOFTMAX_SQL},
imgacc AS (SELECT AVG(CAST(list_position(probs, list_max(probs)) - 1 = label AS DOUBLE)) AS acc FROM pr)
SELECT (SELECT COUNT(*) FROM LBW) + (SELECT COUNT(*) FROM famp) AS n_models,
       COALESCE(printf('%.3f', (SELECT MAX(auc) FROM LBW)), '{DASH}') AS best_auc_s,
       COALESCE(printf('%.3f', (SELECT MAX(auc) FROM famp)), '{DASH}') AS best_auc_p,
       COALESCE(printf('%.3f', (SELECT ROUND(acc, 6) FROM imgacc)), '{DASH}') AS accuracy_images""",
                                     "P", "LBW", "IMG"))
def lb_headline(spark, sf_dir):
    s = SI.leaderboard_wide(spark, sf_dir).select(
        F.lit("s").alias("family"), F.col("auc").alias("v"), F.lit(1).alias("m"))
    p = family_p(spark, sf_dir).select(F.lit("p").alias("family"), F.col("auc").alias("v"), F.lit(1).alias("m"))
    i = eval_accuracy_multi(spark, sf_dir).select(
        F.lit("img").alias("family"), F.col("accuracy").alias("v"), F.lit(0).alias("m"))
    u = s.unionByName(p).unionByName(i)
    # one pass over a handful of rows: conditional maxima instead of a cross join
    one = u.agg(F.sum("m").alias("n_models"),
                *[F.max(F.when(F.col("family") == f, F.col("v"))).alias(f) for f in ("s", "p", "img")])
    return one.select(
        "n_models",
        F.coalesce(fmt(F.col("s"), "%.3f"), F.lit(DASH)).alias("best_auc_s"),
        F.coalesce(fmt(F.col("p"), "%.3f"), F.lit(DASH)).alias("best_auc_p"),
        F.coalesce(fmt(F.col("img"), "%.3f"), F.lit(DASH)).alias("accuracy_images"))
