"""Evaluation plans over the scored stand-in ``S``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.exprs import threshold
from tessera.operators import metrics as M
from tessera.plans import standins as SI
from tessera.plans.registry import plan
from tessera.session import cut_lineage

# Class names of the binary report, ROC zoom box, folds.
REPORT_NAMES = {0: "no", 1: "yes"}
ROC_ZOOM_FPR = 0.3
FOLDS = 5


def scored_with_pred(spark, sf_dir):
    s = SI.scored(spark, sf_dir)
    return s.withColumn("pred", threshold(F.col("p")))


_AUC_CTE = """g AS (SELECT {by}p, SUM(y) AS pos, SUM(1 - y) AS neg FROM {src} GROUP BY {by}p),
c AS (SELECT {by}pos, neg, COALESCE(SUM(neg) OVER ({part}ORDER BY p
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g),
a AS (SELECT {by}ROUND(SUM(pos * (below + neg / 2.0)) / (SUM(pos) * SUM(neg)), 6) AS auc,
        CAST(SUM(pos) AS BIGINT) AS n_pos, CAST(SUM(neg) AS BIGINT) AS n_neg FROM c {group})"""


def auc_sql(src="S", by=None):
    if by:
        return _AUC_CTE.format(by=f"{by}, ", part=f"PARTITION BY {by} ", src=src,
                               group=f"GROUP BY {by}")
    return _AUC_CTE.format(by="", part="", src=src, group="")


def _round_auc(df):
    return df.withColumn("auc", F.round("auc", 6))


@plan("eval_auc_exact", uses=("SR",), sql=f"WITH {auc_sql('SR')} SELECT * FROM a")
def eval_auc_exact(spark, sf_dir):
    return _round_auc(M.auc_exact(SI.scored_raw(spark, sf_dir), "p", "y"))


@plan("eval_auc_null_segment", uses=("SR",), sql=f"WITH {auc_sql('SR', by='segment')} SELECT * FROM a")
def eval_auc_null_segment(spark, sf_dir):
    """Null is a segment of its own."""
    return _round_auc(M.auc_exact(SI.scored_raw(spark, sf_dir), "p", "y", by=["segment"]))


@plan("eval_auc_by_segment", uses=("S",), sql=f"WITH {auc_sql(by='segment')} SELECT * FROM a")
def eval_auc_by_segment(spark, sf_dir):
    return _round_auc(M.auc_exact(SI.scored(spark, sf_dir), "p", "y", by=["segment"]))


@plan("eval_auc_binned", uses=("S",), sql="""
WITH b AS (SELECT CAST(LEAST(GREATEST(FLOOR(p * 200), 0), 199) AS INT) AS bucket, y FROM S),
g AS (SELECT bucket, SUM(y) AS pos, SUM(1 - y) AS neg FROM b GROUP BY bucket),
c AS (SELECT pos, neg, COALESCE(SUM(neg) OVER (ORDER BY bucket
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
SELECT ROUND(SUM(pos * (below + neg / 2.0)) / (SUM(pos) * SUM(neg)), 6) AS auc,
       CAST(SUM(pos) AS BIGINT) AS n_pos, CAST(SUM(neg) AS BIGINT) AS n_neg FROM c""")
def eval_auc_binned(spark, sf_dir):
    return _round_auc(M.auc_binned(SI.scored(spark, sf_dir), "p", "y"))


_PRED = "CAST(p >= 0.5 AS INT)"


@plan("eval_confusion", uses=("S",), sql=f"""
WITH k AS (SELECT y AS label, {_PRED} AS pred, COUNT(*) AS n FROM S GROUP BY ALL),
gr AS (SELECT l.c AS label, p.c AS pred FROM (VALUES (0), (1)) l(c), (VALUES (0), (1)) p(c))
SELECT gr.label, gr.pred, CAST(COALESCE(k.n, 0) AS BIGINT) AS n
FROM gr LEFT JOIN k ON gr.label = k.label AND gr.pred = k.pred""")
def eval_confusion(spark, sf_dir):
    return M.confusion(scored_with_pred(spark, sf_dir), "y", "pred", classes=[0, 1])


@plan("eval_confusion_wide", uses=("S",), sql=f"""
SELECT y AS label, COUNT(*) FILTER (WHERE {_PRED} = 0) AS pred_0,
       COUNT(*) FILTER (WHERE {_PRED} = 1) AS pred_1 FROM S GROUP BY y""")
def eval_confusion_wide(spark, sf_dir):
    return M.confusion_wide(scored_with_pred(spark, sf_dir), "y", "pred", classes=[0, 1])


_COUNTS = f"""k AS (SELECT COUNT(*) FILTER (WHERE y = 1 AND {_PRED} = 1) AS tp,
  COUNT(*) FILTER (WHERE y = 0 AND {_PRED} = 1) AS fp,
  COUNT(*) FILTER (WHERE y = 1 AND {_PRED} = 0) AS fn,
  COUNT(*) FILTER (WHERE y = 0 AND {_PRED} = 0) AS tn FROM S)"""


@plan("eval_f1", uses=("S",), sql=f"""
WITH {_COUNTS}
SELECT tp, fp, fn, tn, ROUND(COALESCE(2.0 * tp / NULLIF(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM k""")
def eval_f1(spark, sf_dir):
    f = M.f1_binary(scored_with_pred(spark, sf_dir), "y", "pred")
    return f.withColumn("f1", F.round("f1", 6))


@plan("eval_class_report", uses=("S",), sql=f"""
WITH cm AS (SELECT y AS label, {_PRED} AS pred, COUNT(*) AS n FROM S GROUP BY ALL),
per AS (SELECT c.cls,
          COALESCE((SELECT SUM(n) FROM cm WHERE label = c.cls AND pred = c.cls), 0) AS tp,
          COALESCE((SELECT SUM(n) FROM cm WHERE label = c.cls), 0) AS support,
          COALESCE((SELECT SUM(n) FROM cm WHERE pred = c.cls), 0) AS npred
        FROM (SELECT label AS cls FROM cm UNION SELECT pred FROM cm) c),
r AS (SELECT CASE cls WHEN 0 THEN 'no' WHEN 1 THEN 'yes' ELSE CAST(cls AS VARCHAR) END AS class,
         COALESCE(tp / NULLIF(CAST(npred AS DOUBLE), 0), 0) AS precision,
         COALESCE(tp / NULLIF(CAST(support AS DOUBLE), 0), 0) AS recall,
         COALESCE(2.0 * tp / NULLIF(CAST(support + npred AS DOUBLE), 0), 0) AS f1,
         CAST(support AS BIGINT) AS support, tp FROM per),
sm AS (SELECT SUM(tp) AS tp, SUM(support) AS n, AVG(precision) AS mp, AVG(recall) AS mr, AVG(f1) AS mf,
         SUM(precision * support) AS wp, SUM(recall * support) AS wr, SUM(f1 * support) AS wf FROM r)
SELECT class, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall, ROUND(f1, 6) AS f1, support FROM r
UNION ALL SELECT 'accuracy', NULL, NULL, ROUND(tp / CAST(n AS DOUBLE), 6), CAST(n AS BIGINT) FROM sm
UNION ALL SELECT 'macro avg', ROUND(mp, 6), ROUND(mr, 6), ROUND(mf, 6), CAST(n AS BIGINT) FROM sm
UNION ALL SELECT 'weighted avg', ROUND(wp / n, 6), ROUND(wr / n, 6), ROUND(wf / n, 6), CAST(n AS BIGINT) FROM sm""")
def eval_class_report(spark, sf_dir):
    r = M.class_report(scored_with_pred(spark, sf_dir), "y", "pred", names=REPORT_NAMES)
    return r.select("class", *[F.round(x, 6).alias(x) for x in ("precision", "recall", "f1")], "support")


_NULLS = f"""n AS (SELECT CASE WHEN key % 7 <> 0 THEN segment END AS segment, CASE WHEN key % 11 <> 0 THEN y END AS y,
  CASE WHEN key % 13 <> 0 THEN {_PRED} END AS pred FROM S)"""


def scored_with_nulls(spark, sf_dir):
    """Segments, labels and decisions that are null for some rows."""
    s = scored_with_pred(spark, sf_dir)
    return s.select(F.when(F.col("key") % 7 != 0, F.col("segment")).alias("segment"), F.when(F.col("key") % 11 != 0, F.col("y")).alias("y"),
                    F.when(F.col("key") % 13 != 0, F.col("pred")).alias("pred"))


@plan("eval_confusion_nulls", uses=("S",), sql=f"""
WITH {_NULLS}, cl AS (SELECT segment, y AS c FROM n UNION SELECT segment, pred FROM n),
k AS (SELECT segment, y, pred, COUNT(*) AS n FROM n GROUP BY ALL)
SELECT l.segment, l.c AS label, p.c AS pred, CAST(COALESCE(k.n, 0) AS BIGINT) AS n
FROM cl l JOIN cl p ON l.segment IS NOT DISTINCT FROM p.segment
LEFT JOIN k ON k.segment IS NOT DISTINCT FROM l.segment AND k.y IS NOT DISTINCT FROM l.c AND k.pred IS NOT DISTINCT FROM p.c""")
def eval_confusion_nulls(spark, sf_dir):
    return M.confusion(scored_with_nulls(spark, sf_dir), "y", "pred", by=["segment"])


@plan("eval_class_report_nulls", uses=("S",), sql=f"""
WITH {_NULLS}, c AS (SELECT y AS cls FROM n UNION SELECT pred FROM n),
per AS (SELECT cls, (SELECT COUNT(*) FROM n WHERE y IS NOT DISTINCT FROM cls AND pred IS NOT DISTINCT FROM cls) AS tp,
               (SELECT COUNT(*) FROM n WHERE y IS NOT DISTINCT FROM cls) AS support,
               (SELECT COUNT(*) FROM n WHERE pred IS NOT DISTINCT FROM cls) AS npred FROM c),
r AS (SELECT COALESCE(CAST(cls AS VARCHAR), 'null') AS class, tp / npred::DOUBLE AS precision, tp / support::DOUBLE AS recall,
             2.0::DOUBLE * tp / (support + npred) AS f1, CAST(support AS BIGINT) AS support, tp FROM per)
SELECT class, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall, ROUND(f1, 6) AS f1, support FROM r
UNION ALL SELECT 'accuracy', NULL, NULL, ROUND(SUM(tp) / SUM(support)::DOUBLE, 6), CAST(SUM(support) AS BIGINT) FROM r
UNION ALL SELECT 'macro avg', ROUND(AVG(precision), 6), ROUND(AVG(recall), 6), ROUND(AVG(f1), 6), CAST(SUM(support) AS BIGINT) FROM r
UNION ALL SELECT 'weighted avg', ROUND(SUM(precision * support) / SUM(support), 6), ROUND(SUM(recall * support) / SUM(support), 6),
                 ROUND(SUM(f1 * support) / SUM(support), 6), CAST(SUM(support) AS BIGINT) FROM r""")
def eval_class_report_nulls(spark, sf_dir):
    r = M.class_report(scored_with_nulls(spark, sf_dir), "y", "pred")
    return r.select("class", *[F.round(x, 6).alias(x) for x in ("precision", "recall", "f1")], "support")


@plan("eval_accuracy", uses=("S",), sql=f"""
SELECT ROUND(AVG(CAST({_PRED} = y AS DOUBLE)), 6) AS accuracy FROM S""")
def eval_accuracy(spark, sf_dir):
    a = M.accuracy(scored_with_pred(spark, sf_dir), "y", "pred")
    return a.select(F.round("accuracy", 6).alias("accuracy"))


@plan("eval_logloss_binary", uses=("S",), sql="""
WITH c AS (SELECT y, LEAST(GREATEST(p, 1e-7), 1 - 1e-7) AS q FROM S)
SELECT ROUND(-AVG(y * LN(q) + (1 - y) * LN(1 - q)), 6) AS logloss FROM c""")
def eval_logloss_binary(spark, sf_dir):
    ll = M.logloss_binary(SI.scored(spark, sf_dir), "y", "p")
    return ll.select(F.round("logloss", 6).alias("logloss"))


_ROC_SQL = """g AS (SELECT p, SUM(y) AS pos, SUM(1 - y) AS neg FROM SR GROUP BY p),
tot AS (SELECT SUM(pos) AS tot_pos, SUM(neg) AS tot_neg FROM g),
c AS (SELECT p, SUM(pos) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cp,
             SUM(neg) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn FROM g),
roc AS (SELECT p AS threshold, ROUND(cn / CAST(tot_neg AS DOUBLE), 6) AS fpr,
               ROUND(cp / CAST(tot_pos AS DOUBLE), 6) AS tpr FROM c, tot
        UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0)"""


def roc(spark, sf_dir):
    r = M.roc_points(SI.scored_raw(spark, sf_dir), "p", "y")
    return r.select("threshold", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


@plan("eval_roc_points", uses=("SR",), sql=f"WITH {_ROC_SQL} SELECT * FROM roc")
def eval_roc_points(spark, sf_dir):
    return roc(spark, sf_dir)


@plan("eval_roc_zoom", uses=("SR",), sql=f"WITH {_ROC_SQL} SELECT * FROM roc WHERE fpr <= {ROC_ZOOM_FPR}")
def eval_roc_zoom(spark, sf_dir):
    return roc(spark, sf_dir).where(F.col("fpr") <= ROC_ZOOM_FPR)


@plan("eval_auc_ranking", uses=("S",), sql=f"""
WITH {auc_sql(by='segment')} SELECT segment AS model, ROUND(auc, 4) AS auc FROM a ORDER BY auc DESC, model""")
def eval_auc_ranking(spark, sf_dir):
    a = M.auc_exact(SI.scored(spark, sf_dir), "p", "y", by=["segment"])
    return a.select(F.col("segment").alias("model"), F.round(F.round("auc", 6), 4).alias("auc")).orderBy(
        F.desc("auc"), "model")


@plan("eval_cv_summary", uses=("S",), sql=f"""
WITH f AS (SELECT segment, key % {FOLDS} AS fold, y, p FROM S),
g AS (SELECT segment, fold, p, SUM(y) AS pos, SUM(1 - y) AS neg FROM f GROUP BY ALL),
c AS (SELECT segment, fold, pos, neg, COALESCE(SUM(neg) OVER (PARTITION BY segment, fold ORDER BY p
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g),
a AS (SELECT segment, fold, SUM(pos * (below + neg / 2.0)) / (SUM(pos) * SUM(neg)) AS auc FROM c GROUP BY ALL),
k AS (SELECT segment, fold,
        COALESCE(2.0 * COUNT(*) FILTER (WHERE y = 1 AND p >= 0.5)
          / NULLIF(2 * COUNT(*) FILTER (WHERE y = 1 AND p >= 0.5) + COUNT(*) FILTER (WHERE y = 0 AND p >= 0.5)
                   + COUNT(*) FILTER (WHERE y = 1 AND p < 0.5), 0), 0) AS f1
      FROM f GROUP BY ALL),
pf AS (SELECT a.segment, a.fold, ROUND(a.auc, 6) AS auc, ROUND(k.f1, 6) AS f1 FROM a JOIN k
       ON a.segment = k.segment AND a.fold = k.fold)
SELECT segment AS model, ROUND(AVG(auc), 4) AS cv_auc_mean, ROUND(STDDEV_POP(auc), 4) AS cv_auc_std,
       ROUND(AVG(f1), 4) AS cv_f1_mean, ROUND(STDDEV_POP(f1), 4) AS cv_f1_std FROM pf GROUP BY segment""")
def eval_cv_summary(spark, sf_dir):
    s = SI.scored(spark, sf_dir).withColumn("fold", (F.col("key") % FOLDS).cast("long"))
    by = ["segment", "fold"]
    g = cut_lineage(M.score_counts(s, "p", "y", by=by))
    auc = M.auc_from_score_counts(g, "p", by=by)
    k = M.counts_at_threshold(g, "p", by=by, t=0.5)
    from tessera.functions.exprs import safe_div
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    per_fold = auc.join(k, by).select(
        F.col("segment").alias("model"), "fold", F.round("auc", 6).alias("auc"),
        F.round(safe_div(2 * tp, 2 * tp + fp + fn), 6).alias("f1"))
    cv = M.cv_summary(per_fold, "model", ["auc", "f1"])
    return cv.select("model", F.round("auc_mean", 4).alias("cv_auc_mean"),
                     F.round("auc_std", 4).alias("cv_auc_std"),
                     F.round("f1_mean", 4).alias("cv_f1_mean"), F.round("f1_std", 4).alias("cv_f1_std"))


@plan("lb_wide", uses=("LB",), sql="""
SELECT model, MAX(value) FILTER (WHERE metric = 'accuracy') AS accuracy,
       MAX(value) FILTER (WHERE metric = 'auc') AS auc,
       MAX(value) FILTER (WHERE metric = 'f1') AS f1 FROM LB GROUP BY model""")
def lb_wide(spark, sf_dir):
    lb = SI.leaderboard_long(spark, sf_dir)
    # the metric list is fixed, so the pivot needs no extra pass for its values
    return lb.groupBy("model").pivot("metric", ["accuracy", "auc", "f1"]).agg(F.first("value"))
