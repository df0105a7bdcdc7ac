"""Training-history plans over the history stand-ins and S."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import history as HI
from tessera.operators import metrics as M
from tessera.plans import standins as SI
from tessera.plans.registry import plan
from tessera.sources.tables import table

# Callback parameters (patience of early stopping, plateau rule)
EARLY_STOP_PATIENCE = 10
LR_START, LR_FACTOR, LR_PATIENCE, LR_MIN, LR_MIN_DELTA = 1e-3, 0.5, 5, 1e-6, 1e-4
SWEEP_THRESHOLDS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]


@plan("hist_learning_curves", uses=("HL0",), sql="SELECT run, epoch, auc, val_auc, loss, val_loss FROM HL0")
def hist_learning_curves(spark, sf_dir):
    return HI.learning_curves(SI.history_long(spark, sf_dir), ["auc", "val_auc", "loss", "val_loss"])


@plan("hist_early_stop", uses=("HIST",), sql=f"""
WITH h AS (SELECT run, epoch, val, ROW_NUMBER() OVER (PARTITION BY run ORDER BY epoch) AS pos,
             MAX(val) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
           FROM HIST),
i AS (SELECT *, (prev IS NULL OR val > prev) AS improved FROM h),
w AS (SELECT *, pos - MAX(CASE WHEN improved THEN pos END) OVER (PARTITION BY run ORDER BY epoch
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS wait FROM i),
s AS (SELECT *, COALESCE(MIN(CASE WHEN wait >= {EARLY_STOP_PATIENCE} THEN pos END) OVER (PARTITION BY run),
                         MAX(pos) OVER (PARTITION BY run)) AS stop_pos FROM w)
SELECT run, MAX(CASE WHEN pos = stop_pos THEN epoch END) AS stop_epoch,
       arg_max(epoch, CASE WHEN improved THEN pos END) AS best_epoch,
       arg_max(val, CASE WHEN improved THEN pos END) AS best_value,
       CAST(MAX(pos) AS INT) AS epochs_run
FROM s WHERE pos <= stop_pos GROUP BY run""")
def hist_early_stop(spark, sf_dir):
    r = HI.early_stop(SI.history(spark, sf_dir), "val", patience=EARLY_STOP_PATIENCE, mode="max")
    return r.withColumn("epochs_run", F.col("epochs_run").cast("int"))


@plan("hist_lr_schedule", uses=("HL",), sql=f"""
WITH RECURSIVE s AS (SELECT run, epoch, value,
                       ROW_NUMBER() OVER (PARTITION BY run ORDER BY epoch) AS pos
                     FROM HL WHERE metric = 'val_loss'),
r(run, pos, epoch, best, wait, lr) AS (
  SELECT run, pos, epoch, value, 0, CAST({LR_START} AS DOUBLE) FROM s WHERE pos = 1
  UNION ALL
  SELECT s.run, s.pos, s.epoch,
    CASE WHEN s.value < r.best - {LR_MIN_DELTA} THEN s.value ELSE r.best END,
    CASE WHEN s.value < r.best - {LR_MIN_DELTA} THEN 0
         WHEN r.wait + 1 >= {LR_PATIENCE} AND r.lr > {LR_MIN} THEN 0 ELSE r.wait + 1 END,
    CASE WHEN NOT (s.value < r.best - {LR_MIN_DELTA}) AND r.wait + 1 >= {LR_PATIENCE} AND r.lr > {LR_MIN}
         THEN GREATEST(r.lr * {LR_FACTOR}, {LR_MIN}) ELSE r.lr END
  FROM r JOIN s ON s.run = r.run AND s.pos = r.pos + 1)
SELECT run, epoch, lr FROM r""")
def hist_lr_schedule(spark, sf_dir):
    vl = SI.history_long(spark, sf_dir).where(F.col("metric") == "val_loss")
    return HI.lr_schedule(vl, "value", LR_START, LR_FACTOR, LR_PATIENCE, LR_MIN, LR_MIN_DELTA)


@plan("hist_best_checkpoint", uses=("HL",), sql="""
SELECT run, epoch, value FROM (
  SELECT run, epoch, value, ROW_NUMBER() OVER (PARTITION BY run ORDER BY value DESC, epoch) AS rn
  FROM HL WHERE metric = 'val_auc') t WHERE rn = 1""")
def hist_best_checkpoint(spark, sf_dir):
    va = SI.history_long(spark, sf_dir).where(F.col("metric") == "val_auc")
    return HI.best_checkpoint(va.select("run", "epoch", "value"), "value")


_SWEEP_VALUES = ", ".join(f"({t})" for t in SWEEP_THRESHOLDS)


@plan("hist_sweep_curve", uses=("S",), sql=f"""
WITH t AS (SELECT CAST(t AS DOUBLE) AS threshold FROM (VALUES {_SWEEP_VALUES}) v(t)),
g AS (SELECT p, SUM(y) AS pos, SUM(1 - y) AS neg FROM S GROUP BY p),
k AS (SELECT threshold, SUM(CASE WHEN p >= threshold THEN pos ELSE 0 END) AS tp,
             SUM(CASE WHEN p >= threshold THEN neg ELSE 0 END) AS fp,
             SUM(CASE WHEN p < threshold THEN pos ELSE 0 END) AS fn
      FROM g, t GROUP BY threshold),
f AS (SELECT threshold, ROUND(COALESCE(2.0 * tp / NULLIF(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM k)
SELECT threshold, f1, CAST(threshold = (SELECT threshold FROM f ORDER BY f1 DESC, threshold LIMIT 1) AS INT) AS best
FROM f""")
def hist_sweep_curve(spark, sf_dir):
    s = SI.scored(spark, sf_dir)
    g = M.score_counts(s, "p", "y")
    # each distinct score meets the (fixed, 9-value) parameter grid
    grid = g.select("*", F.explode(F.array(*[F.lit(float(t)) for t in SWEEP_THRESHOLDS])).alias("threshold"))
    hit = F.col("p") >= F.col("threshold")
    k = grid.groupBy("threshold").agg(
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(~hit, F.col("pos")).otherwise(0)).alias("fn"))
    from tessera.functions.exprs import safe_div
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    curve = k.select("threshold", F.round(safe_div(2 * tp, 2 * tp + fp + fn), 6).alias("f1"))
    # the curve has one row per grid value: pick the best with a small window
    from pyspark.sql import Window
    w = Window.orderBy(F.desc("f1"), "threshold")
    return curve.withColumn("best", (F.row_number().over(w) == 1).cast("int"))


@plan("hist_elapsed", sql="""
SELECT user_id AS run, ROUND((epoch_us(MAX(ts)) - epoch_us(MIN(ts))) / 1e6, 1) AS seconds
FROM events GROUP BY user_id""")
def hist_elapsed(spark, sf_dir):
    return HI.elapsed_seconds(table(spark, sf_dir, "events"), "user_id", "ts")
