"""Training-history analytics over ``(run, epoch, metric, value)`` tables.

A run has at most a few hundred epochs, so per-run windows and the ordered
fold below are bounded by the epoch count, however many runs there are; runs
are independent and spread over tasks by their key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def learning_curves(hist_long: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """One row per (run, epoch), one column per series (train and validation)."""
    return hist_long.groupBy("run", "epoch").pivot("metric", list(metrics)).agg(F.first("value"))


def early_stop(hist: DataFrame, value: str = "val", patience: int = 10, mode: str = "max",
               min_delta: float = 0.0) -> DataFrame:
    """Keras ``EarlyStopping(restore_best_weights=True)`` replayed on a history:
    per run, the stop epoch (first epoch ``patience`` epochs after the last
    improvement, else the last epoch) and the best epoch kept."""
    w = Window.partitionBy("run").orderBy("epoch")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    v = F.col(value)
    if mode == "max":
        prev = F.max(v).over(before)
        improved = prev.isNull() | (v - F.lit(min_delta) > prev)
    else:
        prev = F.min(v).over(before)
        improved = prev.isNull() | (v + F.lit(min_delta) < prev)
    h = hist.select("run", "epoch", v.alias("v"), F.row_number().over(w).alias("pos"),
                    improved.alias("improved"))
    h = h.withColumn("wait", F.col("pos") - F.max(F.when(F.col("improved"), F.col("pos"))).over(upto))
    per_run = Window.partitionBy("run")
    stop_pos = F.coalesce(F.min(F.when(F.col("wait") >= patience, F.col("pos"))).over(per_run),
                          F.max("pos").over(per_run))
    h = h.withColumn("stop_pos", stop_pos)
    kept = h.where(F.col("pos") <= F.col("stop_pos"))
    return kept.groupBy("run").agg(
        F.max(F.when(F.col("pos") == F.col("stop_pos"), F.col("epoch"))).alias("stop_epoch"),
        F.max_by("epoch", F.when(F.col("improved"), F.col("pos"))).alias("best_epoch"),
        F.max_by("v", F.when(F.col("improved"), F.col("pos"))).alias("best_value"),
        F.max("pos").alias("epochs_run"))


def lr_schedule(series: DataFrame, value: str = "value", start_lr: float = 1e-3, factor: float = 0.5,
                patience: int = 5, min_lr: float = 1e-6, min_delta: float = 1e-4) -> DataFrame:
    """``ReduceLROnPlateau`` (mode min) replayed per run: an ordered fold over
    the run's epochs (``aggregate`` over the sorted epoch list, bounded by the
    epoch count).  Output: learning rate after each epoch."""
    epochs = series.groupBy("run").agg(
        F.array_sort(F.collect_list(F.struct(F.col("epoch"), F.col(value).cast("double").alias("v"))))
        .alias("ep"))
    init = F.struct(F.lit(start_lr).alias("lr"), F.lit(float("inf")).alias("best"),
                    F.lit(0).alias("wait"),
                    F.array().cast("array<struct<epoch:int,lr:double>>").alias("out"))

    def step(acc: Column, e: Column) -> Column:
        better = e["v"] < acc["best"] - F.lit(min_delta)
        wait1 = F.when(better, F.lit(0)).otherwise(acc["wait"] + 1)
        cut = (~better) & (wait1 >= patience) & (acc["lr"] > F.lit(min_lr))
        lr = F.when(cut, F.greatest(acc["lr"] * F.lit(factor), F.lit(min_lr))).otherwise(acc["lr"])
        wait = F.when(cut, F.lit(0)).otherwise(wait1)
        best = F.when(better, e["v"]).otherwise(acc["best"])
        out = F.concat(acc["out"], F.array(F.struct(e["epoch"].cast("int").alias("epoch"),
                                                    lr.alias("lr"))))
        return F.struct(lr.alias("lr"), best.alias("best"), wait.alias("wait"), out.alias("out"))

    folded = epochs.select("run", F.aggregate("ep", init, step)["out"].alias("out"))
    return folded.select("run", F.inline("out"))


def best_checkpoint(hist: DataFrame, value: str = "value") -> DataFrame:
    """``ModelCheckpoint(mode="max", save_best_only=True)``: per run, the
    epoch holding the maximum, first epoch on ties."""
    key = F.struct(F.col(value).alias("m"), (-F.col("epoch")).alias("p"))
    return hist.groupBy("run").agg(F.max_by(F.struct("epoch", value), key).alias("b")).select(
        "run", F.col("b")["epoch"].alias("epoch"), F.col("b")[value].alias(value))


def elapsed_seconds(events: DataFrame, run: str, ts: str, decimals: int = 1) -> DataFrame:
    """Wall time per run: last minus first timestamp, in seconds."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    return events.groupBy(F.col(run).alias("run")).agg(
        F.round((F.max(micros) - F.min(micros)) / F.lit(1e6), decimals).alias("seconds"))
