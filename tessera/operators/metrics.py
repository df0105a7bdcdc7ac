"""Evaluation metrics as DataFrame aggregates.

Every metric first reduces rows to a small table of counts (per score, per
class pair, per bucket) with map-side partial aggregation, so the shuffle
carries counts, not rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import EPSILON_CLIP, c, clip, safe_div
from tessera.operators.prefix import running_totals
from tessera.session import cut_lineage

# Fixed value: number of thresholds of the bucketed (Keras-style) AUC.
AUC_BUCKETS = 200


def score_counts(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., score, pos, neg) — one row per distinct score of each group."""
    y = c(label).cast("long")
    return df.where(c(score).isNotNull() & c(label).isNotNull()).groupBy(
        *[c(b).alias(b) for b in by], (c(score) + F.lit(0.0)).alias(score)
    ).agg(F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg"))


def auc_exact(df: DataFrame, score: str = "p", label: str = "y", by: Sequence[str] = (),
              n_buckets: int | None = None) -> DataFrame:
    """Exact ROC AUC (ties count 1/2) per group: ``sum(pos * (neg_below + neg/2)) / (P*N)``.

    neg_below is a distributed prefix sum over distinct scores; a group with
    one class only gives null.
    """
    return auc_from_score_counts(score_counts(df, score, label, by), score, by, n_buckets)


def auc_from_score_counts(g: DataFrame, score: str = "p", by: Sequence[str] = (),
                          n_buckets: int | None = None) -> DataFrame:
    """AUC from a (by..., score, pos, neg) table (see ``score_counts``)."""
    cum = running_totals(g, [score], ["neg"], partition_by=by, inclusive=False,
                         n_buckets=n_buckets)
    contrib = F.col("pos") * (F.col("cum_neg") + F.col("neg") / F.lit(2.0))
    agg = cum.groupBy(*by).agg(
        F.sum(contrib).alias("__u"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    den = F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    return agg.select(*by, F.when(den > 0, F.col("__u") / den).alias("auc"), "n_pos", "n_neg")


def counts_at_threshold(g: DataFrame, score: str = "p", by: Sequence[str] = (),
                        t: float = 0.5) -> DataFrame:
    """tp/fp/fn/tn of ``score >= t`` from a (by..., score, pos, neg) table."""
    hit = F.col(score) >= F.lit(t)
    return g.groupBy(*by).agg(
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(~hit, F.col("pos")).otherwise(0)).alias("fn"),
        F.sum(F.when(~hit, F.col("neg")).otherwise(0)).alias("tn"))


def auc_binned(df: DataFrame, score: str = "p", label: str = "y", by: Sequence[str] = (),
               n_bins: int = AUC_BUCKETS) -> DataFrame:
    """Bucketed AUC: scores fall in ``n_bins`` equal buckets on [0, 1]; the
    exact formula runs on bucket counts.  Counts are mergeable (partial +
    final), so the same code serves streams."""
    counts = bucket_counts(df, score, label, by, n_bins)
    return auc_from_bucket_counts(counts, by)


def bucket_of(p: Column, n_bins: int = AUC_BUCKETS) -> Column:
    return F.least(F.greatest(F.floor(p * n_bins), F.lit(0)), F.lit(n_bins - 1)).cast("int")


def bucket_counts(df: DataFrame, score: str, label: str, by: Sequence[str] = (),
                  n_bins: int = AUC_BUCKETS) -> DataFrame:
    y = c(label).cast("long")
    return df.where(c(score).isNotNull() & c(label).isNotNull()).groupBy(
        *[c(b).alias(b) for b in by], bucket_of(c(score), n_bins).alias("bucket")
    ).agg(F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg"))


def auc_from_bucket_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """AUC from (by..., bucket, pos, neg); each group has at most n_bins rows,
    so the ordered window below is small."""
    w = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cum = counts.select("*", F.coalesce(F.sum("neg").over(w), F.lit(0)).alias("cum_neg"))
    contrib = F.col("pos") * (F.col("cum_neg") + F.col("neg") / F.lit(2.0))
    agg = cum.groupBy(*by).agg(F.sum(contrib).alias("__u"), F.sum("pos").alias("n_pos"),
                               F.sum("neg").alias("n_neg"))
    den = F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    return agg.select(*by, F.when(den > 0, F.col("__u") / den).alias("auc"), "n_pos", "n_neg")


def roc_points(df: DataFrame, score: str = "p", label: str = "y", by: Sequence[str] = (),
               n_buckets: int | None = None) -> DataFrame:
    """ROC curve: one point per distinct score, descending, plus the origin
    with threshold +inf.  ``tpr = cum_pos / P``, ``fpr = cum_neg / N``."""
    # the per-score counts are written once and feed the running sums, the
    # class totals and the origin rows
    g = cut_lineage(score_counts(df, score, label, by).withColumn("__neg_score", -F.col(score)))
    cum = running_totals(g, ["__neg_score"], ["pos", "neg"], partition_by=by, inclusive=True,
                         n_buckets=n_buckets)
    if by:
        tot = g.groupBy(*[c(b).alias(f"__by{i}") for i, b in enumerate(by)]).agg(
            F.sum("pos").alias("__P"), F.sum("neg").alias("__N"))
        on = F.lit(True)
        for i, b in enumerate(by):
            on = on & c(b).eqNullSafe(F.col(f"__by{i}"))
        cum = cum.join(tot, on)
        P, N = F.col("__P"), F.col("__N")
    else:
        # two numbers reach the driver and are folded in as literals
        r = g.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
        P, N = F.lit(r["P"] or 0), F.lit(r["N"] or 0)
    pts = cum.select(
        *by, F.col(score).alias("threshold"),
        F.try_divide(F.col("cum_neg"), N.cast("double")).alias("fpr"),
        F.try_divide(F.col("cum_pos"), P.cast("double")).alias("tpr"))
    origin = g.select(*by).distinct().select(
        *by, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(origin)


def confusion(df: DataFrame, label: str = "y", pred: str = "pred",
              classes: Sequence | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Long confusion matrix (by..., label, pred, n) over the full class grid;
    absent pairs are 0.  The grid comes from the class list (given, or the
    classes seen — at most k values per group) exploded twice from one row.  A null
    group is a group, and among the classes seen null is a class; with a list of
    classes, rows of other classes (null ones too) have no entry."""
    counts = df.groupBy(*[c(b).alias(b) for b in by], c(label).alias("label"),
                        c(pred).alias("pred")).agg(F.count("*").alias("n"))
    if classes is not None:
        cls = F.array(*[F.lit(x) for x in classes])
        base = df.select(*by).distinct() if by else df.sparkSession.range(1).select()
        grid = base.select(*by, F.explode(cls).alias("label")).select(
            *by, "label", F.explode(cls).alias("pred"))
    else:
        # inside a struct a null is collected as well
        one = lambda x: F.collect_set(F.struct(F.col(x).alias("v")))
        seen = counts.groupBy(*by).agg(F.array_union(one("label"), one("pred")).alias("__cls"))
        grid = seen.select(*by, F.explode("__cls.v").alias("label"), "__cls").select(
            *by, "label", F.explode("__cls.v").alias("pred"))
    keys = [*by, "label", "pred"]
    known = counts.select(*[c(k).alias(f"__k{i}") for i, k in enumerate(keys)], "n")
    on = [c(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    return grid.join(known, on, "left").select(*keys, F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))


def confusion_wide(df: DataFrame, label: str = "y", pred: str = "pred", classes: Sequence = (0, 1)
                   ) -> DataFrame:
    """Rows = truth, one column per predicted class (``pred_<class>``)."""
    long = confusion(df, label, pred, classes)
    return long.groupBy("label").pivot("pred", list(classes)).agg(F.first("n")).select(
        "label", *[F.col(f"`{k}`").alias(f"pred_{k}") for k in classes])


def binary_counts(df: DataFrame, label: str = "y", pred: str = "pred", by: Sequence[str] = ()
                  ) -> DataFrame:
    y, p = c(label), c(pred)
    return df.groupBy(*[c(b).alias(b) for b in by]).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"))


def f1_binary(df: DataFrame, label: str = "y", pred: str = "pred", by: Sequence[str] = ()
              ) -> DataFrame:
    """F1 of the positive class, 0 when undefined."""
    k = binary_counts(df, label, pred, by)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return k.select(*by, "tp", "fp", "fn", "tn",
                    safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"))


def class_report(df: DataFrame, label: str = "y", pred: str = "pred",
                 names: dict | None = None) -> DataFrame:
    """``classification_report``: per class precision/recall/f1/support, then
    accuracy, macro avg and weighted avg rows (support = all rows).  Null labels and
    decisions are a class of their own, ``null``."""
    # per pair of classes: its truth's share of the support, its decision's of the predicted
    counts = df.groupBy(c(label).alias("label"), c(pred).alias("pred")).agg(F.count("*").alias("n"))
    right = F.when(F.col("label").eqNullSafe(F.col("pred")), F.col("n")).otherwise(0)
    none = F.lit(0).cast("long")
    t = counts.select(F.inline(F.array(
        F.struct(F.col("label").alias("cls"), right.alias("tp"), F.col("n").alias("support"), none.alias("npred")),
        F.struct(F.col("pred").alias("cls"), none.alias("tp"), none.alias("support"), F.col("n").alias("npred"))))).groupBy("cls").agg(
        *[F.sum(x).alias(x) for x in ("tp", "support", "npred")])
    prec = safe_div(F.col("tp"), F.col("npred"))
    rec = safe_div(F.col("tp"), F.col("support"))
    f1 = safe_div(2 * F.col("tp"), F.col("support") + F.col("npred"))
    if names:
        m = F.create_map(*[x for kv in names.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
        cname = F.coalesce(m[F.col("cls")], F.col("cls").cast("string"), F.lit("null"))
    else:
        cname = F.coalesce(F.col("cls").cast("string"), F.lit("null"))
    rows = t.select(cname.alias("class"), prec.alias("precision"), rec.alias("recall"),
                    f1.alias("f1"), F.col("support").cast("long").alias("support"), "tp")
    # summary rows: one small aggregate over <= k class rows
    s = rows.agg(
        F.sum("tp").alias("tp"), F.sum("support").alias("n"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        F.sum(F.col("precision") * F.col("support")).alias("wp"),
        F.sum(F.col("recall") * F.col("support")).alias("wr"),
        F.sum(F.col("f1") * F.col("support")).alias("wf"))
    acc = s.select(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                   F.lit(None).cast("double").alias("recall"),
                   safe_div(F.col("tp"), F.col("n")).alias("f1"), F.col("n").alias("support"))
    macro = s.select(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"),
                     F.col("mr").alias("recall"), F.col("mf").alias("f1"), F.col("n").alias("support"))
    weighted = s.select(F.lit("weighted avg").alias("class"),
                        safe_div(F.col("wp"), F.col("n")).alias("precision"),
                        safe_div(F.col("wr"), F.col("n")).alias("recall"),
                        safe_div(F.col("wf"), F.col("n")).alias("f1"), F.col("n").alias("support"))
    return rows.drop("tp").unionByName(acc).unionByName(macro).unionByName(weighted)


def accuracy(df: DataFrame, label: str = "y", pred: str = "pred", by: Sequence[str] = ()
             ) -> DataFrame:
    return df.groupBy(*[c(b).alias(b) for b in by]).agg(
        F.avg((c(pred) == c(label)).cast("double")).alias("accuracy"))


def logloss_binary(df: DataFrame, label: str = "y", score: str = "p", by: Sequence[str] = (),
                   eps: float = EPSILON_CLIP) -> DataFrame:
    p = clip(c(score), eps)
    y = c(label).cast("double")
    ll = y * F.ln(p) + (F.lit(1.0) - y) * F.ln(F.lit(1.0) - p)
    return df.groupBy(*[c(b).alias(b) for b in by]).agg((-F.avg(ll)).alias("logloss"))


def logloss_multi(df: DataFrame, label: str = "label", probs: str = "probs",
                  by: Sequence[str] = (), eps: float = EPSILON_CLIP) -> DataFrame:
    """Categorical cross-entropy: -mean(ln p[label]) with clipping."""
    p = clip(F.element_at(c(probs), c(label) + 1), eps)
    return df.groupBy(*[c(b).alias(b) for b in by]).agg((-F.avg(F.ln(p))).alias("logloss"))


def cv_summary(per_fold: DataFrame, model: str, metric_cols: Sequence[str]) -> DataFrame:
    """Mean and population std of each metric over folds, per model."""
    aggs = []
    for m in metric_cols:
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std")]
    return per_fold.groupBy(model).agg(*aggs)
