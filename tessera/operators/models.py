"""Model training and scoring on Spark ML, plus the ensembles Spark lacks.

Training data is one DataFrame with a ``features`` vector, a double
``label`` and a ``weight`` column (balanced class weights).  Spark ML fits
with distributed tree/gradient aggregation; the custom ensembles (AdaBoost,
explicit bootstrap with out-of-bag votes) loop over rounds on the driver but
every round is a distributed job and the per-row state is a DataFrame column,
checkpointed each round so the lineage stays short and survives executor loss.
"""

from __future__ import annotations

import functools
import math
import time
from collections.abc import Callable, Mapping, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import c, clip, safe_div
from tessera.operators import knn
from tessera.operators import metrics as M
from tessera.session import cut_lineage

MAX_CLASSES = 10_000  # per-class statistics collected on the driver


def assemble(df: DataFrame, features: Sequence[str], keep: Sequence[str] = (),
             out: str = "features") -> DataFrame:
    """Feature columns -> one ML vector (JVM-side ``array_to_vector``)."""
    arr = F.array(*[c(f).cast("double") for f in features])
    return df.select(*[c(k) for k in keep], array_to_vector(arr).alias(out))


def positive_proba(pred: DataFrame, prob_col: str = "probability") -> DataFrame:
    return pred.withColumn("p", F.element_at(vector_to_array(F.col(prob_col)), 2))


def evaluate(pred: DataFrame, score: str = "p", label: str = "label", decision: str = "prediction"
             ) -> dict:
    """Test AUC (exact) and F1 of a scored table — two small aggregations."""
    df = pred.select(F.col(score).alias("p"), F.col(label).cast("int").alias("y"),
                     F.col(decision).cast("int").alias("pred"))
    auc = M.auc_exact(df, "p", "y").first()
    f1 = M.f1_binary(df, "y", "pred").first()
    return {"auc": auc["auc"], "f1": f1["f1"]}


def fit_and_evaluate(name: str, estimator, train: DataFrame, test: DataFrame,
                     score: str = "p") -> tuple[object, dict]:
    t0 = time.time()
    model = estimator.fit(train)
    secs = time.time() - t0
    pred = model.transform(test)
    if score == "p":
        pred = positive_proba(pred)
    elif score == "margin":
        pred = pred.withColumn("p", F.element_at(vector_to_array(F.col("rawPrediction")), 2))
    else:
        pred = pred.withColumn("p", F.col(score))
    res = evaluate(pred)
    res.update({"model": name, "seconds": round(secs, 1)})
    return model, res


RESULT_SCHEMA = "model string, auc double, f1 double, seconds double"


def results_frame(spark, rows: Sequence[dict]) -> DataFrame:
    """A leaderboard from per-model results (one row per fitted model)."""
    return spark.createDataFrame(
        [(r["model"], None if r["auc"] is None else round(r["auc"], 4), round(r["f1"], 4), r["seconds"])
         for r in rows], RESULT_SCHEMA)


# ---- many models and folds, one scored table ------------------------------------

#: fits that run side by side; each is a series of small jobs
PARALLEL_FITS = 4
SCORED = "model string, fold int, key long, p double, pred int, y int"


def margin(prediction: DataFrame) -> Column:
    """The score that ranks a classifier's rows: the positive class's probability,
    its margin where the model has none, or the column ``p`` it adds itself."""
    if "p" in prediction.columns:
        return F.col("p")
    of = "probability" if "probability" in prediction.columns else "rawPrediction"
    return F.element_at(vector_to_array(F.col(of)), 2)


class AllFolds:
    """A candidate that scores all folds at once: ``score`` (training rows of all
    folds, rows, fold) -> rows with ``key``, ``label``, the fold, ``p`` and
    ``prediction``, no row being scored by training rows of its own fold."""

    def __init__(self, score: Callable[[DataFrame, DataFrame, str], DataFrame]):
        self.score = score


def score_folds(frame: DataFrame, candidates: Mapping[str, object], fold: str, folds: Sequence[int],
                seconds: dict | None = None, test_fold: int | None = None) -> DataFrame:
    """Every candidate fitted without each fold and scored on it: one written table
    of ``SCORED`` rows, whatever the number of models and folds.  No candidate
    learns from the rows of ``test_fold``.

    A candidate is an estimator, a function (training rows, rows) -> rows with
    ``key``, ``label``, ``p`` and ``prediction``, or ``AllFolds``.  ``seconds`` takes
    the time of each fit, by (model, fold); of ``AllFolds`` the time of all folds."""
    learnt = frame.where(F.col(fold).isNotNull() if test_fold is None else F.col(fold) != test_fold)

    def scored(name: str, done: DataFrame, k) -> DataFrame:
        return done.select(F.lit(name).alias("model"), k.cast("int").alias("fold"), F.col("key").cast("long").alias("key"),
                           margin(done).cast("double").alias("p"), F.col("prediction").cast("int").alias("pred"),
                           F.col("label").cast("int").alias("y"))

    def one(job: tuple) -> DataFrame:
        name, candidate, of = job
        t0 = time.time()
        if isinstance(candidate, AllFolds):
            done, k = candidate.score(learnt, frame.where(F.col(fold).isin(list(of))), fold), F.col(fold)
        else:
            train, held, k = learnt.where(F.col(fold) != of[0]), frame.where(F.col(fold) == of[0]), F.lit(of[0])
            done = candidate(train, held) if callable(candidate) else candidate.fit(train).transform(held)
        if seconds is not None:
            seconds.update({(name, x): time.time() - t0 for x in of})
        return scored(name, done, k)

    jobs = [(name, x, of) for name, x in candidates.items() for of in ([folds] if isinstance(x, AllFolds) else [[k] for k in folds])]
    jobs.sort(key=lambda job: -len(job[2]))     # the longest first
    with ThreadPool(PARALLEL_FITS) as pool:
        # one job at a time: the fits take from a second to a minute
        parts = pool.map(inheritable_thread_target(frame.sparkSession)(one), jobs, chunksize=1)
    return cut_lineage(functools.reduce(DataFrame.unionAll, parts))


def fold_metrics(scored: DataFrame) -> DataFrame:
    """(model, fold, n, auc, f1, accuracy) of a table of scores, in one pass: rows
    become counts per (model, fold, score, decision), the counts every metric."""
    by = ["model", "fold"]
    counts = cut_lineage(scored.groupBy(*by, (F.col("p") + F.lit(0.0)).alias("p"), "pred").agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg")))
    auc = M.auc_from_score_counts(counts.where("p IS NOT NULL").groupBy(*by, "p").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")), "p", by).select(*by, "auc")
    hit = F.col("pred") == 1
    k = counts.groupBy(*by).agg(
        F.sum(F.col("pos") + F.col("neg")).alias("n"), F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"), F.sum(F.when(hit, 0).otherwise(F.col("pos"))).alias("fn"))
    f1 = safe_div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    right = F.try_divide(F.col("n") - F.col("fp") - F.col("fn"), F.col("n"))
    return k.join(auc, by, "left").select(*by, "n", "auc", f1.alias("f1"), right.alias("accuracy"))


def fold_summary(metrics: DataFrame, test_fold: int) -> DataFrame:
    """Per model: mean and population deviation of AUC and F1 over the folds, and
    both on the test fold."""
    held, cv = F.col("fold") == test_fold, F.col("fold") != test_fold
    aggs = [f(F.when(cv, F.col(m))).alias(f"cv_{m}_{s}") for m in ("auc", "f1") for f, s in ((F.avg, "mean"), (F.stddev_pop, "std"))]
    return metrics.groupBy("model").agg(*aggs, *[F.max(F.when(held, F.col(m))).alias(f"test_{m}") for m in ("auc", "f1")])


# ---- class balance for estimators without weightCol ---------------------------

def class_copies(df: DataFrame, label: str = "label") -> Column:
    """How often a row counts when the classes are balanced: ``round(max_count /
    class_count)``; counts per class reach the driver (one number per class)."""
    rows = df.groupBy(label).count().limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes in {label}")
    if not rows:
        return F.lit(1)
    counts = {r[0]: r[1] for r in rows}
    top = max(counts.values())
    return F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(int(round(top / n))))])[F.col(label)]


def balance_by_replication(df: DataFrame, label: str = "label") -> DataFrame:
    """Replicate each row ``class_copies`` times (exact and deterministic, unlike
    sampling)."""
    return df.withColumn("__rep", F.explode(F.sequence(F.lit(1), class_copies(df, label)))).drop("__rep")


# ---- deterministic bootstrap (Poisson(1) weights) -----------------------------

def _poisson1(u):
    """Inverse CDF of Poisson(1) on a uniform column (cut points from e^-1 k!^-1)."""
    cdf, k, p = [], 0, math.exp(-1.0)
    acc = 0.0
    while acc < 1 - 1e-12 and k < 12:
        acc += p
        cdf.append(acc)
        k += 1
        p = p / k
    expr = F.lit(len(cdf))
    for i in reversed(range(len(cdf))):
        expr = F.when(u < F.lit(cdf[i]), F.lit(i)).otherwise(expr)
    return expr


def bootstrap_weight(key, b: int, seed: int = 7):
    """Poisson(1) count of a row in bootstrap replica ``b`` — a pure function
    of (key, b, seed), so recomputation gives the same replica."""
    h = F.xxhash64(key, F.lit(b), F.lit(seed))
    u = (F.pmod(h, F.lit(1 << 30)).cast("double")) / F.lit(float(1 << 30))
    return _poisson1(u).cast("double")


def bagged_trees_oob(train: DataFrame, key: str, n_trees: int = 10, max_depth: int = 5,
                     seed: int = 7) -> DataFrame:
    """Bagging with an out-of-bag estimate: tree b is fitted with Poisson(1)
    weights; a row votes only through the trees that did not see it."""
    base = train.select(key, "features", "label")
    weighted = base.select("*", *[bootstrap_weight(F.col(key), b, seed).alias(f"w{b}")
                                  for b in range(n_trees)])
    scored = weighted
    for b in range(n_trees):
        tree = DecisionTreeClassifier(maxDepth=max_depth, weightCol=f"w{b}", seed=seed + b).fit(
            weighted.where(F.col(f"w{b}") > 0))
        tree.setPredictionCol(f"pb{b}").setRawPredictionCol(f"raw{b}").setProbabilityCol(f"prob{b}")
        scored = tree.transform(scored).drop(f"raw{b}", f"prob{b}")
    # every tree applied in one pass: a row votes through its out-of-bag trees
    oob = [F.col(f"w{b}") == 0 for b in range(n_trees)]
    v1 = sum((F.when(o, F.col(f"pb{b}")).otherwise(0.0) for b, o in enumerate(oob)), F.lit(0.0))
    nv = sum((F.when(o, 1.0).otherwise(0.0) for o in oob), F.lit(0.0))
    votes = scored.select("label", v1.alias("v1"), nv.alias("nv")).where(F.col("nv") > 0)
    votes = votes.withColumn("vote", (F.col("v1") / F.col("nv") > 0.5).cast("double"))
    return votes.agg(F.lit(n_trees).alias("n_trees"), F.count("*").alias("oob_rows"),
                     F.avg((F.col("vote") != F.col("label")).cast("double")).alias("oob_error"))


def _stump_vote(stump) -> Column:
    """A fitted depth-1 tree as an expression of ``x`` (feature array): -1 or 1."""
    root = stump._call_java("rootNode")
    if stump.numNodes == 1:
        return F.lit(2.0 * root.prediction() - 1.0)
    split = root.split()
    left, right = (2.0 * root.leftChild().prediction() - 1.0, 2.0 * root.rightChild().prediction() - 1.0)
    at = F.get("x", F.lit(int(split.featureIndex())))
    return F.when(at <= F.lit(float(split.threshold())), F.lit(left)).otherwise(F.lit(right))


def adaboost(train: DataFrame, key: str, rounds: int = 10, seed: int = 7, count: str | None = None) -> tuple[list, Column]:
    """Discrete AdaBoost with stumps (depth 1) and exponential loss: per round
    fit a weighted stump, weighted error e, alpha = 0.5 ln((1-e)/e), weights
    x exp(alpha) on mistakes, renormalised.  Stops when e >= 1/2.

    Returns the log (round, error, alpha) and the score as an expression of a
    feature array ``x``: a stump is a feature and a threshold, so the rows are
    written once and their weights are an expression of the stumps so far.  ``count``:
    how many equal rows a row stands for."""
    times = F.lit(1) if count is None else F.col(count)
    rows = cut_lineage(train.select(key, "features", "label", vector_to_array("features").alias("x"), times.alias("times")))
    n = rows.agg(F.sum("times")).first()[0] or 0
    score, weight, log = F.lit(0.0), F.lit(1.0 / max(1, n)) * F.col("times"), []
    for r in range(rounds):
        cur = rows.withColumn("w", weight)
        stump = DecisionTreeClassifier(maxDepth=1, weightCol="w", seed=seed).fit(cur)
        vote = _stump_vote(stump)
        miss = (vote != F.col("label") * 2 - 1).cast("double")
        wrong, total = cur.agg(F.sum(F.col("w") * miss), F.sum("w")).first()
        err = None if not total else wrong / total
        if err is None or err >= 0.5 or err <= 0.0:
            log.append((r, float(err) if err is not None else None, 0.0))
            break
        alpha = 0.5 * math.log((1 - err) / err)
        log.append((r, float(err), alpha))
        # the weights after this round sum to one again
        weight = weight * F.exp(F.lit(alpha) * miss) / F.lit(total * (1 - err + err * math.exp(alpha)))
        score = score + F.lit(alpha) * vote
    return log, score


# ---- random Fourier features (RBF kernel approximation) ----------------------

def fourier_weights(d: int, n_components: int = 64, gamma: float = 0.1, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """W ~ N(0, 2 gamma), b ~ U(0, 2 pi) of the features, from the seed."""
    rng = np.random.default_rng(seed)
    Wm = rng.normal(0.0, math.sqrt(2 * gamma), size=(n_components, d))
    return Wm, rng.uniform(0.0, 2 * math.pi, size=n_components)


def fourier_vector(x: Column, d: int, n_components: int = 64, gamma: float = 0.1, seed: int = 11) -> Column:
    """z(x) = sqrt(2/D) cos(W x + b), W ~ N(0, 2 gamma), b ~ U(0, 2 pi), as a vector
    of a feature array of ``d`` entries: the projection (D x d numbers, from the
    seed) is folded in as literals."""
    from tessera.operators.images import dense

    Wm, bv = fourier_weights(d, n_components, gamma, seed)
    # W x + b as one dense layer over the feature array (array functions keep
    # the generated code small whatever D is), then sqrt(2/D) cos(.)
    scale = math.sqrt(2.0 / n_components)
    return array_to_vector(F.transform(dense(x, Wm.tolist(), bv.tolist()), lambda v: F.lit(scale) * F.cos(v)))


def fourier_features(df: DataFrame, features: Sequence[str], n_components: int = 64,
                     gamma: float = 0.1, seed: int = 11, keep: Sequence[str] = ()) -> DataFrame:
    """``fourier_vector`` of feature columns."""
    x = F.array(*[c(f).cast("double") for f in features])
    return df.select(*[c(k) for k in keep], fourier_vector(x, len(features), n_components, gamma, seed).alias("features"))


# ---- calibrated scores ---------------------------------------------------------

def calibrate(scored: DataFrame, margin_col: str = "margin", label: str = "label"):
    """Isotonic regression of the label on a margin: Spark pools adjacent violators
    inside ranges of the margin, then the few steps that are left."""
    return IsotonicRegression(featuresCol=margin_col, labelCol=label, predictionCol="p").fit(
        scored.select(margin_col, label))


def calibrated(model, scored: DataFrame) -> DataFrame:
    """Rows with ``p``: the probability that belongs to their margin, never
    decreasing in it."""
    return model.transform(scored).withColumn("p", F.least(F.greatest(F.col("p"), F.lit(0.0)), F.lit(1.0)))


def calibration(scored: DataFrame, bins: int = 10) -> DataFrame:
    """One row (log_loss, brier, calibration_error) of probabilities ``p`` and
    labels ``y``: the error is the mean distance of the bins' mean probability
    and share of positives, weighted by rows."""
    y, q = F.col("y").cast("double"), clip(F.col("p"))
    loss = -(y * F.log(q) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - q))
    per = scored.groupBy(M.bucket_of(F.col("p"), bins).alias("bin")).agg(
        F.count("*").alias("n"), F.sum("p").alias("p"), F.sum(y).alias("y"), F.sum(loss).alias("loss"),
        F.sum((F.col("p") - y) ** 2).alias("square"))
    n = F.sum("n")
    return per.agg(F.try_divide(F.sum("loss"), n).alias("log_loss"), F.try_divide(F.sum("square"), n).alias("brier"),
                   F.try_divide(F.sum(F.abs(F.col("p") - F.col("y"))), n).alias("calibration_error"))


# ---- Gaussian naive Bayes as expressions --------------------------------------

def gaussian_nb_fit(train: DataFrame, features: Sequence[str], label: str, var_smoothing: float = 1e-9
                    ) -> dict:
    """Per class: prior, mean and variance (population) of every feature —
    one aggregation; classes x features numbers reach the driver."""
    aggs = [F.count("*").alias("n")]
    for i, f in enumerate(features):
        aggs += [F.avg(c(f)).alias(f"m{i}"), F.var_pop(c(f)).alias(f"v{i}")]
    rows = train.groupBy(c(label).alias("cls")).agg(*aggs).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes in {label}")
    all_var = train.agg(*[F.var_pop(c(f)).alias(f"v{i}") for i, f in enumerate(features)]).first()
    eps = var_smoothing * max(float(all_var[f"v{i}"] or 0.0) for i in range(len(features)))
    total = sum(r["n"] for r in rows)
    model = {}
    for r in rows:
        model[r["cls"]] = {
            "log_prior": math.log(r["n"] / total),
            "mean": [r[f"m{i}"] for i in range(len(features))],
            "var": [r[f"v{i}"] + eps for i in range(len(features))],
        }
    return model


def gaussian_nb_predict(df: DataFrame, model: dict, features: Sequence[str], keep: Sequence[str]
                        ) -> DataFrame:
    """Joint log-likelihood per class as one expression each; prediction =
    the class with the largest, smallest class on ties."""
    classes = sorted(model)
    jll = {}
    for k in classes:
        m = model[k]
        e = F.lit(m["log_prior"])
        for i, f in enumerate(features):
            v = m["var"][i]
            e = e - F.lit(0.5 * math.log(2 * math.pi * v)) - (c(f) - F.lit(m["mean"][i])) ** 2 / F.lit(2 * v)
        jll[k] = e
    best = F.struct(jll[classes[0]].alias("s"), F.lit(-0).alias("neg"), F.lit(classes[0]).alias("k"))
    for k in classes[1:]:
        cand = F.struct(jll[k].alias("s"), F.lit(-classes.index(k)).alias("neg"), F.lit(k).alias("k"))
        best = F.greatest(best, cand)
    return df.select(*[c(x) for x in keep], best["k"].alias("pred"))


# ---- exact k nearest neighbours ---------------------------------------------------

def knn_exact(train: DataFrame, test: DataFrame, vec: str, key: str, label: str, k: int = 5,
              block_rows: int = 2048, part_rows: int = knn.PART_ROWS, max_distances: int = knn.MAX_DISTANCES) -> DataFrame:
    """Exact kNN (squared L2, ties by train key, majority vote, vote ties ->
    smallest class) over a metric index; ``share`` is the winning class's share
    of the k votes."""
    return knn.classify(knn.nearest(train, test, vec, key, label, k, block_rows, part_rows, max_distances), key)


def model_facts(model, feature_names: Sequence[str]) -> list[tuple[str, str]]:
    """Type, size and parameters of a fitted model as (fact, value) pairs."""
    facts = [("type", type(model).__name__)]
    if hasattr(model, "getNumTrees"):
        facts.append(("n_trees", str(model.getNumTrees)))
    if hasattr(model, "depth"):
        facts.append(("depth", str(model.depth)))
    if hasattr(model, "numFeatures"):
        facts.append(("n_features", str(model.numFeatures)))
    if hasattr(model, "featureImportances"):
        imp = model.featureImportances.toArray()
        top = [feature_names[i] for i in np.argsort(-imp, kind="stable")[:5]]
        facts.append(("top5_features", ", ".join(top)))
    for p, v in model.extractParamMap().items():
        facts.append((f"param.{p.name}", str(v)))
    return facts


def importances_rows(model, feature_names: Sequence[str], model_name: str) -> list[tuple]:
    imp = model.featureImportances.toArray()
    return [(feature_names[i], model_name, float(imp[i])) for i in range(len(feature_names))]
