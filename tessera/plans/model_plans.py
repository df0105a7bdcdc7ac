"""Model plans.

Tabular models train on the encoded prospect stand-in (train = key % 5 != 0,
balanced class weights), image models on ``IMG``.  Results are leaderboards
(rows-only checks: training is not SQL); Gaussian naive Bayes scoring and
exact kNN have DuckDB oracles.
"""

from __future__ import annotations

import functools
import time

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from tessera.functions.exprs import clip
from tessera.operators import blocks as BL
from tessera.operators import features as FE
from tessera.operators import grouped as GR
from tessera.operators import knn
from tessera.operators import models as ML
from tessera.operators import pipeline as PL
from tessera.operators import staged as ST
from tessera.operators.features import fit_spec
from tessera.plans import standins as SI
from tessera.plans.registry import plan
from tessera.operators.scoring import PRED_COL, PROBA_COL
from tessera.plans.scoring_plans import COEF, INTERCEPT, SCORED_SQL, rounded_scores, train_rows
from tessera.session import cut_lineage, release
from tessera.sources import files as FS
from tessera.sources.registry import ModelRegistry

SEED = 42


def raw_prospects(spark, sf_dir):
    """The raw prospects, written once: every pass over the join would gather the
    customers on the driver again, wherever Spark broadcasts them."""
    return cut_lineage(SI.prospects(spark, sf_dir))


def prospect_frame(spark, sf_dir):
    """(key, features, label, weight, split, fold) + the frozen feature list;
    written once, since every fit and evaluation reads it again."""
    p = raw_prospects(spark, sf_dir)
    spec = fit_spec(train_rows(p), SI.NUM_COLS, SI.CAT_COLS)
    enc = FE.encode(p, spec, keep=["key", "y"])
    w = FE.class_weights(enc.where(F.col("key") % 5 != 0), "y").select("y", "weight")
    enc = enc.join(FE.bounded_broadcast(w), "y", "left")  # one row per class
    frame = ML.assemble(enc, spec.features, keep=["key", "y", "weight"]).select(
        "key", "features", F.col("y").cast("double").alias("label"), "weight",
        F.when(F.col("key") % 5 == 0, "test").otherwise("train").alias("split"),
        (F.col("key") % 5).cast("int").alias("fold"))
    # spread by rows: the join's few megabytes would leave the fits a few tasks
    laid = cut_lineage(BL.spread(frame, "key", p.count(), 8 * len(spec.features) + 40))
    release(p)
    return laid, spec.features


def split(frame):
    return frame.where(F.col("split") == "train"), frame.where(F.col("split") == "test")


def image_frame(spark, sf_dir, binary: bool = False):
    img = SI.images(spark, sf_dir)
    label = (F.col("label") < 5).cast("double") if binary else F.col("label").cast("double")
    return img.select(F.col("id").alias("key"),
                      array_to_vector(F.transform("px", lambda v: v.cast("double"))).alias("features"),
                      label.alias("label"), F.lit(1.0).alias("weight"),
                      F.when(F.col("id") % 5 == 0, "test").otherwise("train").alias("split"))


def _single(spark, sf_dir, name, est):
    tr, te = split(prospect_frame(spark, sf_dir)[0])
    _, res = ML.fit_and_evaluate(name, est, tr, te)
    return ML.results_frame(spark, [res])


@plan("ml_logreg")
def ml_logreg(spark, sf_dir):
    return _single(spark, sf_dir, "Logistic Reg.", LogisticRegression(weightCol="weight", maxIter=100))


@plan("ml_tree")
def ml_tree(spark, sf_dir):
    return _single(spark, sf_dir, "Decision Tree", DecisionTreeClassifier(weightCol="weight", maxDepth=5, seed=SEED))


@plan("ml_forest")
def ml_forest(spark, sf_dir):
    return _single(spark, sf_dir, "Random Forest", RandomForestClassifier(
        weightCol="weight", numTrees=30, maxDepth=6, featureSubsetStrategy="sqrt", seed=SEED))


@plan("ml_bagging")
def ml_bagging(spark, sf_dir):
    # bagging of full-feature trees = a forest that considers every feature per split
    return _single(spark, sf_dir, "Bagging (DT)", RandomForestClassifier(
        weightCol="weight", numTrees=30, maxDepth=8, featureSubsetStrategy="all", seed=SEED))


@plan("ml_oob_error")
def ml_oob_error(spark, sf_dir):
    tr, _ = split(prospect_frame(spark, sf_dir)[0])
    return ML.bagged_trees_oob(tr, "key", n_trees=10, max_depth=5, seed=SEED)


@plan("ml_gbt")
def ml_gbt(spark, sf_dir):
    return _single(spark, sf_dir, "Gradient Boosting", GBTClassifier(
        weightCol="weight", maxIter=30, stepSize=0.1, maxDepth=3, subsamplingRate=0.8, seed=SEED))


@plan("ml_gbt_early_stop")
def ml_gbt_early_stop(spark, sf_dir):
    frame, _ = prospect_frame(spark, sf_dir)
    tr, te = split(frame)
    tr = tr.withColumn("is_val", F.col("key") % 10 == 1)
    est = GBTClassifier(weightCol="weight", maxIter=100, stepSize=0.1, maxDepth=3,
                        validationIndicatorCol="is_val", validationTol=0.01, seed=SEED)
    model, res = ML.fit_and_evaluate("Gradient Boosting (early stop)", est, tr, te)
    return ML.results_frame(spark, [res]).withColumn("n_trees", F.lit(model.getNumTrees))


@plan("ml_adaboost")
def ml_adaboost(spark, sf_dir):
    from tessera.operators import metrics as M

    tr, te = split(image_frame(spark, sf_dir, binary=True))
    log, score = ML.adaboost(tr, "key", rounds=10, seed=SEED)

    def auc(rows):
        scored = rows.select(vector_to_array("features").alias("x"), F.col("label").cast("int").alias("y")).select(
            score.alias("p"), "y")
        return M.auc_exact(scored, "p", "y").first()["auc"]

    train_auc, test_auc = auc(tr), auc(te)
    return spark.createDataFrame([(r, e, a, train_auc, test_auc) for r, e, a in log],
                                 "round int, weighted_error double, alpha double, train_auc double, test_auc double")


@plan("ml_naive_bayes")
def ml_naive_bayes(spark, sf_dir):
    return _single(spark, sf_dir, "Naive Bayes", NaiveBayes(modelType="gaussian", weightCol="weight"))


GNB_FEATURES = ["o_totalprice", "c_acctbal"]


@plan("gnb_sql", uses=("P",), sql="""
WITH tr AS (SELECT * FROM P WHERE key % 5 <> 0),
eps AS (SELECT 1e-9 * GREATEST(VAR_POP(o_totalprice), VAR_POP(c_acctbal)) AS e FROM tr),
st AS (SELECT y AS cls, LN(COUNT(*) / (SELECT CAST(COUNT(*) AS DOUBLE) FROM tr)) AS lp,
              AVG(o_totalprice) AS m0, VAR_POP(o_totalprice) + MAX(e) AS v0,
              AVG(c_acctbal) AS m1, VAR_POP(c_acctbal) + MAX(e) AS v1 FROM tr, eps GROUP BY y),
j AS (SELECT key, cls, lp - 0.5 * LN(2 * PI() * v0) - POW(o_totalprice - m0, 2) / (2 * v0)
                       - 0.5 * LN(2 * PI() * v1) - POW(c_acctbal - m1, 2) / (2 * v1) AS s
      FROM P, st WHERE key % 5 = 0),
r AS (SELECT key, cls, ROW_NUMBER() OVER (PARTITION BY key ORDER BY s DESC, cls) AS rn FROM j)
SELECT key, cls AS pred FROM r WHERE rn = 1""")
def gnb_sql(spark, sf_dir):
    p = SI.prospects(spark, sf_dir)
    model = ML.gaussian_nb_fit(train_rows(p), GNB_FEATURES, "y")
    return ML.gaussian_nb_predict(p.where(F.col("key") % 5 == 0), model, GNB_FEATURES, keep=["key"])


@plan("knn_exact", uses=("IMG",), sql="""
WITH te AS (SELECT id, px FROM IMG WHERE id % 5 = 0), tr AS (SELECT id, px, label FROM IMG WHERE id % 5 <> 0),
d AS (SELECT te.id AS qid, tr.id AS tid, tr.label AS tl,
             list_distance(CAST(te.px AS DOUBLE[]), CAST(tr.px AS DOUBLE[])) AS d FROM te, tr),
nn AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY qid ORDER BY d, tid) AS r FROM d),
v AS (SELECT qid, tl, COUNT(*) AS n FROM nn WHERE r <= 5 GROUP BY qid, tl),
w AS (SELECT qid, tl, n, ROW_NUMBER() OVER (PARTITION BY qid ORDER BY n DESC, tl) AS r FROM v)
SELECT qid AS id, CAST(tl AS INT) AS pred, n / 5.0::DOUBLE AS share FROM w WHERE r = 1""")
def knn_exact(spark, sf_dir):
    img = SI.images(spark, sf_dir)
    test = img.where(F.col("id") % 5 == 0)
    train = img.where(F.col("id") % 5 != 0)
    return ML.knn_exact(train, test, "px", "id", "label", k=5)


_LEVELS_SQL = "SELECT LIST({0} ORDER BY {0}) AS {1} FROM (SELECT DISTINCT {0} FROM P WHERE key % 5 <> 0 AND {0} IS NOT NULL)"


@plan("ml_knn_prospects", uses=("P",), sql=f"""
WITH st AS (SELECT AVG(o_totalprice) AS m0, STDDEV_POP(o_totalprice) AS s0, AVG(c_acctbal) AS m1, STDDEV_POP(c_acctbal) AS s1
            FROM P WHERE key % 5 <> 0),
lv AS (SELECT * FROM ({_LEVELS_SQL.format("o_orderpriority", "a")}), ({_LEVELS_SQL.format("c_mktsegment", "b")})),
v AS (SELECT key, y, LIST_CONCAT([(o_totalprice - m0) / s0, (c_acctbal - m1) / s1],
             [CAST(o_orderpriority IS NOT DISTINCT FROM x AS DOUBLE) FOR x IN a[2:]] ||
             [CAST(c_mktsegment IS NOT DISTINCT FROM x AS DOUBLE) FOR x IN b[2:]]) AS px FROM P, st, lv),
d AS (SELECT te.key AS qid, tr.key AS tid, tr.y AS tl, LIST_DISTANCE(te.px, tr.px) AS d
      FROM v te JOIN v tr ON te.key % 5 = 0 AND tr.key % 5 <> 0),
nn AS (SELECT qid, UNNEST(ARG_MIN(tl, (d, tid), 5)) AS tl FROM d GROUP BY qid),
c AS (SELECT qid, tl, COUNT(*) AS n FROM nn GROUP BY qid, tl),
w AS (SELECT qid, tl, n, ROW_NUMBER() OVER (PARTITION BY qid ORDER BY n DESC, tl) AS r FROM c)
SELECT qid AS key, CAST(tl AS INT) AS pred, n / 5.0::DOUBLE AS share FROM w WHERE r = 1""")
def ml_knn_prospects(spark, sf_dir):
    """kNN over the encoded, scaled prospects: every test row against the index
    of the training rows."""
    p = raw_prospects(spark, sf_dir)
    spec = fit_spec(train_rows(p), SI.NUM_COLS, SI.CAT_COLS)
    enc = FE.encode(p, spec, keep=["key", "y"])
    rows = cut_lineage(enc.select("key", "y", F.array(*[F.col(f"`{f}`").cast("double") for f in spec.features]).alias("v")))
    return ML.knn_exact(rows.where("key % 5 <> 0"), rows.where("key % 5 = 0"), "v", "key", "y", k=5)


@plan("ml_svm_rbf_approx")
def ml_svm_rbf_approx(spark, sf_dir):
    frame, features = prospect_frame(spark, sf_dir)
    tr, te = split(frame)
    # no probability: the margin of the positive class is the score
    svc = BL.FourierMachine(*ML.fourier_weights(len(features), 64, 0.1, SEED), max_iter=30, reg=0.01)
    _, res = ML.fit_and_evaluate("SVM (RBF, Fourier features)", svc, tr, te, score="margin")
    return ML.results_frame(spark, [res])


def _mlp(spark, sf_dir, name, hidden, features_filter=None, max_iter=100, prepared=None):
    frame, feats = prepared or prospect_frame(spark, sf_dir)
    if features_filter is not None:
        keep_idx = [i for i, f in enumerate(feats) if f in features_filter]
        sub = F.array(*[F.element_at(vector_to_array("features"), i + 1) for i in keep_idx])
        frame = frame.withColumn("features", array_to_vector(sub))
        n_in = len(keep_idx)
    else:
        n_in = len(feats)
    tr, te = split(frame)
    # the classes are balanced: a row counts as often as exact replication repeats it
    est = BL.Network([n_in, *hidden, 2], max_iter, SEED, ML.class_copies)
    _, res = ML.fit_and_evaluate(name, est, tr, te)
    return ML.results_frame(spark, [res])


@plan("ml_mlp_simple")
def ml_mlp_simple(spark, sf_dir):
    return _mlp(spark, sf_dir, "ANN Simple", [64])


@plan("ml_mlp_deep")
def ml_mlp_deep(spark, sf_dir):
    return _mlp(spark, sf_dir, "ANN Profond", [128, 64, 32], max_iter=60)


@plan("ml_mlp_top10")
def ml_mlp_top10(spark, sf_dir):
    """Network on the ten features that the tuned trees, fitted on training rows
    only, rate highest on average."""
    frame, feats = prospect_frame(spark, sf_dir)
    top = ranked_features(_importances(frame, feats))[:10]
    return _mlp(spark, sf_dir, "ANN Top10", [64, 32, 16], features_filter=set(top), prepared=(frame, feats))


@plan("ml_mlp_images")
def ml_mlp_images(spark, sf_dir):
    img = image_frame(spark, sf_dir)
    tr, te = split(img)
    t0 = time.time()
    model = MultilayerPerceptronClassifier(layers=[64, 32, 10], maxIter=100, seed=SEED).fit(tr)
    seconds = time.time() - t0
    pred = model.transform(te).select("prediction", "label", F.element_at(
        vector_to_array("probability"), F.col("label").cast("int") + 1).alias("p"))
    found = pred.agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"), F.avg(-F.log(clip(F.col("p")))).alias("loss"))
    return found.select(F.lit("MLP Base").alias("model"), F.round("accuracy", 4).alias("accuracy"),
                        F.round("loss", 4).alias("loss"), F.lit(round(seconds, 1)).alias("seconds"))


@plan("ml_grid_search")
def ml_grid_search(spark, sf_dir):
    frame, _ = prospect_frame(spark, sf_dir)
    tr, _ = split(frame)
    lr = LogisticRegression(weightCol="weight", maxIter=50)
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.0, 0.01, 0.1]).build()
    # folds by key: the winner does not depend on how the rows are partitioned
    cv = CrossValidator(estimator=lr, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(),
                        foldCol="fold", numFolds=4, parallelism=3, seed=SEED)
    m = cv.fit(tr.withColumn("fold", (F.col("fold") - 1).cast("int")))
    rows = [(float(g[lr.regParam]), float(v)) for g, v in zip(grid, m.avgMetrics)]
    best = max(rows, key=lambda r: (r[1], -r[0]))
    return spark.createDataFrame([(a, round(b, 4), int((a, b) == best)) for a, b in rows],
                                 "reg_param double, val_auc double, best int")


@plan("ml_cross_val")
def ml_cross_val(spark, sf_dir):
    frame, _ = prospect_frame(spark, sf_dir)
    tr, _ = split(frame)  # folds 1-4 of the training rows (fold 0 is the test split)
    tr = tr.withColumn("fold", (F.col("fold") - 1).cast("int"))
    dt = DecisionTreeClassifier(weightCol="weight", seed=SEED)
    grid = ParamGridBuilder().addGrid(dt.maxDepth, [2, 4, 6]).build()
    cv = CrossValidator(estimator=dt, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(),
                        foldCol="fold", numFolds=4, parallelism=3, seed=SEED)
    m = cv.fit(tr)
    return spark.createDataFrame(
        [(int(g[dt.maxDepth]), round(float(a), 4), round(float(s), 4))
         for g, a, s in zip(grid, m.avgMetrics, m.stdMetrics)],
        "max_depth int, cv_auc_mean double, cv_auc_std double")


def _tuned():
    return {
        "CART Optimisé": DecisionTreeClassifier(weightCol="weight", maxDepth=5, minInstancesPerNode=20, seed=SEED),
        "Random Forest Optimisé": RandomForestClassifier(weightCol="weight", numTrees=40, maxDepth=6, seed=SEED),
        "Gradient Boosting Optimisé": GBTClassifier(weightCol="weight", maxIter=30, maxDepth=3, seed=SEED),
    }


def _importances(frame, feats):
    """(feature, model, importance) of the tuned trees on the training rows: one
    row per feature and model."""
    tr, _ = split(frame)
    on_groups = GR.Shared()
    return [r for name, est in _tuned().items() for r in ML.importances_rows(on_groups(est).fit(tr), feats, name)]


def ranked_features(rows):
    """Feature names by mean importance over the models, descending."""
    total: dict[str, float] = {}
    for feature, _, importance in rows:
        total[feature] = total.get(feature, 0.0) + importance
    return sorted(total, key=lambda f: (-total[f], f))


@plan("ml_importances")
def ml_importances(spark, sf_dir):
    return spark.createDataFrame(_importances(*prospect_frame(spark, sf_dir)),
                                 "feature string, model string, importance double")


@plan("ml_top10_features")
def ml_top10_features(spark, sf_dir):
    """Ranking of the features by the trained models."""
    rows = _importances(*prospect_frame(spark, sf_dir))
    mean = spark.createDataFrame(rows, "feature string, model string, importance double").groupBy("feature").agg(
        F.avg("importance").alias("mean"))
    return mean.orderBy(F.desc("mean"), "feature").limit(10)


def _moments_sql():
    """Class means and variances of every encoded feature, from the raw rows."""
    names = [(x, f"(({x} - m{i}) / CASE WHEN s{i} = 0 THEN 1 ELSE s{i} END)") for i, x in enumerate(SI.NUM_COLS)]
    names += [(f"{c}_{lv}", f"CAST({c} IS NOT DISTINCT FROM '{lv}' AS DOUBLE)")
              for c in SI.CAT_COLS for lv in SI.LEVELS[c][1:]]
    parts = [f"SELECT y AS label, '{n}' AS feature, ROUND(AVG({e}), 5) AS mean, ROUND(VAR_POP({e}), 5) AS variance "
             "FROM P, st WHERE key % 5 <> 0 GROUP BY y" for n, e in names]
    return """WITH st AS (SELECT AVG(o_totalprice) AS m0, STDDEV_POP(o_totalprice) AS s0,
                   AVG(c_acctbal) AS m1, STDDEV_POP(c_acctbal) AS s1 FROM P WHERE key % 5 <> 0)
""" + " UNION ALL ".join(parts)


@plan("ml_naive_bayes_moments", uses=("P",), sql=_moments_sql())
def ml_naive_bayes_moments(spark, sf_dir):
    """What the fitted Gaussian naive Bayes has learned, against the class means
    and variances of the rows."""
    frame, feats = prospect_frame(spark, sf_dir)
    tr, _ = split(frame)
    model = NaiveBayes(modelType="gaussian", weightCol="weight").fit(tr)
    mean, var = model.theta.toArray(), model.sigma.toArray()
    rows = [(k, f, float(mean[k][i]), float(var[k][i])) for k in range(len(mean)) for i, f in enumerate(feats)]
    return spark.createDataFrame(rows, "label int, feature string, mean double, variance double").select(
        "label", "feature", F.round("mean", 5).alias("mean"), F.round("variance", 5).alias("variance"))


def _knn(train, rows, fold):
    """Share of positives among the five nearest training rows of the other folds."""
    vectors = lambda df: df.select("key", "label", fold, vector_to_array("features").alias("v"))
    # few large blocks: inside them a tree of boxes sorts out training rows
    near = knn.nearest(vectors(train), vectors(rows), "v", "key", "label", 5, block_rows=16384, part_rows=65536, group=fold)
    share = near.groupBy(F.col("qid").alias("key")).agg(F.avg("tl").alias("p"))
    return rows.select("key", "label", fold).join(share, "key").withColumn("prediction", (F.col("p") > 0.5).cast("double"))


def _adaboost(shared):
    """Stumps on the groups of the training rows."""
    def scored(train, rows):
        groups = shared.groups(train)
        _, score = ML.adaboost(groups.rows, "code", rounds=10, seed=SEED, count="n")
        return rows.select("key", "label", vector_to_array(groups.vector()).alias("x")).select(
            "key", "label", score.alias("p")).withColumn("prediction", (F.col("p") > 0).cast("double"))
    return scored


def _width(train):
    return train.select(F.size(vector_to_array("features"))).first()[0]


def _folds(rows, fold):
    return sorted(r[0] for r in rows.select(fold).distinct().collect())     # one row per fold


def _by_fold(rows, fold, score):
    """The rows of every fold scored by ``score`` (fold, rows)."""
    parts = [score(k, rows.where(F.col(fold) == k)) for k in _folds(rows, fold)]
    return functools.reduce(lambda a, b: a.unionAll(b), parts).select("key", "label", fold, "p", "prediction")


def _network(train, rows, fold):
    net = BL.Network([_width(train), 16, 2], 30, SEED, ML.class_copies)
    models = net.fit_folds(train, fold, _folds(rows, fold))
    return _by_fold(rows, fold, lambda k, held: ML.positive_proba(models[k].transform(held)))


def _svm_parts(train):
    """A linear machine on Fourier features, the rows it learns from and the fourth
    of the training rows, unseen by it, on which its margin is calibrated."""
    machine = BL.FourierMachine(*ML.fourier_weights(_width(train), 64, 0.1, SEED), max_iter=15, reg=0.01)
    return machine, train.where(F.col("key") % 4 != 1), train.where(F.col("key") % 4 == 1)


def _calibrated(machine, held, rows):
    margins = lambda df: machine.transform(df).withColumn(
        "margin", F.element_at(vector_to_array("rawPrediction"), 2)).drop("rawPrediction")
    return ML.calibrated(ML.calibrate(margins(held)), margins(rows))


def _svm(train, rows):
    machine, fit, held = _svm_parts(train)
    return _calibrated(machine.fit(fit), held, rows)


def _svm_folds(train, rows, fold):
    machine, fit, held = _svm_parts(train)
    machines = machine.fit_folds(fit, fold, _folds(rows, fold))
    return _by_fold(rows, fold, lambda k, own: _calibrated(machines[k], held.where(F.col(fold) != k), own))


def _candidates():
    """The classifiers of the common leaderboard."""
    on_groups = GR.Shared()
    return {
        "Logistic Regression": LogisticRegression(weightCol="weight", maxIter=30),
        "CART": on_groups(DecisionTreeClassifier(weightCol="weight", seed=SEED)),
        "Random Forest": on_groups(RandomForestClassifier(weightCol="weight", numTrees=20, seed=SEED)),
        "Bagging": on_groups(RandomForestClassifier(weightCol="weight", numTrees=10, featureSubsetStrategy="all", seed=SEED)),
        "Gradient Boosting": on_groups(GBTClassifier(weightCol="weight", maxIter=10, seed=SEED)),
        "AdaBoost": _adaboost(on_groups),
        "Naive Bayes": NaiveBayes(modelType="gaussian", weightCol="weight"),
        "k-NN": ML.AllFolds(_knn),
        "SVM (RBF)": ML.AllFolds(_svm_folds),
        "MLP": ML.AllFolds(_network),
    }


@plan("ml_leaderboard")
def ml_leaderboard(spark, sf_dir):
    """Every classifier: cross-validated AUC and F1 (mean and deviation over the
    four training folds), test AUC and F1, seconds of the final fit (k-NN: of its
    search for all folds; SVM and MLP: of the fits of all folds, side by side; trees
    that share groups of rows: of those too where they are first).  All scores of all models and folds are one written
    table, measured in one pass."""
    frame, _ = prospect_frame(spark, sf_dir)
    seconds: dict = {}
    # fold 0 holds the test rows
    scores = ML.score_folds(frame, _candidates(), "fold", [0, 1, 2, 3, 4], seconds, test_fold=0)
    board = ML.fold_summary(ML.fold_metrics(scores), test_fold=0)
    times = spark.createDataFrame([(m, round(s, 1)) for (m, k), s in seconds.items() if k == 0], "model string, seconds double")
    return board.join(F.broadcast(times), "model").select(  # one row per model
        "model", *[F.round(c, 4).alias(c) for c in board.columns[1:]], "seconds").orderBy(F.desc("test_auc"), "model")


_FOLD_SCORES = """
WITH s AS (SELECT 'm' || m AS model, CAST(key % 5 AS INT) AS fold, key, y,
                  CAST((key * (37 + 11 * m)) % 701 + y * (100 * m) AS DOUBLE) / 1000.0::DOUBLE AS p FROM P, (VALUES (1), (2), (3)) t(m)),
c AS (SELECT model, fold, p, SUM(y) AS pos, SUM(1 - y) AS neg FROM s GROUP BY ALL),
a AS (SELECT *, COALESCE(SUM(neg) OVER (PARTITION BY model, fold ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM c),
u AS (SELECT model, fold, SUM(pos * (below + neg / 2.0::DOUBLE)) / (SUM(pos) * SUM(neg))::DOUBLE AS auc FROM a GROUP BY ALL),
k AS (SELECT model, fold, COUNT(*) FILTER (WHERE y = 1 AND p >= 0.5) AS tp, COUNT(*) FILTER (WHERE y = 0 AND p >= 0.5) AS fp,
             COUNT(*) FILTER (WHERE y = 1 AND p < 0.5) AS fn FROM s GROUP BY ALL),
f AS (SELECT u.model, u.fold, auc, 2.0::DOUBLE * tp / (2 * tp + fp + fn) AS f1 FROM u JOIN k ON u.model = k.model AND u.fold = k.fold)
SELECT model, ROUND(AVG(auc) FILTER (WHERE fold <> 0), 6) AS cv_auc_mean, ROUND(STDDEV_POP(auc) FILTER (WHERE fold <> 0), 6) AS cv_auc_std,
       ROUND(AVG(f1) FILTER (WHERE fold <> 0), 6) AS cv_f1_mean, ROUND(STDDEV_POP(f1) FILTER (WHERE fold <> 0), 6) AS cv_f1_std,
       ROUND(MAX(auc) FILTER (WHERE fold = 0), 6) AS test_auc, ROUND(MAX(f1) FILTER (WHERE fold = 0), 6) AS test_f1 FROM f GROUP BY model"""


@plan("eval_fold_scores", uses=("P",), sql=_FOLD_SCORES)
def eval_fold_scores(spark, sf_dir):
    """The leaderboard's metric pass over a written table of scores of three
    scoring rules on five folds."""
    rules = F.explode(F.array(*[F.lit(m) for m in (1, 2, 3)])).alias("m")
    rows = SI.prospects(spark, sf_dir).select("key", "y", rules)
    m = F.col("m")
    p = ((F.col("key") * (37 + 11 * m)) % 701 + F.col("y") * (100 * m)).cast("double") / F.lit(1000.0)
    scored = cut_lineage(rows.select(F.concat(F.lit("m"), m.cast("string")).alias("model"), (F.col("key") % 5).cast("int").alias("fold"),
                                     "key", p.alias("p"), (p >= 0.5).cast("int").alias("pred"), "y"))
    board = ML.fold_summary(ML.fold_metrics(scored), test_fold=0)
    return board.select("model", *[F.round(c, 6).alias(c) for c in board.columns[1:]])


@plan("ml_svm_calibrated")
def ml_svm_calibrated(spark, sf_dir):
    """The kernel machine with a probability: AUC and F1 beside log loss, Brier
    score and calibration error on the test rows."""
    tr, te = split(prospect_frame(spark, sf_dir)[0])
    scored = cut_lineage(_svm(tr, te).select(F.lit("SVM (RBF)").alias("model"), F.lit(0).alias("fold"), "key", "p",
                                             (F.col("p") >= 0.5).cast("int").alias("pred"), F.col("label").cast("int").alias("y")))
    found = ML.calibration(scored).first()      # three numbers
    return ML.fold_metrics(scored).select("model", *[F.round(x, 4).alias(x) for x in ("auc", "f1")],
                                          *[F.round(F.lit(found[x]), 4).alias(x) for x in found.asDict()])


def _curve(spark, family, parameter, model, rows, over):
    threshold = 0.0 if isinstance(model, GBTClassificationModel) else 0.5
    found = ST.curve(ST.stage_scores(spark, model, rows, over), threshold)
    return found.select(F.lit(family).alias("family"), F.lit(parameter).alias("parameter"), F.col("stage").alias("value"), "auc", "f1")


def _best(curves):
    """The curve points with the best of each family marked (ties: the smallest value)."""
    best = curves.groupBy("family").agg(F.max_by("value", F.struct("auc", -F.col("value"))).alias("at"))   # one row per family
    return curves.join(F.broadcast(best), "family").select(
        "family", "parameter", "value", F.round("auc", 4).alias("auc"), F.round("f1", 4).alias("f1"),
        (F.col("value") == F.col("at")).cast("int").alias("best"))


@plan("ml_sweep_trees")
def ml_sweep_trees(spark, sf_dir):
    """Test AUC and F1 after 1, 2, ... trees of a forest and of boosting: one fit
    and one scan each."""
    tr, te = split(prospect_frame(spark, sf_dir)[0])
    models = {"Random Forest": RandomForestClassifier(weightCol="weight", numTrees=30, maxDepth=6, seed=SEED),
              "Gradient Boosting": GBTClassifier(weightCol="weight", maxIter=20, maxDepth=3, seed=SEED)}
    parts = [_curve(spark, name, "trees", est.fit(tr), te, "trees") for name, est in models.items()]
    return _best(parts[0].unionAll(parts[1]))


@plan("ml_sweep_depth")
def ml_sweep_depth(spark, sf_dir):
    """Training and test curves against the depth of one tree, cut off at each."""
    tr, te = split(prospect_frame(spark, sf_dir)[0])
    model = DecisionTreeClassifier(weightCol="weight", maxDepth=10, seed=SEED).fit(tr)
    return _best(_curve(spark, "CART, test", "depth", model, te, "depth").unionAll(
        _curve(spark, "CART, training", "depth", model, tr, "depth")))


@plan("ml_sweep_features")
def ml_sweep_features(spark, sf_dir):
    """Test curves against the features a split may choose from."""
    frame, feats = prospect_frame(spark, sf_dir)
    tr, te = split(frame)
    parts = []
    for n in (1, 2, 4, len(feats)):
        est = RandomForestClassifier(weightCol="weight", numTrees=15, maxDepth=6, featureSubsetStrategy=str(n), seed=SEED)
        scored = ST.stage_scores(spark, est.fit(tr), te, "trees").where(F.col("stage") == 15).withColumn("stage", F.lit(n))
        parts.append(scored)
    found = ST.curve(functools.reduce(lambda a, b: a.unionAll(b), parts))
    return _best(found.select(F.lit("Random Forest").alias("family"), F.lit("features per split").alias("parameter"),
                              F.col("stage").alias("value"), "auc", "f1"))


@plan("ml_top3")
def ml_top3(spark, sf_dir):
    frame, _ = prospect_frame(spark, sf_dir)
    tr, te = split(frame)
    res = [ML.fit_and_evaluate(name, est, tr, te)[1] for name, est in _tuned().items()]
    return ML.results_frame(spark, res).orderBy(F.desc("auc"), "model")


def _raw_training(p):
    """Raw prospects with the columns a classifier is trained on."""
    tr = train_rows(p)
    return FE.attach_row_weight(tr, "y").withColumn("label", F.col("y").cast("double"))


def _fit_pipeline(p, estimator=None):
    """A pipeline fitted on raw training rows, and the raw test rows."""
    estimator = estimator or LogisticRegression(weightCol="weight", maxIter=50)
    pipe = Pipeline(stages=[PL.FitEncoding(numeric=SI.NUM_COLS, categorical=SI.CAT_COLS), estimator])
    return pipe.fit(_raw_training(p)), p.where(F.col("key") % 5 == 0)


def _test_auc(model, te):
    return ML.evaluate(ML.positive_proba(model.transform(te.withColumn("label", F.col("y").cast("double")))))["auc"]


def _registry(spark):
    return ModelRegistry(spark, FS.scratch_path(spark, "registry"))


_LEVEL_NAMES = "(SELECT LIST('{0}_' || x ORDER BY x) FROM (SELECT DISTINCT {0} AS x FROM P WHERE key % 5 <> 0 AND {0} IS NOT NULL))[2:]"


@plan("sink_manifest_contents", uses=("P",), sql=f"""
SELECT 'logreg' AS name, 1 AS version, LIST_CONCAT({SI.NUM_COLS!r}, {" || ".join(_LEVEL_NAMES.format(c) for c in SI.CAT_COLS)}) AS features,
       COUNT(*) AS rows, COUNT(*) FILTER (WHERE y = 0) AS n_no, COUNT(*) FILTER (WHERE y = 1) AS n_yes,
       ROUND(AVG(o_totalprice), 4) AS mean_o_totalprice, ROUND(STDDEV_POP(o_totalprice), 4) AS std_o_totalprice,
       ROUND(AVG(c_acctbal), 4) AS mean_c_acctbal, ROUND(STDDEV_POP(c_acctbal), 4) AS std_c_acctbal
FROM P WHERE key % 5 <> 0""")
def sink_manifest_contents(spark, sf_dir):
    """What the manifest and the stored stages of a published model say: features
    from the levels seen, training rows by class, scaler statistics."""
    p = raw_prospects(spark, sf_dir)
    model, _ = _fit_pipeline(p)
    registry = _registry(spark)
    registry.publish("logreg", model, None, train_rows(p), "y")
    scaler = registry.load("logreg").stages[0].stages[1]
    stats = {f"{n}_{x}": v for n, values in (("mean", scaler.mean), ("std", scaler.std))
             for x, v in zip(SI.NUM_COLS, scaler.getOrDefault(values), strict=True)}
    return registry.manifests().select(
        "name", "version", "features", "rows", F.col("classes")["0"].alias("n_no"), F.col("classes")["1"].alias("n_yes"),
        *[F.round(F.lit(v), 4).alias(k) for k, v in stats.items()])


@plan("sink_model_manifest")
def sink_model_manifest(spark, sf_dir):
    p = raw_prospects(spark, sf_dir)
    model, te = _fit_pipeline(p)
    registry = _registry(spark)
    registry.publish("logreg", model, _test_auc(model, te), train_rows(p), "y", {"maxIter": 50})
    return registry.manifests()


@plan("model_save_load", uses=("P",), sql="""
SELECT COUNT(*) AS rows, CAST(0 AS BIGINT) AS differences FROM P WHERE key % 5 = 0""")
def model_save_load(spark, sf_dir):
    """A saved and reloaded pipeline, encoder and scaler included, predicts from
    raw rows exactly as the original on every test row."""
    model, te = _fit_pipeline(raw_prospects(spark, sf_dir))
    path = FS.scratch_path(spark, "pipeline")
    model.write().overwrite().save(path)
    a = PL.score_raw(model, te).select("key", F.col(PRED_COL).alias("a"), F.col(PROBA_COL).alias("pa"))
    b = PL.score_raw(PipelineModel.load(path), te).select("key", F.col(PRED_COL).alias("b"), F.col(PROBA_COL).alias("pb"))
    differ = ~(F.col("a").eqNullSafe(F.col("b")) & F.col("pa").eqNullSafe(F.col("pb")))
    return a.join(b, "key").agg(F.count("*").alias("rows"), F.count_if(differ).alias("differences"))


@plan("model_pipeline_scores", uses=("P",), sql=SCORED_SQL + "SELECT * FROM sc WHERE key % 5 = 0")
def model_pipeline_scores(spark, sf_dir):
    """Raw test rows scored by a pipeline that was saved and loaded: encoding and
    scaling fitted on the training rows, stored weights as classifier."""
    p = raw_prospects(spark, sf_dir)
    prepared = PL.FitEncoding(numeric=SI.NUM_COLS, categorical=SI.CAT_COLS).fit(train_rows(p))
    weights = [COEF.get(f, 0.0) for f in PL.features_of(prepared)]
    path = FS.scratch_path(spark, "pipeline")
    PipelineModel([prepared, PL.LinearScorer(weights=weights, intercept=INTERCEPT)]).write().save(path)
    return rounded_scores(PL.score_raw(PipelineModel.load(path), p.where(F.col("key") % 5 == 0)))


@plan("score_model_choice")
def score_model_choice(spark, sf_dir):
    """Two published models: the raw test rows scored by the one of the best test
    AUC and by one chosen by name."""
    p = raw_prospects(spark, sf_dir)
    registry = _registry(spark)
    for name, est in (("logreg", LogisticRegression(weightCol="weight", maxIter=50)),
                      ("cart", DecisionTreeClassifier(weightCol="weight", maxDepth=5, seed=SEED))):
        model, te = _fit_pipeline(p, est)
        registry.publish(name, model, _test_auc(model, te), train_rows(p), "y")
    best, version = registry.best()
    te = p.where(F.col("key") % 5 == 0)
    scored = [PL.score_raw(registry.load(name, v), te).select(
        F.lit(choice).alias("choice"), F.lit(name).alias("model"), "key", PRED_COL, F.round(PROBA_COL, 6).alias(PROBA_COL))
        for choice, name, v in (("best", best, version), ("by name", "logreg", None))]
    return scored[0].unionAll(scored[1])


@plan("score_model_facts")
def score_model_facts(spark, sf_dir):
    """Facts of the tuned forest: type, size, parameters, best features, and the
    parameters that won among those tried (validation: one training fold)."""
    frame, feats = prospect_frame(spark, sf_dir)
    tr, _ = split(frame)
    tried = {(n, d): RandomForestClassifier(weightCol="weight", numTrees=n, maxDepth=d, seed=SEED) for n in (10, 20) for d in (3, 5)}
    scores = ML.score_folds(tr, {f"{n}|{d}": est for (n, d), est in tried.items()}, "fold", [4])
    found = {r["model"]: r["auc"] for r in ML.fold_metrics(scores).collect()}     # one row per candidate
    best = max(tried, key=lambda k: (found[f"{k[0]}|{k[1]}"] or 0.0, -k[0], -k[1]))
    facts = ML.model_facts(tried[best].fit(tr), feats)
    facts += [("best.numTrees", str(best[0])), ("best.maxDepth", str(best[1])),
              ("best.validation_auc", f"{found[f'{best[0]}|{best[1]}']:.4f}")]
    return spark.createDataFrame(facts, "fact string, value string")
