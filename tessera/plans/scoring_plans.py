"""Scoring plans: batch scoring of the prospect stand-in and the flagship
(scoring + evaluation per segment)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.exprs import THRESHOLD, safe_div
from tessera.operators import metrics as M
from tessera.operators.features import fit_spec
from tessera.operators.scoring import (
    PRED_COL,
    PROBA_COL,
    LinearModel,
    score_batch,
)
from tessera.plans import standins as SI
from tessera.plans.registry import plan
from tessera.session import cut_lineage

# The stored linear model used for the prospect stand-in
# (intercept and one weight per frozen feature, in frozen order).
INTERCEPT = -0.25
COEF = {
    "o_totalprice": 0.9,
    "c_acctbal": -0.4,
    "o_orderpriority_2-HIGH": 0.1,
    "o_orderpriority_3-MEDIUM": 0.2,
    "o_orderpriority_4-NOT SPECIFIED": -0.1,
    "o_orderpriority_5-LOW": -0.2,
    "c_mktsegment_BUILDING": 0.15,
    "c_mktsegment_FURNITURE": -0.15,
    "c_mktsegment_HOUSEHOLD": 0.05,
    "c_mktsegment_MACHINERY": -0.05,
}
MODEL = LinearModel(INTERCEPT, COEF)


def train_rows(p: DataFrame) -> DataFrame:
    return p.where(F.col(SI.KEY) % SI.TEST_MOD != 0)


def test_rows(p: DataFrame) -> DataFrame:
    return p.where(F.col(SI.KEY) % SI.TEST_MOD == 0)


def scored_prospects(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = SI.prospects(spark, sf_dir)
    spec = fit_spec(train_rows(p), SI.NUM_COLS, SI.CAT_COLS)
    return score_batch(p, spec, MODEL, target=SI.TARGET)


def _logit_sql() -> str:
    """SQL text of the same linear score (oracle side)."""
    terms = [repr(INTERCEPT)]
    for i, x in enumerate(SI.NUM_COLS):
        terms.append(f"{COEF[x]!r} * (({x} - m{i}) / CASE WHEN s{i} = 0 THEN 1 ELSE s{i} END)")
    for name, w in COEF.items():
        for col in SI.CAT_COLS:
            if name.startswith(col + "_"):
                level = name[len(col) + 1:]
                terms.append(f"{w!r} * CAST({col} IS NOT DISTINCT FROM '{level}' AS DOUBLE)")
    return " + ".join(terms)


# decimals of the score column in reports and files; decisions use the score itself
REPORT_DECIMALS = 6


def rounded_scores(df: DataFrame) -> DataFrame:
    return df.withColumn(PROBA_COL, F.round(PROBA_COL, REPORT_DECIMALS))


SCORED_SQL = f"""
WITH st AS (SELECT AVG(o_totalprice) AS m0, STDDEV_POP(o_totalprice) AS s0,
                   AVG(c_acctbal) AS m1, STDDEV_POP(c_acctbal) AS s1
            FROM P WHERE key % 5 <> 0),
sc0 AS (SELECT P.*, 1 / (1 + EXP(-({_logit_sql()}))) AS raw FROM P, st),
sc AS (SELECT key, o_totalprice, c_acctbal, o_orderpriority, c_mktsegment, y,
              CAST(raw >= 0.5 AS INT) AS {PRED_COL}, ROUND(raw, 6) AS {PROBA_COL} FROM sc0)
"""


@plan("score_batch", sql=SCORED_SQL + "SELECT * FROM sc", uses=("P",))
def q_score_batch(spark, sf_dir):
    return rounded_scores(scored_prospects(spark, sf_dir))


@plan("score_proba", sql=SCORED_SQL + f"SELECT key, {PROBA_COL} FROM sc", uses=("P",))
def q_score_proba(spark, sf_dir):
    return rounded_scores(scored_prospects(spark, sf_dir)).select("key", PROBA_COL)


def segment_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: score every prospect, evaluate test rows per market segment
    (exact AUC, F1, accuracy, row count)."""
    s = test_rows(scored_prospects(spark, sf_dir)).select(
        F.col("c_mktsegment").alias("segment"), "y", F.col(PROBA_COL).alias("p"))
    # one reduced table (segment, score, pos, neg) feeds every metric; it is
    # written once to the checkpoint directory so the source is scanned once
    g = cut_lineage(M.score_counts(s, "p", "y", by=["segment"]))
    auc = M.auc_from_score_counts(g, "p", by=["segment"])
    k = M.counts_at_threshold(g, "p", by=["segment"], t=THRESHOLD)
    out = auc.join(k, "segment")
    n = F.col("n_pos") + F.col("n_neg")
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return out.select(
        "segment",
        n.alias("n"),
        F.round("auc", 6).alias("auc"),
        F.round(safe_div(2 * tp, 2 * tp + fp + fn), 6).alias("f1"),
        F.round((F.col("tp") + F.col("tn")) / n, 6).alias("accuracy"),
    )


SEGMENT_EVAL_CTES = SCORED_SQL + f""",
t AS (SELECT c_mktsegment AS segment, y, raw AS p, CAST(raw >= 0.5 AS INT) AS pred FROM sc0 WHERE key % 5 = 0),
g AS (SELECT segment, p, SUM(y) AS pos, SUM(1 - y) AS neg FROM t GROUP BY segment, p),
c AS (SELECT segment, pos, neg,
             COALESCE(SUM(neg) OVER (PARTITION BY segment ORDER BY p
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g),
a AS (SELECT segment, SUM(pos * (below + neg / 2.0)) / (SUM(pos) * SUM(neg)) AS auc,
             CAST(SUM(pos) + SUM(neg) AS BIGINT) AS n FROM c GROUP BY segment),
k AS (SELECT segment,
             COUNT(*) FILTER (WHERE y = 1 AND pred = 1) AS tp,
             COUNT(*) FILTER (WHERE y = 0 AND pred = 1) AS fp,
             COUNT(*) FILTER (WHERE y = 1 AND pred = 0) AS fn,
             COUNT(*) FILTER (WHERE y = 0 AND pred = 0) AS tn FROM t GROUP BY segment),
segeval AS (SELECT a.segment, a.n, ROUND(a.auc, 6) AS auc,
       ROUND(COALESCE(2.0 * tp / NULLIF(2 * tp + fp + fn, 0), 0), 6) AS f1,
       ROUND((tp + tn) / CAST(a.n AS DOUBLE), 6) AS accuracy
FROM a JOIN k ON a.segment = k.segment)
"""
SEGMENT_EVAL_SQL = SEGMENT_EVAL_CTES + "SELECT * FROM segeval"


@plan("eval_segment_scoring", sql=SEGMENT_EVAL_SQL, uses=("P",))
def q_segment_eval(spark, sf_dir):
    return segment_evaluation(spark, sf_dir)
