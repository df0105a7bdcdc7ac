"""Streaming plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.metrics import auc_from_bucket_counts
from tessera.operators.features import fit_spec
from tessera.operators.scoring import score_batch
from tessera.plans import standins as SI
from tessera.plans.registry import plan
from tessera.plans.scoring_plans import MODEL, SCORED_SQL, rounded_scores, train_rows
from tessera.sources.tables import table
from tessera.streaming import monitor as ST

# A stream event counts as a positive prediction when its
# value / 500 reaches the decision threshold; a purchase is a positive label.
POSITIVE_EVENT = "purchase"


@plan("stream_score", uses=("P",), sql=SCORED_SQL + "SELECT * FROM sc")
def stream_score(spark, sf_dir):
    # the stored model's statistics come from the batch training rows
    spec = fit_spec(train_rows(SI.prospects(spark, sf_dir)), SI.NUM_COLS, SI.CAT_COLS)
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")

    def build(sp):
        orders = ST.file_stream(sp, sf_dir, "orders")
        # stream-static join: each micro-batch of orders meets the customer table
        p = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
            F.col("o_orderkey").alias("key"), "o_totalprice", "c_acctbal", "o_orderpriority",
            "c_mktsegment", (F.col("o_orderstatus") == "F").cast("int").alias("y"))
        return score_batch(p, spec, MODEL, target="y")

    return rounded_scores(ST.stream_score(spark, sf_dir, build))


@plan("stream_prediction_counts", sql="""
SELECT CAST(ts AS DATE) AS day, CAST(value / 500 >= 0.5 AS INT) AS prediction, COUNT(*) AS n
FROM events GROUP BY ALL""")
def stream_prediction_counts(spark, sf_dir):
    ev = ST.file_stream(spark, sf_dir, "events")
    pred = (F.col("value") / 500 >= 0.5).cast("int")
    counts = ST.daily_prediction_counts(ev, pred)
    return ST.run_windowed(counts, spark, "daily-counts", ["day", "prediction"]).table()


@plan("stream_auc_binned", sql=f"""
WITH b AS (SELECT CAST(ts AS DATE) AS day,
             CAST(LEAST(GREATEST(FLOOR(value / 500 * 200), 0), 199) AS INT) AS bucket,
             CAST(event_type = '{POSITIVE_EVENT}' AS INT) AS y FROM events),
g AS (SELECT day, bucket, SUM(y) AS pos, SUM(1 - y) AS neg FROM b GROUP BY day, bucket),
c AS (SELECT day, pos, neg, COALESCE(SUM(neg) OVER (PARTITION BY day ORDER BY bucket
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
SELECT day, ROUND(SUM(pos * (below + neg / 2.0)) / NULLIF(SUM(pos) * SUM(neg), 0), 6) AS auc,
       CAST(SUM(pos) AS BIGINT) AS n_pos, CAST(SUM(neg) AS BIGINT) AS n_neg FROM c GROUP BY day""")
def stream_auc_binned(spark, sf_dir):
    ev = ST.file_stream(spark, sf_dir, "events")
    counts = ST.windowed_bucket_counts(ev, F.col("value") / 500, F.col("event_type") == POSITIVE_EVENT)
    state = ST.run_windowed(counts, spark, "bucket-counts", ["day", "bucket"]).table()
    auc = auc_from_bucket_counts(state, by=["day"])
    return auc.select("day", F.round("auc", 6).alias("auc"), "n_pos", "n_neg")
