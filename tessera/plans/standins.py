"""Fixture stand-ins for the tables the analytics work on.

The reference works on a prospect table, a scored test set, an image set,
training histories and leaderboards.  The driver's fixtures are TPC-H-like, so
each of those is derived from them (FIXTURES.md §3).  Every stand-in exists
twice: as a Spark plan (used by the library) and as SQL text (used by the DuckDB
oracle only).  Both read the whole fixture tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.exprs import safe_corr
from tessera.sources.tables import table

# Fixed values of the stand-ins (shared by the Spark plans and the SQL text).
NUM_COLS = ["o_totalprice", "c_acctbal"]
CAT_COLS = ["o_orderpriority", "c_mktsegment"]
TARGET = "y"
KEY = "key"
TEST_MOD = 5  # hold-out: key % 5 = 0 is test


def prospects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``P``: one row per order with two numerics, two categoricals, target."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    # No broadcast hint: customer grows with the data; AQE broadcasts it only
    # when its measured size is under spark.sql.autoBroadcastJoinThreshold.
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("key"),
        "o_totalprice",
        "c_acctbal",
        "o_orderpriority",
        "c_mktsegment",
        (F.col("o_orderstatus") == "F").cast("int").alias("y"),
    )


def score_expr(key="key", y="y"):
    return ((F.col(key) * 37) % 700 + F.col(y) * 300).cast("double") / F.lit(1000.0)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``S``: scored test set (key, segment, y, p) with exact arithmetic."""
    p = prospects(spark, sf_dir)
    return p.select("key", F.col("c_mktsegment").alias("segment"), "y",
                    score_expr().alias("p"))


def scored_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``SR``: as ``S`` with a score that takes nearly as many values as rows
    (one division of integers: the same double in every engine), and a segment
    that is null for some rows."""
    p = prospects(spark, sf_dir)
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    return p.select(
        "key", F.when(F.col("key") % 7 != 0, F.col("c_mktsegment")).alias("segment"), "y",
        ((cents * 7919 % 999983 + F.col("y") * 300000).cast("double") / F.lit(1300000.0)).alias("p"))


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``IMG``: 64 floats as an 8x8 one-channel image, 10 classes."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("px"), "label")


IMG_H, IMG_W, IMG_CLASSES = 8, 8, 10


def _cents(col):
    return F.round(col * 100).cast("long")


def _ratio(cents_sum, n):
    """exact integers divided once: the same double in every engine"""
    return cents_sum.cast("double") / (n * F.lit(50000))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``HIST``: (run, epoch, val) from events; a run is a user, an epoch a
    day; val = mean value / 500, computed from integer cents so that both
    engines produce the same double."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.col("user_id").alias("run"),
                     F.dayofmonth("ts").cast("int").alias("epoch")).agg(
        _ratio(F.sum(_cents(F.col("value"))), F.count("*")).alias("val"))


def history_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training history in long form ``(run, epoch, metric, value)``.

    Four series per run, as a Keras history holds them: auc / val_auc and
    loss / val_loss; train series from click+view events, validation series
    from the others.
    """
    e = table(spark, sf_dir, "events")
    is_train = F.col("event_type").isin("click", "view")
    tr = _ratio(F.sum(F.when(is_train, _cents(F.col("value")))), F.count_if(is_train))
    va = _ratio(F.sum(F.when(~is_train, _cents(F.col("value")))), F.count_if(~is_train))
    g = e.groupBy(F.col("user_id").alias("run"),
                  F.dayofmonth("ts").cast("int").alias("epoch")).agg(
        tr.alias("auc"), va.alias("val_auc"),
        (F.lit(1.0) - tr).alias("loss"), (F.lit(1.0) - va).alias("val_loss"))
    long = g.unpivot(["run", "epoch"], ["auc", "val_auc", "loss", "val_loss"], "metric", "value")
    return long.where(F.col("value").isNotNull())


# --------------------------------------------------------------------------
# SQL text of the same stand-ins (DuckDB oracle side).
# --------------------------------------------------------------------------
SQL = {
    "P": """SELECT o_orderkey AS key, o_totalprice, c_acctbal, o_orderpriority, c_mktsegment,
              CAST(o_orderstatus = 'F' AS INT) AS y
            FROM orders JOIN customer ON o_custkey = c_custkey""",
    "S": """SELECT key, c_mktsegment AS segment, y,
              ((key * 37) % 700 + 300 * y) / CAST(1000 AS DOUBLE) AS p FROM P""",
    "SR": """SELECT key, CASE WHEN key % 7 <> 0 THEN c_mktsegment END AS segment, y,
              CAST(CAST(ROUND(o_totalprice * 100) AS BIGINT) * 7919 % 999983 + y * 300000 AS DOUBLE) / 1300000.0 AS p FROM P""",
    "IMG": "SELECT vec_id AS id, embedding AS px, label FROM embeddings",
    "HIST": """SELECT user_id AS run, CAST(DAY(ts) AS INT) AS epoch,
                 CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) AS DOUBLE) / (COUNT(*) * 50000) AS val
               FROM events GROUP BY user_id, DAY(ts)""",
    "HL0": """SELECT run, epoch, tr AS auc, va AS val_auc, 1.0 - tr AS loss, 1.0 - va AS val_loss FROM (
               SELECT user_id AS run, CAST(DAY(ts) AS INT) AS epoch,
                 CAST(SUM(CASE WHEN event_type IN ('click','view') THEN CAST(ROUND(value * 100) AS BIGINT) END) AS DOUBLE)
                   / (COUNT(*) FILTER (WHERE event_type IN ('click','view')) * 50000) AS tr,
                 CAST(SUM(CASE WHEN event_type NOT IN ('click','view') THEN CAST(ROUND(value * 100) AS BIGINT) END) AS DOUBLE)
                   / (COUNT(*) FILTER (WHERE event_type NOT IN ('click','view')) * 50000) AS va
               FROM events GROUP BY user_id, DAY(ts)) t""",
    "HL": """SELECT run, epoch, metric, value FROM (
               SELECT run, epoch, 'auc' AS metric, auc AS value FROM HL0 UNION ALL
               SELECT run, epoch, 'val_auc', val_auc FROM HL0 UNION ALL
               SELECT run, epoch, 'loss', loss FROM HL0 UNION ALL
               SELECT run, epoch, 'val_loss', val_loss FROM HL0) t WHERE value IS NOT NULL""",
}

_DEPS = {"S": ["P"], "SR": ["P"], "HL": ["HL0"]}


def with_standins(sql: str, *names: str) -> str:
    """Prefix ``sql`` with CTEs for the named stand-ins (and what they need)."""
    order: list[str] = []

    def add(n):
        for d in _DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({SQL[n]})" for n in order)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


# --------------------------------------------------------------------------
# Leaderboard stand-in: every segment of S plays a "model".
# --------------------------------------------------------------------------
def leaderboard_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``LBW``: (model, auc, f1, accuracy), 4 decimals, from the whole of S."""
    from tessera.functions.exprs import safe_div
    from tessera.operators import metrics as M

    s = scored(spark, sf_dir)
    g = M.score_counts(s, "p", "y", by=["segment"])
    auc = M.auc_from_score_counts(g, "p", by=["segment"])
    k = M.counts_at_threshold(g, "p", by=["segment"], t=0.5)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return auc.join(k, "segment").select(
        F.col("segment").alias("model"),
        F.round("auc", 4).alias("auc"),
        F.round(safe_div(2 * tp, 2 * tp + fp + fn), 4).alias("f1"),
        F.round((tp + tn) / (tp + tn + fp + fn), 4).alias("accuracy"))


def leaderboard_long(spark: SparkSession, sf_dir: str, source: str = "S") -> DataFrame:
    """``LB``: (source, model, metric, value)."""
    w = leaderboard_wide(spark, sf_dir)
    return w.unpivot(["model"], ["auc", "f1", "accuracy"], "metric", "value").select(
        F.lit(source).alias("source"), "model", "metric", "value")


SQL.update({
    "LBG": "SELECT segment, p, SUM(y) AS pos, SUM(1 - y) AS neg FROM S GROUP BY segment, p",
    "LBA": """SELECT segment, SUM(pos * (below + neg / 2.0)) / (SUM(pos) * SUM(neg)) AS auc FROM (
                SELECT segment, pos, neg, COALESCE(SUM(neg) OVER (PARTITION BY segment ORDER BY p
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM LBG) t
              GROUP BY segment""",
    "LBK": """SELECT segment, COUNT(*) FILTER (WHERE y = 1 AND p >= 0.5) AS tp,
                COUNT(*) FILTER (WHERE y = 0 AND p >= 0.5) AS fp,
                COUNT(*) FILTER (WHERE y = 1 AND p < 0.5) AS fn,
                COUNT(*) FILTER (WHERE y = 0 AND p < 0.5) AS tn FROM S GROUP BY segment""",
    "LBW": """SELECT a.segment AS model, ROUND(auc, 4) AS auc,
                ROUND(COALESCE(2.0 * tp / NULLIF(2 * tp + fp + fn, 0), 0), 4) AS f1,
                ROUND((tp + tn) / CAST(tp + tn + fp + fn AS DOUBLE), 4) AS accuracy
              FROM LBA a JOIN LBK k ON a.segment = k.segment""",
    "LB": """SELECT 'S' AS source, model, 'auc' AS metric, auc AS value FROM LBW UNION ALL
             SELECT 'S', model, 'f1', f1 FROM LBW UNION ALL
             SELECT 'S', model, 'accuracy', accuracy FROM LBW""",
})
_DEPS.update({"LBG": ["S"], "LBA": ["LBG"], "LBK": ["S"], "LBW": ["LBA", "LBK"], "LB": ["LBW"]})


# --------------------------------------------------------------------------
# Importance stand-in: |corr(feature, y)| per segment ("model") of P.
# --------------------------------------------------------------------------
# The full dummy levels of the prospect categoricals.
LEVELS = {
    "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "c_mktsegment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
}
IMP_FEATURES = NUM_COLS + [f"{c}_{lv}" for c in CAT_COLS for lv in LEVELS[c]]


def _imp_feature_exprs():
    out = {x: F.col(x) for x in NUM_COLS}
    for col in CAT_COLS:
        for lv in LEVELS[col]:
            out[f"{col}_{lv}"] = F.col(col).eqNullSafe(F.lit(lv)).cast("double")
    return out


def importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``IMP``: (feature, model, importance) rounded to 6 decimals; an
    undefined correlation (constant feature inside a segment) counts 0."""
    p = prospects(spark, sf_dir)
    ex = _imp_feature_exprs()
    names = list(ex)
    def imp(r):
        # an undefined correlation (null or NaN, by engine) counts 0
        return F.round(F.when(r.isNull() | F.isnan(r), F.lit(0.0)).otherwise(F.abs(r)), 6)

    wide = p.groupBy(F.col("c_mktsegment").alias("model")).agg(*[
        imp(safe_corr(ex[n], F.col("y").cast("double"))).alias(f"f{i}") for i, n in enumerate(names)])
    arr = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(f"f{i}").alias("importance"))
                    for i, n in enumerate(names)])
    return wide.select("model", F.inline(arr)).select("feature", "model", "importance")


def _imp_sql():
    exprs = [(x, x) for x in NUM_COLS]
    for col in CAT_COLS:
        for lv in LEVELS[col]:
            exprs.append((f"{col}_{lv}", f"CAST({col} IS NOT DISTINCT FROM '{lv}' AS DOUBLE)"))
    parts = [f"SELECT '{n}' AS feature, c_mktsegment AS model, "
             f"ROUND(CASE WHEN CORR({e}, CAST(y AS DOUBLE)) IS NULL OR isnan(CORR({e}, CAST(y AS DOUBLE))) "
             f"THEN 0.0 ELSE ABS(CORR({e}, CAST(y AS DOUBLE))) END, 6) AS importance "
             f"FROM P GROUP BY c_mktsegment" for n, e in exprs]
    return " UNION ALL ".join(parts)


SQL["IMP"] = _imp_sql()
_DEPS["IMP"] = ["P"]
