"""Projection, filter and scalar-expression plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import exprs as X
from tessera.operators import features as FE
from tessera.operators import rules as RU
from tessera.plans import standins as SI
from tessera.plans.registry import plan
from tessera.plans.scoring_plans import scored_prospects
from tessera.sources.tables import table

# A stored frozen feature list and a stored top-10 list of the
# prospect model (both artefacts name features the input may lack).
FROZEN = ["o_totalprice", "c_acctbal",
          "o_orderpriority_2-HIGH", "o_orderpriority_3-MEDIUM",
          "o_orderpriority_4-NOT SPECIFIED", "o_orderpriority_5-LOW",
          "c_mktsegment_BUILDING", "c_mktsegment_FURNITURE",
          "c_mktsegment_HOUSEHOLD", "c_mktsegment_MACHINERY",
          "o_orderstatus_P", "n_nationkey"]
TOP10 = ["c_acctbal", "o_orderpriority_5-LOW", "o_totalprice", "n_nationkey",
         "c_mktsegment_MACHINERY", "o_orderpriority_1-URGENT", "o_orderstatus_P",
         "c_mktsegment_AUTOMOBILE", "o_orderpriority_3-MEDIUM", "c_mktsegment_BUILDING"]
# Text of the scoring result (as shown to a user).
LABEL_YES = "✓ Souscription probable"
LABEL_NO = "✗ Pas de souscription"


def full_onehot_prospects(spark, sf_dir):
    p = SI.prospects(spark, sf_dir)
    levels = FE.distinct_levels(p, SI.CAT_COLS)
    return FE.onehot(p, levels)


def _q(name):
    return '"' + name + '"'


_ONEHOT_SQL = "SELECT key, o_totalprice, c_acctbal, y, " + ", ".join(
    f"CAST(({c} IS NOT DISTINCT FROM '{lv}') AS INT) AS \"{c}_{lv}\""
    for c in SI.CAT_COLS for lv in SI.LEVELS[c]) + " FROM P"


@plan("proj_drop_target", uses=("P",),
      sql="SELECT key, o_totalprice, c_acctbal, o_orderpriority, c_mktsegment FROM P")
def proj_drop_target(spark, sf_dir):
    return SI.prospects(spark, sf_dir).drop("y")


_ONEHOT_COLS = {"key", "o_totalprice", "c_acctbal", "y"} | {
    f"{c}_{lv}" for c in SI.CAT_COLS for lv in SI.LEVELS[c]}
_MISSING = [f for f in FROZEN if f not in _ONEHOT_COLS]


@plan("proj_add_const", uses=("P",), sql=f"""
WITH oh AS ({_ONEHOT_SQL})
SELECT *, {", ".join(f"0 AS {_q(m)}" for m in _MISSING)} FROM oh""")
def proj_add_const(spark, sf_dir):
    oh = full_onehot_prospects(spark, sf_dir)
    missing = [f for f in FROZEN if f not in oh.columns]
    return oh.withColumns({m: F.lit(0) for m in missing})


_COMMON = [f for f in TOP10 if f in _ONEHOT_COLS]


@plan("proj_common_columns", uses=("P",), sql=f"""
WITH oh AS ({_ONEHOT_SQL}) SELECT {", ".join(_q(f) for f in _COMMON)} FROM oh""")
def proj_common_columns(spark, sf_dir):
    oh = full_onehot_prospects(spark, sf_dir)
    return oh.select(*[X.c(f) for f in TOP10 if f in oh.columns])


@plan("proj_listed_table_order", uses=("P",), sql=f"""
WITH oh AS ({_ONEHOT_SQL}) SELECT {", ".join(_q(f) for f in _COMMON)} FROM oh""")
def proj_listed_table_order(spark, sf_dir):
    oh = full_onehot_prospects(spark, sf_dir)
    wanted = set(TOP10)
    return oh.select(*[X.c(x) for x in oh.columns if x in wanted])


@plan("expr_cast", sql="""
SELECT l_orderkey, l_linenumber, CAST(TRUNC(l_quantity) AS INTEGER) AS qty_int,
       CAST(TRUNC(l_extendedprice / 100) AS INTEGER) AS price_hundreds,
       CAST(l_extendedprice AS FLOAT) AS price_f32 FROM lineitem""")
def expr_cast(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.col("l_quantity").cast("int").alias("qty_int"),
                     (F.col("l_extendedprice") / 100).cast("int").alias("price_hundreds"),
                     F.col("l_extendedprice").cast("float").alias("price_f32"))


# Defaults of the scoring form for fields an event may lack.
ROW_DEFAULTS = {"k": 0, "campaign": 2, "pdays": 999, "previous": 0}


@plan("proj_row_from_json", sql="""
SELECT event_id,
       COALESCE(CAST(json_extract(props, '$.k') AS INTEGER), 0) AS k,
       COALESCE(CAST(json_extract(props, '$.campaign') AS INTEGER), 2) AS campaign,
       COALESCE(CAST(json_extract(props, '$.pdays') AS INTEGER), 999) AS pdays,
       COALESCE(CAST(json_extract(props, '$.previous') AS INTEGER), 0) AS previous
FROM events""")
def proj_row_from_json(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return RU.row_from_json(e, "props", "k INT, campaign INT, pdays INT, previous INT",
                            ROW_DEFAULTS, keep=["event_id"])


# The domain rules of the stand-in form (range or level set).
DOMAIN_RULES = [
    ("o_totalprice", "range", (1000.0, 400000.0)),
    ("c_acctbal", "range", (0.0, 9999.0)),
    ("o_orderpriority", "levels", SI.LEVELS["o_orderpriority"]),
    ("c_mktsegment", "levels", ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]),
]


@plan("filter_domain_rules", uses=("P",), sql="""
WITH b AS (SELECT key, list_filter([
    CASE WHEN NOT (o_totalprice BETWEEN 1000.0 AND 400000.0) OR o_totalprice IS NULL THEN 'o_totalprice' END,
    CASE WHEN NOT (c_acctbal BETWEEN 0.0 AND 9999.0) OR c_acctbal IS NULL THEN 'c_acctbal' END,
    CASE WHEN NOT (o_orderpriority IN ('1-URGENT','2-HIGH','3-MEDIUM','4-NOT SPECIFIED','5-LOW')) OR o_orderpriority IS NULL THEN 'o_orderpriority' END,
    CASE WHEN NOT (c_mktsegment IN ('AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD')) OR c_mktsegment IS NULL THEN 'c_mktsegment' END
  ], lambda x: x IS NOT NULL) AS broken FROM P)
SELECT key, CAST(len(broken) = 0 AS INT) AS valid, CAST(len(broken) AS INT) AS n_broken,
       array_to_string(broken, ',') AS broken FROM b""")
def filter_domain_rules(spark, sf_dir):
    return RU.check_rules(SI.prospects(spark, sf_dir), DOMAIN_RULES, keep=["key"])


@plan("expr_threshold", uses=("S",), sql="SELECT key, CAST(p >= 0.5 AS INT) AS pred FROM S")
def expr_threshold(spark, sf_dir):
    return SI.scored(spark, sf_dir).select("key", X.threshold(F.col("p")).alias("pred"))


def _scored_sql():
    from tessera.plans.scoring_plans import SCORED_SQL
    return SCORED_SQL


@plan("expr_label_text", uses=("P",), sql=_scored_sql() + f"""
SELECT key, CASE WHEN CAST(prediction AS VARCHAR) IN ('1', 'yes') THEN '{LABEL_YES}'
                 ELSE '{LABEL_NO}' END AS label FROM sc""")
def expr_label_text(spark, sf_dir):
    s = scored_prospects(spark, sf_dir)
    return s.select("key", X.label_text(F.col("prediction"), LABEL_YES, LABEL_NO).alias("label"))


@plan("expr_correct_flag", uses=("S",), sql="""
SELECT key, CASE WHEN CAST(p >= 0.5 AS INT) = y THEN 'green' ELSE 'red' END AS flag FROM S""")
def expr_correct_flag(spark, sf_dir):
    s = SI.scored(spark, sf_dir)
    return s.select("key", X.correct_flag(X.threshold(F.col("p")), F.col("y")).alias("flag"))


@plan("expr_round", sql="""
SELECT l_orderkey, l_linenumber, ROUND(l_extendedprice / 7, 4) AS r4,
       ROUND(l_extendedprice / 7.3, 1) AS r1, ROUND_EVEN(l_extendedprice / 7, 4) AS b4 FROM lineitem""")
def expr_round(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    x7, x73 = F.col("l_extendedprice") / 7, F.col("l_extendedprice") / 7.3
    return li.select("l_orderkey", "l_linenumber", F.round(x7, 4).alias("r4"),
                     F.round(x73, 1).alias("r1"), F.bround(x7, 4).alias("b4"))


@plan("expr_format", uses=("P",), sql="""
SELECT key, printf('%.3f', o_totalprice / 7) AS f3, printf('%.4f', c_acctbal / 13) AS f4,
       printf('%.1f%%', o_totalprice / 700000 * 100) AS pct FROM P""")
def expr_format(spark, sf_dir):
    p = SI.prospects(spark, sf_dir)
    return p.select("key", X.fmt(F.col("o_totalprice") / 7, "%.3f").alias("f3"),
                    X.fmt(F.col("c_acctbal") / 13, "%.4f").alias("f4"),
                    X.pct(F.col("o_totalprice") / 700000).alias("pct"))


@plan("expr_split_prefix", sql="""
SELECT c_custkey, c_name || ' (' || c_mktsegment || ')' AS label,
       split_part(c_name || ' (' || c_mktsegment || ')', ' (', 1) AS model FROM customer""")
def expr_split_prefix(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    lab = F.concat("c_name", F.lit(" ("), "c_mktsegment", F.lit(")"))
    return c.select("c_custkey", lab.alias("label"), X.split_prefix(lab).alias("model"))


@plan("expr_contains_ci", uses=("LB",), sql="""
SELECT source, model, metric, value FROM LB WHERE contains(lower(metric), 'auc')""")
def expr_contains_ci(spark, sf_dir):
    lb = SI.leaderboard_long(spark, sf_dir)
    return lb.where(X.contains_ci(F.col("metric"), "AUC"))


# The families a headline panel asks for (one is absent).
FAMILIES = ["AUTOMOBILE", "BUILDING", "RETAIL"]


@plan("expr_default_dash", uses=("S",), sql=f"""
WITH f AS (SELECT * FROM (VALUES {", ".join(f"('{x}')" for x in FAMILIES)}) t(family)),
b AS (SELECT segment, MAX(p) AS best FROM S GROUP BY segment)
SELECT family, COALESCE(printf('%.3f', best), '{X.DASH}') AS best
FROM f LEFT JOIN b ON f.family = b.segment""")
def expr_default_dash(spark, sf_dir):
    s = SI.scored(spark, sf_dir)
    best = s.groupBy(F.col("segment").alias("family")).agg(F.max("p").alias("best"))
    fam = spark.createDataFrame([(x,) for x in FAMILIES], "family string")
    # every family stays; a left join leaves Spark free to broadcast the best values
    return fam.join(best, "family", "left").select(
        "family", F.coalesce(X.fmt(F.col("best"), "%.3f"), F.lit(X.DASH)).alias("best"))


@plan("agg_distinct_sorted", uses=("P",),
      sql="SELECT DISTINCT o_orderpriority FROM P ORDER BY o_orderpriority")
def agg_distinct_sorted(spark, sf_dir):
    return SI.prospects(spark, sf_dir).select("o_orderpriority").distinct().orderBy("o_orderpriority")


@plan("proj_rename", uses=("P",), sql="SELECT y, COUNT(*) AS n_rows FROM P GROUP BY y")
def proj_rename(spark, sf_dir):
    return SI.prospects(spark, sf_dir).groupBy("y").count().withColumnRenamed("count", "n_rows")


@plan("agg_list_join", uses=("IMP",), sql="""
WITH m AS (SELECT feature, ROUND(AVG(importance), 6) AS mean FROM IMP GROUP BY feature),
r AS (SELECT feature, ROW_NUMBER() OVER (ORDER BY mean DESC, feature) AS rn FROM m)
SELECT string_agg(feature, ', ' ORDER BY rn) AS top5 FROM r WHERE rn <= 5""")
def agg_list_join(spark, sf_dir):
    from tessera.operators.lookups import top_k_list_text

    imp = SI.importances(spark, sf_dir)
    mean = imp.groupBy("feature").agg(F.round(F.avg("importance"), 6).alias("mean"))
    return top_k_list_text(mean, "feature", [F.desc("mean"), F.asc("feature")], 5, out="top5")
