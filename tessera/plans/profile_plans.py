"""Profiling plans (EDA page) over the prospect stand-in and lineitem."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from tessera.operators import profile as PR
from tessera.plans import standins as SI
from tessera.plans.registry import plan
from tessera.sources.tables import table

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def lineitem_numeric(spark, sf_dir):
    # -0.0 folded into 0.0 (the fixtures contain both)
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", *[(F.col(x) + 0.0).alias(x) for x in LI_NUM])


@plan("prof_shape", sql="SELECT COUNT(*) AS rows, 5 AS features FROM P", uses=("P",))
def prof_shape(spark, sf_dir):
    return PR.shape(SI.prospects(spark, sf_dir), target="y")


@plan("prof_nunique", sql="SELECT COUNT(DISTINCT o_orderpriority) AS nunique FROM P", uses=("P",))
def prof_nunique(spark, sf_dir):
    return PR.nunique(SI.prospects(spark, sf_dir), "o_orderpriority")


_NULLS_P = """SELECT key, o_totalprice, NULLIF(c_acctbal, c_acctbal) AS c_acctbal_gone,
       NULLIF(o_orderpriority, '1-URGENT') AS o_orderpriority,
       NULLIF(c_mktsegment, 'BUILDING') AS c_mktsegment, y FROM P"""


@plan("prof_nulls", uses=("P",), sql=f"""
WITH n AS ({_NULLS_P})
SELECT 'key' AS "column", 'bigint' AS type, COUNT(key) AS non_null, COUNT(*) FILTER (WHERE key IS NULL) AS nulls FROM n
UNION ALL SELECT 'o_totalprice', 'double', COUNT(o_totalprice), COUNT(*) FILTER (WHERE o_totalprice IS NULL) FROM n
UNION ALL SELECT 'c_acctbal_gone', 'double', COUNT(c_acctbal_gone), COUNT(*) FILTER (WHERE c_acctbal_gone IS NULL) FROM n
UNION ALL SELECT 'o_orderpriority', 'string', COUNT(o_orderpriority), COUNT(*) FILTER (WHERE o_orderpriority IS NULL) FROM n
UNION ALL SELECT 'c_mktsegment', 'string', COUNT(c_mktsegment), COUNT(*) FILTER (WHERE c_mktsegment IS NULL) FROM n
UNION ALL SELECT 'y', 'int', COUNT(y), COUNT(*) FILTER (WHERE y IS NULL) FROM n
""")
def prof_nulls(spark, sf_dir):
    p = SI.prospects(spark, sf_dir)
    n = p.select("key", "o_totalprice",
                 F.nullif("c_acctbal", "c_acctbal").alias("c_acctbal_gone"),
                 F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("o_orderpriority"),
                 F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"), "y")
    return PR.null_counts(n)


def _unpivot_sql(cols, src):
    sel = ", ".join(f"CAST({x} AS DOUBLE) + 0.0 AS {x}" for x in cols)
    return f"""(UNPIVOT (SELECT {sel} FROM {src}) ON {", ".join(cols)}
               INTO NAME "column" VALUE value)"""


@plan("prof_describe", sql=f"""
SELECT "column", COUNT(value) AS count, ROUND(AVG(value), 6) AS mean,
       ROUND(STDDEV_SAMP(value), 6) AS std, ROUND(MIN(value), 6) AS min,
       ROUND(QUANTILE_CONT(value, 0.25), 6) AS p25, ROUND(QUANTILE_CONT(value, 0.5), 6) AS p50,
       ROUND(QUANTILE_CONT(value, 0.75), 6) AS p75, ROUND(MAX(value), 6) AS max
FROM {_unpivot_sql(LI_NUM, "lineitem")} GROUP BY "column"
""")
def prof_describe(spark, sf_dir):
    return PR.describe(lineitem_numeric(spark, sf_dir), LI_NUM)


@plan("prof_value_counts", sql="SELECT y, COUNT(*) AS count FROM P WHERE y IS NOT NULL GROUP BY y",
      uses=("P",))
def prof_value_counts(spark, sf_dir):
    return PR.value_counts(SI.prospects(spark, sf_dir), "y")


@plan("prof_imbalance", sql="""
WITH vc AS (SELECT toxic, COUNT(*) AS n FROM labels WHERE toxic IS NOT NULL GROUP BY toxic)
SELECT MIN(n) / CAST(MAX(n) AS DOUBLE) * 100 AS imbalance_pct, MIN(n) AS min_count, MAX(n) AS max_count FROM vc
""")
def prof_imbalance(spark, sf_dir):
    return PR.imbalance(table(spark, sf_dir, "labels"), "toxic")


@plan("prof_head", sql="SELECT * FROM P ORDER BY key LIMIT 20", uses=("P",))
def prof_head(spark, sf_dir):
    return PR.head(SI.prospects(spark, sf_dir), "key", 20)


@plan("prof_numeric_only", sql="SELECT key, o_totalprice, c_acctbal, y FROM P", uses=("P",))
def prof_numeric_only(spark, sf_dir):
    p = SI.prospects(spark, sf_dir)
    return p.select(*PR.numeric_columns(p))


@plan("prof_string_only", sql="SELECT o_orderpriority, c_mktsegment FROM P", uses=("P",))
def prof_string_only(spark, sf_dir):
    p = SI.prospects(spark, sf_dir)
    return p.select(*PR.string_columns(p))


@plan("prof_cols_by_keyword", sql="SELECT key, o_totalprice FROM P", uses=("P",))
def prof_cols_by_keyword(spark, sf_dir):
    p = SI.prospects(spark, sf_dir)
    return p.select("key", *PR.columns_by_keyword(p, "PRICE"))


def _corr_sql():
    parts = []
    for a in LI_NUM:
        for b in LI_NUM:
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, ROUND(CORR({a} + 0.0, {b} + 0.0), 6) AS r FROM lineitem")
    return "\nUNION ALL ".join(parts)


@plan("prof_corr_matrix", sql=_corr_sql())
def prof_corr_matrix(spark, sf_dir):
    return PR.corr_matrix(lineitem_numeric(spark, sf_dir), LI_NUM)


@plan("prof_cat_vs_target", uses=("P",), sql="""
SELECT "column", level, COUNT(*) AS n, CAST(SUM(y) AS BIGINT) AS positives, AVG(y) AS rate
FROM (UNPIVOT (SELECT y, o_orderpriority, c_mktsegment FROM P) ON o_orderpriority, c_mktsegment
      INTO NAME "column" VALUE level)
GROUP BY "column", level
""")
def prof_cat_vs_target(spark, sf_dir):
    return PR.category_vs_target(SI.prospects(spark, sf_dir), SI.CAT_COLS, "y")


@plan("prof_histogram", sql=f"""
WITH l AS (SELECT * FROM {_unpivot_sql(LI_NUM, "lineitem")} WHERE value IS NOT NULL),
r AS (SELECT "column", MIN(value) AS lo, MAX(value) AS hi FROM l GROUP BY "column"),
b AS (SELECT l."column",
             CAST(CASE WHEN hi - lo = 0 THEN 1
                       ELSE LEAST(FLOOR((value - lo) / (hi - lo) * 10) + 1, 10) END AS INT) AS bin
      FROM l JOIN r ON l."column" = r."column"),
c AS (SELECT "column", bin, COUNT(*) AS count FROM b GROUP BY "column", bin),
g AS (SELECT "column", lo, hi, CAST(bin AS INT) AS bin FROM r, range(1, 11) t(bin))
SELECT g."column", g.bin, ROUND(lo + (hi - lo) * (g.bin - 1) / 10, 6) AS bin_lo,
       ROUND(lo + (hi - lo) * (g.bin + 1 - 1) / 10, 6) AS bin_hi,
       CAST(COALESCE(c.count, 0) AS BIGINT) AS count
FROM g LEFT JOIN c ON g."column" = c."column" AND g.bin = c.bin
""")
def prof_histogram(spark, sf_dir):
    return PR.histogram(lineitem_numeric(spark, sf_dir), LI_NUM, bins=10)


def _pairs_sql():
    parts = []
    for a, b in combinations(LI_NUM, 2):
        parts.append(f"SELECT l_orderkey, '{a}' AS x_col, '{b}' AS y_col, {a} + 0.0 AS x, {b} + 0.0 AS y FROM lineitem")
    return "\nUNION ALL ".join(parts)


@plan("prof_scatter_pairs", sql=_pairs_sql())
def prof_scatter_pairs(spark, sf_dir):
    return PR.scatter_pairs(lineitem_numeric(spark, sf_dir), "l_orderkey", LI_NUM)


def _regr_sql():
    parts = []
    for a, b in combinations(LI_NUM, 2):
        parts.append(
            f"SELECT '{a}' AS x_col, '{b}' AS y_col, ROUND(REGR_SLOPE({b} + 0.0, {a} + 0.0), 6) AS slope, "
            f"ROUND(REGR_INTERCEPT({b} + 0.0, {a} + 0.0), 6) AS intercept, "
            f"ROUND(REGR_R2({b} + 0.0, {a} + 0.0), 6) AS r2 FROM lineitem")
    return "\nUNION ALL ".join(parts)


@plan("prof_regression_line", sql=_regr_sql())
def prof_regression_line(spark, sf_dir):
    return PR.regression_lines(lineitem_numeric(spark, sf_dir), LI_NUM)


_DESC_FIELDS = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]


@plan("proj_transpose", sql=f"""
WITH d AS (
  SELECT "column", CAST(COUNT(value) AS DOUBLE) AS count, ROUND(AVG(value), 6) AS mean,
         ROUND(STDDEV_SAMP(value), 6) AS std, ROUND(MIN(value), 6) AS min,
         ROUND(QUANTILE_CONT(value, 0.25), 6) AS p25, ROUND(QUANTILE_CONT(value, 0.5), 6) AS p50,
         ROUND(QUANTILE_CONT(value, 0.75), 6) AS p75, ROUND(MAX(value), 6) AS max
  FROM {_unpivot_sql(LI_NUM, "lineitem")} GROUP BY "column"),
l AS (SELECT * FROM (UNPIVOT d ON {", ".join(_DESC_FIELDS)} INTO NAME field VALUE value))
SELECT field, {", ".join(f"MAX(value) FILTER (WHERE " + '"column"' + f" = '{c}') AS {c}" for c in sorted(LI_NUM))}
FROM l GROUP BY field""")
def proj_transpose(spark, sf_dir):
    d = PR.describe(lineitem_numeric(spark, sf_dir), LI_NUM)
    return PR.transpose_small(d, "column", _DESC_FIELDS, name_col="field")


@plan("prof_cat_vs_target_labels", sql="""
SELECT "column", level, COUNT(*) AS n, CAST(SUM(toxic) AS BIGINT) AS positives, AVG(toxic) AS rate
FROM (UNPIVOT (SELECT l.toxic, d.lang, d.source FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
      ON lang, source INTO NAME "column" VALUE level)
GROUP BY "column", level
""")
def prof_cat_vs_target_labels(spark, sf_dir):
    """Category vs target over labelled documents (labels ⋈ documents); the
    document scan reads only the key and the two categorical columns."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    lab = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return PR.category_vs_target(lab.join(docs, "doc_id"), ["lang", "source"], "toxic")
