"""Source and sink plans: every one writes a table derived
from the fixtures and reads it back through the operator under test."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.features import FeatureSpec, fit_spec, holdout_split
from tessera.plans import standins as SI
from tessera.plans.registry import plan
from tessera.plans.scoring_plans import SCORED_SQL, rounded_scores, scored_prospects, train_rows
from tessera.sources import files as FS
from tessera.sources.tables import table

CUSTOMER_SCHEMA = ("c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                   "c_mktsegment STRING")
LBW_SCHEMA = "model STRING, auc DOUBLE, f1 DOUBLE, accuracy DOUBLE"
SCORED_SCHEMA = ("key BIGINT, o_totalprice DOUBLE, c_acctbal DOUBLE, o_orderpriority STRING, "
                 "c_mktsegment STRING, y INT, prediction INT, score_souscription DOUBLE")


@plan("src_csv_semicolon", sql="SELECT * FROM customer")
def src_csv_semicolon(spark, sf_dir):
    path = FS.scratch_path(spark, "customer-semicolon")
    FS.write_delimited(table(spark, sf_dir, "customer"), path, sep=";")
    return FS.read_delimited(spark, path, CUSTOMER_SCHEMA, sep=";")


@plan("src_csv_by_name", sql="""
SELECT c_custkey, '"' || c_name || '"; said, "so"' AS c_name, c_mktsegment, CAST(NULL AS STRING) AS absent FROM customer""")
def src_csv_by_name(spark, sf_dir):
    """Columns in another order, one more and one less than declared; quotes and
    delimiters inside the text."""
    path = FS.scratch_path(spark, "customer-by-name")
    quoted = F.concat(F.lit('"'), F.col("c_name"), F.lit('"; said, "so"'))
    FS.write_delimited(table(spark, sf_dir, "customer").select(
        "c_mktsegment", quoted.alias("c_name"), "c_nationkey", "c_custkey"), path, sep=";")
    return FS.read_delimited(spark, path, "c_custkey BIGINT, c_name STRING, c_mktsegment STRING, absent STRING", sep=";")


@plan("src_csv_rejects", sql="""
SELECT 'kept' AS what, c_custkey || ',' || c_nationkey AS line FROM customer WHERE c_custkey % 10 <> 0
UNION ALL SELECT 'rejected', c_custkey || ',n/a' FROM customer WHERE c_custkey % 10 = 0""")
def src_csv_rejects(spark, sf_dir):
    """Rows that do not fit the declared types come back as text."""
    path = FS.scratch_path(spark, "customer-rejects")
    nation = F.when(F.col("c_custkey") % 10 == 0, F.lit("n/a")).otherwise(F.col("c_nationkey").cast("string"))
    FS.write_delimited(table(spark, sf_dir, "customer").select("c_custkey", nation.alias("c_nationkey")), path)
    good, bad = FS.read_with_rejects(spark, path, "c_nationkey INT, c_custkey BIGINT")
    kept = good.select(F.lit("kept").alias("what"), F.concat_ws(",", "c_custkey", "c_nationkey").alias("line"))
    return kept.unionByName(bad.select(F.lit("rejected").alias("what"), "line"))


@plan("src_csv_report", uses=("LBW",), sql="SELECT * FROM LBW")
def src_csv_report(spark, sf_dir):
    path = FS.scratch_path(spark, "report")
    FS.write_delimited(SI.leaderboard_wide(spark, sf_dir), path, single_file=True)
    missing = FS.load_csv(spark, path + "-absent", LBW_SCHEMA)
    assert missing is None
    return FS.load_csv_or_empty(spark, path, LBW_SCHEMA)


@plan("src_csv_sniff", sql="SELECT * FROM customer")
def src_csv_sniff(spark, sf_dir):
    path = FS.scratch_path(spark, "customer-pipe")
    FS.write_delimited(table(spark, sf_dir, "customer"), path, sep="|")
    return FS.read_sniffed(spark, path, CUSTOMER_SCHEMA)


@plan("src_blank_header", uses=("IMP",), sql="""
SELECT feature, ROUND(AVG(importance), 6) AS mean FROM IMP GROUP BY feature""")
def src_blank_header(spark, sf_dir):
    imp = SI.importances(spark, sf_dir)
    ranking = imp.groupBy("feature").agg(F.round(F.avg("importance"), 6).alias("mean"))
    path = FS.scratch_path(spark, "importances")
    FS.write_delimited(ranking, path, single_file=True, blank_first_header=True)
    return FS.read_blank_header_report(spark, path, "feature").select(
        "feature", F.col("mean").cast("double").alias("mean"))


@plan("src_split_table", uses=("P",), sql="""
SELECT key, o_totalprice, c_acctbal, o_orderpriority, c_mktsegment, y, 'test' AS split
FROM P WHERE key % 5 = 0""")
def src_split_table(spark, sf_dir):
    path = FS.scratch_path(spark, "split-bundle")
    FS.write_split_table(holdout_split(SI.prospects(spark, sf_dir), "key"), path)
    return FS.read_split(spark, path, "test").select(
        "key", "o_totalprice", "c_acctbal", "o_orderpriority", "c_mktsegment", "y", "split")


def _meta_sql():
    rows = ["SELECT 0 AS pos, 'o_totalprice' AS feature, ROUND(m0, 6) AS mean, ROUND(s0, 6) AS std FROM st",
            "SELECT 1, 'c_acctbal', ROUND(m1, 6), ROUND(s1, 6) FROM st"]
    pos = 2
    for c in SI.CAT_COLS:
        for lv in SI.LEVELS[c][1:]:
            rows.append(f"SELECT {pos}, '{c}_{lv}', NULL, NULL")
            pos += 1
    return """WITH st AS (SELECT AVG(o_totalprice) AS m0, STDDEV_POP(o_totalprice) AS s0,
                   AVG(c_acctbal) AS m1, STDDEV_POP(c_acctbal) AS s1 FROM P WHERE key % 5 <> 0)
""" + "\nUNION ALL ".join(rows)


@plan("src_feature_meta", uses=("P",), sql=_meta_sql())
def src_feature_meta(spark, sf_dir):
    p = SI.prospects(spark, sf_dir)
    spec = fit_spec(train_rows(p), SI.NUM_COLS, SI.CAT_COLS)
    path = FS.scratch_path(spark, "feature-meta")
    spec.to_df(spark).write.mode("overwrite").parquet(path)
    back = FeatureSpec.from_df(spark.read.parquet(path), SI.NUM_COLS, SI.CAT_COLS)
    assert back.features == spec.features
    return spark.read.parquet(path).select(
        "pos", "feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@plan("src_images", uses=("IMG",), sql="SELECT id, px, label FROM IMG")
def src_images(spark, sf_dir):
    path = FS.scratch_path(spark, "images")
    SI.images(spark, sf_dir).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).select("id", "px", "label")


@plan("src_file_catalog")
def src_file_catalog(spark, sf_dir):
    return FS.file_catalog(spark, sf_dir, "*.parquet").select("path", "length")


@plan("sink_report_csv", uses=("LBW",), sql="SELECT * FROM LBW")
def sink_report_csv(spark, sf_dir):
    path = FS.scratch_path(spark, "leaderboard-csv")
    FS.write_delimited(SI.leaderboard_wide(spark, sf_dir), path, single_file=True)
    return FS.read_delimited(spark, path, LBW_SCHEMA)


@plan("sink_predictions_csv", uses=("P",), sql=SCORED_SQL + "SELECT * FROM sc")
def sink_predictions_csv(spark, sf_dir):
    path = FS.scratch_path(spark, "predictions-csv")
    FS.write_delimited(rounded_scores(scored_prospects(spark, sf_dir)), path)  # parallel part files
    return FS.read_delimited(spark, path, SCORED_SCHEMA)
