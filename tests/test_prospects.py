"""The reference's own table shape: dotted column names, ';' separator,
string target, 'unknown' levels — through read, rules, one-hot and align."""

from pyspark.sql import functions as F

from tessera.operators import features as FE
from tessera.operators.profile import describe, null_counts
from tessera.operators.rules import check_rules
from tessera.sources import files as FS
from tessera.sources import prospects as PR

HEADER = ("age;job;marital;education;default;housing;loan;contact;month;day_of_week;duration;"
          "campaign;pdays;previous;poutcome;emp.var.rate;cons.price.idx;cons.conf.idx;euribor3m;"
          "nr.employed;y")
ROWS = [
    '56;"housemaid";"married";"basic.4y";"no";"no";"no";"telephone";"may";"mon";261;1;999;0;'
    '"nonexistent";1.1;93.994;-36.4;4.857;5191.0;"no"',
    '37;"services";"married";"high.school";"unknown";"yes";"no";"cellular";"may";"tue";226;2;6;1;'
    '"success";-1.8;92.893;-46.2;1.313;5099.1;"yes"',
    '99;"astronaut";"single";"university.degree";"no";"no";"yes";"cellular";"jun";"fri";10;3;999;0;'
    '"failure";1.4;94.465;-41.8;4.961;5228.1;"no"',
]


def test_read_rules_encode_align(spark):
    path = FS.scratch_path(spark, "prospects")
    spark.createDataFrame([(x,) for x in [HEADER] + ROWS], "value string").coalesce(1).write.text(path)
    df = PR.read_prospects(spark, path).withColumn("rid", F.col("age") * 1000 + F.col("campaign"))
    assert df.count() == 3
    assert [r["y"] for r in df.orderBy("age").collect()] == [1, 0, 0]   # ages 37, 56, 99
    assert FS.sniff_delimiter(spark, path) == ";"

    checked = {r["age"]: r for r in check_rules(df, PR.domain_rules(), keep=["age"]).collect()}
    assert checked[56]["valid"] == 1 and checked[37]["valid"] == 1
    assert checked[99]["broken"] == "age,job"   # out of range + unseen level

    train = df.where(F.col("age") < 90)
    spec = FE.fit_spec(train, PR.NUMERIC, PR.CATEGORICAL)
    assert "default_yes" not in spec.features        # only 'no'/'unknown' seen
    assert all(not f.endswith("_unknown") for f in spec.features)
    enc = FE.encode(df.drop(*PR.NOT_FEATURES), spec, keep=["rid"], scale=True)
    frozen = spec.features + ["month_dec"]          # a level the data never had
    aligned = FE.align(enc, frozen, keep=["rid"])
    assert aligned.columns == ["rid"] + frozen
    r99 = aligned.where("rid = 99003").first()
    assert r99["job_services"] == 0 and r99["month_dec"] == 0   # unseen level -> zero vector

    d = {r["column"]: r for r in describe(df, ["emp.var.rate", "nr.employed"]).collect()}
    assert d["emp.var.rate"]["count"] == 3 and d["nr.employed"]["max"] == 5228.1
    n = {r["column"]: r for r in null_counts(df).collect()}
    assert n["cons.conf.idx"]["nulls"] == 0 and n["y"]["type"] == "int"
