"""The prospect (bank-marketing) table the reference trains on: schema,
domain rules and form defaults, and its ``;``-separated reader.

The fixtures do not contain this table, so no registered query reads it;
the plans run the same operators on the ``P`` stand-in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.exprs import c
from tessera.sources.files import read_delimited

# Column names, types and order of the raw prospect table.
PROSPECT_SCHEMA = (
    "age INT, job STRING, marital STRING, education STRING, default STRING, housing STRING, "
    "loan STRING, contact STRING, month STRING, day_of_week STRING, duration INT, campaign INT, "
    "pdays INT, previous INT, poutcome STRING, `emp.var.rate` DOUBLE, `cons.price.idx` DOUBLE, "
    "`cons.conf.idx` DOUBLE, euribor3m DOUBLE, `nr.employed` DOUBLE, y STRING"
)

# The input form's domains (numeric ranges and level lists).
NUMERIC_RANGES = {
    "age": (18, 95),
    "duration": (0, 5000),
    "campaign": (1, 50),
    "pdays": (-1, 999),
    "previous": (0, 20),
    "emp.var.rate": (-5.0, 5.0),
    "cons.price.idx": (90.0, 100.0),
    "cons.conf.idx": (-55.0, -20.0),
    "euribor3m": (0.0, 6.0),
    "nr.employed": (4900.0, 5300.0),
}
LEVELS = {
    "job": ["admin.", "blue-collar", "entrepreneur", "housemaid", "management", "retired",
            "self-employed", "services", "student", "technician", "unemployed", "unknown"],
    "marital": ["divorced", "married", "single", "unknown"],
    "education": ["basic.4y", "basic.6y", "basic.9y", "high.school", "illiterate",
                  "professional.course", "university.degree", "unknown"],
    "default": ["no", "yes", "unknown"],
    "housing": ["no", "yes", "unknown"],
    "loan": ["no", "yes", "unknown"],
    "contact": ["cellular", "telephone"],
    "month": ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"],
    "day_of_week": ["mon", "tue", "wed", "thu", "fri"],
    "poutcome": ["failure", "nonexistent", "success"],
}
# Form defaults of the numeric fields (categoricals default to
# their first level).
FORM_DEFAULTS = {
    "age": 40, "duration": 200, "campaign": 2, "pdays": 999, "previous": 0,
    "emp.var.rate": 1.1, "cons.price.idx": 93.2, "cons.conf.idx": -42.7,
    "euribor3m": 4.9, "nr.employed": 5191.0,
}
# Columns left out of training (known only after the call).
NOT_FEATURES = ["duration", "y"]

NUMERIC = ["age", "campaign", "pdays", "previous", "emp.var.rate", "cons.price.idx",
           "cons.conf.idx", "euribor3m", "nr.employed"]
CATEGORICAL = list(LEVELS)


def domain_rules() -> list:
    """Rules for :func:`tessera.operators.rules.check_rules`."""
    rules = [(col, "range", rng) for col, rng in NUMERIC_RANGES.items()]
    rules += [(col, "levels", lv) for col, lv in LEVELS.items()]
    return rules


def target_as_int(y) -> F.Column:
    """``yes``/``1`` -> 1, ``no``/``0`` -> 0, anything else -> null."""
    s = F.lower(F.trim(y.cast("string")))
    return F.when(s.isin("yes", "1"), F.lit(1)).when(s.isin("no", "0"), F.lit(0))


def read_prospects(spark: SparkSession, path: str) -> DataFrame:
    """The ``;``-separated table with a header, declared types, target as int."""
    df = read_delimited(spark, path, PROSPECT_SCHEMA, sep=";")
    return df.withColumn("y", target_as_int(c("y")))
