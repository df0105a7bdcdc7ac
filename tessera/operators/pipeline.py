"""One persisted pipeline from raw rows to scores.

Encoding, alignment to the frozen feature list, scaling and the classifier are
stages of a single ``PipelineModel``: what is saved can score a raw table in any
later session.  The stages of our own are Spark ML transformers whose parameters
(levels per column, scaler statistics, weights) are stored with Spark's own reader
and writer; each adds one projection, so a scored table needs no shuffle.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import THRESHOLD, c, sigmoid
from tessera.operators.features import MAX_LEVELS, FeatureSpec, dummy_name, fit_spec, scale_expr
from tessera.operators.scoring import PRED_COL, PROBA_COL


def _param(name: str, doc: str, kind) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=kind)


class _Stage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    inputCol = _param("inputCol", "column that is read", TypeConverters.toString)
    outputCol = _param("outputCol", "column that is added", TypeConverters.toString)

    def _value(self, param: Param):
        return self.getOrDefault(param)


class EncodeAlign(_Stage):
    """Raw columns -> an array over the frozen feature list: numerics as they are
    (absent: 0, null: NaN), one 0/1 entry per kept level (null, base, unseen
    level or absent column: 0)."""

    numeric = _param("numeric", "numeric columns, in order", TypeConverters.toListString)
    levels = _param("levels", "JSON list of (column, kept levels), in order", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, numeric=None, levels=None, outputCol="aligned"):
        super().__init__()
        self._setDefault(outputCol="aligned")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def kept_levels(self) -> list[tuple[str, list[str]]]:
        return [(col, list(lv)) for col, lv in json.loads(self._value(self.levels))]

    @property
    def features(self) -> list[str]:
        return list(self._value(self.numeric)) + [dummy_name(col, x) for col, lv in self.kept_levels() for x in lv]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        present = set(dataset.columns)
        values = [F.coalesce(c(x).cast("double"), F.lit(float("nan"))) if x in present else F.lit(0.0)
                  for x in self._value(self.numeric)]
        for col, lv in self.kept_levels():
            values += [c(col).eqNullSafe(F.lit(x)).cast("double") if col in present else F.lit(0.0) for x in lv]
        return dataset.withColumn(self._value(self.outputCol), F.array(*values))


class ScaleAligned(_Stage):
    """The first entries of the array centred and scaled (deviation 0 divides by
    1), and the whole as a feature vector."""

    mean = _param("mean", "mean of each numeric", TypeConverters.toListFloat)
    std = _param("std", "population deviation of each numeric", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, mean=None, std=None, inputCol="aligned", outputCol="features"):
        super().__init__()
        self._setDefault(inputCol="aligned", outputCol="features")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x, mean, std = F.col(self._value(self.inputCol)), self._value(self.mean), self._value(self.std)
        scaled = [scale_expr(F.get(x, F.lit(i)), m, s) for i, (m, s) in enumerate(zip(mean, std, strict=True))]
        rest = F.slice(x, F.lit(len(mean) + 1), F.greatest(F.size(x) - len(mean), F.lit(0)))
        return dataset.withColumn(self._value(self.outputCol), array_to_vector(F.concat(F.array(*scaled).cast("array<double>"), rest)))


class LinearScorer(_Stage):
    """Stored logistic weights: ``probability`` (of 0 and 1) and ``prediction``."""

    weights = _param("weights", "one weight per feature", TypeConverters.toListFloat)
    intercept = _param("intercept", "intercept", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, weights=None, intercept=None, inputCol="features"):
        super().__init__()
        self._setDefault(inputCol="features", intercept=0.0)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = vector_to_array(F.col(self._value(self.inputCol)))
        logit = F.lit(self._value(self.intercept))
        for i, w in enumerate(self._value(self.weights)):
            if w:
                logit = logit + F.lit(w) * F.get(x, F.lit(i))
        p = sigmoid(logit)
        return dataset.withColumn("probability", array_to_vector(F.array(F.lit(1.0) - p, p))).withColumn(
            "prediction", (p >= F.lit(THRESHOLD)).cast("double"))


class FitEncoding(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Fits levels (the first of each column dropped) and scaler statistics on raw
    training rows, in one scan; the model is ``EncodeAlign`` and ``ScaleAligned``."""

    numeric = _param("numeric", "numeric columns", TypeConverters.toListString)
    categorical = _param("categorical", "categorical columns", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, numeric=None, categorical=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        spec = fit_spec(dataset, self.getOrDefault(self.numeric), self.getOrDefault(self.categorical), MAX_LEVELS)
        return from_spec(spec)


def from_spec(spec: FeatureSpec) -> PipelineModel:
    """The encoding and scaling stages of frozen features."""
    missing = [x for x in spec.numeric if spec.mean.get(x) is None]
    if missing:
        raise ValueError(f"no training value in {missing}")
    return PipelineModel([
        EncodeAlign(numeric=spec.numeric, levels=json.dumps(list(spec.levels.items()))),
        ScaleAligned(mean=[float(spec.mean[x]) for x in spec.numeric], std=[float(spec.std[x]) for x in spec.numeric])])


def features_of(model: PipelineModel) -> list[str]:
    """The frozen feature list of a pipeline, found in its encoding stage."""
    for stage in model.stages:
        found = features_of(stage) if isinstance(stage, PipelineModel) else getattr(stage, "features", None)
        if isinstance(found, list) and found:
            return found
    return []


def score_raw(model: PipelineModel, raw: DataFrame) -> DataFrame:
    """Raw rows + ``prediction`` (int) and, where the model has one, the
    probability of the positive class."""
    scored = model.transform(raw)
    out = [c(x) for x in raw.columns if x not in (PRED_COL, PROBA_COL)]
    out.append(F.col("prediction").cast("int").alias(PRED_COL))
    if "probability" in scored.columns:
        out.append(F.element_at(vector_to_array("probability"), 2).alias(PROBA_COL))
    return scored.select(*out)
