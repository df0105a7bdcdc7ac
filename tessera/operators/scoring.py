"""Batch scoring: drop target -> one-hot -> align -> scale -> predict.

The whole path is one projection over the input rows (no shuffle): the stored
feature metadata (a few dozen names and numbers) is folded into the plan as
literals, so each row is scored inside one whole-stage-codegen stage.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import c, sigmoid, threshold
from tessera.operators.features import FeatureSpec, dummy_name, scale_expr

PROBA_COL = "score_souscription"
PRED_COL = "prediction"


@dataclass
class LinearModel:
    """Stored logistic-regression coefficients over a frozen feature list."""

    intercept: float
    coef: Mapping[str, float]

    def logit(self, spec: FeatureSpec, present: set[str]) -> Column:
        """``b + sum(w * x)`` over encoded and scaled inputs, as one expression."""
        terms = [F.lit(float(self.intercept))]
        for x in spec.numeric:
            w = self.coef.get(x, 0.0)
            if w == 0.0:
                continue
            # reindex fills an absent numeric with 0 *before* scaling
            v = c(x).cast("double") if x in present else F.lit(0.0)
            terms.append(F.lit(float(w)) * scale_expr(v, spec.mean[x], spec.std[x]))
        for col, lv in spec.levels.items():
            if col not in present:
                continue
            for level in lv:
                w = self.coef.get(dummy_name(col, level), 0.0)
                if w != 0.0:
                    terms.append(F.lit(float(w)) * c(col).eqNullSafe(F.lit(level)).cast("double"))
        out = terms[0]
        for t in terms[1:]:
            out = out + t
        return out


def score_batch(df: DataFrame, spec: FeatureSpec, model: LinearModel, target: str | None = "y",
                with_proba: bool = True) -> DataFrame:
    """Input columns + ``prediction`` (+ ``score_souscription``).

    The target never enters the score (it is not in the frozen list, so the
    alignment drops it); the input columns are returned unchanged.  The
    prediction follows the score as computed: rounding is for reports.
    """
    present = set(df.columns) - ({target} if target else set())
    p = sigmoid(model.logit(spec, present))
    cols = [c(x) for x in df.columns] + [threshold(p).alias(PRED_COL)]
    if with_proba:
        cols.append(p.alias(PROBA_COL))
    return df.select(*cols)
