"""Column expressions shared by the operators.

All built from ``pyspark.sql.functions`` so they stay inside whole-stage
codegen (higher-order array functions stay JVM-side too).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (library defaults the reference relies on).
EPSILON_CLIP = 1e-7          # Keras cross-entropy clipping
BATCHNORM_EPS = 1e-3         # Keras BatchNormalization epsilon
THRESHOLD = 0.5              # decision threshold
DASH = "—"              # placeholder shown for an absent value


def c(name_or_col) -> Column:
    """Column from a name (back-quoted: names may contain dots) or a Column."""
    if isinstance(name_or_col, Column):
        return name_or_col
    return F.col(f"`{name_or_col}`")


def safe_div(num: Column, den: Column, default=0.0) -> Column:
    """num / den, ``default`` when den is 0 or null (scikit-learn's zero_division)."""
    return F.coalesce(F.try_divide(num, F.when(den != 0, den)), F.lit(default))


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over the rows where both values exist, null when
    either side is constant there (``corr`` divides by zero, which fails under
    ANSI mode)."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def relu(x: Column) -> Column:
    return F.greatest(x, F.lit(0.0))


def threshold(p: Column, t: float = THRESHOLD) -> Column:
    """score >= t -> 1 else 0 (null stays null)."""
    return (p >= F.lit(t)).cast("int")


def clip(p: Column, eps: float = EPSILON_CLIP) -> Column:
    return F.least(F.greatest(p, F.lit(eps)), F.lit(1.0 - eps))


def label_text(pred: Column, yes: str, no: str) -> Column:
    """Text for a prediction that may be 1/0 or "yes"/"no"."""
    return F.when(pred.cast("string").isin("1", "yes"), F.lit(yes)).otherwise(F.lit(no))


def correct_flag(pred: Column, label: Column) -> Column:
    return F.when(pred == label, F.lit("green")).otherwise(F.lit("red"))


def fmt(x: Column, pattern: str) -> Column:
    """printf-style text; null stays null (Java would print "null")."""
    return F.when(x.isNotNull(), F.format_string(pattern, x))


def pct(x: Column, decimals: int = 1) -> Column:
    """Python's ``{:.1%}``: value x 100 with a percent sign."""
    return F.when(x.isNotNull(), F.format_string(f"%.{decimals}f%%", x * 100))


def split_prefix(s: Column, sep: str = " (") -> Column:
    """Text before the first ``sep`` (whole text when absent)."""
    return F.substring_index(s, sep, 1)


def contains_ci(s: Column, needle: str) -> Column:
    return F.lower(s).contains(needle.lower())


# ---- array (vector) expressions -----------------------------------------

def arr_sum(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v)


def softmax(x: Column) -> Column:
    """Numerically safe softmax of an array: subtract the max first."""
    m = F.array_max(x)
    ex = F.transform(x, lambda v: F.exp(v - m))
    s = arr_sum(ex)
    return F.transform(ex, lambda v: v / s)


def argmax(x: Column) -> Column:
    """0-based index of the first maximum (np.argmax)."""
    return (F.array_position(x, F.array_max(x)) - 1).cast("int")
