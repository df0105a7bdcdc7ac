"""Table profiling (the EDA page): shape, distinct classes, null counts,
describe, class frequencies, correlations, histograms, scatter pairs,
regression lines.

Wide tables are handled by ``unpivot`` to a long ``(column, value)`` form and
one ``groupBy(column)`` with map-side partial aggregation, never a loop of
jobs per column.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.exprs import c
from tessera.operators import gram
from tessera.operators.features import bounded_broadcast
from tessera.operators.quantiles import exact_quantiles

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                 T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    """``select_dtypes(include="number")`` on the schema."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def string_columns(df: DataFrame) -> list[str]:
    """``select_dtypes(include="object")`` on the schema."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def columns_by_keyword(df: DataFrame, keyword: str, first_only: bool = True) -> list[str]:
    """Column names containing ``keyword`` case-insensitively (first hit)."""
    hits = [x for x in df.columns if keyword.lower() in x.lower()]
    return hits[:1] if first_only else hits


def shape(df: DataFrame, target: str | None = "y") -> DataFrame:
    """One row: rows, features (= columns minus the target)."""
    n_feat = len(df.columns) - (1 if target and target in df.columns else 0)
    return df.agg(F.count("*").alias("rows")).select("rows", F.lit(n_feat).alias("features"))


def nunique(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values (``Series.nunique``)."""
    return df.agg(F.count_distinct(c(col)).alias("nunique"))


def null_counts(df: DataFrame) -> DataFrame:
    """Per column: type, non-null count, null count — one pass for all columns."""
    cols = df.columns
    aggs = []
    for i, x in enumerate(cols):
        aggs += [F.count(c(x)).alias(f"nn{i}"), F.count_if(c(x).isNull()).alias(f"nu{i}")]
    one = df.agg(*aggs)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = F.array(*[
        F.struct(F.lit(x).alias("column"), F.lit(types[x]).alias("type"),
                 F.col(f"nn{i}").alias("non_null"), F.col(f"nu{i}").alias("nulls"))
        for i, x in enumerate(cols)])
    return one.select(F.inline(rows))


def long_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, value double) for the numeric columns (``unpivot``)."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    return df.select(*[c(x).cast("double").alias(x) for x in cols]).unpivot(
        [], [c(x) for x in cols], "column", "value")


def describe(df: DataFrame, cols: Sequence[str] | None = None, decimals: int | None = 6) -> DataFrame:
    """``df.describe().T``: column, count, mean, std (n-1), min, p25, p50, p75, max.

    Moments are one partial aggregation over the (column-pruned) source;
    quantiles are selected exactly (``quantiles.exact_quantiles``)."""
    long = long_numeric(df, cols)
    stats = long.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"))
    qs = exact_quantiles(long, [0.25, 0.5, 0.75]).select(
        "column", F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75"))
    out = stats.join(qs, "column", "left")
    r = (lambda x: F.round(F.col(x), decimals)) if decimals is not None else F.col
    return out.select("column", "count", *[r(x).alias(x) for x in
                                           ("mean", "std", "min", "p25", "p50", "p75", "max")])


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Frequency per value, null excluded, count descending then value."""
    return df.where(c(col).isNotNull()).groupBy(c(col).alias(col)).agg(
        F.count("*").alias("count")).orderBy(F.desc("count"), F.col(col))


def imbalance(df: DataFrame, col: str) -> DataFrame:
    """min class count / max class count x 100."""
    vc = df.where(c(col).isNotNull()).groupBy(c(col)).agg(F.count("*").alias("n"))
    return vc.agg((F.min("n") / F.max("n") * 100).alias("imbalance_pct"),
                  F.min("n").alias("min_count"), F.max("n").alias("max_count"))


def head(df: DataFrame, key: str, n: int = 20) -> DataFrame:
    """First n rows by an explicit key (files have no order in Spark)."""
    return df.orderBy(c(key)).limit(n)


def corr_matrix(df: DataFrame, cols: Sequence[str] | None = None, decimals: int = 6) -> DataFrame:
    """Pearson correlation for every ordered pair (a, b), over the rows where both
    values exist, from blocked Gram matrices."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    return gram.correlations(df, cols).withColumn("r", F.round("r", decimals))


def category_vs_target(df: DataFrame, cat_cols: Sequence[str], target: str) -> DataFrame:
    """Per (column, level): rows, positives, positive rate."""
    long = df.select(c(target).alias("__y"), *[c(x).cast("string").alias(x) for x in cat_cols]
                     ).unpivot(["__y"], [c(x) for x in cat_cols], "column", "level")
    return long.groupBy("column", "level").agg(
        F.count("*").alias("n"), F.sum("__y").cast("long").alias("positives"),
        F.avg("__y").alias("rate"))


def histogram(df: DataFrame, cols: Sequence[str] | None = None, bins: int = 10) -> DataFrame:
    """Equal-width bins per numeric column on [min, max], last bin closed;
    empty bins are emitted (count 0).  Bin of x: ``floor((x-lo)/(hi-lo)*n)+1``
    clamped to n; lo = hi puts everything in bin 1."""
    long = long_numeric(df, cols)
    # one row per column, also of columns that are null throughout (no edges, counts 0)
    rng = long.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    j = long.where(F.col("value").isNotNull()).join(bounded_broadcast(rng), "column")
    width = F.col("hi") - F.col("lo")
    b = F.when(width == 0, F.lit(1)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / width * bins) + 1, F.lit(bins))).cast("int")
    counts = j.groupBy("column", b.alias("bin")).agg(F.count("*").alias("count"))
    grid = rng.select("column", "lo", "hi", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    edge = lambda k: F.col("lo") + width * (k - 1) / bins
    return grid.join(counts, ["column", "bin"], "left").select(
        "column", "bin",
        F.round(edge(F.col("bin")), 6).alias("bin_lo"),
        F.round(edge(F.col("bin") + 1), 6).alias("bin_hi"),
        F.coalesce("count", F.lit(0)).cast("long").alias("count"))


def scatter_pairs(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Every row as a point of every numeric pair (x, y): the data behind a
    scatter matrix, one ``explode`` per row (no join)."""
    pairs = list(combinations(cols, 2))
    arr = F.array(*[F.struct(F.lit(a).alias("x_col"), F.lit(b).alias("y_col"),
                             c(a).cast("double").alias("x"), c(b).cast("double").alias("y"))
                    for a, b in pairs])
    return df.select(c(key).alias(key), F.inline(arr))


def regression_lines(df: DataFrame, cols: Sequence[str], decimals: int = 6) -> DataFrame:
    """Least-squares line of y on x for every numeric pair: slope, intercept, r2."""
    found = gram.lines(df, cols)
    return found.select("x_col", "y_col", *[F.round(x, decimals).alias(x) for x in ("slope", "intercept", "r2")])


def transpose_small(df: DataFrame, id_col: str, value_cols: Sequence[str],
                    name_col: str = "field") -> DataFrame:
    """Rows <-> columns of a small summary: unpivot then pivot on ``id_col``.
    The pivot values are the ids seen (a small summary: bounded)."""
    long = df.select(c(id_col).cast("string").alias(id_col),
                     *[c(v).cast("double").alias(v) for v in value_cols]).unpivot(
        [c(id_col)], [c(v) for v in value_cols], name_col, "value")
    max_ids = 1000  # a transposed summary has one column per id: keep it small
    ids = sorted(r[0] for r in df.select(c(id_col).cast("string")).distinct().limit(max_ids + 1).collect())
    if len(ids) > max_ids:
        raise ValueError(f"transpose of more than {max_ids} rows: not a small summary")
    return long.groupBy(name_col).pivot(id_col, ids).agg(F.first("value"))
