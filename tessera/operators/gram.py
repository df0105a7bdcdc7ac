"""Correlations and regression lines of wide tables from blocked Gram matrices.

For every pair of columns the sums over the rows where both have a value (count,
sums, squares, product) are entries of four matrix products of the values and of
the 0/1 matrix of what is there.  Columns are taken in blocks: a pass reads two
blocks, adds up the products of its Arrow batches with NumPy, and each task ends
with one row per pair; tasks are merged before that, so what is shuffled grows with
the pairs and not with the rows.  Values enter less their column's mean, so large
means do not cancel.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import c

#: columns of a block: a task holds four matrices of twice as many columns
BLOCK = 512
#: tasks per core that add up products
TASKS_PER_CORE = 4

SUMS = "a int, b int, n long, sa double, sb double, saa double, sbb double, sab double"


def _pass(df: DataFrame, cols: Sequence[str], shift: Sequence[float], left: range, right: range) -> DataFrame:
    """``SUMS`` of the pairs (a in left, b in right, a <= b), per task."""
    used = sorted({*left, *right})
    at = {x: i for i, x in enumerate(used)}
    pairs = np.array([(a, b) for a in left for b in right if a <= b], np.int32).reshape(-1, 2)
    ia, ib = np.array([at[a] for a in pairs[:, 0]], int), np.array([at[b] for b in pairs[:, 1]], int)
    moved = np.array([shift[x] for x in used])
    schema = pa.schema([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64()), *[(x, pa.float64()) for x in ("sa", "sb", "saa", "sbb", "sab")]])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(used)
        there, once, square, product = (np.zeros((k, k)) for _ in range(4))
        for batch in batches:
            x = np.stack([col.to_numpy(zero_copy_only=False) for col in batch.columns], axis=1).astype(np.float64)
            m = ~np.isnan(x)
            x = np.where(m, x - moved, 0.0)
            m = m.astype(np.float64)
            there += m.T @ m
            once += x.T @ m
            square += (x * x).T @ m
            product += x.T @ x
        if there.any():
            yield from pa.table([
                pairs[:, 0], pairs[:, 1], there[ia, ib].astype(np.int64), once[ia, ib], once[ib, ia], square[ia, ib], square[ib, ia],
                product[ia, ib]], schema=schema).to_batches(max_chunksize=1 << 16)

    rows = df.select(*[c(cols[x]).cast("double").alias(f"c{x}") for x in used])
    cores = df.sparkSession.sparkContext.defaultParallelism
    return rows.coalesce(TASKS_PER_CORE * cores).mapInArrow(sums, SUMS)


def pair_moments(df: DataFrame, cols: Sequence[str], block: int = BLOCK) -> DataFrame:
    """(a, b, n, ma, mb, caa, cbb, cab) of every pair of column numbers a <= b:
    means and centred sums over the rows where both columns have a value (null and
    NaN are no values).  Pairs without such a row are left out."""
    # one number per column
    means = df.agg(*[F.avg(F.nanvl(c(x).cast("double"), F.lit(None).cast("double"))).alias(f"m{i}") for i, x in enumerate(cols)]).first()
    shift = [float(means[i] or 0.0) for i in range(len(cols))]
    blocks = [range(i, min(i + block, len(cols))) for i in range(0, len(cols), block)]
    parts = [_pass(df, cols, shift, p, q) for i, p in enumerate(blocks) for q in blocks[i:]]
    names = ("n", "sa", "sb", "saa", "sbb", "sab")
    total = functools.reduce(DataFrame.unionAll, parts).groupBy("a", "b").agg(*[F.sum(x).alias(x) for x in names]).where("n > 0")
    moved = F.array(*[F.lit(x) for x in shift])
    n = F.col("n").cast("double")
    mean = lambda s, i: F.col(s) / n + F.get(moved, F.col(i))
    centred = lambda s, x, y: F.col(s) - F.col(x) * F.col(y) / n
    return total.select("a", "b", "n", mean("sa", "a").alias("ma"), mean("sb", "b").alias("mb"), centred("saa", "sa", "sa").alias("caa"),
                        centred("sbb", "sb", "sb").alias("cbb"), centred("sab", "sa", "sb").alias("cab"))


def _name(cols: Sequence[str], number: str):
    return F.get(F.array(*[F.lit(x) for x in cols]), F.col(number))


def _spread(x: str, mean: str):
    """A centred sum, 0 where only rounding is left of it."""
    return F.when(F.col(x) > 1e-24 * F.col("n") * F.col(mean) * F.col(mean), F.col(x)).otherwise(0.0)


def correlations(df: DataFrame, cols: Sequence[str], block: int = BLOCK) -> DataFrame:
    """(a, b, r) of every ordered pair of columns; null where a side is constant
    or no row has both."""
    found = pair_moments(df, cols, block)
    root = F.sqrt(_spread("caa", "ma")) * F.sqrt(_spread("cbb", "mb"))
    r = F.try_divide(F.col("cab"), root)
    r = F.when(F.col("a") == F.col("b"), F.when(r.isNotNull(), 1.0)).otherwise(F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0)))
    half = found.select("a", "b", F.when(root > 0, r).alias("r"))
    # pairs without a common row: every pair of column numbers once
    every = df.sparkSession.range(len(cols) * len(cols)).select(
        F.floor(F.col("id") / len(cols)).cast("int").alias("a"), F.pmod("id", F.lit(len(cols))).cast("int").alias("b"))
    both = half.unionAll(half.where("a < b").select(F.col("b").alias("a"), F.col("a").alias("b"), "r"))
    return every.join(both, ["a", "b"], "left").select(_name(cols, "a").alias("a"), _name(cols, "b").alias("b"), "r")


def lines(df: DataFrame, cols: Sequence[str], block: int = BLOCK) -> DataFrame:
    """(x_col, y_col, slope, intercept, r2) of the least-squares line of the later
    column on the earlier, for every pair; nulls where x is constant, r2 1 where y is."""
    found = pair_moments(df, cols, block).where("a < b")
    sxx, syy = _spread("caa", "ma"), _spread("cbb", "mb")
    slope = F.try_divide(F.col("cab"), sxx)
    r2 = F.when(sxx > 0, F.when(syy > 0, F.try_divide(F.col("cab") * F.col("cab"), sxx * syy)).otherwise(1.0))
    every = df.sparkSession.range(len(cols) * len(cols)).select(
        F.floor(F.col("id") / len(cols)).cast("int").alias("a"), F.pmod("id", F.lit(len(cols))).cast("int").alias("b")).where("a < b")
    fitted = found.select("a", "b", slope.alias("slope"), (F.col("mb") - slope * F.col("ma")).alias("intercept"), r2.alias("r2"))
    return every.join(fitted, ["a", "b"], "left").select(_name(cols, "a").alias("x_col"), _name(cols, "b").alias("y_col"), "slope", "intercept", "r2")
