"""Lookups, best-of, top-k and ranking.

Global top-k uses ``orderBy().limit(k)`` (TakeOrderedAndProject: every task
keeps k rows, the final merge sees k x tasks).  Per-group top-k is two-phase
with a salt so that a group holding a third of the rows is still spread over
many tasks before its k winners are merged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import c
from tessera.operators.features import bounded_broadcast

SALT_BUCKETS = 64


def top_k_list_text(df: DataFrame, item: str, order: Sequence[Column], k: int,
                    sep: str = ", ", out: str = "text") -> DataFrame:
    """First ``k`` items in ``order`` joined by ``sep`` (one row)."""
    top = df.orderBy(*order).limit(k)
    # at most k rows remain: ranking them in one window is bounded
    ranked = top.select(c(item).alias("__item"), F.row_number().over(Window.orderBy(*order)).alias("__rn"))
    return ranked.agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("__rn", "__item"))), lambda s: s["__item"]), sep).alias(out))


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
                    salt_buckets: int = SALT_BUCKETS, salt_col: str | Column | None = None,
                    rank_col: str = "rank") -> DataFrame:
    """k first rows of every group in ``order`` (ties broken by the order
    list, which should end with a unique key).

    Phase 1 ranks inside (group, salt) — salt from ``salt_col`` (default: a
    hash of every column) — and keeps k rows each; phase 2 ranks the
    <= k x salt_buckets survivors of each group.
    """
    g = list(group)
    salt_src = F.xxhash64(*[c(x) for x in df.columns]) if salt_col is None else (
        c(salt_col) if isinstance(salt_col, str) else salt_col)
    salted = df.withColumn("__salt", F.pmod(salt_src, F.lit(salt_buckets)))
    w1 = Window.partitionBy(*g, "__salt").orderBy(*order)
    cand = salted.withColumn("__r1", F.row_number().over(w1)).where(F.col("__r1") <= k).drop(
        "__r1", "__salt")
    w2 = Window.partitionBy(*g).orderBy(*order)
    return cand.withColumn(rank_col, F.row_number().over(w2)).where(F.col(rank_col) <= k)


def first_max_row(df: DataFrame, metric: str, pos: str, group: Sequence[str] = ()) -> DataFrame:
    """Row with the largest ``metric``, first position on ties
    (``idxmax``/``np.argmax``): ``max_by`` on (metric, -pos) — one
    partial aggregation, no sort of the data."""
    others = [x for x in df.columns if x not in group]
    key = F.struct(c(metric).alias("m"), (-c(pos)).alias("p"))
    best = df.groupBy(*group).agg(F.max_by(F.struct(*[c(x) for x in others]), key).alias("__b"))
    return best.select(*group, *[F.col("__b")[x].alias(x) for x in others])


def rank_within(df: DataFrame, part: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``rank`` and ``dense_rank`` per partition — for small report tables
    (one row per model and metric)."""
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn("rank", F.rank().over(w)).withColumn("dense_rank", F.dense_rank().over(w))


def join_dimension(df: DataFrame, dim: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Lookup in a dimension (a class-name list, a weight per class); broadcast
    when its row count allows."""
    return df.join(bounded_broadcast(dim), on=key, how=how)
