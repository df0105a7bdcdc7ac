"""Distributed running totals (prefix sums) without a single-task window.

A window ``ORDER BY x`` without ``PARTITION BY`` moves every row to one task,
and one hot group does the same with ``PARTITION BY``.  Here the rows are laid
out in ranges of (group, order) first, the same way at every size:

1. ``repartitionByRange`` over (group, order) and one write to the shared
   folder, with the range number stored as a column: a task that is run again
   later reads the stored number, so no boundary can move;
2. totals per (range, group) - about ``ranges + groups`` rows;
3. their exclusive running sum per group: the offset of a range;
4. running sum inside (range, group), plus the offset.

A hot group spreads over as many ranges as its rows fill.  Null groups and
null order keys are ordinary values (nulls order first); all joins are null-safe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import c
from tessera.session import cut_lineage, input_bytes, shuffle_partitions

RANGE = "__range"
RANGE_BYTES = 64 << 20   # input bytes per range


def range_count(df: DataFrame) -> int:
    """Ranges for ``df``: one per ``RANGE_BYTES`` of its input and at least one
    per shuffle partition; no upper limit."""
    return max(2, shuffle_partitions(df.sparkSession), -(-input_bytes(df) // RANGE_BYTES))


def laid_out(df: DataFrame, keys: Sequence[str | Column], n_ranges: int | None = None) -> DataFrame:
    """``df`` written in ranges of ``keys``, with the range number in ``__range``.

    Rows that are equal in all keys share a range: end the keys with a unique
    column where many rows may tie.  An empty input gives an empty table."""
    n = n_ranges or range_count(df)
    return cut_lineage(df.repartitionByRange(n, *keys).withColumn(RANGE, F.spark_partition_id()))


def running_totals(
    df: DataFrame,
    order_by: Sequence[str | Column],
    values: Sequence[str],
    partition_by: Sequence[str] = (),
    n_buckets: int | None = None,
    prefix: str = "cum_",
    inclusive: bool = True,
) -> DataFrame:
    """Add ``<prefix><v>`` = sum of ``v`` over rows of the same ``partition_by``
    group that come before the row (and the row itself when ``inclusive``) in
    ``order_by`` order, a total order inside a group (add a unique key to
    break ties).  Null groups are a group; null order keys come first."""
    part = list(partition_by)
    order = [c(o) for o in order_by]
    laid = laid_out(df, [*[c(p) for p in part], *order], n_buckets)
    own = Window.partitionBy(RANGE, *[c(p) for p in part]).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    inner = laid.select("*", *[
        F.coalesce(F.sum(c(v)).over(own), F.lit(0)).alias(f"__in_{i}") for i, v in enumerate(values)])
    totals = laid.groupBy(RANGE, *[c(p) for p in part]).agg(
        *[F.sum(c(v)).alias(f"__t{i}") for i, v in enumerate(values)])
    before = Window.partitionBy(*[c(p) for p in part]).orderBy(RANGE).rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col(RANGE).alias("__o_range"), *[c(p).alias(f"__o_part{i}") for i, p in enumerate(part)],
        *[F.coalesce(F.sum(f"__t{i}").over(before), F.lit(0)).alias(f"__off_{i}")
          for i, _ in enumerate(values)])
    on = F.col(RANGE) == F.col("__o_range")
    for i, p in enumerate(part):
        on = on & c(p).eqNullSafe(F.col(f"__o_part{i}"))
    return inner.join(offsets, on).select(
        *[c(x) for x in df.columns],
        *[(F.col(f"__off_{i}") + F.col(f"__in_{i}")).alias(f"{prefix}{v}") for i, v in enumerate(values)])


def global_position(df: DataFrame, order_col: str | Sequence[str], partition_by: Sequence[str] = (),
                    out: str = "pos", n_buckets: int | None = None) -> DataFrame:
    """1-based row number by ``order_col`` (unique inside a group) without a
    single-partition window."""
    order = [order_col] if isinstance(order_col, str) else list(order_col)
    tmp = df.withColumn("__one", F.lit(1).cast("long"))
    res = running_totals(tmp, order, ["__one"], partition_by=partition_by,
                         n_buckets=n_buckets, prefix="__cum")
    return res.withColumnRenamed("__cum__one", out).drop("__one")
