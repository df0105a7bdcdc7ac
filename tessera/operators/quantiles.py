"""Exact quantiles by selection.

A mergeable sketch of each column brackets every target rank; further sketches
narrow brackets that still hold many rows; one exact counting pass then groups
only the values inside the brackets, and counts what lies between them.  The
rows that this leaves per column are bounded by ``LIMIT`` per target, whatever
the table's size, and nothing is written per distinct value.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.features import bounded_broadcast
from tessera.session import cut_lineage

#: steps of the grid of sketched quantiles, and the sketch's accuracy (ranks
#: are off by n / ACCURACY at most)
GRID, ACCURACY = 1024, 1 << 12
#: rows a bracket may hold for the counting pass, besides those of its ends
LIMIT = 1 << 16


def _sketch():
    return F.percentile_approx("value", [i / GRID for i in range(GRID + 1)], ACCURACY).alias("grid")


def _narrowed(stats: DataFrame, group: str) -> DataFrame:
    """(group, n, prob, lo, hi, size) from rows with the exact counts ``below`` and
    ``inside`` of a bracket and the sketch of what it holds.  ``size`` bounds the
    rows between the new ends."""
    h = (F.col("n") - 1) * F.col("prob")
    at = lambda r: (r - F.col("below")) / F.col("inside") * GRID
    # a step of the grid is four times the sketch's error; two ranks more where
    # a step is less than one
    low = F.greatest(F.floor(at(F.floor(h) - 2)) - 2, F.lit(0)).cast("int")
    high = F.least(F.ceil(at(F.ceil(h) + 3)) + 2, F.lit(GRID)).cast("int")
    size = F.ceil((high - low + 1) / GRID * F.col("inside"))
    return stats.select(group, "n", "prob", F.get("grid", low).alias("lo"), F.get("grid", high).alias("hi"), size.cast("long").alias("size"))


def brackets(rows: DataFrame, probs: Sequence[float], group: str, limit: int) -> DataFrame:
    """One row per group and target: the ends of a bracket with at most ``limit``
    (20 or more) rows inside."""
    first = rows.groupBy(group).agg(F.count("*").alias("n"), _sketch()).select(
        "*", F.lit(0).alias("below"), F.col("n").alias("inside"),
        F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"))
    found = cut_lineage(_narrowed(first, group))
    while (found.agg(F.max(F.when(F.col("lo") < F.col("hi"), F.col("size")))).first()[0] or 0) > limit:
        wide = found.where((F.col("size") > limit) & (F.col("lo") < F.col("hi")))
        # ends with many equal rows are taken off first: between them a sketch sees other values
        inner = rows.join(bounded_broadcast(wide), group).where("value <= hi")
        stats = inner.groupBy(group, "n", "prob", "lo", "hi").agg(
            F.count_if(F.col("value") < F.col("lo")).alias("below"), F.count_if(F.col("value") == F.col("lo")).alias("low"),
            F.count_if((F.col("value") > F.col("lo")) & (F.col("value") < F.col("hi"))).alias("inside"),
            F.percentile_approx(F.when((F.col("value") > F.col("lo")) & (F.col("value") < F.col("hi")), F.col("value")),
                                [i / GRID for i in range(GRID + 1)], ACCURACY).alias("grid"))
        h = (F.col("n") - 1) * F.col("prob")
        past = F.col("below") + F.col("low")              # rows up to the lower end
        on_low, on_high = F.ceil(h) < past, F.floor(h) >= past + F.col("inside")
        whole = (F.floor(h) >= past) & (F.ceil(h) < past + F.col("inside"))
        narrow = _narrowed(stats.where(whole).withColumn("below", past), group)
        # a target on an end, or with its two ranks on either side of one
        rest = stats.where(~whole).select(
            group, "n", "prob", F.when(on_high, F.col("hi")).when(F.floor(h) >= past, F.element_at("grid", -1)).otherwise(F.col("lo")).alias("lo"),
            F.when(on_low, F.col("lo")).when(F.ceil(h) < past + F.col("inside"), F.get("grid", F.lit(0))).otherwise(F.col("hi")).alias("hi"),
            F.lit(0).cast("long").alias("size"))
        done = found.where(~((F.col("size") > limit) & (F.col("lo") < F.col("hi"))))
        found = cut_lineage(done.unionByName(narrow).unionByName(rest))
    return found


def exact_quantiles(long: DataFrame, probs: Sequence[float], group: str = "column", value: str = "value",
                    limit: int = LIMIT) -> DataFrame:
    """(group, q0, q1, ...): quantiles with linear interpolation (pandas /
    ``quantile_cont``) of the non-null values per group:
    ``h = (n-1) q``, result ``v[floor h] + (v[ceil h] - v[floor h]) (h - floor h)``.
    A group without values has no row."""
    rows = long.where(F.col(value).isNotNull()).select(group, (F.col(value) + 0.0).alias("value"))
    found = brackets(rows, probs, group, limit)
    # per group: the ends of the targets' brackets, side by side
    ends = found.groupBy(group).agg(F.max("n").alias("n"), *[
        F.max(F.when(F.col("prob") == float(p), F.col(x))).alias(f"{x}{i}") for i, p in enumerate(probs) for x in ("lo", "hi")])
    # the place of a row: how many brackets end below it, then its value where it
    # lies in one; rows between brackets only count
    v, each = F.col("value"), range(len(probs))
    zone = functools.reduce(Column.__add__, [(F.col(f"hi{i}") < v).cast("int") for i in each])
    inside = functools.reduce(Column.__or__, [(F.col(f"lo{i}") <= v) & (v <= F.col(f"hi{i}")) for i in each])
    counts = rows.join(bounded_broadcast(ends), group).groupBy(
        group, "n", zone.alias("zone"), F.when(inside, v).alias("value")).agg(F.count("*").alias("cnt"))
    # at most LIMIT rows and a few for each target
    upto = F.sum("cnt").over(Window.partitionBy(group).orderBy("zone", F.asc_nulls_first("value")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    ranked = counts.select("*", upto.alias("upto"))
    first, last = F.col("upto") - F.col("cnt"), F.col("upto") - 1
    at = lambda r: F.max(F.when((first <= r) & (r <= last), F.col("value")))
    aggs = []
    for i, p in enumerate(probs):
        h = (F.col("n") - 1) * F.lit(float(p))
        aggs += [at(F.floor(h)).alias(f"lo{i}"), at(F.ceil(h)).alias(f"hi{i}"), F.max(h - F.floor(h)).alias(f"part{i}")]
    out = ranked.groupBy(group).agg(*aggs)
    low, high, part = ([F.col(f"{x}{i}") for i in range(len(probs))] for x in ("lo", "hi", "part"))
    missed = lambda i: F.raise_error(F.lit("a target rank lies outside its bracket")).cast("double")
    return out.select(group, *[
        F.when(low[i].isNull() | high[i].isNull(), missed(i)).when(low[i] == high[i], low[i]).otherwise(
            low[i] + (high[i] - low[i]) * part[i]).alias(f"q{i}") for i in range(len(probs))])
