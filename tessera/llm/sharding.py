"""Shards along a Hilbert curve over document metadata.

Several metadata dimensions (source, language, size, document number) are
quantised into 16 cells each, by quantiles over all documents (strings by their
rank); the cell numbers
are the coordinates of a point, whose position on the Hilbert curve orders the
documents.  Runs of the curve order become shards, so a shard holds a compact
region of every dimension at once and min/max statistics prune on any of them.

The order is total (curve index, text checksum, document number), so equal
texts with equal metadata stand together.  Positions come from
``operators.prefix``: ranges of the order, counts per range, offsets.

Defined results: null metadata takes the lowest cell of its dimension; a null
text has size 1 and the checksum of the empty text; repeated rows take
neighbouring places; an empty table gives an empty one; only the documented
columns are read, so other names cannot clash.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import text_or_empty
from tessera.operators.prefix import global_position, running_totals

SHARDS = 16
#: bits per dimension: 2**BITS cells
BITS = 4
DIMENSIONS = ("source", "lang", "size", "doc_id")


def curve_tables(n: int) -> tuple[list[int], list[int]]:
    """(digit, next state) by ``state * 2**n + point`` for one bit of each of
    ``n`` dimensions.  A state is the orientation of a sub-cube: its entry
    corner and its direction; the entry corners follow from the Gray code."""
    size, mask = 1 << n, (1 << n) - 1

    def rotated(x: int, by: int) -> int:
        by %= n
        return (x >> by | x << (n - by)) & mask

    gray = [i ^ (i >> 1) for i in range(size)]
    at = {g: i for i, g in enumerate(gray)}
    entry = [0] + [gray[2 * ((i - 1) // 2)] for i in range(1, size)]
    trailing_ones = [((i ^ (i + 1)) >> 1).bit_length() for i in range(size)]
    turn = [0] + [trailing_ones[i - 1 if i % 2 == 0 else i] % n for i in range(1, size)]
    digits, nexts = [], []
    for state in range(size * n):
        corner, direction = divmod(state, n)
        for point in range(size):
            i = at[rotated(point ^ corner, direction + 1)]
            digits.append(i)
            to = corner ^ rotated(entry[i], n - (direction + 1) % n)
            nexts.append(to * n + (direction + turn[i] + 1) % n)
    return digits, nexts


def curve_index(cells: list[Column], bits: int = BITS) -> Column:
    """Position on the Hilbert curve of integer cells (each below ``2**bits``)."""
    n = len(cells)
    digits, nexts = (F.split(F.lit(",".join(map(str, t))), ",").cast("array<int>") for t in curve_tables(n))
    points = []
    for b in reversed(range(bits)):
        point = F.lit(0)
        for k, cell in enumerate(cells):
            point = point.bitwiseOR(F.shiftleft(F.shiftright(cell, b).bitwiseAND(F.lit(1)), k))
        points.append(point.cast("int"))

    def step(acc: Column, point: Column) -> Column:
        where = acc["state"] * F.lit(1 << n) + point
        return F.struct(F.get(nexts, where).alias("state"),
                        (acc["at"] * F.lit(1 << n) + F.get(digits, where).cast("long")).alias("at"))

    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("at"))
    return F.aggregate(F.array(*points), start, step, lambda acc: acc["at"])


def string_cuts(facts: DataFrame, name: str, bits: int) -> list[str]:
    """Values that begin a new cell of a string column: the rank of a value is the
    number of rows below it (nulls first), its cell the share of the rank in all
    rows.  Ranks come from one count per value and a distributed running total; at
    most ``2**bits - 1`` values reach the driver."""
    counts = facts.groupBy(name).agg(F.count("*").alias("rows"))
    below = running_totals(counts, [name], ["rows"], inclusive=False)
    n = facts.count()
    cell = F.floor(F.col("cum_rows") * (1 << bits) / F.lit(max(n, 1)))
    found = below.where(F.col(name).isNotNull()).groupBy(cell.alias("cell")).agg(F.min(name).alias("cut")).collect()
    # the lowest value itself begins no cell, unless nulls lie below it
    return sorted(r["cut"] for r in found if r["cell"] > 0)


def quantised(facts: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS, bits: int = BITS) -> list[Column]:
    """Cell number of each dimension, by quantile cuts over all rows (at most
    ``2**bits - 1`` values per dimension reach the driver): numbers by their
    value, strings by their rank."""
    kinds = dict(facts.dtypes)
    numbers = [d for d in dimensions if kinds[d] != "string"]
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    value = lambda d: F.coalesce(F.col(d).cast("double"), F.lit(-1.0))  # noqa: E731  null is below everything
    cuts = facts.agg(*[F.percentile_approx(value(d), shares, 10000).alias(d) for d in numbers]).first() if numbers else {}
    cells = []
    for d in dimensions:
        if d in numbers:
            over = [value(d) >= F.lit(float(cut)) for cut in sorted(set(cuts[d] or []))]
        else:
            over = [F.coalesce(F.col(d) >= F.lit(cut), F.lit(False)) for cut in string_cuts(facts, d, bits)]
        cells.append(functools.reduce(Column.__add__, [x.cast("int") for x in over], F.lit(0)))
    return cells


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, curve_index)
    of every row; by the law ``rows``, shard sizes differ by one at most."""
    facts = docs.select(
        "doc_id", "source", "lang", (F.octet_length(text_or_empty()) + 1).cast("long").alias("size"),
        F.crc32(text_or_empty()).cast("long").alias("text_crc32"))
    points = facts.select(
        "doc_id", "size", "text_crc32", curve_index(quantised(facts)).alias("curve_index"))
    placed = global_position(points, ["curve_index", "text_crc32", "doc_id"], out="pos")
    n = int(docs.count())
    shard = F.expr(f"CAST((pos - 1) * {shards} DIV {max(n, 1)} AS INT)")
    first = F.expr(f"(shard * {n}L + {shards - 1}) DIV {shards}")
    return placed.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("pos") - 1 - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve_index")


def write_shards(docs: DataFrame, placed: DataFrame, path: str) -> None:
    """Write ``docs`` as one folder per shard, rows in curve order in each file;
    columns of ``docs`` that are called ``shard`` or ``slot`` are left out."""
    at = placed.select(F.col("doc_id").alias("__id"), F.col("text_crc32").alias("__crc"), "shard", "slot").dropDuplicates(
        ["__id", "__crc"])
    rows = docs.drop("shard", "slot").join(
        at, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.crc32(text_or_empty()) == F.col("__crc")))
    (rows.drop("__id", "__crc").repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
        .drop("slot").write.partitionBy("shard").parquet(path))
