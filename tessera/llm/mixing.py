"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, the
source's target over its size.  Documents stand in order of size inside their
source; the prefix sum of expected copies plus one random offset per source
crosses integers, and a document is taken once per integer it crosses.  The
order by size makes the words taken follow the target closely.  The random
offset is a hash of the source, so runs agree.

Targets share a given percentage of all words by weight; no target exceeds
``cap`` times its source, and what is cut off goes to the other sources by
weight until none is above its limit.

Defined results: a null text has size 0; a null source is a source of its own,
ordered last; sources without words take nothing; repeated rows are rows of
their own; an empty table gives an empty one; only the documented columns are
read, so other names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, text_or_empty
from tessera.operators.prefix import global_position
from tessera.session import cut_lineage

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
CAP = 2
SEED = "mixing"


def offset(source: Column) -> Column:
    """The random offset in [0, 1) of a source."""
    digest = F.md5(F.concat(F.lit(SEED), F.lit("|"), F.coalesce(source, F.lit("\0null"))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_percent: int = SHARE_PERCENT,
                   cap: int = CAP) -> DataFrame:
    """(source, source_size, target, rate) from (source, size).

    The water level (words per unit of weight) rises until no further source
    reaches its limit; every step is one aggregation over the source table."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("last", F.col("source").isNull())
    per = global_position(per, ["last", "source"], out="place")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), ((F.col("place") - 1) % len(weights)).cast("int"))
    per = cut_lineage(per.select("source", "source_size", weight.alias("weight")))
    limit = F.lit(cap) * F.col("source_size")
    total = per.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        at_limit = F.lit(full >= 0) & (F.lit(level) * F.col("weight") >= limit)
        cut = F.coalesce(F.sum(F.when(at_limit, limit)), F.lit(0))
        n, taken, rest = per.agg(
            F.coalesce(F.sum(at_limit.cast("long")), F.lit(0)), cut,
            F.coalesce(F.sum(F.when(~at_limit, F.col("weight"))), F.lit(0))).first()
        if n == full or not rest:
            break
        full, level = n, (share_percent * total / 100 - taken) / rest
    # with every source at its limit, all targets are the limits
    target = F.least(F.lit(float(level)) * F.col("weight"), limit.cast("double")) if rest else limit.cast("double")
    return per.select("source", "source_size", target.alias("target")).withColumn(
        "rate", F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0)))


def copies(docs: DataFrame) -> DataFrame:
    """(doc_id, source, text_crc32, size, source_size, target, copies) of every row."""
    sized = cut_lineage(docs.select(
        "doc_id", "source", F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"),
        F.crc32(text_or_empty()).alias("text_crc32")))
    targets = source_targets(sized)
    ordered = sized.select("*", (-F.col("size")).alias("largest"), F.md5(F.col("doc_id").cast("string")).alias("dice"))
    placed = global_position(ordered, ["largest", "dice", "doc_id", "text_crc32"], partition_by=["source"], out="pos")
    known = targets.select(F.col("source").alias("of"), "source_size", "target", "rate")
    joined = placed.join(known, F.col("source").eqNullSafe(F.col("of")))
    crossed = [F.floor(offset(F.col("source")) + F.col("rate") * (F.col("pos") - k)) for k in (0, 1)]
    return joined.select("doc_id", "source", "text_crc32", "size", "source_size", "target",
                         (crossed[0] - crossed[1]).cast("long").alias("copies"))


def mix_report(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row."""
    return copies(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken."""
    # one 128-bit key without nulls for the join and the numbering of equal
    # rows, so that texts move once
    what = [F.col("doc_id"), F.col("source"), F.col("text_crc32")]
    key = {"k1": F.xxhash64(*what), "k2": F.xxhash64(F.lit(1), *what)}
    rows = docs.select("doc_id", "source", F.crc32(text_or_empty()).alias("text_crc32"), F.struct("*").alias("row"),
                       F.spark_partition_id().alias("part"))
    rows = rows.withColumns(key).select("k1", "k2", "row", "part")
    taken = cut_lineage(copies(docs).withColumns(key).groupBy("k1", "k2").agg(
        F.sum("copies").alias("copies"), F.count("*").alias("rows")))
    joined = rows.join(taken, ["k1", "k2"])
    if taken.where("rows > 1").head(1):
        joined = _numbered(joined)
    else:
        joined = joined.withColumn("nth", F.lit(1))
    # equal rows share their copies evenly
    own = F.expr("CAST(copies DIV rows + IF(nth <= copies % rows, 1, 0) AS INT)")
    return joined.withColumn("own", own).where("own > 0").select(
        "row", F.explode(F.sequence(F.lit(1), F.col("own"))).alias("copy")).select("row.*")


def _numbered(joined: DataFrame) -> DataFrame:
    """``nth``: the place of a row among the rows of its key.  Rows are numbered
    inside the partition they were read from, behind the counts of the partitions
    before it: a row that is repeated in a third of the table is never one task's."""
    written = cut_lineage(joined)
    counts = written.where("rows > 1").groupBy("k1", "k2", "part").agg(F.count("*").alias("here"))
    before = F.sum("here").over(Window.partitionBy("k1", "k2").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("k1", "k2", "part", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("k1", "k2", "part").orderBy(F.lit(1)))
    several = written.where("rows > 1").join(offsets, ["k1", "k2", "part"]).withColumn("nth", F.col("before") + inside).drop("before")
    return written.where("rows = 1").withColumn("nth", F.lit(1).cast("long")).unionByName(several)
