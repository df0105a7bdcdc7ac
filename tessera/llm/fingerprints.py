"""Document fingerprints from spot signatures.

A spot is an occurrence of a common word (an anchor); its signature is the
chain of the next content words behind it.  The set of a document's signatures,
as sorted 32-bit hashes in hex, is its fingerprint; fingerprints are compared by
Jaccard similarity above a floor.  Sets whose lengths lie too far apart cannot
reach it: lengths fall into partitions that grow by the factor 1/floor, and only
sets of one partition or of neighbouring ones are compared, portion by portion,
until what is left of them can no longer bring the floor.

``fingerprint_next`` compares each document in this way with an edited copy of
itself and with the next document in descending ``doc_id`` order; a likeness
below ``FLOOR`` is 0.  Rows are cut into ranges of ``doc_id``; the first row of a
range is sent to the range before it as well, so each range is read once, in
order, without any other exchange of texts.  Rows without a doc_id, and rows that
share one, are spread over as many ranges as they fill by a hash of the text
(repeats of one row lie in one range, which is streamed).

``similar_pairs`` searches all fingerprints: equal ones are one class
(``classes``), partners share a signature among their rarest (prefix), lie in the
same or the next partition, and are verified on whole sets.

Defined results: null texts are empty; a text without words has the empty
fingerprint, and two empty fingerprints are alike (1.0); a text without an
anchor takes the chains of all its words; rows with equal doc_id follow each
other by a hash of the text, then by text; null doc_ids come last; a table of one
row is its own next; an empty table gives an empty one; only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import give_back, partitions_for, small_batches, text_or_empty
from tessera.session import cut_lineage

#: common words of English, German, French and Spanish
ANCHORS = frozenset("""
a an and are as at be by for from in is it of on that the this to was with
das dem den der des die ein eine ist mit und von zu
au avec ce dans des du en est et il la le les pour que qui sur un une
como con del el en es la las lo los no para por que se su un una y
""".split())
CHAIN = 2
#: likeness below which two fingerprints count as unlike
FLOOR = 0.05
#: input bytes in a range of doc_id; a range is streamed
RANGE_BYTES = 16 << 20
#: signatures of the longer set that are looked at together
PORTION = 512
MAX_WORDS = 300_000

_WORD = re.compile(r"\w+")


class _Words(dict):
    """Hash of a word; the lowest bit marks anchors."""

    def __missing__(self, word: str) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word) & ~1 | (word in ANCHORS)
        return h


_words = _Words()


def signatures(text: str) -> np.ndarray:
    """Sorted distinct 32-bit spot signatures of a text."""
    words = _WORD.findall(text.lower())
    if not words:
        return np.zeros(0, "<u4")
    if len(_words) > MAX_WORDS:
        _words.clear()
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    anchor = (h & np.uint64(1)).astype(bool)
    content = np.flatnonzero(~anchor)
    spots = np.flatnonzero(anchor)
    nth = np.searchsorted(content, spots)
    spots, nth = spots[nth + CHAIN <= len(content)], nth[nth + CHAIN <= len(content)]
    out = h[spots]
    if not len(spots):
        # no anchor with a whole chain behind it: the chains of all words
        size = min(CHAIN, len(h))
        nth, content = np.arange(len(h) - size + 1), np.arange(len(h))
        out = np.zeros(len(nth), np.uint64)
    else:
        size = CHAIN
    for k in range(size):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + h[content[nth + k]]
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return np.unique((out >> np.uint64(32)).astype("<u4"))


def partition_of(n: int, floor: float) -> int:
    """Partition of a set length: sets that reach ``floor`` lie in one or in neighbours."""
    return math.floor(math.log(max(n, 1)) / math.log(1 / floor) + 1e-9)


def likeness(a: np.ndarray, b: np.ndarray, floor: float = FLOOR) -> float:
    """Jaccard similarity of two sorted signature sets, 0 below ``floor``."""
    if len(a) > len(b):
        a, b = b, a
    if not len(b):
        return 1.0
    if not len(a) or partition_of(len(b), floor) - partition_of(len(a), floor) > 1 or len(a) < floor * len(b):
        return 0.0
    # shared / (|a| + |b| - shared) >= floor
    least = math.ceil(floor * (len(a) + len(b)) / (1 + floor) - 1e-9)
    shared = begin = 0
    for k in range(0, len(b), PORTION):
        part = b[k : k + PORTION]
        end = int(np.searchsorted(a, part[-1], side="right"))
        both = np.sort(np.concatenate([a[begin:end], part]))
        shared += int((both[1:] == both[:-1]).sum())
        begin = end
        if shared + min(len(a) - end, len(b) - k - len(part)) < least:
            return 0.0
    return shared / (len(a) + len(b) - shared)


def as_text(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


def edited(text: str, following: str) -> str:
    """The last third of ``text`` replaced by the beginning of ``following``."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of a range in order, then the first rows of the next range."""
    held = None   # the row that waits for the one behind it
    for batch in batches:
        out = []
        for rng, tail, doc_id, text in zip(batch["rng"], batch["tail"], batch["doc_id"], batch["text"], strict=True):
            if held is None and tail:
                continue
            sig = signatures(text)
            if held is not None and held[0] == rng:
                changed = edited(held[2], text)
                changed_sig = signatures(changed)
                out.append((held[1], len(held[2]), hashlib.sha256(changed.encode()).hexdigest(), as_text(held[3]),
                            as_text(changed_sig), likeness(held[3], changed_sig), likeness(held[3], sig)))
            held = None if tail else (rng, None if pd.isna(doc_id) else int(doc_id), text, sig)
        names = [c.split()[0] for c in RESULT.split(", ")]
        yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})
    _words.clear()
    give_back()


def _listed(values: list, kind: str, at: Column) -> Column:
    """Element ``at`` of a list, one entry a range."""
    return F.get(F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>"), at)


def _ranges(rows: DataFrame, n: int) -> tuple[DataFrame, int]:
    """``rows`` with ``rng``, their range in descending order of doc_id (null last),
    and the number of ranges, at least ``n`` where there are as many rows."""
    shares = [i / n for i in range(1, n)]
    found = shares and rows.select(F.percentile_approx(F.col("doc_id").cast("double"), shares, 20 * n)).first()[0] or []
    # a doc_id that fills several shares gets a bucket of its own
    alone = [x + 1 for x, y in zip(found, found[1:], strict=False) if x == y]
    splits = [float("-inf"), *sorted({*found, *alone} or {0.0}), float("inf")]
    cut = Bucketizer(splits=splits, inputCol="number", outputCol="bucket", handleInvalid="keep")
    last = len(splits) - 1   # the bucket of null numbers
    bucketed = cut.transform(rows.withColumn("number", F.coalesce(F.col("doc_id").cast("double"), F.lit(0.0)))).withColumn(
        "bucket", F.when(F.col("doc_id").isNull(), last).otherwise(F.col("bucket").cast("int")))
    seen = {r[0]: r[1:] for r in bucketed.groupBy("bucket").agg(F.count("*"), F.min("doc_id"), F.max("doc_id")).collect()}
    fair = max(1, sum(r[0] for r in seen.values()) // n)
    parts, begin, total = [1] * (last + 1), [0] * (last + 1), 0
    for bucket in [*range(last - 1, -1, -1), last]:
        rows_in, low, high = seen.get(bucket, (0, None, None))
        begin[bucket] = total
        parts[bucket] = -(-rows_in // fair) if rows_in and low == high else 1
        total += parts[bucket] if rows_in else 0
    if total == len(seen):
        within = F.lit(0)
    else:
        # place of the hash among all numbers of 64 bits
        k = _listed(parts, "int", F.col("bucket"))
        within = F.least(k - 1, F.floor((F.xxhash64("text") / F.lit(2.0**64) + 0.5) * k)).cast("int")
    return bucketed.select("doc_id", "text", (_listed(begin, "int", F.col("bucket")) + within).alias("rng")), max(1, total)


def fingerprint_next(docs: DataFrame) -> DataFrame:
    """The columns of ``RESULT`` for every row of ``docs``."""
    small_batches(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    ranged, n = _ranges(rows, partitions_for(docs, RANGE_BYTES))
    # the first row of each range, by descending doc_id and hash of the text
    place = F.struct(F.bitwise_not("doc_id").alias("down"), F.xxhash64("text").alias("hash"))
    firsts = {r[0]: r[1] for r in ranged.groupBy("rng").agg(F.min(place)).collect()}
    order = sorted(firsts)
    before = {r: order[i - 1] for i, r in enumerate(order)}
    is_head = F.xxhash64("text") == _listed([firsts[i]["hash"] if i in firsts else 0 for i in range(n)], "long", F.col("rng"))
    down = _listed([firsts[i]["down"] or 0 if i in firsts else 0 for i in range(n)], "long", F.col("rng"))
    is_head &= F.col("doc_id").isNull() | (F.bitwise_not("doc_id") == down)
    own = F.struct(F.col("rng").alias("rng"), F.lit(False).alias("tail"))
    ahead = F.struct(_listed([before.get(i, 0) for i in range(n)], "int", F.col("rng")).alias("rng"), F.lit(True).alias("tail"))
    sent = ranged.select("doc_id", "text", F.explode(F.when(is_head, F.array(own, ahead)).otherwise(F.array(own))).alias("at"))
    laid = sent.select("at.*", "doc_id", "text").repartitionById(n, "rng").sortWithinPartitions(
        "rng", "tail", F.desc_nulls_last("doc_id"), F.xxhash64("text"), "text")
    return laid.mapInPandas(_compare, RESULT)


def classes(prints: DataFrame) -> DataFrame:
    """(doc_id, class) of every row (doc_id, fingerprint): the smallest doc_id with an
    equal fingerprint."""
    least = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("class"))
    return prints.join(least, "fingerprint").select("doc_id", "class")


def similar_pairs(prints: DataFrame, percent: int = 50) -> DataFrame:
    """Pairs (a, b), a < b, of classes of rows (doc_id, fingerprint) whose
    fingerprints reach ``percent`` similarity, with it; empty fingerprints pair with
    nothing.  ``classes`` names the members, so copies are never expanded.

    Partitions of set length grow by the factor 100/percent, so partners lie in
    the same or the next one; partners share one of their rarest signatures
    (prefix), and what the lengths allow is verified on the whole sets."""
    t = percent / 100
    sets = prints.where((F.length("fingerprint") > 0) & F.col("doc_id").isNotNull()).groupBy("fingerprint").agg(
        F.min("doc_id").alias("doc_id"))
    sets = sets.select("doc_id", F.expr("transform(sequence(1, length(fingerprint), 8), i -> substring(fingerprint, i, 8))").alias("sig"))
    sets = sets.withColumn("n", F.size("sig")).withColumn(
        "part", F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(1 / t))) + 1e-9).cast("int"))
    sets = cut_lineage(sets)
    each = sets.select("doc_id", "n", "part", F.explode("sig").alias("key"))
    # the rarest signatures of each set first; one that no other set has cannot meet a partner
    often = each.groupBy("key").agg(F.count("*").alias("of"))
    ranked = each.join(often, "key").groupBy("doc_id", "n", "part").agg(
        F.array_sort(F.collect_list(F.struct("of", "key"))).alias("by_rarity"))
    prefix = F.slice("by_rarity", F.lit(1), (F.col("n") - F.ceil(F.col("n") * t - 1e-9) + 1).cast("int"))
    posts = ranked.select("doc_id", "n", "part", F.explode(prefix).alias("p")).where("p.of > 1").select(
        "doc_id", "n", "part", F.col("p.key").alias("key"))
    a = posts.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), "key", F.explode(
        F.array(F.col("part"), F.col("part") + 1)).alias("part"))
    b = posts.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), "key", "part")
    near = a.join(b, ["part", "key"]).where((F.col("a") != F.col("b")) & (F.col("na") <= F.col("nb"))
                                             & (F.col("na") * 100 >= F.col("nb") * percent))
    near = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    of = lambda x: sets.select(F.col("doc_id").alias(x), F.col("sig").alias(f"s{x}"))
    both = near.join(of("a"), "a").join(of("b"), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.withColumn("likeness", shared / (F.size("sa") + F.size("sb") - shared)).where(
        F.col("likeness") >= t).select("a", "b", "likeness")
