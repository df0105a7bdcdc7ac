"""Near-duplicate documents: banded MinHash with sequential Bayesian verification.

Documents are linked when the Jaccard similarity of their word-shingle sets
reaches a threshold; the result names every document's component of links.

1. Equal sets become one node, told apart by 128 bits of the set's digest (the
   number has 64; sets that share it, if there are any, are numbered anew).
2. Signatures of 128 minima fall into 32 bands; nodes that agree in a band are
   candidates.  A pair at similarity 0.8 shares no band with probability 5e-8.
3. Candidates are compared signature batch by signature batch: with a uniform
   prior, a pair is dropped as soon as the posterior probability that its
   similarity reaches the threshold falls below ``MISS``.
4. Survivors are verified on the full sets (64-bit shingle hashes).

Large groups of copies never become all their pairs.  First every node is
compared with the smallest node of each of its buckets only, and the links give
components.  Then only pairs from different components remain; a bucket that
still holds several components is cut into blocks, and pairs of blocks are
compared side by side in numpy.  It hands on the pairs that Bayesian verification
leaves and that 4096-bit parity sketches do not rule out (their distance never
exceeds the symmetric difference), each in the first band it shares.

Defined results: empty, blank and null texts have no shingles and stay alone; a
text with fewer words than a shingle has its whole word sequence as one shingle;
rows are linked by their texts, whatever their doc_ids: texts of one doc_id may
lie in different components, and rows without a doc_id lie in the component of
their text; a component is named by its smallest doc_id (null if none has one);
one row of a component is kept, the first by doc_id (null last) and hash of the
text, also among repeated rows; an empty table gives an empty one; only ``doc_id``
and ``text`` are read (``keep_first`` also orders rows equal in these by the rest).
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import collect_garbage, give_back, portions, small_batches, text_or_empty
from tessera.llm.graph import components
from tessera.session import cut_lineage

BANDS, ROWS = 32, 4
PERMUTATIONS = BANDS * ROWS
BATCH = 16
#: posterior probability of reaching the threshold below which a pair goes
MISS = 1e-6
#: nodes of one block of a large bucket
BLOCK = 2048
#: word hashes a worker keeps
MAX_WORDS = 300_000
#: bits of the parity sketches, and pairs looked at together
SKETCH = 4096
PORTION = 1 << 16
SEED = 20231


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_word_hashes = _WordHashes()


def forget() -> None:
    """Drop the word hashes of a worker and return its memory."""
    _word_hashes.clear()
    give_back()


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``n``-word shingles (A-Z lower-cased)."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(_word_hashes) > MAX_WORDS:
        _word_hashes.clear()
    h = np.fromiter(map(_word_hashes.__getitem__, words), np.uint64, len(words))
    size = min(n, len(h))
    out = np.full(len(h) - size + 1, np.uint64(size))
    for k in range(size):
        out = _spread(out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(out)])
    return np.unique(out)


@functools.cache
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    draw = rng.integers(0, 1 << 32, (2, PERMUTATIONS), dtype=np.uint32)
    return draw[0] | np.uint32(1), draw[1]


def signature(hashes: np.ndarray) -> np.ndarray:
    """Minimum of every permutation of the shingle hashes."""
    mul, add = _permutations()
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.full(PERMUTATIONS, np.uint32(2**32 - 1))
    for k in range(0, len(low), 1024):
        out = np.minimum(out, (low[k : k + 1024, None] * mul + add).min(axis=0))
    return out


@functools.cache
def least_matches(percent: int) -> tuple[int, ...]:
    """For 16, 32, ... compared minima: the fewest equal ones with which the
    posterior of similarity >= percent/100 (uniform prior) is at least ``MISS``."""
    t = percent / 100
    out = []
    for n in range(BATCH, PERMUTATIONS + 1, BATCH):
        # Pr(similarity >= t | m of n equal) = Pr(Binomial(n + 1, t) <= m)
        total, m = 0.0, -1
        while total < MISS:
            m += 1
            total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


def survivors(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Which rows of two aligned signature matrices stay candidates."""
    left = np.arange(len(a))
    matches = np.zeros(len(a), np.int32)
    for k, least in enumerate(least_matches(percent)):
        cols = slice(k * BATCH, (k + 1) * BATCH)
        matches[left] += (a[left, cols] == b[left, cols]).sum(axis=1, dtype=np.int32)
        left = left[matches[left] >= least]
    out = np.zeros(len(a), bool)
    out[left] = True
    return out


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column.tolist()), "<u4").reshape(-1, PERMUTATIONS)


def facts(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, node, signature) of every row."""
    small_batches(docs)

    @F.pandas_udf("n_shingles long, node long, node2 long, signature binary")
    def describe(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            parts = []
            for p in portions(s):
                sets = [shingles(t, n) for t in p]
                parts.append(pd.DataFrame({
                    "n_shingles": [len(x) for x in sets],
                    **_numbers(sets),
                    "signature": [signature(x).astype("<u4").tobytes() if len(x) else None for x in sets]}))
            yield pd.concat(parts, ignore_index=True)
        forget()

    return docs.select("doc_id", F.xxhash64(text_or_empty()).alias("text_key"), describe(text_or_empty()).alias("f")).select(
        "doc_id", "text_key", "f.*")


def _numbers(sets: list[np.ndarray]) -> dict[str, np.ndarray]:
    """128 bits of the digest of every set: its node number, and 64 bits more."""
    digests = b"".join(hashlib.blake2b(x.astype("<u8").tobytes(), digest_size=16).digest() for x in sets)
    both = np.frombuffer(digests, "<i8").reshape(-1, 2)
    return {"node": both[:, 0], "node2": both[:, 1]}


def _told_apart(rows: DataFrame, clashes: DataFrame) -> DataFrame:
    """Rows whose node number belongs to several sets (``clashes``: node, lo) keep
    it where their second number is the least, and take the second elsewhere."""
    lo = clashes.select(F.col("node").alias("shared"), "lo")
    other = F.col("lo").isNotNull() & (F.col("node2") != F.col("lo"))
    return rows.join(lo, rows["node"] == F.col("shared"), "left").withColumn(
        "node", F.when(other, F.col("node2")).otherwise(F.col("node"))).drop("shared", "lo")


def _bayes(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sequential Bayesian verification leaves."""
    sa = nodes.select(F.col("node").alias("a"), F.col("signature").alias("sa"))
    sb = nodes.select(F.col("node").alias("b"), F.col("signature").alias("sb"))

    def prune(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            if len(p):
                yield p.loc[survivors(_matrix(p["sa"]), _matrix(p["sb"]), percent), ["a", "b"]]

    return pairs.join(sa, "a").join(sb, "b").mapInPandas(prune, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    sa = sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha"))
    sb = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb"))

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            keep = []
            for x, y in zip(p["ha"], p["hb"], strict=True):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = np.sort(np.concatenate([x, y]))
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(both) - shared))
            yield p.loc[keep, ["a", "b"]]

    return pairs.join(sa, "a").join(sb, "b").mapInPandas(check, "a long, b long")


def sketch(hashes: np.ndarray) -> bytes:
    """Parities of how many hashes fall on each of ``SKETCH`` bits.  The Hamming
    distance of two sketches never exceeds the symmetric difference of the sets."""
    odd = np.bincount(((hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % SKETCH, minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


class _Members:
    """Rows of several buckets (or pairs of blocks), group after group."""

    def __init__(self, rows: pd.DataFrame):
        self.node, self.component = rows["node"].to_numpy(), rows["component"].to_numpy()
        self.band, self.block, self.n = rows["band"].to_numpy(), rows["block"].to_numpy(), rows["n_shingles"].to_numpy()
        self.across = (rows["bi"] != rows["bj"]).to_numpy()
        self.signature = _matrix(rows["signature"])
        self.sketch = np.frombuffer(b"".join(rows["sketch"].tolist()), np.uint64).reshape(len(rows), -1)
        ends = np.flatnonzero(_group_starts(rows))[1:]
        self.end = np.append(ends, len(rows))[np.searchsorted(ends, np.arange(len(rows)), "right")]

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs inside the groups that lie in different components (and
        blocks), in portions."""
        partners = self.end - np.arange(len(self.end)) - 1
        total, k = np.cumsum(partners), 0
        while k < len(total):
            stop = max(k + 1, int(np.searchsorted(total, (total[k - 1] if k else 0) + PORTION, "right")))
            many = partners[k:stop]
            i = np.repeat(np.arange(k, stop), many)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many)
            keep = (self.component[i] != self.component[j]) & (~self.across[i] | (self.block[i] != self.block[j]))
            yield i[keep], j[keep]
            k = stop

    def links(self, percent: int) -> np.ndarray:
        """The pairs that meet in this band first and may reach the threshold."""
        found = [np.zeros((0, 2), np.int64)]
        for i, j in self.pairs():
            keep = survivors(self.signature[i], self.signature[j], percent) if len(i) < PORTION // 8 else np.concatenate(
                [survivors(self.signature[i[k : k + PORTION // 8]], self.signature[j[k : k + PORTION // 8]], percent)
                 for k in range(0, len(i), PORTION // 8)])
            i, j = i[keep], j[keep]
            size = self.n[i] + self.n[j]
            apart = np.bitwise_count(self.sketch[i] ^ self.sketch[j]).sum(axis=1, dtype=np.int64)
            keep = apart <= size - 2 * (-(-size * percent // (100 + percent)))
            i, j = i[keep], j[keep]
            same = (self.signature[i] == self.signature[j]).reshape(len(i), BANDS, ROWS).all(axis=2)
            keep = same.argmax(axis=1) == self.band[i]
            i, j = self.node[i[keep]], self.node[j[keep]]
            found.append(np.stack([np.minimum(i, j), np.maximum(i, j)], axis=1))
        return np.concatenate(found)


def _group_starts(rows: pd.DataFrame) -> np.ndarray:
    at = rows[["key", "bi", "bj"]].to_numpy()
    out = np.ones(len(rows), bool)
    out[1:] = (at[1:] != at[:-1]).any(axis=1)
    return out


def _crossing(percent: int):
    """Reads members sorted by group; hands on the pairs that may be links."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if not len(rows):
                continue
            last = int(np.flatnonzero(_group_starts(rows))[-1])
            if last:
                yield pd.DataFrame(_Members(rows.iloc[:last]).links(percent), columns=["a", "b"])
            held = rows.iloc[last:]
        if held is not None:
            yield pd.DataFrame(_Members(held).links(percent), columns=["a", "b"])

    return compare


def judged(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, kept) of every row."""
    spark = docs.sparkSession
    # numbered where it is written, so that one of several equal rows can be told
    described = cut_lineage(facts(docs, shingle).withColumn("row_no", F.monotonically_increasing_id()))
    # sets that differ but share 64 bits of their digest: none, or very few
    several = described.where("n_shingles > 0").groupBy("node").agg(F.min("node2").alias("lo"), F.max("node2").alias("hi"))
    clashes = cut_lineage(several.where("lo <> hi").select("node", "lo"))
    clash = bool(clashes.head(1))
    if clash:
        described = cut_lineage(_told_apart(described, clashes))
    spoken = described.where("n_shingles > 0")
    first = F.struct(F.col("doc_id").isNull().alias("unnumbered"), "doc_id", "text_key", "row_no")
    classes = cut_lineage(spoken.groupBy("node").agg(F.min(first).alias("first")))
    nodes = spoken.select("node", "row_no", "signature").join(
        classes.select("node", F.col("first.row_no").alias("row_no")), ["node", "row_no"], "left_semi").select("node", "signature")
    nodes = cut_lineage(nodes)
    # (key, band, node) of every band
    bands = nodes.select("node", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.xxhash64(b, F.substring(F.col("signature"), b * (4 * ROWS) + 1, F.lit(4 * ROWS))))).alias("band", "key"))
    shared = bands.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first <> last")
    candidates = cut_lineage(bands.join(shared.select("key", "first"), "key"))
    collect_garbage(spark)
    # the full sets of every node that has a candidate, from its first row
    at = F.xxhash64(F.col("doc_id").cast("long"), F.col("text_key")).alias("at")
    wanted = classes.join(candidates.select("node").distinct(), "node", "left_semi").select("first.*").select(at).distinct()
    rows = docs.select("doc_id", text_or_empty().alias("text")).withColumn("text_key", F.xxhash64("text")).select(
        at, "text").join(wanted, "at", "left_semi")

    @F.pandas_udf("node long, node2 long, hashes binary")
    def hashes(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            sets = [shingles(t, shingle) for t in s]
            yield pd.DataFrame({**_numbers(sets),
                                "hashes": pd.Series([x.astype("<u8").tobytes() for x in sets], dtype=object)})
        forget()

    fetched = rows.select(hashes("text").alias("s")).select("s.*")
    fetched = _told_apart(fetched, clashes) if clash else fetched
    sets = cut_lineage(fetched.drop("node2").dropDuplicates(["node"]))
    collect_garbage(spark)
    # first each node against the smallest node of its buckets
    stars = cut_lineage(candidates.where("node <> first").select(
        F.col("first").alias("a"), F.col("node").alias("b")).distinct())
    links = cut_lineage(_verified(_bayes(stars, nodes, percent), sets, percent))
    collect_garbage(spark)
    found = components(links)
    # then the pairs between different components
    labelled = candidates.join(found, "node", "left").select(
        "key", "band", "node", F.coalesce("component", "node").alias("component"))
    labelled = cut_lineage(labelled)
    mixed = labelled.groupBy("key").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n")).where("lo <> hi")
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")

    @F.pandas_udf("binary")
    def sketches(found: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in found:
            yield pd.Series([sketch(np.frombuffer(h, "<u8")) for h in s], dtype=object)

    members = labelled.join(mixed, "key")
    about = nodes.join(sets, "node").join(members.select("node").distinct(), "node", "left_semi").select(
        "node", "signature", (F.octet_length("hashes") / 8).cast("long").alias("n_shingles"), sketches("hashes").alias("sketch"))
    members = members.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    members = members.select("key", "band", "node", "component", "block",
                             F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"))
    members = members.join(about, "node").repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj")
    crossing = members.mapInPandas(_crossing(percent), "a long, b long")
    crossing = cut_lineage(crossing.join(stars, ["a", "b"], "left_anti"))
    collect_garbage(spark)
    more = cut_lineage(_verified(crossing, sets, percent))
    collect_garbage(spark)
    found = components(links.unionByName(more)) if not more.isEmpty() else found
    # a component is named by the first of its rows
    labels = classes.join(found, "node", "left").select("node", "first", F.coalesce("component", "node").alias("component"))
    heads = labels.groupBy("component").agg(F.min("first").alias("head"))
    labels = labels.join(heads, "component").select(
        F.col("node").alias("of"), F.col("head.doc_id").alias("name"), F.col("head.row_no").alias("head"))
    out = described.select("doc_id", "text_key", "n_shingles", "row_no", "node").join(
        labels, (F.col("n_shingles") > 0) & (F.col("node") == F.col("of")), "left")
    # without shingles a row stays alone
    alone = F.col("n_shingles") == 0
    return out.select("doc_id", "text_key", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("name")).cast("long").alias(
        "component_id"), (alone | (F.col("row_no") == F.col("head"))).alias("kept"))


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; a link needs
    ``100 * |intersection| >= percent * |union|`` of ``shingle``-word shingles."""
    return judged(docs, shingle, percent).drop("text_key")


def keep_first(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without the later rows of each component."""
    some = judged(docs, shingle, percent).groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).agg(
        F.count("*").alias("n"), F.sum(F.col("kept").cast("long")).alias("n_kept")).where("n_kept < n")
    some = cut_lineage(some.select("__id", "__key", "n_kept"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64(text_or_empty()) == F.col("__key"))
    kept = docs.join(some, same, "left_anti").select(*docs.columns)
    repeated = some.where("n_kept > 0")
    if repeated.isEmpty():
        return kept
    # of rows equal in doc_id and text one stays
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = docs.select("doc_id", "text", row.alias("__row")).join(repeated, same).groupBy("__id", "__key").agg(
        F.min_by("__row", F.to_json("__row")).alias("row")).select("row.*")
    return kept.unionByName(one)
