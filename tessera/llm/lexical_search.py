"""Ranked lexical search by presence masks.

Items (the queries) are taken in blocks of bounded size; a block's vocabulary
goes to every task.  One pass over the documents writes, per chunk of documents,
the postings of that vocabulary; document frequencies and lengths are summed from
them.  A second pass over the written chunks ranks: bitmaps of the documents that
hold each term are combined into one presence mask per document, documents are
grouped by mask, and every mask gets the highest score its documents could have
(for each term the best share that any document of the chunk reaches).  Masks are
evaluated in descending order of that bound until the next bound lies below the
score of the k-th document found, so what is skipped cannot enter the result.
The best of each chunk are merged per item, in parts first.

Defined results: null and empty texts hold no term; documents without a term count
neither in N nor in L; every row of ``docs`` is a document of its own, also where
rows repeat; equal scores rank by ascending doc_id, nulls last; items equal in
item_id and text are one item, one item_id with two texts gives two rankings; an
item without terms, or an empty table, gives no rows; only ``doc_id`` and ``text``,
and ``item_id`` and ``text``, are read, so other names cannot clash.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.bytewords import byte_classes, slices, split
from tessera.llm.common import BATCH_ROWS, batch_rows
from tessera.session import cut_lineage, release

TOP = 10
#: items, and characters of items, in a block
BLOCK_ITEMS, BLOCK_CHARS = 1024, 1 << 20
#: documents, and postings, of a chunk
CHUNK_DOCS, CHUNK_POSTINGS = 1 << 15, 1 << 22
#: documents evaluated before bounds are looked at for the first time
FIRST_DOCS = 64
#: parts of an item's candidates that are ranked side by side
SALTS = 64
LENGTH_PERCENT = 75

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
CLASSES = byte_classes(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
_UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

POSTINGS = ("chunk long, n_docs long, n_terms long, df_term array<int>, df array<long>, "
            "doc_id binary, known binary, length binary, first binary, term binary, tf binary")


def terms_of(text: str | None) -> list[str]:
    return TERM.findall((text or "").translate(_UPPER))


def _pack(a: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(a).tobytes(), 1)


def _unpack(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


@functools.cache
def _schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in POSTINGS.split(", "))])


def postings(docs: DataFrame, vocabulary: list[str], chunk_docs: int = CHUNK_DOCS) -> DataFrame:
    """One row per chunk of documents: its numbers of documents and terms, and
    the postings of the vocabulary by document."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_terms = pa.array([t.encode() for t in vocabulary], pa.large_binary())
        held: list[tuple] = []
        number = 0

        def chunk() -> pa.RecordBatch:
            ids, known, length, rows, term, tf = (np.concatenate(x) for x in zip(*held, strict=True))
            some = np.bincount(rows, minlength=len(ids))
            df = np.bincount(term, minlength=len(vocabulary))
            present = np.flatnonzero(df)
            used = some > 0
            row = {"chunk": (TaskContext.get().partitionId() << 32) + number, "n_docs": int((length > 0).sum()),
                   "n_terms": int(length.sum()), "df_term": present, "df": df[present],
                   "doc_id": _pack(ids[used]), "known": _pack(known[used]), "length": _pack(length[used]),
                   "first": _pack(np.r_[0, np.cumsum(some[used])].astype(np.int64)),
                   "term": _pack(term.astype(np.int32)), "tf": _pack(tf.astype(np.int32))}
            return pa.RecordBatch.from_pylist([row], schema=_schema())

        n_docs = n_posts = 0
        for batch in batches:
            numbers = batch.column("doc_id")
            known = pc.is_valid(numbers).to_numpy(zero_copy_only=False).astype(np.uint8)
            ids = pc.fill_null(numbers, 0).to_numpy(zero_copy_only=False)
            for at, part in slices(batch.column("text")):
                cut = split(part, CLASSES)
                length = np.bincount(cut.row, minlength=len(part)).astype(np.int64)
                found = pc.index_in(cut.words, value_set=known_terms)
                hit = pc.is_valid(found).to_numpy(zero_copy_only=False)
                key = cut.row[hit] * len(vocabulary) + found.drop_null().to_numpy(zero_copy_only=False)
                key, tf = np.unique(key, return_counts=True)
                held.append((ids[at : at + len(part)], known[at : at + len(part)], length,
                             key // len(vocabulary) + n_docs, key % len(vocabulary), tf))
                n_docs, n_posts = n_docs + len(part), n_posts + len(key)
                if n_docs >= chunk_docs or n_posts >= CHUNK_POSTINGS:
                    yield chunk()
                    held, n_docs, n_posts, number = [], 0, 0, number + 1
        if held:
            yield chunk()

    batch_rows(docs.sparkSession, min(BATCH_ROWS, chunk_docs))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return cut_lineage(rows.mapInArrow(chunks, POSTINGS))


class Chunk:
    """The postings of one chunk with each posting's share of a term's weight."""

    def __init__(self, row: dict, n_docs: int, n_terms: int, n_vocabulary: int):
        self.ids, known = _unpack(row["doc_id"], np.int64), _unpack(row["known"], np.uint8)
        #: place by doc_id, nulls last
        self.tie = np.empty(len(self.ids), np.int64)
        self.tie[np.lexsort((self.ids, known == 0))] = np.arange(len(self.ids))
        self.known = known.astype(bool)
        self.first = _unpack(row["first"], np.int64)
        self.term = _unpack(row["term"], np.int32)
        tf = _unpack(row["tf"], np.int32).astype(np.int64)
        length = _unpack(row["length"], np.int64)
        m = 100 - LENGTH_PERCENT + (LENGTH_PERCENT * length * n_docs) // max(1, n_terms)
        self.doc = np.repeat(np.arange(len(self.ids)), np.diff(self.first))
        self.share = (1_000_000_000 * tf) // (1000 * tf + 8 * m[self.doc])
        self.best = np.zeros(n_vocabulary, np.int64)
        np.maximum.at(self.best, self.term, self.share)
        # documents of each term, as a bitmap when it is asked for
        self._order = np.argsort(self.term, kind="stable")
        self._ends = np.searchsorted(self.term[self._order], np.arange(n_vocabulary + 1))
        self._bitmaps: dict[int, np.ndarray] = {}

    def bitmap(self, term: int) -> np.ndarray:
        bits = self._bitmaps.get(term)
        if bits is None:
            flags = np.zeros(len(self.ids), np.uint8)
            flags[self.doc[self._order[self._ends[term] : self._ends[term + 1]]]] = 1
            bits = self._bitmaps[term] = np.packbits(flags)
        return bits

    def masks(self, terms: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(documents, number of each one's mask, presence of each term by mask)
        of the documents that hold any of ``terms``."""
        rows = [self.bitmap(t) for t in terms]
        docs = np.flatnonzero(np.unpackbits(functools.reduce(np.bitwise_or, rows), count=len(self.ids)))
        number = np.zeros(len(docs), np.int64)
        for at in range(0, len(rows), 32):
            # 32 terms at a time: distinct masks so far, then the next bits behind them
            bits = number.astype(np.uint64)
            for row in rows[at : at + 32]:
                bits = bits << np.uint64(1) | np.unpackbits(row, count=len(self.ids))[docs]
            _, head, number = np.unique(bits, return_index=True, return_inverse=True)
        present = np.stack([np.unpackbits(row, count=len(self.ids))[docs[head]] for row in rows], axis=1)
        return docs, number, present.astype(np.int64)

    def scores(self, docs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Scores of documents that hold a term each; ``weight`` by term."""
        begin, size = self.first[docs], self.first[docs + 1] - self.first[docs]
        heads = np.r_[0, np.cumsum(size)[:-1]]
        at = np.arange(int(size.sum())) + np.repeat(begin - heads, size)
        return np.add.reduceat(weight[self.term[at]] * self.share[at], heads)

    def top(self, item: dict[int, int], weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the chunk's ``k`` best for an item's terms
        ({term: weight with repeats}); ``weight`` is a work array of zeros."""
        terms = [t for t in item if self.best[t]]
        none = np.zeros(0, np.int64)
        if not terms:
            return none, none
        gains = np.array([item[t] for t in terms], np.int64)
        docs, number, present = self.masks(terms)
        bound = present @ (gains * self.best[terms])
        order = np.argsort(-bound, kind="stable")             # masks, best bound first
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        by_mask = np.argsort(rank[number], kind="stable")      # documents, best mask first
        ends = np.cumsum(np.bincount(rank[number], minlength=len(order)))
        weight[terms] = gains
        found, scores, mask, step = none, none, 0, FIRST_DOCS
        while mask < len(order) and (len(found) < k or bound[order[mask]] >= scores[-1]):
            begin = ends[mask - 1] if mask else 0
            to = max(mask + 1, int(np.searchsorted(ends, begin + step, "right")))
            new = docs[by_mask[begin : ends[to - 1]]]
            found, scores = np.r_[found, new], np.r_[scores, self.scores(new, weight)]
            keep = np.lexsort((self.tie[found], -scores))[:k]
            found, scores, mask, step = found[keep], scores[keep], to, 2 * step
        weight[terms] = 0
        return found[scores > 0], scores[scores > 0]


def candidates(chunks: DataFrame, items: list[dict[int, int]], n_docs: int, n_terms: int, n_vocabulary: int,
               k: int) -> DataFrame:
    """(item, chunk, doc_id, score) of each chunk's ``k`` best documents per item."""
    schema = pa.schema([("item", pa.int32()), ("chunk", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.zeros(n_vocabulary, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row, n_docs, n_terms, n_vocabulary)
                for i, item in enumerate(items):
                    docs, scores = chunk.top(item, weight, k)
                    if len(docs):
                        yield pa.record_batch([
                            pa.array(np.full(len(docs), i), pa.int32()), pa.array(np.full(len(docs), row["chunk"])),
                            pa.array(chunk.ids[docs], pa.int64(), mask=~chunk.known[docs]), pa.array(scores)], schema=schema)

    return chunks.select([c.split()[0] for c in POSTINGS.split(", ")]).mapInArrow(
        best, "item int, chunk long, doc_id long, score long")


def _block(docs: DataFrame, block: list[tuple], k: int, chunk_docs: int) -> DataFrame | None:
    """Ranks of one block of items (item_id, text), written."""
    counted = [(item_id, Counter(terms_of(text))) for item_id, text in block]
    counted = [(item_id, terms) for item_id, terms in counted if terms]
    vocabulary = sorted(set().union(*[terms for _, terms in counted]))
    if not vocabulary:
        return None
    place = {t: i for i, t in enumerate(vocabulary)}
    chunks = postings(docs, vocabulary, chunk_docs)
    n_docs, n_terms = chunks.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    # one number per term of the block's vocabulary
    df = dict(chunks.select(F.explode(F.arrays_zip("df_term", "df")).alias("e")).groupBy("e.df_term").agg(
        F.sum("e.df")).collect())
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for t, d in df.items()}
    items = [{place[t]: weight[place[t]] * n for t, n in terms.items() if weight.get(place[t], 0) > 0} for _, terms in counted]
    found = candidates(chunks, items, n_docs, n_terms, len(vocabulary), k)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = Window.partitionBy("item", F.pmod("chunk", F.lit(SALTS))).orderBy(*order)
    found = found.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= k)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    # numbers of a block's items: BLOCK_ITEMS at most
    ids = docs.sparkSession.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(counted)], "item int, item_id long")
    out = cut_lineage(found.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score"))
    release(chunks)
    return out


def search(docs: DataFrame, items: DataFrame, k: int = TOP, block_items: int = BLOCK_ITEMS,
           chunk_docs: int = CHUNK_DOCS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item."""
    spark = docs.sparkSession
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    parts, block, chars = [], [], 0
    try:
        for item_id, text in asked.toLocalIterator():
            block.append((item_id, text))
            chars += len(text or "")
            if len(block) >= block_items or chars >= BLOCK_CHARS:
                parts.append(_block(docs, block, k, chunk_docs))
                block, chars = [], 0
        parts.append(_block(docs, block, k, chunk_docs))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    parts = [p for p in parts if p is not None]
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return functools.reduce(DataFrame.unionAll, parts)
