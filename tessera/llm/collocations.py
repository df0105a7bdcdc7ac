"""Phrase collocations by set-oriented relational mining (SETM).

The occurrence relation R1 (place, word) of the corpus is written once, sorted by
place.  Places run on inside a piece and jump between pieces, so that joining a
relation with itself on "next place" is a merge of two sorted columns.  Each
round

1. merge-joins R_k with itself by piece and adjacent place: R'_(k+1),
2. group-counts the phrases of R'_(k+1),
3. semi-joins R'_(k+1) with the frequent phrases and writes R_(k+1), sorted.

A relation is stored in chunks of about ``CHUNK_WORDS`` words (whole documents),
each with a dictionary of its words; merges stay inside a chunk.  Groups travel
as 64-bit codes with their chunk; the count of a code bounds the count of each of
its phrases from above, so the semi-join never loses a frequent phrase, and the
counts that are returned are taken on whole word tuples.  Words are told apart by
64-bit codes too; if two words of the corpus shared one, the run starts again
with another seed.  Nothing is broadcast or collected.

Defined results: null and empty texts have no words; a null language counts as
``und``; repeated rows count as often as they occur; an empty table gives an
empty one; only ``text`` and ``lang`` are read, so other names cannot clash.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.bytewords import byte_classes, slices, split
from tessera.llm.common import BATCH_ROWS, batch_rows, partitions_for
from tessera.session import cut_lineage, release

MAX_WORDS = 3
MIN_COUNT = 10
TOP = 2000
COVER_PERCENT = 50
UNKNOWN = "und"
CHUNK_WORDS = 1 << 21
#: parts of a language that are ranked side by side before they are merged
SALTS = 64
SEEDS = 16
GROUP_ROWS = 1 << 16

CLASSES = byte_classes(b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d")

RELATION = "chunk long, gaps binary, words binary, starts binary, codes binary"
OCCURRENCES = f"{RELATION}, dict_code array<long>, dict_lang array<string>, dict_word array<binary>, dict_n array<long>"
GROUPS = "g long, chunk long, n long"


def _pack(a: np.ndarray) -> bytes:
    return zstandard.compress(a.tobytes(), 1)


def _unpack(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


class Relation:
    """A chunk of R_k: words in order of place (``gaps``: 1 behind a word of the
    same piece and next place, else 2), the places where a phrase of k words
    starts, and the codes of the chunk's words."""

    def __init__(self, chunk: int, gaps: np.ndarray, words: np.ndarray, starts: np.ndarray, codes: np.ndarray):
        self.chunk, self.gaps, self.words, self.starts, self.codes = chunk, gaps, words, starts, codes

    @classmethod
    def of(cls, row: dict) -> Relation:
        return cls(row["chunk"], _unpack(row["gaps"], np.uint8), _unpack(row["words"], np.uint32),
                   _unpack(row["starts"], np.uint8).astype(bool), _unpack(row["codes"], np.int64))

    def row(self) -> dict:
        return {"chunk": self.chunk, "gaps": _pack(self.gaps.astype(np.uint8)), "words": _pack(self.words.astype(np.uint32)),
                "starts": _pack(self.starts.astype(np.uint8)), "codes": _pack(self.codes)}

    def joined(self) -> np.ndarray:
        """Starts of the phrases of k + 1 words: the merge-join of the sorted
        relation with itself by piece and adjacent place."""
        return np.flatnonzero(self.starts[:-1] & self.starts[1:] & (self.gaps[1:] == 1))

    def group_codes(self, at: np.ndarray, k: int) -> np.ndarray:
        """64-bit codes of the phrases of ``k`` words that start at ``at``."""
        own = self.codes.view(np.uint64)
        out = own[self.words[at]].copy()
        for j in range(1, k):
            out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + own[self.words[at + j]]
        return out.view(np.int64)

    def counted(self, at: np.ndarray, k: int) -> tuple[list[np.ndarray], np.ndarray]:
        """(codes of the 1st .. k-th word, count) of the distinct phrases at ``at``."""
        size = np.int64(max(1, len(self.codes)))
        key = self.words[at].astype(np.int64)
        for j in range(1, k):
            # numbered anew each time, so that numbers never pass 64 bits
            _, key = np.unique(key, return_inverse=True) if j > 1 else (None, key)
            key = key * size + self.words[at + j].astype(np.int64)
        _, first, n = np.unique(key, return_index=True, return_counts=True)
        return [self.codes[self.words[at[first] + j]] for j in range(k)], n

    def kept(self, at: np.ndarray, k: int) -> Relation:
        """The relation of the phrases of ``k`` words that start at ``at``."""
        starts, used = np.zeros(len(self.words), bool), np.zeros(len(self.words), bool)
        starts[at] = True
        for j in range(k):
            used[at + j] = True
        places = np.cumsum(self.gaps, dtype=np.int64)[used]
        gaps = np.full(len(places), 2, np.uint8)
        gaps[1:][np.diff(places) == 1] = 1
        present, words = np.unique(self.words[used], return_inverse=True)
        return Relation(self.chunk, gaps, words, starts[used], self.codes[present])


def _batches(columns: dict[str, np.ndarray], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    yield from pa.table(columns, schema=schema).to_batches(max_chunksize=1 << 16)


_GROUPS = pa.schema([("g", pa.int64()), ("chunk", pa.int64()), ("n", pa.int64())])


def occurrences(docs: DataFrame, seed: int = 0, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """R1 with the dictionary (word, language, count) of every chunk, written."""
    text = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
                       F.col("text").cast("string").alias("text")).where("text IS NOT NULL")

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = number = 0

        def chunk() -> pa.RecordBatch:
            words = pa.concat_arrays([h[0] for h in held]).dictionary_encode()
            gaps = np.concatenate([h[1] for h in held])
            names = sorted({name for h in held for name in h[3]})
            place = {name: i for i, name in enumerate(names)}
            lang = np.concatenate([np.array([place[x] for x in h[3]], np.int64)[h[2]] for h in held])
            key = words.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(names) + lang
            distinct, index, n = np.unique(key, return_inverse=True, return_counts=True)
            texts = words.dictionary.take(pa.array(distinct // len(names))).to_pylist()
            langs = [names[i] for i in (distinct % len(names)).tolist()]
            heads = {name: name.encode() + b"\0" for name in names}
            codes = np.fromiter((xxhash.xxh3_64_intdigest(heads[a] + w, seed) for a, w in zip(langs, texts, strict=True)),
                                np.uint64, len(texts)).view(np.int64)
            at = (TaskContext.get().partitionId() << 32) + number
            row = Relation(at, gaps, index, np.ones(len(gaps), np.uint8), codes).row()
            row |= {"dict_code": codes, "dict_lang": langs, "dict_word": texts, "dict_n": n}
            return pa.RecordBatch.from_pylist([row], schema=_schema())

        for batch in batches:
            names = batch.column("lang").to_pylist()
            for first, part in slices(batch.column("text")):
                cut = split(part, CLASSES)
                if not len(cut.words):
                    continue
                gaps = np.full(len(cut.row), 2, np.uint8)
                gaps[1:][cut.piece[1:] == cut.piece[:-1]] = 1
                distinct = list(dict.fromkeys(names[first : first + len(part)]))
                place = {name: i for i, name in enumerate(distinct)}
                lang = np.array([place[x] for x in names[first : first + len(part)]], np.int64)[cut.row]
                held.append((cut.words, gaps, lang, distinct))
                size += len(gaps)
                if size >= chunk_words:
                    yield chunk()
                    held, size, number = [], 0, number + 1
        if held:
            yield chunk()

    batch_rows(docs.sparkSession, BATCH_ROWS)
    return cut_lineage(text.select("lang", "text").mapInArrow(chunks, OCCURRENCES))


@functools.cache
def _schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
             "array<string>": pa.list_(pa.string()), "array<binary>": pa.list_(pa.binary())}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in OCCURRENCES.split(", "))])


def word_table(relation: DataFrame) -> DataFrame:
    """(code, lang, word, f) of every word of the corpus, written."""
    entries = relation.select(F.explode(F.arrays_zip("dict_code", "dict_lang", "dict_word", "dict_n")).alias("e"))
    return cut_lineage(entries.groupBy(
        F.col("e.dict_code").alias("code"), F.col("e.dict_lang").alias("lang"), F.col("e.dict_word").alias("word"))
        .agg(F.sum("e.dict_n").alias("f")))


def word_groups(relation: DataFrame) -> DataFrame:
    """The groups of R1: its words, with chunk and count."""
    return relation.select("chunk", F.explode(F.arrays_zip("dict_code", "dict_n")).alias("e")).select(
        F.col("e.dict_code").alias("g"), "chunk", F.col("e.dict_n").alias("n"))


def phrase_groups(relation: DataFrame, k: int) -> DataFrame:
    """The groups of R'_k: codes of the phrases of ``k`` words, joined from
    the relation of k - 1 words, with chunk and count."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                r = Relation.of(row)
                g, n = np.unique(r.group_codes(r.joined(), k), return_counts=True)
                yield from _batches({"g": g, "chunk": np.full(len(g), r.chunk), "n": n}, _GROUPS)

    return relation.select(*[c.split()[0] for c in RELATION.split(", ")]).mapInArrow(groups, GROUPS)


def frequent(groups: DataFrame, min_count: int, partitions: int) -> DataFrame:
    """(chunk, g) of the groups whose counts reach ``min_count``.  A group has
    one row per chunk at most, and partitions grow with the corpus, so a task
    holds a bounded part."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), schema=_GROUPS)
        g, chunk, n = (table.column(c).to_numpy() for c in ("g", "chunk", "n"))
        order = np.argsort(g, kind="stable")
        g, chunk, n = g[order], chunk[order], n[order]
        heads = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
        often = np.add.reduceat(n, heads) >= min_count if len(g) else np.zeros(0, bool)
        keep = np.repeat(often, np.diff(np.r_[heads, len(g)]))
        yield from _batches({"chunk": chunk[keep], "g": g[keep]}, _GROUPS.remove(2).set(0, _GROUPS[1]).set(1, _GROUPS[0]))

    return groups.repartition(partitions, "g").mapInArrow(whole, "chunk long, g long")


def semi_join(relation: DataFrame, survivors: DataFrame, k: int) -> DataFrame:
    """R_k: the phrases of ``k`` words whose groups survive, written.  Chunks of
    R_(k-1) (for k = 1: of R1 itself) meet the groups that survive in them."""

    def reduced(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        good = np.sort(right.column("g").to_numpy()) if len(right) else np.zeros(0, np.int64)
        for row in left.to_pylist():
            r = Relation.of(row)
            at = np.flatnonzero(r.starts) if k == 1 else r.joined()
            found = r.group_codes(at, k)
            place = np.minimum(np.searchsorted(good, found), max(0, len(good) - 1))
            at = at[good[place] == found] if len(good) else at[:0]
            if len(at):
                out.append(r.kept(at, k).row())
        return pa.Table.from_pylist(out, schema=pa.schema([f for f in _schema() if not f.name.startswith("dict_")]))

    names = [c.split()[0] for c in RELATION.split(", ")]
    both = relation.select(*names).groupBy("chunk").cogroup(survivors.groupBy("chunk"))
    return cut_lineage(both.applyInArrow(reduced, RELATION))


def exact_counts(relation: DataFrame, k: int, max_words: int, joined: bool) -> DataFrame:
    """(c1 .. cmax, n) of the phrases of ``k`` words, per chunk: those of the
    relation, or (``joined``) those of its merge-join."""
    names = [f"c{i + 1}" for i in range(max_words)]
    schema = pa.schema([(x, pa.int64()) for x in [*names, "n"]])

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                r = Relation.of(row)
                codes, n = r.counted(r.joined() if joined else np.flatnonzero(r.starts), k)
                columns = {x: codes[i] if i < k else pa.nulls(len(n), pa.int64()) for i, x in enumerate(names)}
                yield from _batches(columns | {"n": n}, schema)

    return relation.mapInArrow(counts, ", ".join(f"{x} long" for x in [*names, "n"]))


def mined(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT,
          chunk_words: int = CHUNK_WORDS) -> tuple[DataFrame, DataFrame]:
    """(words, phrases): (code, lang, word, f) of all words, and (codes, a) of
    the phrases of 2 to ``max_words`` words that occur ``min_count`` times."""
    spark, parts = docs.sparkSession, partitions_for(docs)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    try:
        for seed in range(SEEDS):
            relation = occurrences(docs, seed, chunk_words)
            words = word_table(relation)
            if not words.groupBy("code").count().where("count > 1").head(1):
                break
            release(relation, words)
        else:
            raise ValueError("words share codes under every seed")
        # group rows are a few bytes each; what relation rows take is bounded by Spark's bytes per batch
        batch_rows(spark, GROUP_ROWS)
        counts = []
        for k in range(1, max_words):
            groups = word_groups(relation) if k == 1 else phrase_groups(relation, k)
            reduced = semi_join(relation, frequent(groups, min_count, parts), k)
            release(relation)
            relation = reduced
            if k > 1:
                counts.append(_added(exact_counts(relation, k, max_words, False), max_words, min_count))
        counts.append(_added(exact_counts(relation, max_words, max_words, True), max_words, min_count))
        release(relation)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    phrases = functools.reduce(DataFrame.unionAll, counts)
    codes = F.filter(F.array(*[f"c{i + 1}" for i in range(max_words)]), lambda x: x.isNotNull())
    return words, phrases.select(codes.alias("codes"), "a")


def _added(counts: DataFrame, max_words: int, min_count: int) -> DataFrame:
    names = [f"c{i + 1}" for i in range(max_words)]
    return cut_lineage(counts.groupBy(*names).agg(F.sum("n").alias("a")).where(F.col("a") >= min_count))


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, top: int = TOP,
                 cover_percent: int = COVER_PERCENT, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases."""
    words, phrases = mined(docs, max_words, min_count, chunk_words)
    parts = phrases.unionAll(words.where(F.col("f") >= min_count).select(F.array("code"), "f")).toDF("part", "count")
    cut = phrases.select("codes", "a", F.explode(F.sequence(F.lit(1), F.size("codes") - 1)).alias("k"))
    cut = cut.select("*", F.slice("codes", F.lit(1), F.col("k")).alias("head"),
                     F.slice("codes", F.col("k") + 1, F.size("codes") - F.col("k")).alias("tail"))
    for side, out in (("head", "l"), ("tail", "r")):
        cut = cut.join(parts.toDF(side, out), side)
    # 38 digits: exact for counts up to 10^16
    score = F.expr("(CAST(a AS DECIMAL(16,0)) * CAST(a AS DECIMAL(16,0)) * CAST(1000000 AS DECIMAL(7,0))) "
                   "DIV (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))")
    scored = cut.select("codes", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut")).groupBy("codes").agg(
        F.first("a").alias("a"), F.min("cut").alias("cut")).select("codes", "a", "cut.score", "cut.l", "cut.r")
    # a phrase goes where a longer one around it is as good as always there
    inner = phrases.where(F.size("codes") > 2).select("a", F.expr(
        "explode(flatten(transform(sequence(2, size(codes) - 1), m -> "
        "transform(sequence(1, size(codes) - m + 1), i -> slice(codes, i, m)))))").alias("codes"))
    inner = inner.groupBy("codes").agg(F.max("a").alias("around"))
    left = scored.join(inner, "codes", "left").where(
        F.coalesce(100 * F.col("around") < cover_percent * F.col("a"), F.lit(True))).drop("around")
    spelled = left.select("*", F.posexplode("codes").alias("pos", "code")).join(
        words.select("code", "lang", "word"), "code").groupBy("codes", "a", "score", "l", "r", "lang").agg(
        F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("spelled"))
    phrase = F.array_join(F.transform("spelled", lambda x: x["word"].cast("string")), " ")
    total = words.groupBy("lang").agg(F.sum("f").alias("n"))
    named = spelled.select("lang", phrase.alias("phrase"), "a", "l", "r", "score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each part first, so that no task sees a whole language
    named = named.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    named = named.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(
        F.col("rank") <= top)
    named = named.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(
        F.col("rank") <= top)
    return named.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
