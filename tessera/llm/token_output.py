"""Token ids of a corpus in compressed files, and back.

Documents are put in ranges of ascending ``doc_id``; each range is a shard.  A
task encodes its documents with the tokenizer library, appends an end id to
each, and writes segments: a directory (document numbers, lengths and the prior of
the ids, with its own checksum) and the ids as blocks of the range coder, each independently
reset and checksummed.  Segments end between documents, so any segment can be
read alone; a shard's segments in order, and the shards in order, hold the ids
of the corpus.  The container is a Parquet table with one row per segment,
written by Spark into any folder that the cluster shares.

Defined results: null and empty texts have the end id only; special strings
inside texts become their added token, as the library does by default; rows with
equal doc_id follow each other by the hash of the text; null doc_ids come first; an empty table
gives an empty file set; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import functools
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import pretokens, rangecoder
from tessera.llm.common import partitions_for, small_batches, text_or_empty, tokenizer_path
from tessera.operators.prefix import running_totals
from tessera.session import cut_lineage, ensure_checkpoint_dir, remove

END_ID = 0
#: input bytes of a shard; ids after which a segment ends; bounds of a block
SHARD_BYTES = 12 << 20
SEGMENT_IDS = 1 << 23
BLOCK_IDS = (256, 4096)
#: pieces, and words, whose ids a worker keeps
MAX_PIECES = 600_000
#: words that the library takes as one text
JOINED_WORDS = 4096

SEGMENT = "shard int, segment int, n_ids long, size int, block int, directory binary, ids binary"
_DIRECTORY = struct.Struct("<4sIII")
_MAGIC = b"TID1"


#: a blank that the next word does not take: text with one is cut as a whole
_LOOSE_BLANK = re.compile(r" (?:\s|$)")


class _Encoder:
    """Ids (little-endian 16-bit) by the library, which merges each piece of its
    cut separately, so each distinct word or piece is encoded once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        # the byte alphabet writes a blank as U+0120
        self.blank_first = np.zeros(self.library.get_vocab_size(), bool)
        self.blank_first[[i for t, i in self.library.get_vocab().items() if t[0] == "\u0120"]] = True
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _learn(self, cuts: list[list[str]]) -> None:
        known = self.pieces
        new = [p for p in dict.fromkeys(p for pieces in cuts for p in pieces) if p not in known]
        for p, e in zip(new, self.library.encode_batch_fast(new, add_special_tokens=False), strict=True):
            known[p] = np.array(e.ids, "<u2").tobytes()

    def _whole(self, texts: list[str]) -> list[bytes]:
        cuts = pretokens.cut(texts)
        self._learn(cuts)
        return [b"".join(map(self.pieces.__getitem__, pieces)) for pieces in cuts]

    def _joined(self, words: list[str]) -> list[bytes]:
        """Ids of words that have a blank before them: laid end to end they are
        cut as they are alone, and a word begins where an id begins with a blank."""
        if any(" " in s for s in self.special):
            return self._whole([" " + w for w in words])
        out: list[bytes] = []
        for k in range(0, len(words), JOINED_WORDS):
            part = words[k : k + JOINED_WORDS]
            [e] = self.library.encode_batch_fast([" " + " ".join(part)], add_special_tokens=False)
            ids = np.array(e.ids, "<u2")
            begins = (2 * np.flatnonzero(self.blank_first[ids])).tolist()
            whole = ids.tobytes()
            if len(begins) != len(part) or begins[0]:
                raise ValueError("the library cuts joined words otherwise")
            out += [whole[a:b] for a, b in zip(begins, [*begins[1:], len(whole)], strict=True)]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        for kept in (self.pieces, self.words):
            if len(kept) > MAX_PIECES:
                kept.clear()
        out: list[bytes] = [b""] * len(texts)
        # a blank before a non-space always begins a piece: between such blanks
        # the text falls into words (with their signs) that repeat
        simple, others = [], []
        for i, t in enumerate(texts):
            if any(s in t for s in self.special):
                out[i] = np.array(self.library.encode(t, add_special_tokens=False).ids, "<u2").tobytes()
            elif _LOOSE_BLANK.search(t):
                others.append(i)
            else:
                simple.append(i)
        for i, ids in zip(others, self._whole([texts[i] for i in others]), strict=True):
            out[i] = ids
        words = [texts[i].split(" ") for i in simple]
        firsts = self._whole([ws[0] for ws in words])
        known = self.words
        new = [w for w in set().union(*[ws[1:] for ws in words]) if w not in known]
        known.update(zip(new, self._joined(new), strict=True))
        for i, first, ws in zip(simple, firsts, words, strict=True):
            out[i] = first + b"".join(map(known.__getitem__, ws[1:]))
        return out


@functools.cache
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


def pack_directory(doc_ids: list, lengths: np.ndarray, prior: bytes = b"") -> bytes:
    """Document numbers (nulls allowed) and id counts of a segment, and the prior
    of its ids."""
    known = np.array([d is not None for d in doc_ids], bool)
    numbers = np.array([0 if d is None else d for d in doc_ids], "<i8")
    body = zlib.compress(np.packbits(known).tobytes() + numbers.tobytes() + lengths.astype("<u4").tobytes() + prior, 6)
    return _DIRECTORY.pack(_MAGIC, len(doc_ids), len(body), zlib.crc32(body)) + body


def unpack_directory(data: bytes) -> tuple[list, np.ndarray, bytes]:
    magic, n, length, crc = _DIRECTORY.unpack_from(data)
    body = data[_DIRECTORY.size :]
    if magic != _MAGIC or len(body) != length or zlib.crc32(body) != crc:
        raise ValueError("segment directory is damaged")
    body, bits = zlib.decompress(body), -(-n // 8)
    known = np.unpackbits(np.frombuffer(body[:bits], np.uint8), count=n).astype(bool)
    numbers = np.frombuffer(body, "<i8", n, bits).tolist()
    lengths = np.frombuffer(body, "<u4", n, bits + 8 * n)
    return [d if k else None for d, k in zip(numbers, known.tolist(), strict=True)], lengths, body[bits + 12 * n :]


def write_token_files(docs: DataFrame, path: str, tokenizer: str = "byte_bpe_50k.json", end_id: int = END_ID) -> None:
    """Write the ids of all rows of ``docs``, in ascending doc_id order, to ``path``."""
    file = tokenizer_path(tokenizer)
    small_batches(docs)
    shards = partitions_for(docs, SHARD_BYTES)

    def segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(file)
        size = encoder.library.get_vocab_size()
        if size > 1 << 16:
            raise ValueError("the file format holds 16-bit ids")
        end = np.array([end_id], "<u2").tobytes()
        shard, number = TaskContext.get().partitionId(), 0
        numbers: list = []
        held: list[bytes] = []
        n_ids = 0

        def segment() -> pd.DataFrame:
            lengths = np.array([len(x) // 2 for x in held], np.int64)
            ids = np.frombuffer(b"".join(held), "<u2")
            # enough blocks to advance side by side, whatever the shard's size
            block = int(np.clip(len(ids) // (rangecoder.LANES // 4), *BLOCK_IDS))
            prior = rangecoder.prior_of(ids, size)
            return pd.DataFrame({
                "shard": [shard], "segment": [number], "n_ids": [len(ids)], "size": [size], "block": [block],
                "directory": [pack_directory(numbers, lengths, prior)], "ids": [rangecoder.encode(ids, size, block, prior)]})

        for batch in batches:
            for doc_id, ids in zip(batch["doc_id"], encoder.encode(batch["text"].tolist()), strict=True):
                numbers.append(None if pd.isna(doc_id) else int(doc_id))
                held.append(ids + end)
                n_ids += len(ids) // 2 + 1
                if n_ids >= SEGMENT_IDS:
                    yield segment()
                    number, n_ids, numbers, held = number + 1, 0, [], []
        if held:
            yield segment()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    # rows of one doc_id, or of none, may be many: their texts order them on
    laid = rows.repartitionByRange(shards, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    laid.mapInPandas(segments, SEGMENT).write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files:
    ``start`` counts the ids of all documents before it."""
    rows = spark.read.schema(SEGMENT).parquet(path)

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for s in batch.itertuples(index=False):
                numbers, lengths, prior = unpack_directory(s.directory)
                ids = rangecoder.decode(s.ids, s.size, s.block, prior)
                ends = np.cumsum(lengths, dtype=np.int64)
                if len(ids) != s.n_ids or (len(ends) and ends[-1] != s.n_ids):
                    raise ValueError("segment is not whole")
                wide = ids.astype("<u4")
                begins = ends - lengths
                yield pd.DataFrame({
                    "shard": s.shard, "segment": s.segment, "doc_id": pd.array(numbers, "Int64"), "within": begins,
                    "n_tokens": lengths.astype(np.int64),
                    "ids_crc32": [zlib.crc32(wide[a:b].tobytes()) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]})

    found = rows.mapInPandas(documents, "shard int, segment int, doc_id long, within long, n_tokens long, ids_crc32 long")
    sizes = running_totals(rows.select("shard", "segment", "n_ids"), ["shard", "segment"], ["n_ids"], inclusive=False)
    return found.join(sizes, ["shard", "segment"]).select(
        "doc_id", (F.col("cum_n_ids") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """Write the corpus to the shared folder and read it back."""
    spark = docs.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/token-files/{uuid.uuid4().hex}"
    try:
        write_token_files(docs, path, tokenizer)
        return cut_lineage(read_token_files(spark, path))
    finally:
        remove(spark, path)
