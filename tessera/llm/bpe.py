"""Byte-level BPE encoding and decoding over padded numpy matrices.

Each distinct piece of a batch is a row of byte ids.  Rows of similar length
share a matrix; in every round each row merges its leftmost pair of minimum
rank, ranks come from a hashed pair table, the row closes up over the merged
place, and rows without a mergeable pair leave the matrix.  Pieces that return
keep their ids in the worker, up to a bound.

A piece longer than ``MATRIX_WIDTH`` bytes is a matrix of one row that merges
every non-overlapping place of its minimum-rank pair in a round, unless that
brings up a pair of lower rank, in which case only the leftmost place merges:
the same result in far fewer rounds.

Defined results: a null or empty text has no ids and decodes to no bytes;
repeated rows give repeated results; an empty table gives an empty one; only
``doc_id`` and ``text`` are read, so other names cannot clash.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import pretokens
from tessera.llm.common import give_back, portions, small_batches, text_or_empty, tokenizer_path

#: upper bounds of the length buckets
WIDTHS = (4, 8, 12, 16, 24, 32, 64)
MATRIX_WIDTH = WIDTHS[-1]
#: rows in one matrix, and pieces whose ids a worker keeps
MATRIX_ROWS = 1 << 15
MAX_PIECES = 250_000
NONE = np.int32(2**31 - 1)


class PairTable:
    """Open-addressing hash table from (left id, right id) to the merged id,
    which is also the rank."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        self.bits = max(4, (4 * len(pairs)).bit_length())
        keys = np.array([l << 32 | r for l, r in pairs], np.uint64)
        values = np.array(list(pairs.values()), np.int32)
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.values = np.full(1 << self.bits, NONE)
        slots, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[slots[left]] == np.uint64(2**64 - 1)
            _, first = np.unique(slots[left], return_index=True)
            takes = np.zeros(len(left), bool)
            takes[first] = True
            takes &= free
            done = left[takes]
            self.keys[slots[done]], self.values[slots[done]] = keys[done], values[done]
            left = left[~takes]
            slots[left] = (slots[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NONE`` where there is none (negative ids: padding)."""
        shape = left.shape
        keys = (left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint32)).reshape(-1)
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], NONE)
        open_ = np.flatnonzero((found != keys) & (found != np.uint64(2**64 - 1)))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (found != np.uint64(2**64 - 1))]
        out = out.reshape(shape)
        out[(left < 0) | (right < 0)] = NONE
        return out


class Vocabulary:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.pairs = PairTable({
            (ranks[t[:k]], ranks[t[k:]]): i
            for t, i in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks})

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of every piece, as unsigned 32-bit arrays."""
        out: list[np.ndarray] = [np.zeros(0, "<u4")] * len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        low = 0
        for width in WIDTHS:
            rows = np.flatnonzero((lengths > low) & (lengths <= width))
            for k in range(0, len(rows), MATRIX_ROWS):
                self._matrix(pieces, rows[k : k + MATRIX_ROWS], lengths, width, out)
            low = width
        for row in np.flatnonzero(lengths > MATRIX_WIDTH):
            out[row] = self._long(pieces[row])
        return out

    def _matrix(self, pieces, rows, lengths, width, out) -> None:
        n, have = len(rows), lengths[rows]
        ids = np.full((n, width), -1, np.int32)
        ids[np.arange(width) < have[:, None]] = self.byte_ids[
            np.frombuffer(b"".join([pieces[r] for r in rows.tolist()]), np.uint8)]
        rank = np.full((n, width), NONE)
        rank[:, :-1] = self.pairs.rank(ids[:, :-1], ids[:, 1:])
        here, cols = np.arange(n), np.arange(width)
        while True:
            at = rank.argmin(axis=1)
            best = rank[here, at]
            done = best == NONE
            if done.any():
                for r, line, k in zip(rows[done].tolist(), ids[done].astype("<u4"), have[done].tolist(), strict=True):
                    out[r] = line[:k]
                keep = ~done
                rows, ids, rank, have, at, best = rows[keep], ids[keep], rank[keep], have[keep], at[keep], best[keep]
                here = np.arange(len(rows))
                if not len(rows):
                    return
            # close up over the merged place
            ids[here, at] = best
            move = np.minimum(cols + (cols > at[:, None]), width - 1)
            ids, rank = np.take_along_axis(ids, move, 1), np.take_along_axis(rank, move, 1)
            ids[:, -1], rank[:, -1] = -1, NONE
            have = have - 1
            after = np.minimum(at + 1, width - 1)
            rank[here, at] = np.where(after > at, self.pairs.rank(ids[here, at], ids[here, after]), NONE)
            before = np.flatnonzero(at > 0)
            rank[before, at[before] - 1] = self.pairs.rank(ids[before, at[before] - 1], ids[before, at[before]])

    def _long(self, piece: bytes) -> np.ndarray:
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)]
        rank = self.pairs.rank(ids[:-1], ids[1:])
        while len(ids) > 1 and (best := rank.min()) != NONE:
            at = np.flatnonzero(rank == best)
            # of touching places every second one merges, from the left
            run = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) > 1, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            for places in (at, at[:1]):
                merged = ids.copy()
                merged[places] = best
                keep = np.ones(len(ids), bool)
                keep[places + 1] = False
                merged = merged[keep]
                new = self.pairs.rank(merged[:-1], merged[1:])
                if len(places) == 1 or not (new < best).any():
                    break
            ids, rank = merged, new
            if not len(rank):
                break
        return ids.astype("<u4")


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    with open(path, "rb") as f:
        return Vocabulary({base64.b64decode(t): int(i) for t, i in (line.split() for line in f if line.strip())})


class _Pieces(dict):
    """Ids (little-endian bytes) of the pieces met so far."""


@functools.cache
def _known(path: str) -> _Pieces:
    return _Pieces()


def encode_texts(texts: list[str], path: str) -> list[bytes]:
    """Ids of every text as little-endian unsigned 32-bit integers."""
    known, vocab = _known(path), vocabulary(path)
    if len(known) > MAX_PIECES:
        known.clear()
    cut = pretokens.cut(texts)
    new = [p for p in dict.fromkeys(p for pieces in cut for p in pieces) if p not in known]
    for p, ids in zip(new, vocab.encode_pieces([p.encode() for p in new]), strict=True):
        known[p] = ids.tobytes()
    return [b"".join(map(known.__getitem__, pieces)) for pieces in cut]


def decode_ids(ids: list[bytes], path: str) -> list[bytes]:
    """The bytes that ids (little-endian unsigned 32-bit integers) stand for."""
    token = vocabulary(path).bytes_of.__getitem__
    return [b"".join(map(token, np.frombuffer(x, "<u4").tolist())) for x in ids]


def encode(docs: DataFrame, ranks: str = "byte_bpe_50k.tiktoken", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``n_tokens`` and ``ids`` (binary: little-endian unsigned
    32-bit integers) of every row's text."""
    path = tokenizer_path(ranks)
    small_batches(docs)

    @F.pandas_udf("binary")
    def ids(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series([x for p in portions(s) for x in encode_texts(p, path)], dtype=object)
        give_back()

    out = docs.select(*keep, ids(text_or_empty()).alias("ids"))
    return out.select(*keep, F.expr("CAST(octet_length(ids) DIV 4 AS BIGINT)").alias("n_tokens"), "ids")


def decode(encoded: DataFrame, ranks: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """``encoded`` with ``decoded`` (binary): the bytes its ``ids`` stand for."""
    path = tokenizer_path(ranks)
    small_batches(encoded)

    @F.pandas_udf("binary")
    def decoded(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in ids:
            yield pd.Series(decode_ids(s.tolist(), path), dtype=object)
        give_back()

    return encoded.withColumn("decoded", decoded("ids"))


def digests(decoded: DataFrame) -> DataFrame:
    """``ids`` and ``decoded`` as SHA-256 digests in lowercase hex."""
    return decoded.select(
        *[c for c in decoded.columns if c not in ("ids", "decoded")],
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
