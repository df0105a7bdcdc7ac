"""Token counts by finite-state transducers.

Two deterministic transducers count the tokens of byte-level BPE without
running its merges on the text:

* the *cutting* transducer reads the symbols of ``pretokens.symbols`` and emits
  1 where a piece begins.  A batch of texts is one long symbol string cut into
  chunks of equal length; all chunks are read side by side from every state at
  once, which gives each chunk's map from entry state to exit state.  The maps
  compose, so a parallel prefix scan yields every chunk's entry state, and a
  second pass emits;
* the *merging* transducer reads the bytes of one piece.  A BPE encoding is
  decided by its neighbouring pairs: after each byte exactly one vocabulary
  entry that ends there can follow the encoding of what precedes it.  A state
  is therefore the open vocabulary prefixes with the token before each of them;
  a transition carries the change of the token count.  Transitions are compiled
  from the merge ranks when first met and kept up to a bound.  Both states
  start anew at a piece, so the maps of the second are constant there.

Added tokens (special strings) inside a text are found first, as the library
does by default, and count one each.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows
give repeated results; an empty table gives an empty one; columns other than
``doc_id`` and ``text`` are not read, so their names cannot clash.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import pretokens
from tessera.llm.common import small_batches, text_or_empty, tokenizer_path

#: compiled transitions, and pieces with a known count, kept in a worker
MAX_TRANSITIONS = 600_000
MAX_PIECES = 600_000
#: symbols in a chunk of the cutting transducer
CHUNK = 512

# States of the cutting transducer: no open piece, open run of letters, digits,
# other signs, white space, a blank that the next run joins, one or two
# characters of a contraction to come.
FRESH, IN_LETTER, IN_DIGIT, IN_OTHER, IN_SPACE, HOLD, REST1, REST2 = range(8)
N_STATES = 8
END = pretokens.N_SYMBOLS          # symbol between two texts
N_ALL = pretokens.N_SYMBOLS + 1


def _cutting_tables() -> tuple[np.ndarray, np.ndarray]:
    """(next state times alphabet size, emitted 0/1), by state * alphabet + symbol."""
    nxt, out = np.zeros(N_STATES * N_ALL, np.uint8), np.zeros(N_STATES * N_ALL, bool)
    runs = {pretokens.LETTER: IN_LETTER, pretokens.DIGIT: IN_DIGIT, pretokens.OTHER: IN_OTHER}
    for s in range(N_STATES):
        for a in range(N_ALL):
            if a == END:
                to, emit = FRESH, False
            elif s == REST2:
                to, emit = REST1, False
            elif s == REST1:
                to, emit = FRESH, False
            elif a in runs:
                to, emit = runs[a], s not in (runs[a], HOLD)
            elif a == pretokens.SHORT:
                to, emit = REST1, True
            elif a == pretokens.LONG:
                to, emit = REST2, True
            elif a == pretokens.BLANK_LAST:
                to, emit = HOLD, True
            elif a == pretokens.SPACE_LAST:
                to, emit = FRESH, True
            else:
                to, emit = IN_SPACE, s != IN_SPACE
            nxt[s * N_ALL + a], out[s * N_ALL + a] = to * N_ALL, emit
    return nxt, out


_NEXT, _EMIT = _cutting_tables()


def scan_maps(maps: np.ndarray) -> np.ndarray:
    """Inclusive parallel prefix scan of state maps: row j becomes the map of
    chunks 0..j (composition is associative, so doubling steps suffice)."""
    maps, d = maps.copy(), 1
    while d < len(maps):
        maps[d:] = np.take_along_axis(maps[d:], maps[:-d], axis=1)
        d *= 2
    return maps


def piece_starts(sym: np.ndarray) -> np.ndarray:
    """Where the cutting transducer emits over ``sym`` (END between texts)."""
    n = len(sym)
    lanes = -(-n // CHUNK)
    grid = np.full(lanes * CHUNK, END, np.uint8)
    grid[:n] = sym
    grid = np.ascontiguousarray(grid.reshape(lanes, CHUNK).T)
    # every chunk from every state
    at = np.repeat((np.arange(N_STATES, dtype=np.uint8) * N_ALL)[:, None], lanes, axis=1)
    for row in grid:
        at = _NEXT.take(at + row)
    entry = np.zeros(lanes, np.uint8)
    scanned = scan_maps((at // N_ALL).T.astype(np.intp))
    entry[1:] = scanned[:-1, FRESH]
    at, out = entry * N_ALL, np.empty(grid.shape, bool)
    for i, row in enumerate(grid):
        at = at + row
        out[i] = _EMIT.take(at)
        at = _NEXT.take(at)
    return out.T.reshape(-1)[:n]


class MergeTransducer:
    """Transitions over bytes, annotated with the change of the token count."""

    def __init__(self, tokens: dict[bytes, int], pairs: dict[tuple[int, int], tuple[int, int]]):
        """``tokens``: bytes to id; ``pairs``: (left id, right id) to (rank, merged id)."""
        self.bytes_of = {i: b for b, i in tokens.items()}
        self.byte_ids = [tokens[bytes([b])] for b in range(256)]
        self.pairs = pairs
        # prefix tree of the vocabulary: (node, byte) to node, token that ends
        # in a node (-1: none), whether a node has children
        self.tree: dict[int, int] = {}
        self.token_at, self.open = [-1], [True]
        for text, i in tokens.items():
            node = 0
            for b in text:
                child = self.tree.get(node << 8 | b)
                if child is None:
                    child = self.tree[node << 8 | b] = len(self.token_at)
                    self.token_at.append(-1)
                    self.open.append(False)
                    self.open[node] = True
                node = child
            self.token_at[node] = i
        self._reset()

    def _reset(self) -> None:
        self.states = [((0, -1, 0),)]
        self.ids = {self.states[0]: 0}
        self.step: dict[int, tuple[int, int]] = {}
        self.follows: dict[tuple[int, int], bool] = {}

    def _merged(self, text: bytes) -> list[int]:
        ids = [self.byte_ids[b] for b in text]
        while len(ids) > 1:
            found = [(self.pairs[p][0], i) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.pairs]
            if not found:
                break
            i = min(found)[1]
            ids[i : i + 2] = [self.pairs[ids[i], ids[i + 1]][1]]
        return ids

    def _can_follow(self, last: int, token: int) -> bool:
        """Whether BPE leaves ``last`` and ``token`` side by side (``last`` -1:
        whether ``token`` is its own encoding)."""
        key = (last, token)
        known = self.follows.get(key)
        if known is None:
            left = [] if last < 0 else [last]
            text = b"".join(self.bytes_of[i] for i in [*left, token])
            known = self.follows[key] = self._merged(text) == [*left, token]
        return known

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        still, token, emitted = [], -1, 0
        for node, last, behind in self.states[state]:
            child = self.tree.get(node << 8 | byte)
            if child is None:
                continue
            ends = self.token_at[child]
            if ends >= 0 and self._can_follow(last, ends):
                token, emitted = ends, behind + 1
            if self.open[child]:
                still.append((child, last, behind))
        new = (*((c, last, behind - emitted) for c, last, behind in still), (0, token, 0))
        to = self.ids.get(new)
        if to is None:
            to = self.ids[new] = len(self.states)
            self.states.append(new)
        move = self.step[state << 8 | byte] = (to, emitted)
        return move

    def count(self, piece: bytes) -> int:
        if len(self.step) > MAX_TRANSITIONS:
            self._reset()
        get, state, n = self.step.get, 0, 0
        for byte in piece:
            state, emitted = get(state << 8 | byte) or self._compile(state, byte)
            n += emitted
        return n


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies:
    printable Latin-1 bytes stand for themselves, the rest follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


@functools.cache
def load(path: str) -> tuple[MergeTransducer, list[str]]:
    """The transducer of a byte-level vocabulary file, and its added tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    alphabet = byte_alphabet()
    as_bytes = lambda t: bytes(alphabet[ch] for ch in t)
    added = [t["content"] for t in spec["added_tokens"]]
    vocab = spec["model"]["vocab"]
    pairs = {}
    for rank, m in enumerate(spec["model"]["merges"]):
        left, right = m.split(" ") if isinstance(m, str) else m
        pairs[vocab[left], vocab[right]] = (rank, vocab[left + right])
    return MergeTransducer({as_bytes(t): i for t, i in vocab.items() if t not in added}, pairs), added


class _Counts(dict):
    """Tokens of a piece, kept for pieces that return."""

    def __init__(self, transducer: MergeTransducer):
        super().__init__()
        self.transducer = transducer

    def __missing__(self, piece: str) -> int:
        n = self[piece] = self.transducer.count(piece.encode())
        return n


@functools.cache
def _counts(path: str) -> _Counts:
    return _Counts(load(path)[0])


def count_tokens(texts: list[str], path: str) -> np.ndarray:
    """Tokens of every text."""
    counts, (_, added) = _counts(path), load(path)
    if len(counts) > MAX_PIECES:
        counts.clear()
    # texts are cut at added tokens, which count one each
    extra = np.zeros(len(texts), np.int64)
    parts, owner = texts, np.arange(len(texts))
    if added and any(a in t for t in texts for a in added):
        special = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True))))
        split = [special.split(t) for t in texts]
        extra = np.array([len(p) - 1 for p in split], np.int64)
        owner = np.repeat(np.arange(len(texts)), extra + 1)
        parts = [p for ps in split for p in ps]
    if not parts:
        return extra
    joined = "\0".join(parts) + "\0"
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    sym = pretokens.symbols(pretokens.code_points(joined), np.stack([ends - 1, ends], axis=1).reshape(-1))
    sym[ends - 1] = END
    begins = piece_starts(sym)
    at = np.flatnonzero(begins)
    # a piece ends where the next one begins or its text ends
    marks = np.flatnonzero(begins | (sym == END))
    stops = marks[np.searchsorted(marks, at) + 1]
    each = np.fromiter(
        map(counts.__getitem__, [joined[a:b] for a, b in zip(at.tolist(), stops.tolist(), strict=True)]),
        np.int64, len(at))
    total = np.concatenate([[0], np.cumsum(each)])
    edges = np.searchsorted(at, np.concatenate([[0], ends]))
    per_part = total[edges[1:]] - total[edges[:-1]]
    return extra + np.bincount(owner, per_part, len(texts)).astype(np.int64)


def token_counts(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``."""
    path = tokenizer_path(tokenizer)
    small_batches(docs)

    @F.pandas_udf("long")
    def n_tokens(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series(count_tokens(s.tolist(), path))

    text = text_or_empty()
    return docs.select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), n_tokens(text).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
