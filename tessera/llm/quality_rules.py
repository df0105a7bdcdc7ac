"""Quality rules: how much of a text repeats itself.

Words get integer ids per batch; rolling hashes over the ids give every n-gram
of several lengths one 64-bit value, all texts of a batch side by side in numpy.
An n-gram is *duplicated* where its value occurs before in the same text.  The
rules measure the share of word characters inside duplicated n-grams of each
length and inside lines that repeat an earlier line.  A longer n-gram can only
repeat where the shorter one does, so each length looks at the places the
previous one left.

Defined results: null and empty texts have no words and fail the base rule;
lines without a word never count as duplicated; repeated rows give repeated
results; an empty table gives an empty one; only ``doc_id`` and ``text`` are
read, so other names cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WORD, give_back, portions, small_batches, text_or_empty

MIN_WORDS = 10
BASE_NGRAM = 5
BASE_PERCENT = 20
#: shares of word characters inside duplicated n-grams, by length, and inside
#: duplicated lines that a kept text may have
NGRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_CHAR_LIMIT = 0.20
SYMBOLS = "#*$%&|<>"

_WORDS = re.compile(WORD)

RESULT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "dup_ngram_share double, dup_line_share double, dup_line_char_share double, "
          "base_failed boolean, kept boolean")


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads integers over 64 bits."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(occurs at least twice, occurs before) for every key."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return twice | later, later


def covered(n_words: int, starts: np.ndarray, n: int) -> np.ndarray:
    """Words inside the windows of ``n`` words that begin at ``starts``."""
    edge = np.zeros(n_words + 1, np.int32)
    edge[starts] += 1
    edge[starts + n] -= 1
    return np.cumsum(edge[:-1]) > 0


def line_repeats(text: str) -> tuple[int, int, int]:
    """(lines with a word, those equal to an earlier one, word characters of the latter)."""
    if "\n" not in text:
        return int(bool(_WORDS.search(text))), 0, 0
    seen: set[str] = set()
    n = dup = chars = 0
    for line in text.split("\n"):
        if not _WORDS.search(line):
            continue
        n += 1
        if line in seen:
            dup += 1
            chars += sum(map(len, _WORDS.findall(line)))
        else:
            seen.add(line)
    return n, dup, chars


def measure(texts: list[str]) -> pd.DataFrame:
    """One row of ``RESULT`` for each text."""
    ids: dict[str, int] = {}
    words = [_WORDS.findall(t) for t in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    total, owner = int(counts.sum()), np.repeat(np.arange(len(texts)), counts)
    flat = [w for ws in words for w in ws]
    sizes = np.fromiter(map(len, flat), np.int64, total)
    word = mix(np.fromiter((ids.setdefault(w, len(ids)) for w in flat), np.int64, total))
    ends = np.cumsum(counts)[owner] if total else np.zeros(0, np.int64)
    word_chars = np.bincount(owner, sizes, len(texts))
    share = np.zeros(len(texts))
    fails = np.zeros(len(texts), bool)
    n_repeat = np.zeros(len(texts), np.int64)
    at = np.arange(total)
    rolling, base = np.zeros(total, np.uint64), np.uint64(0x2545F4914F6CDD1D)
    have = 0
    for n, limit in sorted(NGRAM_LIMITS.items()):
        while have < n:   # value of the window of have+1 words that begins here
            tail = np.zeros(total, np.uint64)
            tail[: max(total - have, 0)] = word[have:]
            rolling = rolling * base + tail
            have += 1
        at = at[at + n <= ends[at]]
        keys = mix(rolling[at] ^ mix(owner[at]))
        twice, later = repeats(keys)
        if n == BASE_NGRAM:
            n_repeat = np.bincount(owner, covered(total, at[twice], n), len(texts)).astype(np.int64)
        chars = np.bincount(owner, sizes * covered(total, at[later], n), len(texts))
        part = chars / np.maximum(word_chars, 1)
        share = np.maximum(share, part)
        fails |= part > limit
        at = at[twice]
    lines = np.array([line_repeats(t) for t in texts], np.int64).reshape(-1, 3)
    line_share = lines[:, 1] / np.maximum(lines[:, 0], 1)
    line_chars = lines[:, 2] / np.maximum(word_chars, 1)
    base_failed = (counts < MIN_WORDS) | (100 * n_repeat > BASE_PERCENT * counts)
    fails |= line_chars > LINE_CHAR_LIMIT
    return pd.DataFrame({
        "n_words": counts, "word_chars": word_chars.astype(np.int64),
        "n_symbols": [sum(map(t.count, SYMBOLS)) for t in texts], "n_dup_lines": lines[:, 1],
        "n_repeat_words": n_repeat, "dup_ngram_share": share, "dup_line_share": line_share,
        "dup_line_char_share": line_chars, "base_failed": base_failed, "kept": ~(base_failed | fails)})


def verdict(text: Column) -> Column:
    """Struct of ``RESULT`` for a text column without nulls."""

    @F.pandas_udf(RESULT)
    def measured(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            yield pd.concat([measure(p) for p in portions(s)], ignore_index=True)
        give_back()

    return measured(text)


def quality_rules(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the columns of ``RESULT`` for every row of ``docs``."""
    small_batches(docs)
    return docs.select("doc_id", verdict(text_or_empty()).alias("q")).select("doc_id", "q.*")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns."""
    small_batches(docs)
    judged = docs.select(F.struct("*").alias("row"), verdict(text_or_empty()).alias("q"))
    return judged.where("q.kept").select("row.*")
