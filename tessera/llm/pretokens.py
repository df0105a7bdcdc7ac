"""Cutting text into the pieces that byte-level BPE merges separately.

The pattern is the public one of the vocabulary files
(``public_tokenizers.PATTERN``): contractions, an optional space with a run of
letters, of digits or of other signs, and white-space runs that leave their
last character to what follows.  ``symbols`` turns characters into the small
alphabet that decides where a piece begins; ``starts`` is the closed form of
that decision over whole numpy arrays (every rule looks at most one character
back and three ahead).
"""

from __future__ import annotations

import functools
import sys
import unicodedata

import numpy as np

#: alphabet of the cut: letter, digit, other sign, blank that is followed by a
#: non-space, other white space that is followed by a non-space, white space
#: followed by white space or the end, apostrophe of a contraction with one and
#: with two more characters
LETTER, DIGIT, OTHER, BLANK_LAST, SPACE_LAST, SPACE_MID, SHORT, LONG = range(8)
N_SYMBOLS = 8
_SPACE = 3


@functools.cache
def _classes() -> np.ndarray:
    """Class of every code point: letter, digit, other or white space.  Where
    the two Unicode tables at hand differ (recent additions), the tokenizer
    library's own cutter decides."""
    import regex
    from tokenizers.pre_tokenizers import ByteLevel

    out = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    # surrogates cannot occur in a text
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    for pattern, value in ((r"\p{L}", LETTER), (r"\p{N}", DIGIT), (r"\s", _SPACE)):
        found = "".join(regex.findall(pattern, every))
        out[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = value
    kinds = {"L": LETTER, "N": DIGIT}
    cutter = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    for ch in every:
        if out[ord(ch)] != _SPACE and out[ord(ch)] != kinds.get(unicodedata.category(ch)[0], OTHER):
            joins = (v for v, one in ((LETTER, "a"), (DIGIT, "1"), (OTHER, "!")) if len(cutter(one + ch)) == 1)
            out[ord(ch)] = next(joins, _SPACE)
    return out


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def symbols(cp: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Symbol of each character of several texts laid end to end; ``ends``:
    positions where a text ends (exclusive)."""
    n = len(cp)
    sym = _classes()[cp]
    last = np.zeros(n + 3, bool)       # the last character of its text
    last[ends[ends > 0] - 1] = True
    space = sym == _SPACE
    before_text = np.zeros(n, bool)    # a non-space follows in the same text
    before_text[:-1] = ~space[1:] & ~last[: n - 1] if n else False
    sym[space & ~before_text] = SPACE_MID
    sym[space & before_text] = SPACE_LAST
    sym[space & before_text & (cp == 32)] = BLANK_LAST
    # an apostrophe begins a contraction unless an open run takes it
    at = np.flatnonzero(cp == 39)
    if len(at):
        begins = np.zeros(n, bool)
        begins[0] = True
        e = ends[(ends > 0) & (ends < n)]
        begins[e] = True
        prev = sym[at - 1]
        at = at[begins[at] | ((prev != OTHER) & (prev != BLANK_LAST))]
        pad = np.concatenate([cp, np.zeros(3, cp.dtype)])
        one, two = pad[at + 1], pad[at + 2]
        room1, room2 = ~last[at], ~last[at] & ~last[at + 1]
        sym[at[room1 & np.isin(one, [ord(x) for x in "stmd"])]] = SHORT
        pair = one.astype(np.int64) << 32 | two
        sym[at[room2 & np.isin(pair, [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")])]] = LONG
    return sym


def starts(sym: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where a piece begins (boolean), for ``symbols`` of texts laid end to end."""
    n = len(sym)
    kind = np.where(sym >= SHORT, OTHER, sym)
    kind[(sym >= BLANK_LAST) & (sym <= SPACE_MID)] = _SPACE
    out = np.ones(n, bool)
    if not n:
        return out
    same = kind[1:] == kind[:-1]
    after_blank = sym[:-1] == BLANK_LAST
    out[1:] = ~(same | after_blank) | (sym[1:] == BLANK_LAST) | (sym[1:] == SPACE_LAST)
    for symbol, more in ((SHORT, 1), (LONG, 2)):
        at = np.flatnonzero(sym == symbol)
        for k in range(1, more + 1):
            out[at + k] = False
        out[at] = True
        nxt = at + more + 1
        out[nxt[nxt < n]] = True
    out[0] = True
    e = ends[(ends > 0) & (ends < n)]
    out[e] = True
    return out


def cut(texts: list[str]) -> list[list[str]]:
    """The pieces of every text."""
    joined = "".join(texts)
    if not joined:
        return [[] for _ in texts]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths)
    at = np.flatnonzero(starts(symbols(code_points(joined), ends), ends))
    stops = np.append(at[1:], len(joined))
    pieces = [joined[a:b] for a, b in zip(at.tolist(), stops.tolist(), strict=True)]
    of = np.searchsorted(at, np.concatenate([[0], ends]))
    return [pieces[a:b] for a, b in zip(of[:-1].tolist(), of[1:].tolist(), strict=True)]
