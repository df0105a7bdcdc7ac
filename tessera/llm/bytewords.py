"""Words of whole Arrow text columns, found on their UTF-8 bytes with numpy.

All characters that separate words or pieces are ASCII, so bytes of longer
characters are never touched and whole columns are cut at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: bytes of text that are cut at once (a longer single text is cut whole)
SLICE_BYTES = 8 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

INSIDE, BLANK, BREAK = 0, 1, 2


def byte_classes(blanks: bytes, breaks: bytes = b"") -> np.ndarray:
    """Class of every byte: in a word, between words, between pieces."""
    out = np.full(256, INSIDE, np.uint8)
    out[list(blanks)] = BLANK
    out[list(breaks)] = BREAK
    return out


@dataclass
class Words:
    words: pa.Array       # large binary, A-Z lower-cased
    row: np.ndarray       # row of the column each word stands in
    piece: np.ndarray     # number of its piece, never shared by two rows


def slices(column: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(first row, part) of a column, in parts of about ``SLICE_BYTES``."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE_BYTES, "right")) - 1)
        yield at, column.slice(at, to - at)
        at = to


def split(column: pa.Array, classes: np.ndarray) -> Words:
    """All words of a large string column without nulls."""
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[ends[0] : ends[-1]] if raw is not None else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    kind = classes[data]
    inside = kind == INSIDE
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = ends[:-1][ends[:-1] < len(data)]     # a text's first byte begins a word of its own
    first[heads] = inside[heads]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(stops - starts, out=offsets[1:])
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(LOWER[data[inside]])])
    row = np.searchsorted(ends, starts, "right") - 1
    return Words(words, row, np.searchsorted(np.flatnonzero(kind == BREAK), starts) + row)
