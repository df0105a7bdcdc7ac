"""Adaptive context-mixing range coder for token ids, many blocks side by side.

A block is a run of ids that starts from fresh models and decodes on its own.
All blocks of a call advance together: step ``t`` codes id ``t`` of every block,
as numpy operations over the blocks.

Three predictions share the code space of the next id:

* order 0: how often each group of 64 neighbouring ids occurred in the block so
  far (byte-pair ids are numbered by frequency), times the share of the id in its
  group by a *prior*: the ids' frequencies over many blocks, one byte for each,
  which the caller stores beside the blocks; groups start from the prior as well;
* order 1 and order 2: the id last seen behind the previous one or two ids, from
  hashed tables that hold an id and a confidence.

The order-2 prediction gets the share of its confidence's predictions that came
true in this block, the order-1 prediction that of its own in what is left, and
order 0 the rest; where both predict the same id their shares add up.  Shares and
order-0 tables are made anew after 32, 64, 128, ... ids.  A carry-less range coder with 64-bit state
codes the interval; it moves 32 bits out when its range has no more than 32 bits
left.

Block: magic, number of ids, bytes of code, CRC-32 of the ids, code.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"TIB1"
_HEAD = struct.Struct("<4sIII")

GROUP_BITS = 6              # ids of a group
MEMBER_BITS = 9             # a group's ids share 2**9 units
UNIT_BITS = 14              # group tables sum to 2**14
TOTAL_BITS = MEMBER_BITS + UNIT_BITS
SHARE_BITS = 6              # code space is dealt out in 64 shares
GAIN = 16                   # weight of an occurrence against an unseen group
PRIOR_GAIN = 64 * GAIN      # weight of the prior of all groups together
BITS1, BITS2 = 10, 11       # slots of the hashed tables
LEVELS = 4                  # confidences
FIRST_REFRESH = 32
LANES = 2048                # blocks side by side

U = np.uint64
_SHIFT, _WORD = U(TOTAL_BITS + SHARE_BITS), U(32)
_LOW32 = U(0xFFFFFFFF)
_MASK1, _MASK2 = (1 << BITS1) - 1, (1 << BITS2) - 1
_WHOLE = 1 << (TOTAL_BITS + SHARE_BITS)
# an entry of the hashed tables: id | confidence << 16; a hit raises it so much
_RISE = np.array([1 << 16] * (LEVELS - 1) + [0])


def _epochs(steps: int) -> list[tuple[int, int]]:
    """Spans of steps that share an order-0 table."""
    cuts, at = [0], FIRST_REFRESH
    while at < steps:
        cuts.append(at)
        at *= 2
    return list(zip(cuts, [*cuts[1:], steps], strict=True))


def prior_of(ids: np.ndarray, size: int) -> bytes:
    """One byte per id: its frequency in quarter powers of two, 0 for none."""
    n = np.bincount(np.asarray(ids, np.int64), minlength=size)[:size]
    return np.where(n, np.minimum(np.round(4 * np.log2(np.maximum(n, 1))) + 1, 255), 0).astype(np.uint8).tobytes()


class _Prior:
    """What the prior says about groups, and about ids inside their group."""

    def __init__(self, size: int, prior: bytes | None):
        self.groups = -(-size // (1 << GROUP_BITS))
        steps = np.zeros(self.groups << GROUP_BITS, np.int64)
        if prior is not None:
            steps[:size] = np.frombuffer(prior, np.uint8)
        # whole numbers, so that every machine makes the same tables
        quarter = np.array([256, 304, 362, 431], np.int64)
        weight = np.where(steps, (quarter[(steps - 1) & 3] << np.minimum((steps - 1) >> 2, 40)) >> 8, 0).reshape(self.groups, -1)
        total = weight.sum(axis=1)
        # every id has a unit of its group, the others go by weight
        free = (1 << MEMBER_BITS) - (1 << GROUP_BITS)
        even = np.arange(1, (1 << GROUP_BITS) + 1) * free >> GROUP_BITS
        cum = np.where(total[:, None] > 0, np.cumsum(weight, axis=1) * free // np.maximum(total, 1)[:, None], even)
        cum += np.arange(1, (1 << GROUP_BITS) + 1)
        wide = np.diff(cum, axis=1, prepend=0)
        self.wide = wide.reshape(-1)
        self.low = (cum - wide).reshape(-1)
        self.member_of = np.repeat(np.tile(np.arange(1 << GROUP_BITS, dtype=np.uint8), self.groups), self.wide)
        whole = int(total.sum())
        self.start = total * PRIOR_GAIN // whole if whole else np.zeros(self.groups, np.int64)


class _OrderZero:
    """Cumulative group tables of several blocks."""

    def __init__(self, lanes: int, prior: _Prior, decoding: bool):
        self.lanes, self.decoding, self.t, self.prior = lanes, decoding, 0, prior
        self.groups = prior.groups
        self.counts = np.zeros((lanes, self.groups), np.int64)
        self.row = np.arange(lanes) * (self.groups + 1)
        self.unit_row = np.arange(lanes) << UNIT_BITS

    def refresh(self, ids: np.ndarray) -> None:
        """Count ``ids`` (steps x lanes) and make the tables anew."""
        if len(ids):
            at = (ids >> GROUP_BITS) + np.arange(self.lanes) * self.groups
            self.counts += np.bincount(at.reshape(-1), minlength=self.counts.size).reshape(self.counts.shape)
        self.t += len(ids)
        space, total = (1 << UNIT_BITS) - self.groups, self.groups + GAIN * self.t + int(self.prior.start.sum())
        cum = np.zeros((self.lanes, self.groups + 1), np.int64)
        np.cumsum(1 + self.prior.start + GAIN * self.counts, axis=1, out=cum[:, 1:])
        cum *= space
        cum //= total
        cum += np.arange(self.groups + 1)
        self.cum = cum.reshape(-1)
        if self.decoding:
            # the group of every unit
            each = np.tile(np.arange(self.groups, dtype=np.uint16), self.lanes)
            self.group_of = np.repeat(each, np.diff(cum, axis=1).reshape(-1))

    def span(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lower end, width) of ids ``x`` (any rows x lanes)."""
        at = (x >> GROUP_BITS) + self.row
        low = self.cum.take(at)
        width = self.cum.take(at + 1) - low
        return (low << MEMBER_BITS) + self.prior.low.take(x) * width, self.prior.wide.take(x) * width

    def find(self, lanes: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(id, lower end, width) of the intervals that hold ``v``, for some lanes."""
        group = self.group_of.take(self.unit_row.take(lanes) + (v >> MEMBER_BITS)).astype(np.int64)
        at = self.row.take(lanes) + group
        low = self.cum.take(at)
        width = self.cum.take(at + 1) - low
        low <<= MEMBER_BITS
        x = (group << GROUP_BITS) + self.prior.member_of.take((group << MEMBER_BITS) + (v - low) // width)
        return x, low + self.prior.low.take(x) * width, self.prior.wide.take(x) * width


class _Contexts:
    """Order-1 and order-2 predictions of several blocks, both stacked in one
    array: the first half holds order 1."""

    def __init__(self, lanes: int, steps: int):
        self.lanes = lanes
        each = (1 << BITS1) + (1 << BITS2)
        self.table = np.zeros(lanes * each, np.int64)
        # order 2 lies behind order 1
        self.row = np.arange(lanes) * each
        self.level_row = np.arange(2 * lanes) * LEVELS
        self.tried = np.ones(2 * lanes * LEVELS)
        self.came = np.zeros(2 * lanes * LEVELS)
        self.seen = np.zeros((_longest_epoch(steps), 2 * lanes), np.uint8)
        self.hits = np.zeros((_longest_epoch(steps), 2 * lanes), bool)
        self.t = 0
        self.refresh()

    def refresh(self) -> None:
        """Shares from how often predictions came true so far."""
        if self.t:
            seen, hits = self.seen[: self.t], self.hits[: self.t]
            for level in range(LEVELS):
                at = seen == level
                self.tried[level::LEVELS] += np.count_nonzero(at, axis=0)
                self.came[level::LEVELS] += np.count_nonzero(at & hits, axis=0)
        most = 1 << SHARE_BITS
        # of the whole for order 2, of what order 2 leaves for order 1
        self.shares = np.clip((self.came * most / self.tried).astype(np.int64), 1, most - 3)
        self.t = 0

    def slots(self, last: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Table places for contexts (any rows x lanes), both orders stacked."""
        out = np.empty((*last.shape[:-1], 2 * self.lanes), np.int64)
        np.add(last & _MASK1, self.row, out=out[..., : self.lanes])
        np.add((last * 40503 + before) & _MASK2, self.row + (1 << BITS1), out=out[..., self.lanes :])
        return out

    def predict(self, slot: np.ndarray) -> None:
        n, self.slot = self.lanes, slot
        self.entry = self.table.take(slot)
        self.c, self.k = self.entry & 0xFFFF, self.entry >> 16
        shares, most = self.shares.take(self.level_row + self.k), 1 << SHARE_BITS
        second = shares[n:]
        first = np.maximum(1, (most - second) * shares[:n] >> SHARE_BITS)
        self.m1 = first << TOTAL_BITS
        self.m12 = (first + second) << TOTAL_BITS
        self.rest = most - first - second

    def interval(self, xx: np.ndarray, low: np.ndarray, wide: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, width) of ids (stacked twice) with the order-0 span (low,
        wide); notes which predictions came true."""
        n, self.true = self.lanes, self.c == xx
        t1, t2 = self.true[:n], self.true[n:]
        start = np.where(t1, 0, np.where(t2, self.m1, self.m12 + self.rest * low))
        end = np.where(t2, self.m12, np.where(t1, self.m1, start + self.rest * wide))
        return start, end - start

    def update(self, xx: np.ndarray) -> None:
        self.seen[self.t], self.hits[self.t] = self.k, self.true
        self.t += 1
        self.table[self.slot] = np.where(self.true, self.entry + _RISE.take(self.k), xx)


def _longest_epoch(steps: int) -> int:
    return max(b - a for a, b in _epochs(steps))


def _encode(lanes: np.ndarray, prior: _Prior) -> list[bytes]:
    """Code of every row of ``lanes`` (blocks x ids)."""
    n, steps = lanes.shape
    behind = np.zeros((steps + 2, n), np.int64)
    behind[2:] = lanes.T
    ids = behind[2:]
    zero, contexts = _OrderZero(n, prior, False), _Contexts(n, steps)
    low, rng = np.zeros(n, U), np.full(n, U(2**64 - 1))
    out, pos = np.zeros(n * (steps + 4), "<u4"), np.arange(n) * (steps + 4)
    begin = pos.copy()
    done = 0
    for first, stop in _epochs(steps):
        zero.refresh(ids[done:first])
        contexts.refresh()
        done = first
        for part in range(first, stop, 256):
            end = min(part + 256, stop)
            lows, wides = zero.span(ids[part:end])
            slots = contexts.slots(behind[part + 1 : end + 1], behind[part:end])
            twice = np.concatenate([ids[part:end]] * 2, axis=1)
            for xx, slot, lo, wide in zip(twice, slots, lows, wides, strict=True):
                contexts.predict(slot)
                start, width = contexts.interval(xx, lo, wide)
                unit = rng >> _SHIFT
                low += unit * start.view(U)
                rng = unit * width.view(U)
                go = np.flatnonzero(rng <= _LOW32)
                if len(go):
                    l, r, to = low.take(go), rng.take(go), pos.take(go)
                    r = np.where((l ^ (l + r)) >> _WORD, (U(0) - l) & _LOW32, r)
                    out[to] = l >> _WORD
                    pos[go] = to + 1
                    low[go], rng[go] = l << _WORD, r << _WORD
                contexts.update(xx)
    for _ in range(2):
        out[pos] = low >> _WORD
        pos += 1
        low <<= _WORD
    return [out[a:b].tobytes() for a, b in zip(begin.tolist(), pos.tolist(), strict=True)]


def _decode(codes: list[bytes], steps: int, prior: _Prior) -> np.ndarray:
    n = len(codes)
    zero, contexts = _OrderZero(n, prior, True), _Contexts(n, steps)
    words = np.array([len(c) // 4 for c in codes])
    units = np.frombuffer(b"".join(codes) + bytes(16), "<u4").astype(U)
    pos = np.cumsum(words) - words
    code = units[pos] << _WORD | units[pos + 1]
    pos += 2
    low, rng = np.zeros(n, U), np.full(n, U(2**64 - 1))
    most = U(_WHOLE - 1)
    out = np.zeros((steps + 2, n), np.int64)
    lows, wides = np.zeros(n, np.int64), np.zeros(n, np.int64)
    done = 0
    for first, stop in _epochs(steps):
        zero.refresh(out[done + 2 : first + 2])
        contexts.refresh()
        done = first
        for t in range(first, stop):
            contexts.predict(contexts.slots(out[t + 1], out[t]))
            unit = rng >> _SHIFT
            v = np.minimum((code - low) // unit, most).view(np.int64)
            x = np.where(v < contexts.m1, contexts.c[:n], contexts.c[n:])
            free = np.flatnonzero(v >= contexts.m12)
            if len(free):
                plain = (v.take(free) - contexts.m12.take(free)) // contexts.rest.take(free)
                x[free], lows[free], wides[free] = zero.find(free, plain)
            out[t + 2] = x
            xx = np.concatenate([x, x])
            start, width = contexts.interval(xx, lows, wides)
            low += unit * start.view(U)
            rng = unit * width.view(U)
            go = np.flatnonzero(rng <= _LOW32)
            if len(go):
                l, r, at = low.take(go), rng.take(go), pos.take(go)
                r = np.where((l ^ (l + r)) >> _WORD, (U(0) - l) & _LOW32, r)
                code[go] = code.take(go) << _WORD | units.take(at, mode="clip")
                pos[go] = at + 1
                low[go], rng[go] = l << _WORD, r << _WORD
            contexts.update(xx)
    return out[2:].T


def encode(ids: np.ndarray, size: int, block: int, prior: bytes | None = None) -> bytes:
    """``ids`` (below ``size``) as a sequence of blocks of ``block`` ids."""
    about = _Prior(size, prior)
    ids = np.asarray(ids, np.uint16)
    rows = -(-len(ids) // block)
    full = np.zeros(rows * block, np.uint16)
    full[: len(ids)] = ids
    full = full.reshape(rows, block)
    out = []
    for k in range(0, rows, LANES):
        for i, code in enumerate(_encode(full[k : k + LANES], about), k):
            own = ids[i * block : (i + 1) * block].astype("<u2").tobytes()
            out.append(_HEAD.pack(MAGIC, len(own) // 2, len(code), zlib.crc32(own)) + code)
    return b"".join(out)


def decode(data: bytes, size: int, block: int, prior: bytes | None = None) -> np.ndarray:
    """The ids of a sequence of blocks; ValueError where a block is damaged."""
    about, blocks, at = _Prior(size, prior), [], 0
    while at < len(data):
        if len(data) - at < _HEAD.size:
            raise ValueError("block header cut short")
        magic, n, length, crc = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        if magic != MAGIC or n > block or at + length > len(data):
            raise ValueError("not a block")
        blocks.append((n, data[at : at + length], crc))
        at += length
    out = []
    for k in range(0, len(blocks), LANES):
        part = blocks[k : k + LANES]
        for (n, _, crc), row in zip(part, _decode([c for _, c, _ in part], block, about), strict=True):
            own = row[:n].astype("<u2")
            if zlib.crc32(own.tobytes()) != crc:
                raise ValueError("block checksum does not match")
            out.append(own)
    return np.concatenate(out) if out else np.zeros(0, "<u2")
