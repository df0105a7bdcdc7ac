"""Exact k nearest neighbours over a metric index.

Index: a bounded sample of training vectors are pivots; every training row
belongs to the cell of its nearest pivot and, by its distance to it, to one of the
cell's rings.  A (cell, ring) is a block; its row count and its least and greatest
distance to the pivot are the index (at most ``MAX_PIVOTS * MAX_RINGS`` rows,
whatever the size of the table).  The triangle inequality and the bisecting
hyperplane between pivots bound from below how near a block's rows can be.

Search: each test row first meets the nearest blocks that together hold k rows,
which bounds its k-th distance from above, and then only the other blocks whose
lower bound does not exceed that.  The result is that of comparing all pairs.
Blocks too large for a task are dealt into parts by a hash of the key, and so are
the test rows that a popular block attracts, so no task grows with the data.
Inside a task a tree of bounding boxes (``Boxes``) sorts out training rows, wherever
it can: then few large blocks are better than many small ones.

Vectors without a near or a far (independent coordinates in many dimensions)
cannot be pruned by any metric bound; then all blocks are visited.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage, shuffle_partitions

MAX_PIVOTS, MAX_RINGS = 1024, 64
#: groups of training rows that some test rows are not compared with, at most
MAX_GROUPS = 256
#: stand for no group: no training row is in a test row's, and the reverse
NO_GROUP = {"tg": -(1 << 63), "qg": -(1 << 63) + 1}
#: distances held by one task at a time
MAX_DISTANCES = 1 << 21
#: rows of either side in one task
PART_ROWS = 20000
MAX_TASKS = 2000
#: rows of a leaf in a task's tree of boxes, and coordinates that boxes can bound
LEAF, MAX_BOX_WIDTH = 64, 64
FOUND = "qid long, tid long, tl long, d double"


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64) if len(vectors) else np.zeros((0, 0))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to few rows: from the expanded square where
    nothing cancels, from differences where rows are close for their size."""
    out = np.empty((len(a), len(b)))
    if not out.size:
        return out
    b = np.broadcast_to(b, (len(b), a.shape[1]))    # the pivot of a table of one block has one entry
    centre = b.mean(axis=0)
    near = b - centre
    b2 = np.einsum("ij,ij->i", near, near)
    step = max(1, (1 << 17) // len(b))
    for lo in range(0, len(a), step):
        rows = a[lo : lo + step] - centre
        a2 = np.einsum("ij,ij->i", rows, rows)
        d = out[lo : lo + step]
        np.matmul(rows, near.T, out=d)
        d *= -2
        size = a2[:, None] + b2[None, :]
        d += size
        size *= 1e-3
        # not finite either: far-off rows
        i, j = np.nonzero(~((d > size) & (d < np.inf)))
        diff = a[lo + i] - b[j]
        d[i, j] = np.einsum("ij,ij->i", diff, diff)
        np.sqrt(d, out=d)
    return out


class Boxes:
    """Training rows in leaves of at most ``LEAF`` by halving the widest side of their
    bounding box, with every node's own box."""

    def __init__(self, T: np.ndarray):
        self.order, leaves, nodes = np.arange(len(T)), [], []

        def grow(lo: int, hi: int, depth: int) -> int:
            part = self.order[lo:hi]
            x = T[part]
            least, most = x.min(axis=0), x.max(axis=0)
            at = len(nodes)
            nodes.append(None)
            axis = int((most - least).argmax())
            if hi - lo <= LEAF:
                leaves.append((lo, hi))
                nodes[at] = (least, most, -1, -1, 0, 0.0, len(leaves) - 1)
                return at
            v = x[:, axis]
            # in the middle of the box, so that few values part cleanly; far-off rows are not peeled off for ever
            cut = least[axis] + (most[axis] - least[axis]) / 2
            below = v < cut
            mid = int(below.sum())
            if not 0 < mid < hi - lo or (depth > 40 and min(mid, hi - lo - mid) < (hi - lo) / 8):
                mid = (hi - lo) // 2
                halves = np.argpartition(v, mid)
                cut = v[halves[mid]]
            else:
                halves = np.argsort(~below, kind="stable")
            self.order[lo:hi] = part[halves]
            left, right = grow(lo, lo + mid, depth + 1), grow(lo + mid, hi, depth + 1)
            nodes[at] = (least, most, left, right, axis, float(cut), -1)
            return at

        grow(0, len(T), 0)
        self.leaves = leaves
        self.least, self.most = (np.ascontiguousarray(np.stack([n[i] for n in nodes], 1)) for i in (0, 1))
        self.left, self.right, self.axis, self.leaf = (np.array([n[i] for n in nodes]) for i in (2, 3, 4, 6))
        self.cut = np.array([n[5] for n in nodes])

    def home(self, Q: np.ndarray) -> np.ndarray:
        """The leaf on a row's side of every cut."""
        at, rows = np.zeros(len(Q), int), np.arange(len(Q))
        while len(rows := rows[self.left[at[rows]] >= 0]):
            node = at[rows]
            at[rows] = np.where(Q[rows, self.axis[node]] < self.cut[node], self.left[node], self.right[node])
        return self.leaf[at]

    def near(self, Q: np.ndarray, within: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf), by leaf: the leaves whose box is not farther than the root of ``within``."""
        columns, square = np.ascontiguousarray(Q.T), within * (1 + 1e-9) + 1e-300
        q, at, found = np.arange(len(Q)), np.zeros(len(Q), int), []
        while len(q):
            d = np.zeros(len(q))
            for x, least, most in zip(columns, self.least, self.most, strict=True):
                v = x[q]
                out = np.maximum(least[at] - v, v - most[at])
                np.maximum(out, 0, out=out)
                out *= out
                d += out
            keep = ~(d > square[q])
            q, at = q[keep], at[keep]
            end = self.leaf[at] >= 0
            found.append((q[end], self.leaf[at[end]]))
            q, at = q[~end], at[~end]
            q, at = np.concatenate([q, q]), np.concatenate([self.left[at], self.right[at]])
        i, leaf = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(leaf, kind="stable")
        return i[order], leaf[order]


def _by_value(x: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, from, to) of the runs of a sorted array."""
    at = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, int)
    return list(zip(x[at].tolist(), at.tolist(), np.r_[at[1:], len(x)].tolist(), strict=True))


def nearest_by_boxes(Q: np.ndarray, T: np.ndarray, tid: np.ndarray, k: int, within: np.ndarray | None = None,
                     max_distances: int = MAX_DISTANCES, groups: tuple[np.ndarray, np.ndarray] | None = None
                     ) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """``nearest_in`` over a tree of boxes; None where boxes sort out too little."""
    if not (np.isfinite(T).all() and np.isfinite(Q).all()):
        return None
    boxes = Boxes(T)
    sets = [boxes.order[a:b] for a, b in boxes.leaves]
    near = [_Near(T, x) for x in sets]
    # any k rows bound the distance; a small leaf takes those beside it
    beside = [_Near(T, boxes.order[max(0, a - LEAF // 2) : b + LEAF // 2]) if b - a < LEAF // 2 else near[i]
              for i, (a, b) in enumerate(boxes.leaves)]
    found, portion, lo = [], min(512, len(Q)), 0
    while lo < len(Q):
        q = Q[lo : lo + portion]
        qg = None if groups is None else groups[0][lo : lo + len(q)]
        bound = np.full(len(q), np.inf) if within is None else within[lo : lo + len(q)].astype(float) ** 2
        home = boxes.home(q)
        order = np.argsort(home, kind="stable")
        for leaf, a, b in _by_value(home[order]):
            i, to = order[a:b], beside[leaf]
            if len(to.rows) < k:
                continue
            d, slack = to.about(q[i])
            if groups is not None:
                d[qg[i][:, None] == groups[1][to.rows][None, :]] = np.inf
            bound[i] = np.minimum(bound[i], np.maximum(np.partition(d, k - 1, axis=1)[:, k - 1], 0) + slack)
        i, leaf = boxes.near(q, bound)
        if not lo and len(i) > 0.25 * len(q) * len(sets):
            return None
        r, j = [], []
        for x, a, b in _by_value(leaf):
            rows, to = i[a:b], near[x]
            d, slack = to.about(q[rows])
            m, n = np.nonzero(d <= (bound[rows] + slack)[:, None])
            r.append(rows[m])
            j.append(to.rows[n])
        r, j = (np.concatenate(x) if x else np.zeros(0, int) for x in (r, j))
        if groups is not None:
            other = qg[r] != groups[1][j]
            r, j = r[other], j[other]
        # whatever may be among the nearest is left; exact distances decide
        exact = np.empty(len(r))
        for a in range(0, len(r), 1 << 14):
            diff = q[r[a : a + (1 << 14)]] - T[j[a : a + (1 << 14)]]
            exact[a : a + (1 << 14)] = (diff * diff).sum(1)
        if within is not None:
            inside = exact <= bound[r] * (1 + 1e-9) + 1e-300
            r, j, exact = r[inside], j[inside], exact[inside]
        order = np.lexsort((tid[j], exact, r))
        r, j, exact = r[order], j[order], exact[order]
        runs = np.flatnonzero(np.r_[True, r[1:] != r[:-1]]) if len(r) else np.zeros(0, int)
        keep = np.arange(len(r)) - np.repeat(runs, np.diff(np.r_[runs, len(r)])) < k
        found.append((r[keep] + lo, j[keep], exact[keep]))
        lo += len(q)
        # as many rows as their pairs with leaves, so far, let fit
        portion = max(1, min(8192, max_distances // max(1, LEAF * len(i) // len(q))))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 3


class _Near:
    """A few training rows about their centre, which lets nothing cancel that counts."""

    def __init__(self, T: np.ndarray, rows: np.ndarray):
        self.rows, self.centre = rows, T[rows].mean(axis=0)
        near = T[rows] - self.centre
        self.square = np.einsum("ij,ij->i", near, near)
        self.minus2 = np.ascontiguousarray(-2 * near.T)
        self.size = self.square.max() + 1e-300

    def about(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances, and per row of ``q`` how far off rounding may have left them."""
        P = q - self.centre
        p2 = np.einsum("ij,ij->i", P, P)
        d = P @ self.minus2
        d += p2[:, None]
        d += self.square
        return d, 1e-9 * (p2 + self.size)


def nearest_in(Q: np.ndarray, T: np.ndarray, tid: np.ndarray, k: int, within: np.ndarray | None = None,
               max_distances: int = MAX_DISTANCES, groups: tuple[np.ndarray, np.ndarray] | None = None
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(test row, training row, squared distance) of the k nearest of every
    test row, ties by training key; ``within``: greatest distance of interest;
    ``groups`` (of the test rows, of the training rows): rows of one group do not meet."""
    if len(T) >= 8 * LEAF and len(Q) >= LEAF and T.shape[1] <= MAX_BOX_WIDTH:
        found = nearest_by_boxes(Q, T, tid, k, within, max_distances, groups)
        if found is not None:
            return found
    centre = T.mean(axis=0)
    near = T - centre            # far-off coordinates would cancel in the expanded square
    t2 = (near * near).sum(1)
    kk = min(k, len(T))
    found = []
    for lo in range(0, len(Q), max(1, max_distances // len(T))):
        q = Q[lo : lo + max(1, max_distances // len(T))]
        P = q - centre
        p2 = (P * P).sum(1)
        P *= -2
        d = P @ near.T          # one matrix, filled in place
        d += p2[:, None]
        d += t2[None, :]
        same = None if groups is None else groups[0][lo : lo + len(q), None] == groups[1][None, :]
        if same is not None:
            d[same] = np.inf
        limit = np.partition(d, kk - 1, axis=1)[:, kk - 1].copy()   # not a view of all distances
        if within is not None:
            limit = np.minimum(limit, within[lo : lo + len(q)] ** 2)
        # whatever may tie with the k-th stays; exact distances decide
        hit = d <= (limit + 1e-9 * (p2 + t2.max() + 1e-300))[:, None]
        if same is not None:
            hit &= ~same
        r, j = np.nonzero(hit)
        exact = np.empty(len(r))
        for a in range(0, len(r), 1 << 16):
            diff = q[r[a : a + (1 << 16)]] - T[j[a : a + (1 << 16)]]
            exact[a : a + (1 << 16)] = (diff * diff).sum(1)
        order = np.lexsort((tid[j], exact, r))
        r, j, exact = r[order], j[order], exact[order]
        starts = np.flatnonzero(np.r_[True, r[1:] != r[:-1]]) if len(r) else np.zeros(0, int)
        rank = np.arange(len(r)) - np.repeat(starts, np.diff(np.r_[starts, len(r)]))
        keep = rank < kk
        found.append((r[keep] + lo, j[keep], exact[keep]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 3


@dataclass
class Index:
    rows: DataFrame | None     # block, r, tid, tl, tg, tv
    pivots: np.ndarray         # one row per cell
    between: np.ndarray        # distances of the pivots
    blocks: pd.DataFrame       # block, cell, n, lo, hi; numbered from 0
    inside: pd.DataFrame | None = None     # tg, block, n: rows of a group in a block

    def __post_init__(self) -> None:
        """Blocks by cell: number of the first, how many, and per ring (in order of
        the distance to the pivot) the least and greatest distance."""
        cell = self.blocks["cell"].to_numpy()
        self.held = self.blocks["n"].to_numpy()
        self.start = np.searchsorted(cell, np.arange(len(self.pivots)))
        self.count = np.bincount(cell, minlength=len(self.pivots))
        ring = np.arange(len(cell)) - self.start[cell]
        self.lo, self.hi = (np.full((len(self.pivots), int(self.count.max())), np.inf) for _ in range(2))
        self.lo[cell, ring], self.hi[cell, ring] = self.blocks["lo"], self.blocks["hi"]
        # rows a group's test rows may meet, by block; the last line: rows without a group
        self.groups = np.unique(self.inside["tg"]) if self.inside is not None else np.zeros(0, np.int64)
        self.open = np.tile(self.held, (len(self.groups) + 1, 1))
        if self.inside is not None:
            np.subtract.at(self.open, (np.searchsorted(self.groups, self.inside["tg"]), self.inside["block"].to_numpy()),
                           self.inside["n"].to_numpy())

    def _line(self, group: np.ndarray) -> np.ndarray:
        """The line of ``open`` of each test row's group."""
        if not len(self.groups):
            return np.zeros(len(group), int)
        at = np.minimum(np.searchsorted(self.groups, group), len(self.groups) - 1)
        return np.where(self.groups[at] == group, at, len(self.groups))

    def _few(self, to: np.ndarray, k: int, held: np.ndarray) -> list[int]:
        """Blocks that hold k rows, of the nearest cells, for one test row."""
        out, n = [], 0
        for c in np.argsort(to, kind="stable"):
            rings = slice(0, self.count[c])
            low = np.maximum(to[c] - self.hi[c, rings], self.lo[c, rings] - to[c])
            for j in np.argsort(low, kind="stable"):
                out.append(self.start[c] + j)
                n += held[out[-1]]
                if n >= k:
                    return out
        return out

    def visits(self, Q: np.ndarray, ub: np.ndarray, k: int, first: bool, group: np.ndarray | None = None
               ) -> tuple[np.ndarray, np.ndarray]:
        """(test row, block) by test row.  First: its nearest pivot's ring, or the
        nearest blocks that hold k rows.  Second: the blocks not yet visited whose
        lower bound does not exceed ``ub``.  Cells are sorted out before their rings
        are looked at, so a test row costs by pivots, not by blocks."""
        to = distances(Q, self.pivots)
        own, rows = to.argmin(1), np.arange(len(Q))
        r = to[rows, own]
        block = self.start[own] + np.minimum((self.hi[own] < r[:, None]).sum(1), self.count[own] - 1)
        line = self._line(np.full(len(Q), NO_GROUP["qg"]) if group is None else group)
        one = np.flatnonzero((self.open[line, block] >= k) & (self.count[own] > 0))
        few = [(i, x) for i in np.setdiff1d(rows, one) for x in self._few(to[i], k, self.open[line[i]])]
        seen = np.concatenate([np.stack([one, block[one]], 1), np.array(few, np.int64).reshape(-1, 2)])
        if first:
            seen = seen[np.argsort(seen[:, 0], kind="stable")]
            return seen[:, 0], seen[:, 1]
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = (to**2 - (r**2)[:, None]) / (2 * self.between[own])
        # less than rounding could have added
        slack = 1e-9 * (1 + to)
        i, c = np.nonzero(~(plane - slack > ub[:, None]) | ~np.isfinite(plane))
        found = [np.zeros((0, 2), np.int64)]
        for a in range(0, len(i), 1 << 15):
            ii, cc = i[a : a + (1 << 15)], c[a : a + (1 << 15)]
            at, far = to[ii, cc], slack[ii, cc] + ub[ii]
            hit = (self.hi[cc] >= (at - far)[:, None]) & (self.lo[cc] <= (at + far)[:, None])
            pair, j = np.nonzero(hit & (np.arange(self.hi.shape[1]) < self.count[cc][:, None]))
            found.append(np.stack([ii[pair], self.start[cc[pair]] + j], 1))
        pairs = np.concatenate(found)
        code = lambda x: x[:, 0] * len(self.held) + x[:, 1]
        pairs = pairs[~np.isin(code(pairs), code(seen))]
        return pairs[:, 0], pairs[:, 1]


def _group(group: str | None, out: str):
    """The group column; rows without one meet all."""
    none = F.lit(NO_GROUP[out]).cast("long")
    return (none if group is None else F.coalesce(F.col(group).cast("long"), none)).alias(out)


def build_index(train: DataFrame, vec: str, key: str, label: str, block_rows: int, group: str | None = None) -> Index:
    spark = train.sparkSession
    rows = train.where(F.col(vec).isNotNull()).select(
        F.col(key).cast("long").alias("tid"), F.col(label).cast("long").alias("tl"), _group(group, "tg"), F.col(vec).alias("tv"))
    if group is not None and len(rows.select("tg").distinct().limit(MAX_GROUPS + 1).collect()) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} groups in {group}")
    n = rows.count()
    blocks = max(1, math.ceil(n / block_rows))
    cells = min(MAX_PIVOTS, blocks)
    # a sample by the keys' hashes; a table of one block needs no order inside
    sample = rows.orderBy(F.xxhash64("tid"), "tid").limit(cells).select("tv").collect() if cells > 1 else []
    pivots = np.unique(np.array([r[0] for r in sample], np.float64), axis=0) if sample else None
    if pivots is None:
        only = pd.DataFrame({"block": [0], "cell": [0], "n": [n], "lo": [0.0], "hi": [np.inf]})
        # whatever its groups, a test row meets the one block
        return Index(rows.select(F.lit(0).alias("block"), F.lit(0.0).alias("r"), "*"), np.zeros((1, 1)), np.zeros((1, 1)), only)
    rings = min(MAX_RINGS, math.ceil(blocks / len(pivots)))

    @F.pandas_udf("cell int, r double")
    def nearest(vectors: pd.Series) -> pd.DataFrame:
        d = distances(_matrix(vectors), pivots) if len(vectors) else np.zeros((0, 1))
        return pd.DataFrame({"cell": d.argmin(1).astype(np.int32), "r": d.min(1)})

    laid = cut_lineage(rows.withColumn("at", nearest("tv")).select("at.*", "tid", "tl", "tg", "tv"))
    # one row per cell
    cuts = laid.groupBy("cell").agg(F.percentile_approx("r", [i / rings for i in range(1, rings)] or [0.5], 100 * rings).alias("cuts"))
    ring = F.size(F.filter("cuts", lambda x: x < F.col("r"))) if rings > 1 else F.lit(0)
    ringed = laid.join(F.broadcast(cuts), "cell").withColumn("ring", ring).drop("cuts")
    # at most MAX_PIVOTS * MAX_RINGS rows
    found = ringed.groupBy("cell", "ring").agg(F.count("*").alias("n"), F.min("r").alias("lo"), F.max("r").alias("hi")).toPandas()
    found = found.sort_values(["cell", "ring"], ignore_index=True)
    found.insert(0, "block", np.arange(len(found)))
    numbers = spark.createDataFrame(found[["block", "cell", "ring"]])
    inside = None
    if group is not None:   # at most MAX_GROUPS times as many
        inside = ringed.groupBy("tg", "cell", "ring").agg(F.count("*").alias("n")).toPandas().merge(
            found[["block", "cell", "ring"]], on=["cell", "ring"])[["tg", "block", "n"]]
    return Index(ringed.join(F.broadcast(numbers), ["cell", "ring"]).select(F.col("block").cast("int"), "r", "tid", "tl", "tg", "tv"),
                 pivots, distances(pivots, pivots), found.drop(columns="ring"), inside)


def routes(test: DataFrame, index: Index, k: int, first: bool) -> DataFrame:
    """(qid, qv, qg, ub, block): the blocks a test row visits in its first round
    (those nearest that hold k rows), or in its second (those not yet visited
    whose lower bound does not exceed ``ub``)."""
    numbers = replace(index, rows=None)     # tasks need the numbers alone

    @F.pandas_udf("array<int>")
    def visited(vectors: pd.Series, ub: pd.Series, group: pd.Series) -> pd.Series:
        out = []
        vectors, ub, group = vectors.to_numpy(), ub.to_numpy(np.float64), group.to_numpy(np.int64)
        for a in range(0, len(vectors), 512):
            Q = np.stack(vectors[a : a + 512]).astype(np.float64)
            i, block = numbers.visits(Q, ub[a : a + 512], k, first, group[a : a + 512])
            out += np.split(block.astype(np.int32), np.searchsorted(i, np.arange(1, len(Q))))
        return pd.Series(out)

    return test.select("qid", "qv", "qg", "ub", F.explode(visited("qv", "ub", "qg")).alias("block"))


def search(index: Index, visits: DataFrame, k: int, part_rows: int = PART_ROWS, max_distances: int = MAX_DISTANCES) -> DataFrame:
    """The k nearest of every visit (``FOUND``), no farther than its ``ub``."""
    visits = visits if hasattr(visits, "_cut_path") else cut_lineage(visits)
    asked = visits.groupBy("block").agg(F.count("*").alias("asked"))   # one row per block
    sizes = visits.sparkSession.createDataFrame(index.blocks[["block", "n"]])
    deal = asked.join(sizes, "block").select(
        F.col("block").cast("int").alias("block"), F.ceil(F.col("n") / part_rows).cast("int").alias("tparts"),
        F.ceil(F.col("asked") / part_rows).cast("int").alias("qparts"))
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    part = lambda x, n: F.pmod(F.xxhash64(x), F.col(n)).cast("int")
    left = visits.join(F.broadcast(deal), "block").withColumn("qpart", part("qid", "qparts")).withColumn("tpart", upto("tparts"))
    right = index.rows.join(F.broadcast(deal), "block").withColumn("tpart", part("tid", "tparts")).withColumn("qpart", upto("qparts"))
    keys = ["block", "qpart", "tpart"]

    def cell(q: pa.Table, t: pa.Table) -> pa.Table:
        whole = lambda x, name: x.column(name).combine_chunks()
        matrix = lambda v: v.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(v), -1)
        if not q.num_rows or not t.num_rows:
            i = j = np.zeros(0, np.int64)
            qid = tid = tl = i
            d = np.zeros(0)
        else:
            qid, qg, ub = (whole(q, x).to_numpy(zero_copy_only=False) for x in ("qid", "qg", "ub"))
            tid, tl, tg = (whole(t, x).to_numpy(zero_copy_only=False) for x in ("tid", "tl", "tg"))
            groups = (qg, tg) if np.isin(qg, tg).any() else None
            i, j, d = nearest_in(matrix(whole(q, "qv")), matrix(whole(t, "tv")), tid, k, ub, max_distances, groups)
        names, kinds = zip(*(x.split() for x in FOUND.split(", ")), strict=True)
        return pa.table([pa.array(v, pa.int64() if kind == "long" else pa.float64(), from_pandas=True)
                         for v, kind in zip((qid[i], tid[j], tl[j], d), kinds, strict=True)], names=list(names))

    # a few blocks a task, so that none waits for one that met the large ones
    tasks = max(shuffle_partitions(visits.sparkSession), min(MAX_TASKS, len(index.blocks) // 8))
    left, right = (x.repartition(tasks, *keys).groupBy(*keys) for x in (
        left.select(*keys, "qid", "qv", "qg", "ub"), right.select(*keys, "tid", "tl", "tg", "tv")))
    both = left.cogroup(right)
    return both.applyInArrow(cell, FOUND)


def best(found: DataFrame, k: int) -> DataFrame:
    """Of the candidates of every test row, the k nearest, with their rank."""
    w = Window.partitionBy("qid").orderBy("d", "tid")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def visits_of(index: Index, test: DataFrame, k: int, part_rows: int = PART_ROWS,
              max_distances: int = MAX_DISTANCES) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """First-round visits, their candidates, and second-round visits (None
    where the first has seen every block)."""
    first = routes(test.withColumn("ub", F.lit(float("inf"))), index, k, first=True)
    if len(index.blocks) == 1:
        return first, search(index, first, k, part_rows, max_distances), None
    first = cut_lineage(first)
    found = cut_lineage(best(search(index, first, k, part_rows, max_distances), k))
    # a rounding step above the k-th distance, so that ties are seen
    kth = found.groupBy("qid").agg(F.count("*").alias("n"), F.max("d").alias("d")).where(F.col("n") >= k).select(
        "qid", (F.sqrt("d") * (1 + 1e-9) + 1e-300).alias("limit"))
    bounded = test.join(kth, "qid", "left").select("qid", "qv", "qg", F.coalesce("limit", F.lit(float("inf"))).alias("ub"))
    return first, found.drop("rank"), cut_lineage(routes(bounded, index, k, first=False))


def nearest(train: DataFrame, test: DataFrame, vec: str, key: str, label: str, k: int = 5, block_rows: int = 2048,
            part_rows: int = PART_ROWS, max_distances: int = MAX_DISTANCES, group: str | None = None) -> DataFrame:
    """(qid, tid, tl, d, rank): the k nearest training rows of every test row by
    squared L2 distance, ties by training key.

    Rows without a vector take no part; fewer than k training rows give fewer
    neighbours; keys are unique on either side.  With ``group`` (a whole number, at
    most ``MAX_GROUPS`` values) the neighbours are of another group than the test
    row: all folds of a table are searched over one index."""
    index = build_index(train, vec, key, label, block_rows, group)
    asked = test.where(F.col(vec).isNotNull()).select(F.col(key).cast("long").alias("qid"), F.col(vec).alias("qv"), _group(group, "qg"))
    _, found, second = visits_of(index, asked, k, part_rows, max_distances)
    if second is not None:
        found = found.unionAll(search(index, second, k, part_rows, max_distances))
    return best(found, k)


def compared(train: DataFrame, test: DataFrame, vec: str, key: str, label: str, k: int = 5, block_rows: int = 2048) -> DataFrame:
    """(qid, pairs): how many training rows each test row is compared with."""
    index = build_index(train, vec, key, label, block_rows)
    asked = test.where(F.col(vec).isNotNull()).select(F.col(key).cast("long").alias("qid"), F.col(vec).alias("qv"), _group(None, "qg"))
    first, _, second = visits_of(index, asked, k)
    visits = first.select("qid", "block") if second is None else first.select("qid", "block").unionAll(second.select("qid", "block"))
    sizes = train.sparkSession.createDataFrame(index.blocks[["block", "n"]])
    return visits.join(F.broadcast(sizes), "block").groupBy("qid").agg(F.sum("n").alias("pairs"))


def classify(neighbours: DataFrame, key: str) -> DataFrame:
    """(key, pred, share): the majority label of each test row's neighbours (vote
    ties: the smallest class) and its share of the votes."""
    votes = neighbours.groupBy("qid", "tl").agg(F.count("*").alias("n"))
    best_first = Window.partitionBy("qid").orderBy(F.desc("n"), "tl")
    share = F.col("n") / F.sum("n").over(Window.partitionBy("qid"))
    return votes.withColumn("r", F.row_number().over(best_first)).withColumn("share", share).where(F.col("r") == 1).select(
        F.col("qid").alias(key), F.col("tl").cast("int").alias("pred"), "share")
