"""The metric kNN index against all pairs."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import knn

SCHEMA = "id long, v array<double>, label int"


def table(spark, x, base=0, labels=None):
    labels = [0] * len(x) if labels is None else labels
    return spark.createDataFrame([(base + i, None if v is None else [float(a) for a in v], int(c))
                                  for i, (v, c) in enumerate(zip(x, labels, strict=True))], SCHEMA).repartition(3)


def all_pairs(train, test, k):
    out = {}
    for i, q in enumerate(test):
        if q is not None:
            found = sorted((float(((np.asarray(t, float) - np.asarray(q, float)) ** 2).sum()), j)
                           for j, t in enumerate(train) if t is not None)
            out[i] = [j for _, j in found[:k]]
    return out


def check(spark, train, test, k, **options):
    got = knn.nearest(table(spark, train), table(spark, test), "v", "id", "label", k, **options).collect()
    found = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        found.setdefault(r["qid"], []).append(r["tid"])
    assert found == {i: x for i, x in all_pairs(train, test, k).items() if x}


@pytest.mark.parametrize("block_rows,part_rows", [(10_000, 10_000), (40, 10_000), (7, 10)])
def test_equals_all_pairs(spark, block_rows, part_rows):
    rng = np.random.default_rng(1)
    train = rng.normal(size=(400, 3))
    # whole coordinates: many exact ties; a group of copies; far-off rows
    train[100:200] = rng.integers(0, 3, (100, 3))
    train[200:290] = train[200]
    train[395:] += 1e6
    test = np.concatenate([rng.normal(size=(30, 3)), rng.integers(0, 3, (10, 3)), train[200:201], train[396:397] + 0.5])
    check(spark, list(train), list(test), 5, block_rows=block_rows, part_rows=part_rows, max_distances=500)


def test_few_rows_and_nulls(spark):
    train = [[0.0, 1.0], None, [2.0, 2.0]]
    check(spark, train, [[0.0, 0.0], None, [9.0, 9.0]], 5, block_rows=1)
    empty = table(spark, train).limit(0)
    assert knn.nearest(empty, table(spark, train), "v", "id", "label").collect() == []
    assert knn.nearest(table(spark, train), empty, "v", "id", "label", block_rows=1).collect() == []


def test_pairs_grow_slower_than_the_training_table(spark):
    rng = np.random.default_rng(2)
    test = table(spark, rng.normal(size=(60, 3)))
    mean = {}
    for n in (1500, 6000):
        seen = knn.compared(table(spark, rng.normal(size=(n, 3))), test, "v", "id", "label", block_rows=50)
        mean[n], rows = seen.agg(F.avg("pairs"), F.count("*")).first()
        assert rows == 60
    assert mean[1500] < 0.5 * 1500 and mean[6000] < 0.25 * 6000
    assert mean[6000] < 2.5 * mean[1500]     # four times the rows


def test_unprunable_vectors_visit_all(spark):
    """Nothing bounds independent coordinates in many dimensions: still exact."""
    rng = np.random.default_rng(3)
    train, test = rng.normal(size=(200, 40)), rng.normal(size=(8, 40))
    check(spark, list(train), list(test), 4, block_rows=20)
    assert knn.compared(table(spark, train), table(spark, test), "v", "id", "label", 4, 20).agg(F.max("pairs")).first()[0] == 200


def test_routing_costs_by_pivots_not_by_blocks():
    """Over 65536 blocks: the blocks that the bounds allow, without a number per
    test row and block."""
    import tracemalloc

    import pandas as pd

    rng = np.random.default_rng(4)
    pivots = rng.normal(size=(1024, 2))
    edges = np.sort(rng.uniform(0, 0.2, (1024, 65)), axis=1)
    blocks = pd.DataFrame({"block": np.arange(65536), "cell": np.repeat(np.arange(1024), 64), "n": rng.integers(1, 40, 65536),
                           "lo": edges[:, :-1].ravel(), "hi": edges[:, 1:].ravel()})
    index = knn.Index(None, pivots, knn.distances(pivots, pivots), blocks)
    q, ub = rng.normal(size=(64, 2)), np.full(64, 0.01)
    ub[0] = 1.0
    tracemalloc.start()
    first, second = index.visits(q, ub, 5, True), index.visits(q, ub, 5, False)
    assert tracemalloc.get_traced_memory()[1] < 60e6       # 64 x 65536 doubles alone: 34e6, five of them at once before
    tracemalloc.stop()
    to, cell = knn.distances(q, pivots), blocks["cell"].to_numpy()
    for i in range(64):
        own = to[i].argmin()
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = np.nan_to_num((to[i] ** 2 - to[i, own] ** 2) / (2 * index.between[own]), nan=0, posinf=0, neginf=0)
        at = to[i][cell]
        low = np.maximum(np.maximum(at - blocks["hi"], blocks["lo"] - at), plane[cell])
        seen = set(first[1][first[0] == i])
        assert blocks["n"].to_numpy()[list(seen)].sum() >= 5
        assert set(second[1][second[0] == i]) == set(np.flatnonzero(low - 1e-9 * (1 + at) <= ub[i])) - seen


def test_distances_of_a_full_task_stay_small():
    """A task's largest pair of parts, 20000 rows of either side (here 20000 x 1000),
    holds few distances at a time; the result is that of any other portion."""
    import tracemalloc

    rng = np.random.default_rng(5)
    q, t = rng.normal(size=(20000, 8)), rng.normal(size=(1000, 8))
    tid = np.arange(len(t))
    tracemalloc.start()
    found = knn.nearest_in(q, t, tid, 5)
    assert tracemalloc.get_traced_memory()[1] < 100e6      # 16.8 M distances, three times over, before
    tracemalloc.stop()
    few = knn.nearest_in(q[:300], t, tid, 5, max_distances=7000)
    assert all((a[:1500] == b).all() for a, b in zip(found, few, strict=True))


def test_groups_over_one_index(spark):
    """Neighbours of another group than the test row, against all pairs; groups that
    fill whole blocks, rows without a group, too few rows outside a group."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 3))
    x[100:160] = rng.integers(0, 2, (60, 3))
    group = [int(v) for v in rng.integers(0, 4, 300)]
    for i in range(200, 260):
        x[i], group[i] = x[200] + (i - 200) * 1e-6, 9
    group[5] = group[6] = None
    rows = [(i, [float(a) for a in x[i]], 0, group[i]) for i in range(300)]
    table_of = lambda r: spark.createDataFrame(r, SCHEMA + ", g int").repartition(3)
    for block_rows, train in ((10_000, rows), (15, rows), (4, rows), (2, [r for r in rows if r[3] == 9] + rows[:3])):
        got = knn.nearest(table_of(train), table_of(rows), "v", "id", "label", 5, block_rows=block_rows, group="g").collect()
        found = {}
        for r in sorted(got, key=lambda r: r["rank"]):
            found.setdefault(r["qid"], []).append(r["tid"])
        want = {}
        for i, v, _, g in rows:
            d = sorted((float(((x[j] - x[i]) ** 2).sum()), j) for j, _, _, h in train if g is None or h is None or g != h)
            want[i] = [j for _, j in d[:5]]
        assert found == {i: w for i, w in want.items() if w}


def test_distances_of_close_and_far_off_rows():
    rng = np.random.default_rng(3)
    b = rng.normal(size=(40, 4))
    b[30:] = 1e6 + rng.normal(size=(10, 4)) * 1e-3
    a = np.concatenate([rng.normal(size=(500, 4)), b, b + 1e-9, b * 1e3])
    want = np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(2))
    got = knn.distances(a, b)
    assert np.all(np.abs(got - want) <= 1e-11 * want) and np.all(got[500:540].diagonal() == 0)
    assert knn.distances(a[:0], b).shape == (0, 40)


def test_boxes_in_a_task_find_what_all_pairs_find():
    """The tree of boxes against brute force: mixed columns, copies, ties, far-off rows,
    groups, bounds; where nothing can be sorted out it steps back."""
    rng = np.random.default_rng(9)
    t = np.c_[rng.normal(size=(3000, 2)), rng.integers(0, 2, (3000, 3))]
    t[500:900] = t[500]
    t[900:1300] = np.round(t[900:1300])
    t[2990:] += 1e6
    q = np.concatenate([np.c_[rng.normal(size=(300, 2)), rng.integers(0, 2, (300, 3))], t[480:560], t[1000:1050], t[2985:]])
    tid, groups = rng.permutation(3000), (rng.integers(0, 4, len(q)), rng.integers(0, 4, 3000))
    groups[0][:20] = 9
    d = ((q[:, None, :] - t[None, :, :]) ** 2).sum(2)
    within = np.sqrt(np.partition(d, 8, axis=1)[:, 8]) * rng.choice([0.5, 2.0], len(q))
    for g in (None, groups):
        for w in (None, within):
            i, j, found = knn.nearest_by_boxes(q, t, tid, 5, w, 1 << 16, g)
            ok = np.ones_like(d, bool) if g is None else g[0][:, None] != g[1][None, :]
            for r in range(len(q)):
                want = sorted((d[r, c], tid[c]) for c in np.flatnonzero(ok[r]))[:5]
                got = list(zip(found[i == r], tid[j[i == r]], strict=True))
                want = [x for x in want if w is None or x[0] <= w[r] ** 2]
                assert [x[1] for x in got][: len(want)] == [x[1] for x in want] and len(got) <= 5
                assert np.allclose([x[0] for x in got][: len(want)], [x[0] for x in want], rtol=1e-9, atol=1e-12)
    wide = rng.normal(size=(2000, 30))
    assert knn.nearest_by_boxes(wide, wide, np.arange(2000), 5) is None


def test_boxes_sort_out_most_rows_of_a_task():
    rng = np.random.default_rng(10)
    t, q = (np.c_[rng.uniform(size=(16000, 2)), rng.integers(0, 2, (16000, 2))] for _ in range(2))
    boxes = knn.Boxes(t)
    assert max(b - a for a, b in boxes.leaves) <= knn.LEAF and len(boxes.leaves) < 4 * 16000 / knn.LEAF
    seen, real = [], knn._Near.about
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(knn._Near, "about", lambda self, x: seen.append(len(x) * len(self.rows)) or real(self, x))
        knn.nearest_in(q, t, np.arange(16000), 5)
    assert sum(seen) < 0.06 * 16000 * 16000      # all pairs before
