"""Line and document deduplication, components and the pipeline, by brute force."""
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from llm_cases import SF_CHECK, texts_of
from pyspark.sql import functions as F

from tessera.llm import graph, line_dedup, minhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
BIG = 2**63 - 1


def brute_lines(rows, percent=80):
    """{(doc_id, text): (shortened text, lines with words, removed)}"""
    found = [((BIG if i is None else i, k), i, t, line, frozenset(WORDS.findall(line.lower())))
             for i, t in rows for k, line in enumerate(t.split("\n"))]
    first, holders = {}, {}
    for at, *_, words in found:
        if words:
            first[words] = min(first.get(words, at), at)
    for s in first:
        for w in s:
            holders.setdefault(w, []).append(s)
    similar = set()
    for s, at in first.items():
        shared = Counter(o for w in s for o in holders[w] if first[o] < at)
        if any(100 * n >= percent * (len(s) + len(o) - n) for o, n in shared.items()):
            similar.add(s)
    out = {}
    for at, i, t, line, words in found:
        gone = bool(words) and (at > first[words] or words in similar)
        text, n, k = out.setdefault((i, t), ([], 0, 0))
        out[i, t] = (text if gone else [*text, line], n + bool(words), k + gone)
    return {key: ("\n".join(text), n, k) for key, (text, n, k) in out.items()}


def check_lines(df):
    rows = texts_of(df)
    want = brute_lines(sorted(set(rows), key=str))
    got = line_dedup.dedup_lines(df.withColumn("was", F.col("text"))).collect()
    assert Counter((r["doc_id"], r["was"] or "", r["text"] or "", r["n_lines"], r["n_removed"]) for r in got) == Counter(
        (i, t, *want[i, t]) for i, t in rows)


def test_op2(edge, empty):
    check_lines(edge)
    assert line_dedup.dedup_lines(empty).collect() == []


def test_op2_near_lines(spark):
    rng = random.Random(1)
    vocabulary = [f"w{k}" for k in range(400)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 4, 9, 10, 25, 80, 300]))] for _ in range(40)]
    texts = []
    for i in range(60):
        lines = []
        for _ in range(5):
            line = list(rng.choice(bases))
            for _ in range(rng.randint(0, max(1, len(line) // 6))):
                line[rng.randrange(len(line))] = rng.choice(vocabulary)
            lines.append(" ".join(line))
        texts.append((i, "\n".join(lines)))
    check_lines(spark.createDataFrame(texts, "doc_id long, text string"))


def test_op2_shared_places(spark):
    """Near copies of numbered lines whose own places are shared: many rows
    without a doc_id, and one doc_id with two texts."""
    rng = random.Random(6)
    base = [[f"w{i}_{k}" for k in range(20)] for i in range(30)]
    copies = [" ".join([*b[1:], f"new{rng.randrange(10**9)}"]) for b in base]
    rows = [(i, " ".join(b)) for i, b in enumerate(base)]
    rows += [(None if i < 28 else 500, c) for i, c in enumerate(copies)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in got) == Counter(
        [(i, t, 1, 0) for i, t in rows[:30]] + [(i, "", 1, 1) for i, _ in rows[30:]])


def test_op2_hashes_lines_once(spark, monkeypatch):
    """The words of all lines are hashed for one table; counts and verification
    do not take up every line again."""
    hashed, lines = [], line_dedup.lines
    monkeypatch.setattr(line_dedup, "lines", lambda docs: hashed.append(1) or lines(docs))
    near = " ".join(f"w{k}" for k in range(20))
    rows = [(1, f"{near}\nA\tb"), (2, f"{near} more\nb  a\r"), (3, "\x0b\nown")]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in got} == {
        1: (rows[0][1], 2, 0), 2: ("", 2, 2), 3: (rows[2][1], 1, 0)}
    assert len(hashed) == 1


def in_order(row):
    """The order of documents: doc_id (null last), then Spark's hash of the text."""
    key = xxhash.xxh64_intdigest(row[1].encode(), seed=42)
    return (row[0] is None, row[0] or 0, key - 2**64 if key >= 2**63 else key)


def test_op2_tied_rows(spark):
    """Rows without a doc_id, with one doc_id and several texts, and numbered
    like the place of the null ones: each copy but the first of them goes."""
    rng = random.Random(8)
    licence = " ".join(f"l{k}" for k in range(20))
    def text(i):
        near = licence.split()
        near[rng.randrange(20)] = f"n{i}"
        return "\n".join([rng.choice([licence, " ".join(near)]), *[" ".join(rng.choice("abcdefgh") for _ in range(3)) for _ in range(3)], f"own{i}"])
    rows = [(i, text(k)) for k, i in enumerate([None] * 25 + [7] * 6 + [BIG] * 4 + [9, 10])]
    rows += [rows[0], rows[26], (BIG, rows[1][1])]
    order = sorted(set(rows), key=in_order)
    want = brute_lines([(k, t) for k, (_, t) in enumerate(order)])
    got = line_dedup.dedup_lines(spark.createDataFrame([(*r, r[1]) for r in rows], "doc_id long, text string, was string")).collect()
    assert Counter((r["doc_id"], r["was"], r["text"], r["n_lines"], r["n_removed"]) for r in got) == Counter(
        (i, t, *want[order.index((i, t)), t]) for i, t in rows)
    # the licence line stays once, in the first document
    assert sum("l3 " in r["text"] or "l5 " in r["text"] for r in got) == sum(r == order[0] for r in rows)


def shingle_set(text, n):
    w = text.encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1)))


def brute_components(rows, n, percent=80):
    sets = {}
    for i, t in rows:
        s = shingle_set(t, n)
        if s and i is not None:
            sets.setdefault(s, []).append(i)
    keys, parent = list(sets), {s: s for s in sets}

    def root(s):
        while parent[s] is not s:
            s = parent[s]
        return s

    holders = {}
    for s in keys:
        shared = Counter(o for g in s for o in holders.get(g, ()))
        for o, k in shared.items():
            if 100 * k >= percent * (len(s) + len(o) - k):
                parent[root(s)] = root(o)
        for g in s:
            holders.setdefault(g, []).append(s)
    least = {}
    for s in keys:
        least[root(s)] = min([least.get(root(s), BIG), *sets[s]])
    return lambda i, t: (i, len(shingle_set(t, n)),
                         least[root(shingle_set(t, n))] if shingle_set(t, n) and i is not None else i)


def check_components(df, n):
    rows = texts_of(df)
    of = brute_components(rows, n)
    out = minhash.near_duplicates(df, n)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    got = [tuple(r) for r in out.collect()]
    assert Counter(r[:3] for r in got) == Counter(of(i, t) for i, t in rows)
    assert all(r[3] == (r[0] == r[2]) for r in got)


def test_op7(edge, empty):
    check_components(edge, 4)
    assert minhash.near_duplicates(empty).collect() == []


def test_op7_shared_numbers(spark):
    """Rows without a doc_id, one doc_id with several texts, and equal rows."""
    rng = random.Random(9)
    base = [[f"w{i}_{k}" for k in range(60)] for i in range(12)]
    def near(i):
        return " ".join([*base[i][:-1], f"new{rng.randrange(10**9)}"])
    rows = [(7, near(i)) for i in range(8)] + [(100 + i, near(i)) for i in range(8)] + [(3, near(2))]
    rows += [(None, near(i)) for i in range(12) for _ in range(3)] + [(7, near(0)), (None, "")]
    rows += [rows[0], rows[-3], rows[-3], (2, ""), (2, ""), (50, "all alone in the world"), (50, "all alone in the world")]
    order = sorted(set(rows), key=in_order)
    of = brute_components(list(enumerate(t for _, t in order)), 4)
    head = {r: of(k, r[1])[2] for k, r in enumerate(order)}
    want = Counter((i, len(shingle_set(t, 4)), order[head[i, t]][0]) for i, t in rows)
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, at int")
    got = minhash.near_duplicates(df, 4).collect()
    assert Counter(tuple(r[:3]) for r in got) == want
    stay = Counter(r for k, r in enumerate(order) if head[r] == k) + Counter({(2, ""): 1})
    assert Counter(r["doc_id"] for r in got if r["kept"]) == Counter(i for i, t in stay.elements())
    kept = minhash.keep_first(df, 4)
    assert kept.columns == df.columns
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == stay


def test_op7_documents(spark):
    check_components(spark.read.parquet(f"{SF_CHECK}/documents.parquet"), 5)


@pytest.mark.parametrize("block", [2048, 16])
def test_op7_spread_group(spark, monkeypatch, block):
    """Copies at all distances from their source: links between copies only
    show up in the second round, also when buckets are cut into blocks."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(block)
    words = [f"w{k}" for k in range(5000)]
    source = [rng.choice(words) for _ in range(120)]
    rows = []
    for i in range(150):
        copy = list(source)
        for _ in range(rng.randint(0, 12)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        rows.append((rng.randrange(10**6), " ".join(copy)))
        rows.append((10**7 + i, " ".join(rng.choice(words) for _ in range(60))))
    check_components(spark.createDataFrame(rows, "doc_id long, text string"), 4)


def test_keep_first(edge):
    kept = minhash.keep_first(edge, 4)
    assert kept.columns == edge.columns
    ids = Counter(r["doc_id"] for r in minhash.near_duplicates(edge, 4).where("kept").collect())
    assert Counter(r["doc_id"] for r in kept.collect()) == ids


def test_bayes_limits():
    limits = minhash.least_matches(80)
    assert len(limits) == 8 and list(limits) == sorted(limits)
    # a pair at the threshold practically never goes, one far below always does
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**32, (4000, 128), dtype=np.uint32)
    near = np.where(rng.random(a.shape) < 0.8, a, a + 1)
    far = np.where(rng.random(a.shape) < 0.4, a, a + 1)
    assert minhash.survivors(a, near, 80).all()
    assert not minhash.survivors(a, far, 80).any()


def test_components(spark):
    rng = random.Random(3)
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(5, k) for k in range(200, 260)]
    rand = [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(260)]
    links = chain + star + rand + [(7, 7)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    want = {x: root(x) for x in list(parent) if any(x in l and l[0] != l[1] for l in links)}
    got = dict(tuple(r) for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == want
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_pipeline(spark, edge):
    import corpus_pipeline
    import public_tokenizers as P

    from tessera.llm import bpe, mixing, quality_rules

    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").where("doc_id % 3 = 0").union(
        edge.select("doc_id", "text", "lang", "source", "n_chars"))
    docs = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).cache()
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    now = docs
    rows = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    steps = []
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF_CHECK).cache()
        steps.append(now)
        if len(steps) < 5:
            assert now.columns == docs.columns
    # quality rules
    verdicts = dict(zip(rows, quality_rules.measure(list(rows.values()))["kept"], strict=True))
    rows = {i: t for i, t in rows.items() if verdicts[i]}
    assert {r["doc_id"] for r in steps[0].collect()} == set(rows)
    # lines
    want = brute_lines(list(rows.items()))
    rows = {i: want[i, t][0] for i, t in rows.items()}
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in steps[1].collect()} == {i: (t, len(t)) for i, t in rows.items()}
    # near duplicates
    of = brute_components(list(rows.items()), 5)
    rows = {i: t for i, t in rows.items() if of(i, t)[2] == i}
    assert {r["doc_id"] for r in steps[2].collect()} == set(rows)
    # mix
    copies = {r["doc_id"]: r["copies"] for r in mixing.copies(steps[2]).collect()}
    assert Counter(r["doc_id"] for r in steps[3].collect()) == +Counter(copies)
    # ids
    path = P.path("byte_bpe_50k.tiktoken")
    for r in steps[4].collect():
        assert bytes(r["ids"]) == bpe.encode_texts([rows[r["doc_id"]]], path)[0]
        assert r["decoded_sha256"] == hashlib.sha256(rows[r["doc_id"]].encode()).hexdigest()
    assert steps[4].count() == sum(copies.values())
    run = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert run.columns == steps[4].columns and run.count() > 0


def test_line_dedup_with_its_own_column_names(spark):
    rows = [(1, "a b c d e\nx y", 7, 8, "k"), (2, "a b c d e\nz", 9, 1, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines long, n_removed long, row string")
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(df).collect()}
    assert (got[2]["text"], got[2]["n_lines"], got[2]["n_removed"]) == ("z", 2, 1)
    short = line_dedup.shorten(df)
    assert short.columns == df.columns
    assert {r["doc_id"]: (r["text"], r["n_lines"]) for r in short.collect()} == {1: (rows[0][1], 7), 2: ("z", 9)}


def test_sets_that_share_a_number(spark, monkeypatch):
    """Different sets with one 64-bit number stay different nodes."""
    rows = spark.createDataFrame([(5, 1, "a"), (5, 2, "b"), (5, 1, "a"), (6, 3, "c")], "node long, node2 long, of string")
    clashes = rows.groupBy("node").agg(F.min("node2").alias("lo"), F.max("node2").alias("hi")).where("lo <> hi").select("node", "lo")
    got = {(r["of"], r["node"]) for r in minhash._told_apart(rows, clashes).collect()}
    assert got == {("a", 5), ("b", 2), ("c", 6)}


def test_pipeline_edges(spark, edge, empty):
    """Null and shared doc_ids, repeated rows, further columns whose names the
    operators use, and an empty table, in every stage."""
    import corpus_pipeline

    prose = "the river ran over stone and under the old bridge while nobody looked at the water that rose all night"
    odd = [(None, prose, None, None), (None, prose, None, None), (None, "other " + prose[::-1], "en", "s1"), (900, prose + " again", "en", "s1"),
           (900, " ".join(reversed(prose.split())), "en", "s2"), (901, None, "en", "s2"), (902, "", None, None)]
    more = spark.createDataFrame([(i, t, lang, src, None if t is None else len(t), 9, 9) for i, t, lang, src in odd],
                                 "doc_id long, text string, lang string, source string, n_chars long, n_lines int, shard int")
    docs = edge.select("doc_id", "text", "lang", "source", "n_chars", F.lit(3).alias("n_lines"), "shard").unionAll(more)
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF_CHECK).cache()
        assert now.columns == docs.columns, name
        rows = [r["text"] for r in now.select("text").collect()]
        assert rows and None not in rows
        if name == "near_dedup":
            left = [(r["doc_id"], r["text"]) for r in now.select("doc_id", "text").collect() if r["text"].strip()]
            assert len(left) == len(set(left)) and sum(i is None for i, _ in left) >= 1
        if name == "line_dedup":
            # values of a further column stay what they were
            assert {r["n_lines"] for r in now.select("n_lines").collect()} <= {3, 9}
    out = corpus_pipeline.STAGES[-1][1](spark, now, SF_CHECK)
    assert out.count() == now.count()
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_CHECK).count() == 0, name
