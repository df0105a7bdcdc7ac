"""Rules, sharding, mixing, classifier and fingerprints."""
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import SF_CHECK, texts_of
from pyspark.sql import functions as F

from tessera.llm import fingerprints, mixing, quality_classifier, quality_rules, sharding

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def rules(text):
    w = WORDS.findall(text)
    n, chars = len(w), sum(map(len, w))

    def cover(size, later):
        seen = Counter() if later else Counter(tuple(w[i:i + size]) for i in range(n - size + 1))
        out = set()
        for i in range(n - size + 1):
            g = tuple(w[i:i + size])
            if later:
                if seen[g]:
                    out.update(range(i, i + size))
                seen[g] += 1
            elif seen[g] > 1:
                out.update(range(i, i + size))
        return out

    repeat = len(cover(5, False))
    fails = any(chars and sum(len(w[i]) for i in cover(k, True)) / chars > limit
                for k, limit in quality_rules.NGRAM_LIMITS.items())
    seen, dup, dup_chars = set(), 0, 0
    for line in text.split("\n"):
        if WORDS.search(line):
            if line in seen:
                dup, dup_chars = dup + 1, dup_chars + sum(map(len, WORDS.findall(line)))
            seen.add(line)
    fails |= bool(chars) and dup_chars / chars > quality_rules.LINE_CHAR_LIMIT
    base = n < 10 or 100 * repeat > 20 * n
    return (n, chars, sum(c in "#*$%&|<>" for c in text), dup, repeat, base, not (base or fails))


def test_op8(spark, edge, empty):
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    extra = spark.createDataFrame([(900, "x " * 40), (901, "a b c d e f g h i j\n" * 5), (902, "#$ " + "q w e r t " * 9)], "doc_id long, text string")
    for df in (edge, extra):
        got = Counter(tuple(r) for r in quality_rules.quality_rules(df).select("doc_id", *cols).collect())
        assert got == Counter((i, *rules(t)) for i, t in texts_of(df))
    assert quality_rules.quality_rules(empty).collect() == []
    kept = quality_rules.keep_good(edge)
    assert kept.columns == edge.columns
    assert kept.count() == sum(rules(t)[-1] for _, t in texts_of(edge))


@pytest.mark.parametrize(("n", "bits"), [(2, 3), (3, 2), (4, 2)])
def test_curve_visits_neighbours(spark, n, bits):
    side = 1 << bits
    cells = spark.range(side**n).select(*[F.expr(f"CAST(id DIV {side**k} % {side} AS INT)").alias(f"c{k}") for k in range(n)])
    rows = cells.withColumn("at", sharding.curve_index([F.col(f"c{k}") for k in range(n)], bits)).orderBy("at").collect()
    assert [r["at"] for r in rows] == list(range(side**n))
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(a[k] - b[k]) for k in range(n)) == 1


def test_op3(spark, edge, empty):
    for df in (edge, spark.read.parquet(f"{SF_CHECK}/documents.parquet")):
        rows = sharding.shard_documents(df).collect()
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
            (i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in texts_of(df))
        slots = defaultdict(list)
        for r in rows:
            assert r["law"] == "rows" and r["grown_shard"] is None and 0 <= r["shard"] < 16
            slots[r["shard"]].append(r["slot"])
        counts = [len(slots[s]) for s in range(16)]
        assert max(counts) - min(counts) <= 1 and sum(counts) == len(rows)
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())
        order = [r["curve_index"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
        assert order == sorted(order)
    assert sharding.shard_documents(empty).collect() == []


def test_shards_prune(spark):
    """A shard holds a small part of every dimension's values."""
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    per = sharding.shard_documents(docs).join(docs, "doc_id").groupBy("shard").agg(
        F.count_distinct("source").alias("sources"), F.count_distinct("lang").alias("langs"))
    assert per.agg(F.avg("sources")).first()[0] < 0.8 * docs.select("source").distinct().count()


def test_write_shards(spark, edge, tmp_path):
    sharding.write_shards(edge.drop("shard"), sharding.shard_documents(edge), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.where("doc_id IS NOT NULL").count() == edge.where("doc_id IS NOT NULL").count()


def targets(sizes, weights=(5, 2, 1)):
    """Water filling by the words of the contract: cut, reshare, repeat."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    out, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > 2 * sizes[s]]
        if not over:
            out.update({s: level * weight[s] for s in open_})
            break
        for s in over:
            out[s], left = 2.0 * sizes[s], left - 2 * sizes[s]
            open_.remove(s)
    return out


def test_op6(spark, edge, empty):
    for df, exact in ((edge, False), (spark.read.parquet(f"{SF_CHECK}/documents.parquet"), True)):
        rows = [(r["doc_id"], r["source"], len(WORDS.findall(r["text"] or ""))) for r in df.select("doc_id", "source", "text").collect()]
        sizes = Counter()
        for _, s, n in rows:
            sizes[s] += n
        want = targets(sizes)
        got = mixing.copies(df).collect()
        assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter(rows)
        taken = Counter()
        for r in got:
            assert 0 <= r["copies"] <= 2 and r["source_size"] == sizes[r["source"]]
            assert r["target"] == pytest.approx(want[r["source"]])
            taken[r["source"]] += r["copies"] * r["size"]
        for s in sizes:
            biggest = max(n for _, x, n in rows if x == s)
            assert abs(taken[s] - want[s]) <= 2 * biggest
        again = mixing.mix_report(df.repartition(3)).collect()
        assert Counter(map(tuple, again)) == Counter(map(tuple, mixing.mix_report(df).collect()))
    assert mixing.mix_report(empty).collect() == [] and mixing.mixed(empty).collect() == []


def test_mixed_rows(edge):
    mixed = mixing.mixed(edge)
    assert mixed.columns == edge.columns
    want = Counter()
    for r in mixing.copies(edge).collect():
        want[(r["doc_id"], r["source"], r["size"])] += r["copies"]
    got = Counter((r["doc_id"], r["source"], len(WORDS.findall(r["text"] or ""))) for r in mixed.collect())
    assert got == +want


def test_op4(spark, edge, empty):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = quality_classifier.score_quality(docs, labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    pdf = out.join(labels, "doc_id").toPandas()
    assert (pdf["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in pdf["doc_id"]]).all()
    held = pdf[pdf["held_out"]]
    good, bad = held[held["quality"] == 1]["score"].to_numpy(), held[held["quality"] == 0]["score"].to_numpy()
    auc = (good[:, None] > bad[None, :]).mean() + 0.5 * (good[:, None] == bad[None, :]).mean()
    assert auc > 0.97 and (held["predicted"] == held["quality"]).mean() > 0.95
    assert pdf["score"].between(0, 1).all() and (pdf["predicted"] == (pdf["score"] >= 0.3)).all()
    some = quality_classifier.score_quality(edge, labels.withColumn("lang", F.lit("clash")))
    assert some.count() == edge.count() and some.where("score IS NULL OR predicted IS NULL").count() == 0
    assert quality_classifier.score_quality(empty, labels).collect() == []
    none = quality_classifier.score_quality(edge, labels.limit(0)).select("score").distinct().collect()
    assert [r[0] for r in none] == [0.5]


def test_op4_ignores_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality_classifier.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (dict(quality_classifier.score_quality(docs, x).select("doc_id", "score").collect()) for x in (labels, turned))
    assert a == b


def jaccard(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def spots(text):
    """Chains as word tuples, found word by word."""
    words = re.findall(r"\w+", text.lower())
    out = set()
    for i, w in enumerate(words):
        if w in fingerprints.ANCHORS:
            chain = [x for x in words[i + 1:i + 1 + 400] if x not in fingerprints.ANCHORS][:2]
            if len(chain) == 2:
                out.add((w, *chain))
    if not out and words:
        size = min(2, len(words))
        out = {("", *words[i:i + size]) for i in range(len(words) - size + 1)}
    return out


def likeness_by_hand(a, b):
    j = jaccard(a, b)
    return j if j >= fingerprints.FLOOR else 0.0


def test_op9(spark, edge, empty):
    for df in (edge, spark.read.parquet(f"{SF_CHECK}/documents.parquet"), edge.where("doc_id = 4")):
        rows = sorted(texts_of(df), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
        want = Counter()
        for k, (i, t) in enumerate(rows):
            after = rows[(k + 1) % len(rows)][1]
            changed = t[: len(t) - len(t) // 3] + after[: len(t) // 3]
            a, b, c = spots(t), spots(changed), spots(after)
            want[(i, len(t), hashlib.sha256(changed.encode()).hexdigest(), round(likeness_by_hand(a, b), 9), round(likeness_by_hand(a, c), 9))] += 1
        out = fingerprints.fingerprint_next(df).collect()
        assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9))
                       for r in out) == want
    assert fingerprints.fingerprint_next(empty).collect() == []


def test_op9_hot_numbers(spark, monkeypatch):
    """A third of the rows without a doc_id, a third with one doc_id: spread over
    ranges, each row once, in the order of the hash."""
    texts = [f"the river {i} walks of stone {i % 7} and blue {i % 5} in water {i}" for i in range(900)]
    ids = [None if i % 3 == 0 else 77 if i % 3 == 1 else i for i in range(900)]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").repartition(4)
    ranged, n = fingerprints._ranges(docs, 9)
    sizes = [r[1] for r in ranged.groupBy("rng").count().collect()]
    assert n >= 9 and max(sizes) <= 200 and sum(sizes) == 900
    hashed = {r["text"]: r["h"] for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    rows = sorted(zip(ids, texts, strict=True), key=lambda r: (r[0] is None, -(r[0] or 0), hashed[r[1]]))
    want = Counter()
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        want[i, hashlib.sha256((t[: len(t) - len(t) // 3] + after[: len(t) // 3]).encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["edited_sha256"]) for r in fingerprints.fingerprint_next(docs).collect()) == want


def test_pruned_likeness():
    """Above the floor exact, below it 0, whatever the lengths."""
    rng = np.random.default_rng(5)
    for _ in range(400):
        n, m = rng.integers(0, 3000, 2) // rng.integers(1, 60, 2)
        a = np.unique(rng.integers(0, 4000, n)).astype("<u4")
        b = np.unique(np.concatenate([rng.choice(a, int(len(a) * rng.random())) if len(a) else a, rng.integers(0, 4000, m)])).astype("<u4")
        j = jaccard(set(a.tolist()), set(b.tolist()))
        for floor in (0.05, 0.5, 0.8):
            assert fingerprints.likeness(a, b, floor) == (pytest.approx(j) if j >= floor else 0.0)


def test_equal_texts_equal_fingerprints(edge):
    rows = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprint_next(edge).collect()}
    assert rows[5] == rows[6] and rows[7] == rows[8] and rows[5] != rows[7] and rows[2] == ""


def test_similar_pairs(spark):
    rng = np.random.default_rng(2)
    base = [set(rng.integers(0, 1 << 32, n).tolist()) for n in (4, 9, 30, 80)]
    sets = []
    for b in base:
        for _ in range(8):
            keep = {x for x in b if rng.random() < 0.85}
            sets.append(keep | set(rng.integers(0, 1 << 32, 1).tolist()))
    rows = [(i, fingerprints.as_text(np.array(sorted(s), "<u4"))) for i, s in enumerate(sets)] + [(99, "")]
    df = spark.createDataFrame(rows, "doc_id long, fingerprint string")
    for percent in (50, 80):
        got = {(r["a"], r["b"]): r["likeness"] for r in fingerprints.similar_pairs(df, percent).collect()}
        want = {(i, j): jaccard(a, b) for j, b in enumerate(sets) for i, a in enumerate(sets[:j]) if 100 * jaccard(a, b) >= percent}
        assert got == pytest.approx(want)


def test_similar_classes(spark):
    """Many copies of a fingerprint are one class; pairs lie between classes only."""
    sets = [{1, 2, 3, 4, 5}, {1, 2, 3, 4, 6}, {7, 8}, {1, 2, 3, 4, 5}]
    rows = [(i, fingerprints.as_text(np.array(sorted(s), "<u4"))) for i, s in enumerate(sets)]
    rows += [(100 + i, rows[1][1]) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, fingerprint string")
    pairs = fingerprints.similar_pairs(df, 50).collect()
    assert [(r["a"], r["b"], round(r["likeness"], 6)) for r in pairs] == [(0, 1, round(4 / 6, 6))]
    of = dict(fingerprints.classes(df).collect())
    assert of[3] == 0 and of[2] == 2 and all(of[100 + i] == 1 for i in range(300)) and len(of) == 304


def test_op4_risk_and_gradient():
    """The parts of the risk by their definition, the gradients by finite differences."""
    rng = np.random.default_rng(1)
    weights = [rng.normal(0, 1, (4, 3)), rng.normal(0, 1, 3), rng.normal(0, 1, 3), rng.normal(0, 1, 1)]
    p, u, prior = rng.normal(0.5, 1, (7, 4)), rng.normal(0, 1, (11, 4)), 0.4

    def parts(w):
        out = [np.tanh(x @ w[0] + w[1]) @ w[2] + w[3][0] for x in (p, u)]
        plus, minus = np.log(1 + np.exp(-out[0])).mean(), [np.log(1 + np.exp(o)).mean() for o in out]
        return prior * plus, minus[1] - prior * minus[0]

    first, bracket, *grads = quality_classifier.risk(weights, p, u, prior)
    assert (first, bracket) == pytest.approx(parts(weights))
    for part, grad in enumerate(grads):
        for k, g in enumerate(grad):
            for at in np.ndindex(g.shape):
                up, down = ([w.copy() for w in weights] for _ in range(2))
                up[k][at] += 1e-5
                down[k][at] -= 1e-5
                assert g[at] == pytest.approx((parts(up)[part] - parts(down)[part]) / 2e-5, abs=1e-6)


def test_op4_prior():
    """The prior comes back from positives and unlabelled rows alone."""
    rng = np.random.default_rng(3)
    for share in (0.2, 0.5, 0.8):
        positive = rng.normal(1.5, 1, (3000, 3))
        of = rng.random(6000) < share
        unlabelled = np.where(of[:, None], rng.normal(1.5, 1, (6000, 3)), rng.normal(-1.5, 1, (6000, 3)))
        assert quality_classifier.class_prior(positive, unlabelled) == pytest.approx(share, abs=0.06)
    assert quality_classifier.class_prior(positive[:5], unlabelled) == quality_classifier.NO_PRIOR


def test_shards_of_strings_with_one_beginning(spark):
    """Sources that differ behind a long common beginning still prune, and cells
    follow the order of the values."""
    docs = spark.range(4000).selectExpr("id AS doc_id", "concat('https://site', lpad(cast(id % 20 as string), 2, '0'), '.org') AS source",
                                        "'en' AS lang", "repeat('x', cast(id % 50 as int)) AS text")
    per = sharding.shard_documents(docs).join(docs, "doc_id").groupBy("shard").agg(F.count_distinct("source").alias("n")).collect()
    assert max(r["n"] for r in per) <= 12 and len(per) == 16
    facts = docs.select("source").unionAll(spark.createDataFrame([(None,)] * 400, "source string"))
    cells = facts.select("source", sharding.quantised(facts, ("source",))[0].alias("cell")).distinct().collect()
    order = sorted(cells, key=lambda r: (r["source"] is not None, r["source"] or ""))
    n, below, want = 4400, 0, []
    for r in order:
        want.append(below * 16 // n)
        below += 400 if r["source"] is None else 200
    numbers = {c: i for i, c in enumerate(sorted(set(want)))}
    assert [r["cell"] for r in order] == [numbers[c] for c in want]


def test_mixed_repeats(spark):
    """Rows repeated over many partitions: every copy once, others untouched."""
    rows = [(1, "a b c", "s0", "one")] * 300 + [(None, None, None, "null")] * 200 + [(i, "w " * (i % 9), f"s{i % 3}", "own") for i in range(100, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, nth string").repartition(7)
    counts = {}
    for r in mixing.copies(docs).collect():
        key = (r["doc_id"], r["source"])
        counts[key] = counts.get(key, 0) + r["copies"]
    got = {}
    for r in mixing.mixed(docs).collect():
        key = (r["doc_id"], r["source"])
        got[key] = got.get(key, 0) + 1
    assert got == {k: n for k, n in counts.items() if n} and mixing.mixed(docs).columns == docs.columns
