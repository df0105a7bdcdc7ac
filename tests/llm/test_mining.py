"""Collocations, archives and ranked search by brute force."""
import base64
import glob
import gzip
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import archives, bytewords, collocations, lexical_search

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_collocations(rows, max_words, min_count, top, cover):
    """rows of (text, lang)"""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for m in range(1, max_words + 1):
                f.update((lang, *ws[i : i + m]) for i in range(len(ws) - m + 1))
    cands = {p: a for p, a in f.items() if len(p) > 2 and a >= min_count}
    around = Counter()
    for (lang, *ws), a in cands.items():
        for m in range(2, len(ws)):
            for i in range(len(ws) - m + 1):
                inner = (lang, *ws[i : i + m])
                around[inner] = max(around[inner], a)
    out = {}
    for (lang, *ws), a in cands.items():
        if 100 * around[lang, *ws] >= cover * a:
            continue
        score, _, left, right = min((1000000 * a * a // (x * y), k, x, y) for k in range(1, len(ws))
                                    for x, y in [(f[lang, *ws[:k]], f[lang, *ws[k:]])])
        out.setdefault(lang, []).append((-score, -a, " ".join(ws).encode(), left, right))
    return {(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for lang, found in out.items()
            for i, (s, a, p, x, y) in enumerate(sorted(found)[:top])}


def check_collocations(df, max_words=3, min_count=2, top=25, cover=50, chunk_words=60):
    got = collocations.collocations(df, max_words, min_count, top, cover, chunk_words)
    rows = [tuple(r) for r in got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]
    want = brute_collocations([(r["text"], r["lang"]) for r in df.select("text", "lang").collect()], max_words, min_count, top, cover)
    assert len(rows) == len(set(rows)) and set(rows) == want
    return rows


def test_split_words():
    import pyarrow as pa
    texts = ["Ab cd. EF", "", None, "é!!Ü x", "tail", "next", ".", " a"]
    got = bytewords.split(next(bytewords.slices(pa.array(texts)))[1], collocations.CLASSES)
    assert [w.decode() for w in got.words.to_pylist()] == ["ab", "cd", "ef", "é", "Ü", "x", "tail", "next", "a"]
    assert got.row.tolist() == [0, 0, 0, 3, 3, 3, 4, 5, 7]
    assert (np.diff(got.piece) == 0).tolist() == [True, False, False, False, True, False, False, False]
    assert [x for x, _ in bytewords.slices(pa.array([], pa.string()))] == []


def test_op11_edges(edge, empty):
    assert check_collocations(edge)
    assert check_collocations(edge, max_words=2, min_count=3)
    assert collocations.collocations(empty).collect() == []


@pytest.mark.parametrize("max_words", [3, 4])
def test_op11_random(spark, max_words):
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(12)] + ["A", "É", "b\x0c", "x.y"]
    rows = [(" ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ",", "\n", "\t"]) for _ in range(rng.randint(0, 40))),
             rng.choice(["en", "de", None, "und"])) for _ in range(80)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    assert check_collocations(df, max_words=max_words, chunk_words=100)
    # a low cover drops more, a high one nothing
    check_collocations(df, max_words=max_words, cover=20, top=5)


def brute_search(docs, items, k=10):
    """docs of (doc_id, text), items of (item_id, text); {(item_id, text): [(doc_id, score)]}"""
    counts = [(i, Counter(lexical_search.terms_of(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = {}
    for item_id, text in set(items):
        found = []
        for i, c in counts:
            m = 25 + 75 * sum(c.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in lexical_search.terms_of(text) if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0))
        if found:
            out[item_id, text] = [(None if none else i, -s) for s, none, i in sorted(found)[:k]]
    return out


def check_search(spark, docs, items, k=10, **options):
    got = lexical_search.search(docs, items, k, **options).collect()
    want = brute_search([tuple(r) for r in docs.select("doc_id", "text").collect()],
                        [tuple(r) for r in items.select("item_id", "text").collect()], k)
    assert Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got) == Counter(
        (item_id, rank + 1, i, s) for (item_id, _), found in want.items() for rank, (i, s) in enumerate(found))
    return got


def test_op13_edges(spark, edge, empty):
    rows = [(1, "the river of stone"), (2, None), (3, ""), (4, "zzz nowhere"), (1, "the river of stone"), (1, "Blue walk WALK walk"),
            (None, "naïve é éàü 一二"), (5, "x1 don't ab"), (6, " ".join(f"w{k} the{k}" for k in range(90)) + " the the number of")]
    items = spark.createDataFrame(rows, "item_id long, text string").withColumns({"doc_id": F.lit(1), "score": F.lit("x")})
    assert check_search(spark, edge, items)
    assert check_search(spark, edge, items, k=3, block_items=2, chunk_docs=4)
    assert lexical_search.search(empty, items).collect() == []
    assert lexical_search.search(edge, items.limit(0)).collect() == []
    assert lexical_search.search(edge, items.where("item_id = 2")).collect() == []


def test_op13_random(spark):
    """Items of more terms than a word of a mask has bits, many equal scores."""
    rng = random.Random(13)
    vocabulary = [f"t{k}" for k in range(150)]
    weights = [1 / (k + 1) for k in range(150)]
    docs = [(rng.randint(0, 250), " ".join(rng.choices(vocabulary, weights, k=rng.randint(0, 60)))) for _ in range(300)]
    docs += [(1000 + i, "t1 t2 t3") for i in range(40)] + [(None, "t1 t2 t140")] * 3
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 30, 120])))) for i in range(25)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert check_search(spark, d, spark.createDataFrame(items, "item_id long, text string"), chunk_docs=50)


def test_op13_skips_masks():
    """Few documents are scored where masks with high bounds fill the ranks."""
    n, scored = 5000, []
    term = np.concatenate([np.r_[0, 1, 2] if i < 20 else np.r_[0] for i in range(n)])
    size = np.array([3 if i < 20 else 1 for i in range(n)])
    row = {"doc_id": np.arange(n), "known": np.ones(n, np.uint8), "length": np.full(n, 5), "first": np.r_[0, np.cumsum(size)],
           "term": term.astype(np.int32), "tf": np.ones(len(term), np.int32)}
    chunk = lexical_search.Chunk({k: lexical_search._pack(v) for k, v in row.items()}, n, 5 * n, 3)
    real = chunk.scores
    chunk.scores = lambda docs, weight: scored.extend(docs) or real(docs, weight)
    docs, scores = chunk.top({0: 10, 1: 900, 2: 800}, np.zeros(3, np.int64), 10)
    assert docs.tolist() == list(range(10)) and len(set(scores.tolist())) == 1 and len(scored) < 200


QUOTED = "before\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:0>\r\nContent-Length: 2\r\n\r\nab"
PAGES = "page_id long, url string, html string, type string, digest string, n long, value string"


def page_rows():
    long_page = "<p>é</p>\r\n" * 30000
    pages = [(1, "http://a.org/x", "one"), (2, "http://a.org/y", "one"), (3, None, "one"), (4, "http://b.org/ \r\nX: y", None),
             (5, "http://b.org", ""), (6, "u", QUOTED), (7, "u", QUOTED + "\r\n"), (8, "u", QUOTED), (9, "u", "\r\n\r\n"),
             (10, "u", "\r\n\r\nWARC/1."), (20, "u", "\nWARC/1." * 9), (11, "u", "WARC/1.1\r\n"), (12, "u", long_page), (12, "u", long_page), (13, "v", "rep"),
             (13, "v", "rep"), (13, "v", "rep"), (13, "w", "rep"), (13, None, "rep"), (None, "n", "rep"), (None, "n", "alone"),
             (None, None, "alone"), (None, "only", "single")]
    return [(*p, "t", "d", 0, "v") for p in pages]


def brute_pages(rows, least=0):
    out = []
    newest = {}
    for k, (page_id, url, html, *_) in enumerate(rows):
        at = (page_id is not None, page_id or 0, url is not None, url or "", k)
        newest[html or ""] = max(newest.get(html or "", at), at)
    for k, (page_id, _, html, *_) in enumerate(rows):
        body = (html or "").encode()
        top = newest[html or ""]
        first = k == top[-1] or len(body) < least
        out.append((page_id, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if first else "revisit",
                    None if first or not top[0] else top[1]))
    return Counter(out)


@pytest.mark.parametrize("least", [0, 4])
def test_op12_edges(spark, least):
    # more pages than a reader's buffer holds, so that version lines cross its ends
    rows = page_rows() + [(100 + i, "u" * (i % 50), "p" * (i % 97), "t", "d", 0, "v") for i in range(3000)]
    df = spark.createDataFrame(rows, PAGES).repartition(3)
    got = archives.archive_report(df, least)
    assert Counter(tuple(r) for r in got.collect()) == brute_pages(rows, least)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert archives.archive_report(df.limit(0)).collect() == []


def test_op12_files_are_warc(spark, tmp_path):
    """The files fall into records by Content-Length alone, each behind the last."""
    rows = page_rows()
    path = str(tmp_path / "w")
    archives.write_archives(spark.createDataFrame(rows, PAGES).repartition(2), path)
    kinds, ids = Counter(), []
    for f in glob.glob(path + "/*.gz"):
        data = gzip.open(f).read()
        at = 0
        while at < len(data):
            head, _, _ = data[at:].partition(b"\r\n\r\n")
            lines = head.split(b"\r\n")
            assert lines[0] == b"WARC/1.1"
            fields = dict(x.split(b": ", 1) for x in lines[1:])
            at += len(head) + 4 + int(fields[b"Content-Length"])
            assert data[at : at + 4] == b"\r\n\r\n"
            at += 4
            kinds[fields[b"WARC-Type"]] += 1
            ids.append(fields[b"WARC-Record-ID"])
    n = len({r[2] or "" for r in rows})
    assert kinds == {b"request": len(rows), b"metadata": len(rows), b"response": n, b"revisit": len(rows) - n}
    assert len(set(ids)) == len(ids)
    whole = archives.captures(archives.read_archives(spark, path)).collect()
    bodies = Counter(bytes(r["response"]["payload"]).decode() for r in whole if r["type"] == "response")
    assert bodies == Counter({r[2] or "" for r in rows})
    assert all(r["request"]["record_id"] and r["metadata"]["record_id"] for r in whole)
    assert {r["target_uri"] for r in whole if r["metadata"]["fields"].get("page") == "4"} == {"http://b.org/%20%20%20X:%20y"}


def test_op12_foreign_archives(spark, tmp_path):
    """Records linked from the response's side, incomplete and damaged ones."""
    def record(kind, own, body=b"", **fields):
        lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: {own}", *[f"{k.replace('_', '-')}: {v}" for k, v in fields.items()]]
        return ("WARC/1.0\r\n" + "\r\n".join(lines) + f"\r\nContent-Length: {len(body)}\r\n\r\n").encode() + body + b"\r\n\r\n"
    http = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\nbody\xff"
    good = [record("warcinfo", "w", b"software: y"), record("request", "q", b"GET /", WARC_Concurrent_To="z"),
            record("response", "r", http, WARC_Concurrent_To="q", Content_Type="application/http; msgtype=response"),
            record("resource", "s", b"img"), record("metadata", "m2", b"a: 1", WARC_Concurrent_To="r", Content_Type="application/warc-fields"),
            record("metadata", "m1", b"a: 2", WARC_Concurrent_To="r", Content_Type="application/warc-fields")]
    def reads(name, parts):
        (tmp_path / name).mkdir()
        with open(tmp_path / name / "a.warc.gz", "wb") as f:
            for p in parts:      # a member for each record, as crawlers write
                f.write(gzip.compress(p))
        return archives.read_archives(spark, str(tmp_path / name))
    got = {r["record_id"]: r for r in archives.captures(reads("good", good)).collect()}
    assert set(got) == {"r", "s"} and got["s"]["request"] is None and got["s"]["metadata"] is None
    assert got["r"]["request"]["record_id"] == "q" and got["r"]["metadata"]["fields"] == {"a": "2"}
    assert bytes(got["r"]["response"]["payload"]) == b"body\xff" and got["r"]["response"]["fields"] == {"server": "x"}
    cut = [good[0], good[2][:-12]]
    long = [good[0], good[2][:-4] + b"more" + good[2][-4:]]
    bad = [record("response", "r", http, Content_Type="application/http", WARC_Payload_Digest="sha1:AAAA")]
    for name, parts in (("cut", cut), ("long", long), ("bad", bad)):
        with pytest.raises(Exception, match="ends inside|longer than|unlike"):
            reads(name, parts).collect()
