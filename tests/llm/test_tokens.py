"""Token counts, BPE and token files against the public libraries."""
import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
import xxhash
from llm_cases import SF_CHECK, texts_of
from tokenizers import Tokenizer

from tessera.llm import bpe, pretokens, rangecoder, token_counts, token_output

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(n=400):
    rng = random.Random(8)
    signs = "ab1 \n\t'stmdrevl!. é٣''Ᲊ\U00011de0一ç  the"
    out = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 80))) for _ in range(n)]
    return out + ["", "the" * 400, "a" * 3000, " " * 999, "x<|endoftext|>y's<|endoftext|>", "\n" * 50 + "a"]


def test_cut_matches_pattern():
    texts = odd_texts()
    # signs of the newest Unicode tables are classed by the library, not by this module
    texts = [t.replace("\U00011de0", "").replace("Ᲊ", "") for t in texts]
    assert pretokens.cut(texts) == [regex.findall(P.PATTERN, t) for t in texts]
    assert pretokens.cut([]) == [] and pretokens.cut(["", ""]) == [[], []]


def test_counts_match_library(library):
    texts = odd_texts()
    expected = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert token_counts.count_tokens(texts, JSON).tolist() == expected
    assert token_counts.count_tokens([], JSON).tolist() == []


def test_scan_equals_sequential_composition():
    rng = np.random.default_rng(3)
    maps = rng.integers(0, 8, (37, 8))
    got, acc = token_counts.scan_maps(maps), np.arange(8)
    for j, m in enumerate(maps):
        acc = m[acc]
        assert (got[j] == acc).all()


def test_counts_survive_small_caches(library, monkeypatch):
    monkeypatch.setattr(token_counts, "MAX_TRANSITIONS", 50)
    monkeypatch.setattr(token_counts, "MAX_PIECES", 3)
    texts = ["reading and writing unusualwords here", "more thstinnt of it"] * 3
    expected = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    token_counts._counts.cache_clear()
    assert [int(token_counts.count_tokens([t], JSON)[0]) for t in texts] == expected


def test_op1_edge(edge, empty, library):
    out = token_counts.token_counts(edge)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    got = Counter(tuple(r) for r in out.collect())
    counts = [(i, t, len(library.encode(t, add_special_tokens=False).ids)) for i, t in texts_of(edge)]
    assert got == Counter((i, len(t.encode()), n, n > 512) for i, t, n in counts)
    assert token_counts.token_counts(empty).collect() == []


def test_bpe_matches_tiktoken_and_round_trips(reference):
    rng = random.Random(5)
    texts = odd_texts() + ["".join(rng.choice("thenigarodlscABéä") for _ in range(rng.randint(65, 400))) for _ in range(60)]
    texts.append("".join(rng.choice("thenigaro") for _ in range(6000)))
    ids = bpe.encode_texts(texts, RANKS)
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [reference.encode_ordinary(t) for t in texts]
    assert bpe.decode_ids(ids, RANKS) == [t.encode() for t in texts]


def test_op5_edge(edge, empty, reference):
    out = bpe.digests(bpe.decode(bpe.encode(edge)))
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    expected = Counter()
    for i, t in texts_of(edge):
        ids = np.array(reference.encode_ordinary(t), "<u4")
        expected[(i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())] += 1
    assert Counter(tuple(r) for r in out.collect()) == expected
    assert bpe.digests(bpe.decode(bpe.encode(empty))).collect() == []


@pytest.mark.parametrize("block", [64, 700, 4096])
def test_range_coder_round_trip(block):
    rng = np.random.default_rng(0)
    for ids in (rng.integers(0, 50257, 3000), np.zeros(2000, int), np.array([5]), np.zeros(0, int),
                rng.zipf(1.3, 9000) % 50257, np.tile(rng.integers(0, 50257, 37), 90), np.full(100, 50256)):
        data = rangecoder.encode(ids, 50257, block)
        assert (rangecoder.decode(data, 50257, block) == ids).all()
        for prior in (rangecoder.prior_of(ids, 50257), rangecoder.prior_of(ids[::2] // 2, 50257)):
            data = rangecoder.encode(ids, 50257, block, prior)
            assert (rangecoder.decode(data, 50257, block, prior) == ids).all()
    # what repeats gets short
    assert len(rangecoder.encode(np.tile(np.arange(50), 200), 50257, 4096)) < 10000 * 2 / 8


def test_fewer_bits_than_zlib(library):
    """On ids of documents, blocks and their prior together."""
    import duckdb

    texts = duckdb.sql(f"SELECT text FROM '{SF_CHECK}/documents.parquet' WHERE text IS NOT NULL ORDER BY doc_id").fetchall()
    ids = np.concatenate([np.array([*e.ids, 0], "<u2") for e in library.encode_batch([t for t, in texts], add_special_tokens=False)])
    prior = rangecoder.prior_of(ids, 50257)
    data = rangecoder.encode(ids, 50257, 4096, prior)
    assert len(data) + len(zlib.compress(prior, 6)) < 0.95 * len(zlib.compress(ids.tobytes(), 6))


def test_priors_of_any_frequency():
    """Tables are whole for very frequent ids, and for ids the prior has not seen."""
    counts = np.array([1 << 60, 1, 3, 0, 0, 7])
    prior = np.where(counts, np.minimum(np.round(4 * np.log2(np.maximum(counts, 1))) + 1, 255), 0).astype(np.uint8).tobytes()
    about = rangecoder._Prior(6, prior)
    assert (about.wide > 0).all() and (about.wide.reshape(-1, 64).sum(axis=1) == 512).all() and len(about.member_of) == 512
    ids = np.array([3, 0, 0, 4, 5, 1, 2] * 20)
    assert (rangecoder.decode(rangecoder.encode(ids, 6, 50, prior), 6, 50, prior) == ids).all()


def test_blocks_are_independent_and_checked():
    ids = np.random.default_rng(1).integers(0, 50257, 1000)
    data = rangecoder.encode(ids, 50257, 100)
    head = rangecoder._HEAD
    first = head.size + head.unpack_from(data)[2]
    assert (rangecoder.decode(data[first:], 50257, 100) == ids[100:]).all()
    broken = bytearray(data)
    broken[head.size + 3] ^= 255
    with pytest.raises(ValueError):
        rangecoder.decode(bytes(broken), 50257, 100)
    with pytest.raises(ValueError):
        rangecoder.decode(data[:-3], 50257, 100)


def expected_files(rows, library):
    at, out = 0, Counter()
    # equal doc_ids, and rows without one, in the order of the texts' hashes
    signed = lambda t: np.uint64(xxhash.xxh64_intdigest(t.encode(), 42)).astype(np.int64)
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed(r[1]), r[1])):
        ids = library.encode(t, add_special_tokens=False).ids + [0]
        out[(i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
        at += len(ids)
    return out


def test_op10_edge(edge, empty, library, monkeypatch):
    got = token_output.token_files(edge)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert Counter(tuple(r) for r in got.collect()) == expected_files(texts_of(edge), library)
    assert token_output.token_files(empty).collect() == []


def test_op10_documents(spark, library):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").where("doc_id < 200")
    got = Counter(tuple(r) for r in token_output.token_files(docs).collect())
    assert got == expected_files(texts_of(docs), library)


def test_encoder_matches_library(library, monkeypatch):
    texts = odd_texts() + ["two  blanks", "end ", " start", "a \n b", "a\n b", "tab\t x", "a\u00a0 b", "x \u3000y", "it 's 'll", " ", "a b c"]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    encoder = token_output._Encoder(JSON)
    assert [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(texts)] == want
    monkeypatch.setattr(token_output, "MAX_PIECES", 5)
    for t, ids in zip(texts[:50], want):
        assert np.frombuffer(encoder.encode([t])[0], "<u2").tolist() == ids
    assert encoder.encode([]) == []


def test_encoder_joins_new_words(library, monkeypatch):
    """New words go to the library many at a time, and come back as they are alone."""
    class Counting:
        taken = 0

        def __getattr__(self, name):
            return getattr(library, name)

        def encode_batch_fast(self, texts, **kwargs):
            Counting.taken += len(texts)
            return library.encode_batch_fast(texts, **kwargs)

    words = [f"{a}{b}{c}" for a in ("qu", "Zé", "'s", "9", "\u3042") for b in range(40) for c in ("\n", "\n\nx", ".", "\u00a0", "!?\r\n")]
    texts = ["one " + " ".join(words[k::7]) for k in range(7)]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    encoder = token_output._Encoder(JSON)
    encoder.library = Counting()
    assert [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(texts)] == want
    assert Counting.taken < 10
    # over several texts, and where a special string holds a blank
    for special in ([], ["never here"]):
        monkeypatch.setattr(token_output, "JOINED_WORDS", 3)
        other = token_output._Encoder(JSON)
        other.special += special
        assert [np.frombuffer(x, "<u2").tolist() for x in other.encode(texts)] == want


def test_directory_round_trip():
    ids, lengths = [None, 5, -3, 2**62], np.array([1, 0, 7, 9])
    back, n, prior = token_output.unpack_directory(token_output.pack_directory(ids, lengths, b"\1\2\3"))
    assert back == ids and n.tolist() == lengths.tolist() and prior == b"\1\2\3"
    with pytest.raises(ValueError):
        token_output.unpack_directory(token_output.pack_directory(ids, lengths)[:-1] + b"x")
