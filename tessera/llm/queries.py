"""The registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bpe
from tessera.llm.archives import archive_report
from tessera.llm.collocations import collocations
from tessera.llm.common import documents
from tessera.llm.fingerprints import fingerprint_next
from tessera.llm.lexical_search import search
from tessera.llm.line_dedup import dedup_lines
from tessera.llm.minhash import near_duplicates
from tessera.llm.mixing import mix_report
from tessera.llm.quality_classifier import score_quality
from tessera.llm.quality_rules import quality_rules
from tessera.llm.sharding import shard_documents
from tessera.llm.token_counts import token_counts
from tessera.llm.token_output import token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(documents(spark, sf_dir)).select("doc_id", "text", "n_lines", "n_removed")


@query
def op3_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir))


@query
def op4_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.decode(bpe.encode(documents(spark, sf_dir))))


@query
def op6_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(documents(spark, sf_dir))


@query
def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), shingle=4, percent=80)


@query
def op8_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))


@query
def op9_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_next(documents(spark, sf_dir))


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(documents(spark, sf_dir))


@query
def op11_setm_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


@query
def op12_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_report(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query
def op13_mask_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE["op6_systematic_mix"] = r"""
WITH d AS (SELECT doc_id, source, COALESCE(LEN(REGEXP_EXTRACT_ALL(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
p AS (SELECT source, SUM(size)::BIGINT AS source_size, ROW_NUMBER() OVER (ORDER BY source NULLS LAST) AS place
      FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((place - 1) % 3 + 1)::INT] AS weight, 2 * source_size AS cap FROM p),
c AS (SELECT *, COALESCE(SUM(cap) OVER o, 0) AS cut, COALESCE(SUM(weight) OVER o, 0) AS gone,
             SUM(weight) OVER () AS weights, SUM(source_size) OVER () AS total, cap / weight AS ratio
      FROM w WINDOW o AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT level FROM (SELECT (1.5 * total::DOUBLE - cut::DOUBLE) / (weights - gone)::DOUBLE AS level, ratio, place FROM c)
      WHERE level <= ratio ORDER BY ratio, place LIMIT 1),
t AS (SELECT source, source_size, LEAST(level * weight, cap::DOUBLE) AS target,
        COALESCE(LEAST(level * weight, cap::DOUBLE) / NULLIF(source_size, 0)::DOUBLE, 0) AS rate,
        LIST_SUM([(STRPOS('0123456789abcdef', SUBSTR(MD5('mixing|' || COALESCE(source, CHR(0) || 'null')), i, 1)) - 1)
                  * (16 ** (8 - i)) FOR i IN RANGE(1, 9)]) / 4294967296.0 AS u
      FROM c, l),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY source ORDER BY size DESC, MD5(doc_id::VARCHAR), doc_id) AS pos FROM d)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       ((FLOOR(u + rate * pos) - FLOOR(u + rate * (pos - 1))) * size)::BIGINT AS taken
FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source"""

ORACLE["op2_line_dedup"] = r"""
WITH l AS (SELECT doc_id, i AS line_no, lines[i + 1] AS line FROM (
             SELECT doc_id, STRING_SPLIT(COALESCE(text, ''), CHR(10)) AS lines,
                    UNNEST(RANGE(LEN(STRING_SPLIT(COALESCE(text, ''), CHR(10))))) AS i FROM documents)),
s AS (SELECT doc_id, line_no, line, LIST_SORT(LIST_DISTINCT(REGEXP_EXTRACT_ALL(LOWER(line), '[^\x20\x09-\x0D]+'))) AS words FROM l),
c AS (SELECT words, LEN(words) AS n, MIN((doc_id, line_no)) AS first, ROW_NUMBER() OVER () AS id
      FROM s WHERE LEN(words) > 0 GROUP BY words),
t AS (SELECT id, n, first, UNNEST(words) AS w FROM c),
p AS (SELECT a.id AS earlier, b.id AS later FROM t a JOIN t b ON a.w = b.w AND a.first < b.first
        AND a.n * 100 >= b.n * 80 AND b.n * 100 >= a.n * 80
      GROUP BY a.id, b.id, a.n, b.n HAVING COUNT(*) * 100 >= (a.n + b.n - COUNT(*)) * 80),
r AS (SELECT s.doc_id, s.line_no, s.line, LEN(s.words) > 0 AS has_words,
             LEN(s.words) > 0 AND ((s.doc_id, s.line_no) > c.first OR c.id IN (SELECT later FROM p)) AS gone
      FROM s LEFT JOIN c ON s.words = c.words)
SELECT doc_id, COALESCE(STRING_AGG(line, CHR(10) ORDER BY line_no) FILTER (WHERE NOT gone), '') AS text,
       COUNT(*) FILTER (WHERE has_words) AS n_lines, COUNT(*) FILTER (WHERE gone) AS n_removed
FROM r GROUP BY doc_id"""

ORACLE["op11_setm_collocations"] = r"""
WITH p AS (SELECT lang, p, i, UNNEST(ws) AS w, UNNEST(RANGE(LEN(ws))) AS j FROM (
   SELECT lang, p, i, REGEXP_EXTRACT_ALL(piece, '[^\x20\x09]+') AS ws FROM (
    SELECT lang, i AS p, UNNEST(ps) AS piece, UNNEST(RANGE(LEN(ps))) AS i FROM (
     SELECT COALESCE(lang, 'und') AS lang, ROW_NUMBER() OVER () AS i,
       REGEXP_SPLIT_TO_ARRAY(TRANSLATE(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS ps
     FROM documents WHERE text IS NOT NULL)))),
g AS (SELECT lang, w, LEAD(w) OVER o AS w2, LEAD(w, 2) OVER o AS w3 FROM p WINDOW o AS (PARTITION BY p, i ORDER BY j)),
f AS (SELECT lang, w AS phrase, COUNT(*) AS f, 1 AS m FROM g GROUP BY ALL
      UNION ALL SELECT lang, w || ' ' || w2, COUNT(*), 2 FROM g WHERE w2 IS NOT NULL GROUP BY ALL
      UNION ALL SELECT lang, w || ' ' || w2 || ' ' || w3, COUNT(*), 3 FROM g WHERE w3 IS NOT NULL GROUP BY ALL),
t AS (SELECT lang, SUM(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, phrase, f AS a, m, STRING_SPLIT(phrase, ' ') AS ws FROM f WHERE m > 1 AND f >= 10),
k AS (SELECT lang, phrase, a, m, k, ARRAY_TO_STRING(ws[1:k], ' ') AS head, ARRAY_TO_STRING(ws[k + 1:], ' ') AS tail
      FROM (SELECT *, UNNEST(RANGE(1, m)) AS k FROM c)),
s AS (SELECT k.lang, k.phrase, k.a, k.m, k.k, x.f AS l, y.f AS r, (1000000::HUGEINT * k.a * k.a) // (x.f::HUGEINT * y.f) AS score
      FROM k JOIN f x ON x.lang = k.lang AND x.phrase = head JOIN f y ON y.lang = k.lang AND y.phrase = tail),
b AS (SELECT * FROM s QUALIFY ROW_NUMBER() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
v AS (SELECT lang, phrase, MAX(a) AS a FROM (SELECT lang, a, UNNEST([ARRAY_TO_STRING(ws[1:2], ' '), ARRAY_TO_STRING(ws[2:3], ' ')]) AS phrase
      FROM c WHERE m = 3) GROUP BY ALL)
SELECT b.lang, ROW_NUMBER() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, ENCODE(b.phrase)) AS rank, b.phrase, b.a, l, r, n, score::BIGINT AS score
FROM b JOIN t ON t.lang = b.lang LEFT JOIN v ON v.lang = b.lang AND v.phrase = b.phrase
WHERE COALESCE(100 * v.a < 50 * b.a, TRUE)
QUALIFY rank <= 2000"""

ORACLE["op13_mask_search"] = r"""
WITH d AS (SELECT doc_id, ROW_NUMBER() OVER () AS i,
             REGEXP_EXTRACT_ALL(TRANSLATE(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
           FROM documents WHERE text IS NOT NULL),
q AS (SELECT q, item_id, t, COUNT(*) AS times FROM (
        SELECT ROW_NUMBER() OVER () AS q, item_id, UNNEST(REGEXP_EXTRACT_ALL(
               TRANSLATE(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM (SELECT DISTINCT item_id, text FROM benchmark))
      GROUP BY q, item_id, t),
s AS (SELECT COUNT(*)::BIGINT AS n_docs, SUM(LEN(ts))::BIGINT AS n_terms FROM d WHERE LEN(ts) > 0),
p AS (SELECT i, doc_id, t, n, COUNT(*)::BIGINT AS tf FROM (SELECT i, doc_id, LEN(ts)::BIGINT AS n, UNNEST(ts) AS t FROM d)
      WHERE t IN (SELECT t FROM q) GROUP BY i, doc_id, t, n),
w AS (SELECT t, FLOOR(1000 * LN((2 * n_docs + 2)::DOUBLE / (2 * COUNT(*) + 1)::DOUBLE))::BIGINT AS w
      FROM p, s GROUP BY t, n_docs),
c AS (SELECT q, item_id, i, doc_id, SUM(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
      FROM q JOIN p USING (t) JOIN w USING (t), s GROUP BY q, item_id, i, doc_id)
SELECT item_id, (ROW_NUMBER() OVER (PARTITION BY q ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
FROM c WHERE score > 0 QUALIFY rank <= 10"""

ORACLE["op12_warc_captures"] = r"""
WITH p AS (SELECT page_id, ENCODE(COALESCE(html, '')) AS body, SHA1(ENCODE(COALESCE(html, ''))) AS hex FROM pages),
d AS (SELECT page_id, OCTET_LENGTH(body)::BIGINT AS payload_bytes, hex,
        LIST_AGGREGATE([SUBSTR('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || SUBSTR(hex, 10 * (i // 8) + 1, 10))::BIGINT >> (35 - 5 * (i % 8))::INT) & 31)::INT + 1, 1)
           FOR i IN RANGE(32)], 'string_agg', '') AS payload_digest,
        MAX(page_id) OVER (PARTITION BY body) AS newest FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> newest THEN newest END AS refers_to FROM d"""
