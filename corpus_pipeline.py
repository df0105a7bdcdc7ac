"""Corpus preparation: the stages that turn ``documents`` into training input.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``.  Rows a stage drops stay dropped; line
dedup shortens texts and keeps every document (a text that loses all its lines
becomes empty); mixing repeats rows.

Defined results: a null or empty text fails the quality rules, and so goes in the
first stage; rows without a doc_id, and rows that share one, are documents told
apart by their texts; of rows equal in doc_id and text one stays behind near dedup
(texts that line dedup has emptied are like nothing, and stay);
null sources mix as a source of their own; an empty table gives an empty one in
every stage; further columns pass through to the mix (``n_chars`` is set anew, also
where it was null), the last stage keeps ``doc_id``, ``lang`` and ``source``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, line_dedup, minhash, mixing, quality_rules
from tessera.llm.common import documents
from tessera.session import cut_lineage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat themselves, or hold too few words, go."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines go that are like an earlier line of the corpus."""
    return line_dedup.shorten(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five-word shingles, 0.8)."""
    return minhash.keep_first(docs, shingle=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights; rows may repeat."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the digest of what they decode to."""
    coded = bpe.decode(bpe.encode(docs, keep=("doc_id", "lang", "source")))
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("mixing", mix),
    ("byte_bpe", encode),
]

#: no SQL for byte-pair merges: the tests hold the pipeline against plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written once, so that the
    next stage does not compute it again."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
