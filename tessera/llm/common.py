"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import input_bytes, shuffle_partitions

#: the columns of ``documents``; an operator selects the ones it reads, so
#: further columns never clash with its own
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: rows in one Arrow batch handed to Python: bounds a worker's memory
BATCH_ROWS = 1000

#: characters that a worker takes on at a time (one text at least)
PORTION_CHARS = 1 << 20

#: a word: a run of anything but the six ASCII white-space characters
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(df: DataFrame) -> None:
    """At most ``BATCH_ROWS`` rows in an Arrow batch of this session."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(df.sparkSession.conf.get(key, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        df.sparkSession.conf.set(key, str(BATCH_ROWS))


def batch_rows(spark: SparkSession, n: int) -> None:
    """Rows in an Arrow batch of this session from now on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(n))


def portions(texts: pd.Series, chars: int = PORTION_CHARS) -> Iterator[list[str]]:
    """The texts of a batch, in order, in lists of at most ``chars`` characters
    or one text: what a worker builds from them does not grow with the batch."""
    rows = texts.tolist()
    if not rows:
        yield rows
    sizes = np.cumsum(np.fromiter(map(len, rows), np.int64, len(rows)))
    begin = 0
    while begin < len(rows):
        before = int(sizes[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(sizes, before + chars, side="right")))
        yield rows[begin:end]
        begin = end


def give_back() -> None:
    """Return what a worker no longer uses to the system: Spark keeps idle
    workers beside the JVM for a while."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def partitions_for(df: DataFrame, bytes_each: int = 16 << 20) -> int:
    """Partitions for a shuffle of ``df``: one per ``bytes_each`` of its input
    and at least one per shuffle partition of the session."""
    return max(shuffle_partitions(df.sparkSession), -(-input_bytes(df) // bytes_each))


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file (installed on every machine)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def pretoken_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


def collect_garbage(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps: its cleaner acts
    when the driver collects the frames that used them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
