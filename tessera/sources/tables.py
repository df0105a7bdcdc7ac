"""Fixture table access.

Every table is one parquet file per name inside an ``sf_dir``; reads go through
``spark.read.parquet`` so that column pruning and filter pushdown reach the
scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

DEFAULT_SF_DIR = "/root/testdata/sf0.01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose the fixture tables as temp views (for ``spark.sql``)."""
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)
