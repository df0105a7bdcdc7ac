"""Delimited and Parquet sources and sinks, the artefact catalogue.

Paths are Hadoop paths (any scheme Spark can write).  Scratch output used by
round trips goes below the shared checkpoint directory of the session, never
a machine-local temp folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.functions.exprs import c
from tessera.session import cut_lineage, ensure_checkpoint_dir, released_at_exit

# Delimiters tried by the sniffer, most likely first.
SNIFF_DELIMITERS = [",", ";", "\t", "|"]


def scratch_path(spark: SparkSession, name: str) -> str:
    """The path of a fresh folder under the session's shared checkpoint directory;
    what is written there goes when the process ends."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return released_at_exit(spark, f"{base}/tessera-io/{name}-{uuid.uuid4().hex[:12]}")


def _fs_path(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def is_directory(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.getFileStatus(p).isDirectory())


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; none where it does not exist."""
    fs, p = _fs_path(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory()] if fs.exists(p) else []


#: column that holds the text of a row which does not fit the schema
REJECTED = "_rejected"


def _csv(spark: SparkSession, sep: str, header: bool):
    """Reader options: quotes inside quoted text are doubled."""
    return spark.read.option("header", header).option("sep", sep).option("quote", '"').option("escape", '"')


def _by_header(spark: SparkSession, path: str, schema: StructType, sep: str) -> StructType:
    """The declared types in the order of the file's header; columns that are
    not declared are read as text."""
    types = {f.name: f.dataType for f in schema.fields}
    found = _csv(spark, sep, True).csv(path).columns   # reads the first line
    return StructType([StructField(n, types.get(n, StringType())) for n in found])


def read_delimited(spark: SparkSession, path: str, schema: StructType | str | None = None,
                   sep: str = ",", header: bool = True, mode: str = "FAILFAST") -> DataFrame:
    """Delimited scan with a declared schema (no inference pass over the data).

    With a header, columns are found by name: their order in the file is free,
    further columns are left out, declared ones that are absent are null.  A row
    that does not fit the types fails the query; ``read_with_rejects`` splits
    such rows off instead."""
    if schema is None:
        return _csv(spark, sep, header).option("inferSchema", True).csv(path)
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not header:
        return _csv(spark, sep, False).option("mode", mode).schema(declared).csv(path)
    laid = _by_header(spark, path, declared, sep)
    # files of one folder whose headers differ are refused
    df = _csv(spark, sep, True).option("mode", mode).option("enforceSchema", False).schema(laid).csv(path)
    return df.select(*[c(f.name) if f.name in laid.names else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in declared.fields])


def read_with_rejects(spark: SparkSession, path: str, schema: StructType | str, sep: str = ","
                      ) -> tuple[DataFrame, DataFrame]:
    """(rows that fit the schema, text of the rows that do not)."""
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    laid = _by_header(spark, path, declared, sep).add(REJECTED, "string")
    # written once: the parser sees all columns of a row, and both results agree
    df = cut_lineage(_csv(spark, sep, True).option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", REJECTED).schema(laid).csv(path))
    good = df.where(F.col(REJECTED).isNull()).select(*[
        c(f.name) if f.name in laid.names else F.lit(None).cast(f.dataType).alias(f.name) for f in declared.fields])
    return good, df.where(F.col(REJECTED).isNotNull()).select(F.col(REJECTED).alias("line"))


def load_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             sep: str = ",") -> DataFrame | None:
    """The table, or ``None`` when there is no such path or it holds no columns;
    any other failure (rights, a broken store) is raised."""
    if not path_exists(spark, path):
        return None
    df = read_delimited(spark, path, schema, sep)
    return df if df.columns else None


def load_csv_or_empty(spark: SparkSession, path: str, schema: StructType | str, sep: str = ","
                      ) -> DataFrame:
    """Like :func:`load_csv` but an absent table is an empty one of the schema."""
    df = load_csv(spark, path, schema, sep)
    return df if df is not None else spark.createDataFrame([], schema)


def _count_outside_quotes(line: str, ch: str) -> int:
    n, quoted = 0, False
    for x in line:
        if x == '"':
            quoted = not quoted
        elif x == ch and not quoted:
            n += 1
    return n


def sniff_delimiter(spark: SparkSession, path: str) -> str:
    """Pick the delimiter from the header line: the candidate seen most often
    outside quotes (ties: list order).  Only the first line is read."""
    first = spark.read.text(path).limit(1).collect()
    if not first:
        return ","
    line = first[0][0]
    counts = [(_count_outside_quotes(line, d), -i, d) for i, d in enumerate(SNIFF_DELIMITERS)]
    best = max(counts)
    return best[2] if best[0] > 0 else ","


def read_sniffed(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    return read_delimited(spark, path, schema, sep=sniff_delimiter(spark, path))


def read_blank_header_report(spark: SparkSession, path: str, first: str = "feature") -> DataFrame:
    """A report whose first header cell is blank: Spark names it ``_c0``."""
    df = spark.read.option("header", True).option("inferSchema", True).csv(path)
    return df.withColumnRenamed("_c0", first) if "_c0" in df.columns else df


def write_delimited(df: DataFrame, path: str, sep: str = ",", single_file: bool = False,
                    blank_first_header: bool = False) -> str:
    """CSV with header.  ``single_file`` (``coalesce(1)``) is for small report
    tables only; scored rows are written in parallel part files."""
    out = df
    if blank_first_header:
        out = out.withColumnRenamed(out.columns[0], "")
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("header", True).option("sep", sep).option("quote", '"').option(
        "escape", '"').csv(path)
    return path


def write_split_table(df: DataFrame, path: str, split_col: str = "split") -> str:
    """Train/test bundle as one table partitioned by split."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)
    return path


def read_split(spark: SparkSession, path: str, split: str, split_col: str = "split") -> DataFrame:
    """One split of the bundle: the filter on the partition column prunes the
    other split's files."""
    return spark.read.parquet(path).where(F.col(split_col) == split)


def file_catalog(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """Artefacts matching a glob: path and size (file content is pruned)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(folder)
            .select("path", "length", "modificationTime"))
