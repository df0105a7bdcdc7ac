"""Spark session helpers.

The library never creates machine-local scratch space on a cluster: lineage is
cut by writing a Parquet table into the directory the cluster names in
``spark.checkpoint.dir`` (and ``DataFrame.checkpoint()`` uses the same folder).  Only when that setting is absent (local tests,
benches) do we fall back to a fresh directory under the system temp folder.
"""

from __future__ import annotations

import atexit
import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tessera") -> SparkSession:
    """Session with the settings every operator here assumes.

    * UTC session zone (event-time windows are daily, UTC),
    * AQE on, with partition coalescing and skew-join splitting,
    * Arrow for pandas hand-offs,
    * no UI server.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    shuffle_partitions = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Settings applied to any session handed to the library (also the
    driver's own session): UTC and a checkpoint directory."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint directory of the session.

    On a cluster the folder must be named in ``spark.checkpoint.dir`` (a
    machine-local folder would be invisible to the other machines); only a
    ``local[...]`` master, as in tests, gets a temp folder of its own."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return conf_dir


#: tables written by ``cut_lineage`` in this process and not yet released
_CUT_TABLES: list[str] = []


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder
    and read it back: one pass over the input (``Dataset.checkpoint`` on an
    unpersisted plan computes it twice), lineage cut, and the result survives
    executor loss.  Never ``localCheckpoint``.  The tables go when the process
    ends or with ``release_cut_tables``."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tessera-cut/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    released_at_exit(spark, path)
    # the written schema is known: no job to infer it
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def released_at_exit(spark: SparkSession, path: str) -> str:
    """Note ``path`` to be deleted when the process ends."""
    if not _CUT_TABLES:
        atexit.register(release_cut_tables, spark)
    _CUT_TABLES.append(path)
    return path


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder of any file system Spark knows."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True))


def release(*tables: DataFrame) -> None:
    """Delete the tables of frames that ``cut_lineage`` has returned, once every
    frame that reads them has been written itself, and let Spark's cleaner drop
    the shuffle files of finished steps."""
    for df in tables:
        path = df._cut_path
        if path in _CUT_TABLES:
            _CUT_TABLES.remove(path)
            remove(df.sparkSession, path)
    if tables:
        gc.collect()
        tables[0].sparkSession.sparkContext._jvm.System.gc()


def release_cut_tables(spark: SparkSession) -> int:
    """Delete the tables ``cut_lineage`` has written so far (call it when no
    frame built on them is needed any more); returns how many."""
    n = 0
    while _CUT_TABLES:
        path = _CUT_TABLES.pop()
        try:
            n += remove(spark, path)
        except Exception:  # noqa: BLE001  (the session has ended: nothing left to ask)
            break
    return n


def input_bytes(df: DataFrame) -> int:
    """Bytes of the tables below ``df`` (Catalyst's leaf sizes; no job).
    Leaves of unknown size count as nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(x for x in sizes if x < 1 << 60)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
