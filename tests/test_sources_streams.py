import os

import pytest
from pyspark.sql import functions as F

from tessera.sources import files as FS
from tessera.streaming import monitor as ST

SF = "/root/testdata/sf0.001"


def _write_text(spark, lines):
    path = FS.scratch_path(spark, "csv-test")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_sniffer_ignores_quoted_delimiters(spark):
    path = _write_text(spark, ['a;"b,c,d";e', '1;"x,y,z";2'])
    assert FS.sniff_delimiter(spark, path) == ";"
    df = FS.read_sniffed(spark, path)
    assert df.columns == ["a", "b,c,d", "e"] and df.count() == 1


def test_absent_csv_is_none_or_empty(spark):
    missing = FS.scratch_path(spark, "nothing-here")
    assert FS.load_csv(spark, missing, "a int") is None
    empty = FS.load_csv_or_empty(spark, missing, "a int, b string")
    assert empty.count() == 0 and empty.columns == ["a", "b"]


def test_blank_first_header_round_trip(spark):
    df = spark.createDataFrame([("x", 1.5), ("y", 2.5)], "feature string, mean double")
    path = FS.scratch_path(spark, "blank")
    FS.write_delimited(df, path, single_file=True, blank_first_header=True)
    back = FS.read_blank_header_report(spark, path, "feature")
    assert back.columns == ["feature", "mean"]
    assert sorted(tuple(r) for r in back.collect()) == [("x", 1.5), ("y", 2.5)]


def test_split_bundle_prunes_partitions(spark):
    df = spark.range(100).select(F.col("id").alias("key"),
                                 F.when(F.col("id") % 5 == 0, "test").otherwise("train").alias("split"))
    path = FS.scratch_path(spark, "bundle")
    FS.write_split_table(df, path)
    t = FS.read_split(spark, path, "test")
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan and t.count() == 20


def test_checkpoint_dir_comes_from_session(spark):
    from tessera.session import ensure_checkpoint_dir

    d = ensure_checkpoint_dir(spark)
    assert d and spark.sparkContext.getCheckpointDir()
    assert FS.scratch_path(spark, "x").startswith(d.rstrip("/"))


def test_append_holds_back_the_open_window_and_update_does_not(spark):
    pred = (F.col("value") / 500 >= 0.5).cast("int")
    counts = lambda: ST.daily_prediction_counts(ST.file_stream(spark, SF, "events"), pred)
    update = ST.run_windowed(counts(), spark, "t-update", ["day", "prediction"]).table()
    append = ST.run_to_parquet(counts(), spark, "t-append")
    batch = spark.read.parquet(os.path.join(SF, "events.parquet")).groupBy(
        F.to_date("ts").alias("day"), pred.alias("prediction")).agg(F.count("*").alias("n"))
    assert update.count() == batch.count() and update.exceptAll(batch.select(*update.columns)).count() == 0
    assert 0 < append.count() < update.count()
    assert append.agg(F.max("day")).first()[0] < update.agg(F.max("day")).first()[0]


def day_counts(spark, folder):
    """Counts per day of a folder of files, one file a batch."""
    events = ST.file_stream(spark, os.path.dirname(folder), os.path.basename(folder).removesuffix(".parquet"), files_per_batch=1)
    return ST.daily_prediction_counts(events, F.lit(1))


def write_days(spark, folder, name, days):
    import time

    rows = [(f"2024-01-{d:02d} 10:00:00",) for d in days]
    part = f"{folder}-{name}"
    spark.createDataFrame(rows, "ts string").select(F.col("ts").cast("timestamp_ntz").alias("ts")).coalesce(1).write.parquet(part)
    os.makedirs(folder, exist_ok=True)
    (file,) = [f for f in os.listdir(part) if f.endswith(".parquet")]
    os.rename(os.path.join(part, file), os.path.join(folder, f"{name}.parquet"))
    time.sleep(0.02)     # files are read in the order of their times


def test_state_is_evicted_and_late_rows_are_dropped(spark, tmp_path):
    folder = str(tmp_path / "days.parquet")
    write_days(spark, folder, "a", [1, 2, 2, 10])
    write_days(spark, folder, "b", [9, 10, 11])
    write_days(spark, folder, "c", [2, 20])      # the watermark stood at the 9th: the 2nd is late
    run = ST.run_windowed(day_counts(spark, folder), spark, "t-evict", ["day", "prediction"])
    got = {r["day"].day: r["n"] for r in run.table().collect()}
    assert got == {1: 1, 2: 2, 9: 1, 10: 2, 11: 1, 20: 1}
    state = [p["stateOperators"][0] for p in run.progress if p["stateOperators"]]
    assert sum(s["numRowsDroppedByWatermark"] for s in state) == 1
    assert state[-1]["numRowsTotal"] == 1 and max(s["numRowsTotal"] for s in state) > 2
    # every batch wrote what it changed only
    assert len(run.batches()) >= 3
    first = spark.read.parquet(f"{run.path}/batch={run.batches()[0]}")
    assert sorted(r["day"].day for r in first.collect()) == [1, 2, 10]


def test_failed_write_keeps_the_last_result(spark, tmp_path):
    folder = str(tmp_path / "days.parquet")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    write_days(spark, folder, "a", [1, 1, 2])
    whole = ST.run_windowed(day_counts(spark, folder), spark, "t", ["day", "prediction"], out, checkpoint)
    before = {tuple(r) for r in whole.table().collect()}
    write_days(spark, folder, "b", [2, 3])

    def fails(batch, path):
        batch.write.mode("overwrite").parquet(path + "/part-of-it")
        raise OSError("the disk is gone")

    with pytest.raises(Exception, match="disk is gone"):
        ST.run_windowed(day_counts(spark, folder), spark, "t", ["day", "prediction"], out, checkpoint, write=fails)
    assert {tuple(r) for r in whole.table().collect()} == before
    # the next run begins with the batch that failed
    again = ST.run_windowed(day_counts(spark, folder), spark, "t", ["day", "prediction"], out, checkpoint)
    assert {r["day"].day: r["n"] for r in again.table().collect()} == {1: 2, 2: 2, 3: 1}


def test_path_helpers_and_weight_sharing(spark):
    from tessera.operators.images import _Local, _share

    folder = FS.scratch_path(spark, "helpers")
    spark.range(3).write.parquet(folder)
    assert FS.path_exists(spark, folder) and FS.is_directory(spark, folder)
    assert not FS.path_exists(spark, folder + "-missing")
    shared = _share(spark, [1, 2, 3])
    assert shared.value == [1, 2, 3]

    class NoContext:  # a session without a SparkContext (e.g. Spark Connect)
        @property
        def sparkContext(self):
            raise RuntimeError("no context")

    local = _share(NoContext(), {"w": 1})
    assert isinstance(local, _Local) and local.value == {"w": 1}
