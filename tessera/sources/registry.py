"""A registry of fitted pipelines: versions with a manifest, in a shared folder.

Layout: ``<folder>/<name>/v<number>/model`` (Spark ML persistence) and
``.../manifest`` (one Parquet row).  A version is written beside the registry and
appears by one rename, so a reader never meets half a model; two writers never get
one number, for the rename refuses a folder that exists.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.pipeline import features_of
from tessera.session import remove
from tessera.sources.files import list_folders, path_exists

MANIFEST = ("name string, version int, path string, type string, features array<string>, score double, "
            "rows long, classes map<string,long>, parameters map<string,string>")
#: versions whose manifests are looked through
MAX_VERSIONS = 100_000
TRIES = 100


class ModelRegistry:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def versions(self, name: str) -> list[int]:
        found = list_folders(self.spark, f"{self.folder}/{name}")
        return sorted(int(x[1:]) for x in found if x.startswith("v") and x[1:].isdigit())

    def publish(self, name: str, model: PipelineModel, score: float | None, training: DataFrame, label: str,
                parameters: Mapping[str, object] | None = None) -> int:
        """Save ``model`` as the next version of ``name`` with what its training
        rows were (row and class counts); the version's number."""
        if not name or "/" in name or name.startswith((".", "_")):
            raise ValueError(f"not a model name: {name!r}")
        hidden = f"{self.folder}/.{uuid.uuid4().hex}"
        model.write().overwrite().save(f"{hidden}/model")
        # a null label is counted under its own name; one entry per class
        counts = training.groupBy(F.coalesce(F.col(label).cast("string"), F.lit("null")).alias("k")).count()
        facts = counts.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("rows"),
                           F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "count")))).alias("classes"))
        kind = type(model.stages[-1]).__name__
        chosen = {k: str(v) for k, v in (parameters or {}).items()}
        for _ in range(TRIES):
            version = max(self.versions(name), default=0) + 1
            path = f"{self.folder}/{name}/v{version:06d}"
            row = facts.select(
                F.lit(name).alias("name"), F.lit(version).alias("version"), F.lit(f"{path}/model").alias("path"), F.lit(kind).alias("type"),
                F.array(*[F.lit(x) for x in features_of(model)]).cast("array<string>").alias("features"),
                F.lit(score).cast("double").alias("score"), "rows", "classes",
                F.create_map(*[F.lit(x) for kv in chosen.items() for x in kv]).cast("map<string,string>").alias("parameters"))
            row.coalesce(1).write.mode("overwrite").parquet(f"{hidden}/manifest")
            if self._appears(hidden, path):
                return version
        remove(self.spark, hidden)
        raise RuntimeError(f"no number for {name} after {TRIES} tries")

    def _appears(self, hidden: str, path: str) -> bool:
        """Rename, unless the version exists by now."""
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        source, target = jvm.org.apache.hadoop.fs.Path(hidden), jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(target.getParent())
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            files.rename(source, target, gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Exception:
            if path_exists(self.spark, path):
                return False
            raise
        return True

    def manifests(self) -> DataFrame:
        """One row per version whose model files are there."""
        found = [f"{self.folder}/{name}/v{v:06d}" for name in list_folders(self.spark, self.folder) if not name.startswith(".")
                 for v in self.versions(name)]
        if len(found) > MAX_VERSIONS:
            raise ValueError(f"more than {MAX_VERSIONS} versions")
        whole = [f"{x}/manifest" for x in found if self._is_whole(f"{x}/model")]
        return self.spark.read.schema(MANIFEST).parquet(*whole) if whole else self.spark.createDataFrame([], MANIFEST)

    def _is_whole(self, path: str) -> bool:
        return path_exists(self.spark, f"{path}/metadata/_SUCCESS") and path_exists(self.spark, f"{path}/stages")

    def load(self, name: str, version: int | None = None) -> PipelineModel:
        """A version of a model, the last one by default; missing files are refused."""
        known = self.versions(name)
        version = max(known, default=0) if version is None else version
        path = f"{self.folder}/{name}/v{version:06d}/model"
        if version not in known or not self._is_whole(path):
            raise FileNotFoundError(f"no model {name} {version} in {self.folder}")
        return PipelineModel.load(path)

    def best(self, names: Sequence[str] | None = None) -> tuple[str, int]:
        """Name and version of the best score (ties: by name, the newest version)."""
        rows = self.manifests().where(F.col("score").isNotNull())
        rows = rows.where(F.col("name").isin(list(names))) if names is not None else rows
        found = rows.orderBy(F.desc("score"), "name", F.desc("version")).select("name", "version").head(1)
        if not found:
            raise FileNotFoundError(f"no scored model in {self.folder}")
        return found[0]["name"], found[0]["version"]
