"""Run log, model versions and aliases as small tables.

Every change is a row; the state is the newest row per key. Versions and alias changes are numbered commits, so of
several writers each gets a number of its own (see ``sinks.commits``). Promotion is always an explicit call:
offline metrics alone do not decide what runs in production.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellops.operators.metrics import METRICS
from wellops.sinks import commits
from wellops.sinks.layout import Layout, exists

SCHEMAS = {
    "model_runs": "run_id string, run_name string, timestamp timestamp, params map<string,string>, "
                  "metrics map<string,double>, path string",
    "model_versions": "name string, version bigint, run_id string, timestamp timestamp",
    "model_aliases": "name string, alias string, version bigint, seq bigint, timestamp timestamp",
}
CHAMPION, CHALLENGER = "champion", "challenger"


@dataclass(frozen=True)
class Registry:
    spark: SparkSession
    layout: Layout

    def table(self, name: str) -> DataFrame:
        path = self.layout.registry(name)
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], SCHEMAS[name])
        reader = self.spark.read.schema(SCHEMAS[name])
        return reader.parquet(path) if name == "model_runs" else reader.json(f"{path}/*/*")

    def _commit(self, table: str, name: str, key: str, **values: object) -> int:
        """A row of a model under the next number, which it holds as ``key``. The model's folder is named by its
        letters and digits and a digest of its name."""
        safe = re.sub(r"[^A-Za-z0-9_-]", "_", name) + "-" + hashlib.sha256(name.encode()).hexdigest()[:12]
        now = dt.datetime.now(dt.timezone.utc).isoformat(timespec="milliseconds")
        return commits.commit_next(self.spark, f"{self.layout.registry(table)}/{safe}", {"name": name, **values, "timestamp": now}, key, first=1)

    def log_run(self, run_name: str, params: dict[str, object], metrics: dict[str, float],
                model: PipelineModel | None = None) -> str:
        """Record a run and save its model; the run name gets the time appended."""
        run_id, now = uuid.uuid4().hex, dt.datetime.now(dt.timezone.utc)
        path = None
        if model is not None:
            path = self.layout.model(run_id)
            model.save(path)
        row = (run_id, f"{run_name}_{now:%Y%m%d_%H%M%S}", now, {k: str(v) for k, v in params.items()}, metrics, path)
        (self.spark.createDataFrame([row], SCHEMAS["model_runs"]).coalesce(1)
         .write.mode("append").parquet(self.layout.registry("model_runs")))
        return run_id

    def register(self, name: str, run_id: str) -> int:
        """Next version of a model."""
        return self._commit("model_versions", name, "version", run_id=run_id)

    def set_alias(self, name: str, alias: str, version: int) -> None:
        known = self.table("model_versions").filter((F.col("name") == name) & (F.col("version") == version))
        if known.isEmpty():
            raise ValueError(f"model {name} has no version {version}")
        self._commit("model_aliases", name, "seq", alias=alias, version=version)

    def promote(self, name: str, version: int) -> None:
        """Make a version the champion."""
        self.set_alias(name, CHAMPION, version)

    def aliases(self) -> DataFrame:
        """Current version per model and alias."""
        return self.table("model_aliases").groupBy("name", "alias").agg(F.max_by("version", "seq").alias("version"))

    def resolved(self, name: str) -> DataFrame:
        """Per alias of a model: version, the metrics of its run, and where the model is saved."""
        return (self.aliases().filter(F.col("name") == name)
                .join(self.table("model_versions").select("name", "version", "run_id"), ["name", "version"])
                .join(self.table("model_runs").select("run_id", "metrics", "path"), "run_id")
                .select("alias", "version", *[F.col("metrics")[m].alias(m) for m in METRICS], "path"))

    def load(self, name: str, alias: str = CHAMPION) -> PipelineModel:
        row = self.resolved(name).filter(F.col("alias") == alias).first()
        if row is None or row["path"] is None:
            raise ValueError(f"no saved model behind {name}@{alias}")
        return PipelineModel.load(row["path"])
