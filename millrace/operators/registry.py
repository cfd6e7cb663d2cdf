"""The registry as append-only tables: rows of changes, many in a write; a column's latest change is its state.

A change says something of some columns only, so two writers that change different columns of one row lose nothing.  Rows come
and go as DataFrames, their keys given by the caller.  A table lies in one folder of Parquet files: writers never overwrite one
another, and a lost write leaves the rest whole.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .telemetry import fail_runs

#: Each table's key and columns (all text but for the sizes).
TABLES = {
    "runs": ("run_id", "run_id string, kind string, status string, config_hash string, dataset_hash string, git_sha string, hardware_json string, started_at string, finished_at string, metrics_json string, notes string"),
    "artifacts": ("artifact_id", "artifact_id string, run_id string, kind string, path string, sha256 string, size_bytes long, created_at string, meta_json string"),
    "datasets": ("dataset_id", "dataset_id string, name string, kind string, split string, path string, sha256 string, n_rows long, source_json string, filter_stats_json string, created_at string"),
    "served_models": ("model_id", "model_id string, display_name string, backend string, weights_ref string, run_id string, enabled int, sort_order int"),
    "human_votes": ("vote_id", "vote_id string, session_id string, prompt string, response_a string, response_b string, model_a string, model_b string, winner string, created_at string"),
}
#: What every change has besides: the columns it is of, when it was written, and its number among those of one write.
_CHANGE = "said array<string>, version long, writer string, number long"


def changed(log: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """A row a key: of each column the latest change that is of it, null if none is."""
    at = F.struct("version", "writer", "number")
    return log.groupBy(key).agg(*(F.max_by(c, F.when(F.array_contains("said", c), at)).alias(c) for c in columns if c != key))


class Registry:
    """Rows without a key raise ValueError; so do keys that are there already where rows begin, and KeyError those that aren't where they are changed."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def log(self, name: str) -> DataFrame:
        """All changes ever written."""
        schema = f"{TABLES[name][1]}, {_CHANGE}"
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    def table(self, name: str) -> DataFrame:
        key, schema = TABLES[name]
        return changed(self.log(name), key, [c.split()[0] for c in schema.split(", ")])

    def put(self, name: str, rows: DataFrame) -> None:
        """Writes rows, whose columns are the key and some of the table's, in one job; of a write's rows with one key the last counts."""
        key, schema = TABLES[name]
        kinds = dict(c.split() for c in schema.split(", "))
        if unknown := {*rows.columns} - {*kinds}:
            raise ValueError(f"{name} has no {sorted(unknown)}")
        if key not in rows.columns or not rows.where(F.col(key).isNull()).isEmpty():
            raise ValueError(f"rows of {name} need a {key}")
        said = F.array(*map(F.lit, rows.columns))
        values = [(F.col(c) if c in rows.columns else F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()]
        change = [said.alias("said"), F.lit(time.time_ns()).alias("version"), F.lit(uuid.uuid4().hex).alias("writer"), F.monotonically_increasing_id().alias("number")]
        rows.select(*values, *change).write.mode("append").parquet(f"{self.folder}/{name}")

    def begin(self, name: str, rows: DataFrame) -> None:
        """Puts rows whose keys are new."""
        key = TABLES[name][0]
        there = rows.join(self.log(name).select(key), key, "left_semi").select(key).limit(3).collect()
        if there:
            raise ValueError(f"{name} has {[r[0] for r in there]} already")
        self.put(name, rows)

    def change(self, name: str, rows: DataFrame) -> None:
        """Puts rows whose keys are there."""
        key = TABLES[name][0]
        lost = rows.join(self.log(name).select(key), key, "left_anti").select(key).limit(3).collect()
        if lost:
            raise KeyError(f"{name} has no {[r[0] for r in lost]}")
        self.put(name, rows)

    def start_runs(self, rows: DataFrame) -> None:
        self.begin("runs", rows.withColumn("status", F.lit("running")))

    def complete_runs(self, rows: DataFrame) -> None:
        """Rows of run_id, finished_at and perhaps metrics_json."""
        self.change("runs", rows.withColumn("status", F.lit("completed")))

    def fail(self, errors: DataFrame) -> None:
        """Rows of run_id, finished_at and error; the error goes behind earlier notes."""
        named = errors.select("run_id", F.coalesce("error", F.lit("unknown error")).alias("error"))
        self.change("runs", errors.select("run_id", "finished_at").withColumn("status", F.lit("failed")))
        before = self.table("runs").join(named, "run_id", "left_semi").select("run_id", "status", "notes")
        self.put("runs", fail_runs(before, named).select("run_id", "notes"))

    def publish(self, models: DataFrame) -> None:
        self.put("served_models", models.withColumn("enabled", F.lit(1)))

    def unpublish(self, models: DataFrame) -> None:
        """Rows of model_id; models that aren't served any more stay as rows."""
        self.change("served_models", models.select("model_id").withColumn("enabled", F.lit(0)))

    def served(self, enabled_only: bool = True) -> DataFrame:
        models = self.table("served_models")
        return (models.where("enabled = 1") if enabled_only else models).orderBy("sort_order", "model_id")


def run_folders(files: DataFrame, kind: str) -> DataFrame:
    """Runs of a kind from a listing (path below the runs' folder, modified): whether the adapter was written, the newest whole checkpoint.

    A checkpoint is whole once its trainer state is there, which is written last.  Newest first, by any file's time.
    """
    part = lambda i: F.element_at(F.split("path", "/"), i)
    rows = files.withColumns({"run_id": part(1), "rest": F.expr("substring(path, instr(path, '/') + 1)")}).where(F.col("run_id").startswith(f"{kind}-") & F.contains("path", F.lit("/")))
    step = F.regexp_extract("rest", r"^checkpoints/checkpoint-(\d+)/trainer_state\.json$", 1).try_cast("long")
    return rows.groupBy("run_id").agg(
        F.bool_or(F.col("rest") == "adapter/adapter_config.json").alias("complete"), F.max(step).alias("latest_step"), F.max("modified").alias("modified"),
    ).orderBy(F.desc("modified"), "run_id")


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """path below the folder, and modified, of its files; contents aren't read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", F.col("modificationTime").alias("modified"))
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    root = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toString().rstrip("/")
    return found.select(F.substring("path", F.lit(len(root) + 2), F.length("path")).alias("path"), "modified")
