"""Structured Streaming twins: log tail, running means, the divergence guard, votes, stream telemetry."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.telemetry import votes_to_preferences
from ..schemas import VOTE
from ..sources.loaders import log_records


def tail_logs(spark: SparkSession, folder: str, **filters) -> DataFrame:
    return log_records(spark.readStream.text(folder), **filters)


def running_mean(stream: DataFrame, key: str, value: str) -> DataFrame:
    return stream.groupBy(key).agg(F.avg(value).alias("mean"), F.count(value).alias("n"))


def divergence_guard(stream: DataFrame, window: int = 20, limit: float = 15.0) -> DataFrame:
    """(run, stop_step) once for each run, when the mean of its last ``window`` values first passes the limit.

    State holds at most ``window`` values of a run; rows of a batch are taken in order of step.
    """

    def guard(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        values, stopped = state.get if state.exists else ([], False)
        values = [*values]
        rows = pd.concat([*batches]).sort_values("step")
        for step, kl in zip(rows["step"], rows["kl"]):
            values = [*values, float(kl)][-window:]
            if not stopped and len(values) == window and sum(values) / window > limit:
                stopped = True
                yield pd.DataFrame({"run": [key[0]], "stop_step": [step]})
        state.update((values, stopped))

    return stream.groupBy("run").applyInPandasWithState(guard, "run long, stop_step long", "recent array<double>, stopped boolean", "append", GroupStateTimeout.NoTimeout)


def read_votes(spark: SparkSession, folder: str) -> DataFrame:
    """Votes of a folder of JSON files, each id once within a day."""
    votes = spark.readStream.schema(VOTE).json(folder).withColumn("at", F.to_timestamp("created_at"))
    return votes.withWatermark("at", "1 day").dropDuplicatesWithinWatermark(["vote_id"])


def votes_sink(folder: str):
    """A foreachBatch function that turns votes into preference pairs; a batch that is run again overwrites its own folder."""

    def write(batch: DataFrame, epoch: int) -> None:
        votes_to_preferences(batch).write.mode("overwrite").parquet(f"{folder}/epoch={epoch}")

    return write


def stream_telemetry(chunks: DataFrame, gap: str = "5 minutes") -> DataFrame:
    """Per stream and session: first and last token times, tokens, tokens a second (null below 0.1 s)."""
    out = chunks.withWatermark("ts", gap).groupBy(F.session_window("ts", gap), "stream_id").agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.count(F.lit(1)).alias("n_tokens"))
    elapsed = F.col("last").cast("double") - F.col("first").cast("double")
    return out.select("stream_id", "first", "last", "n_tokens", F.when(elapsed >= 0.1, F.round(F.col("n_tokens") / elapsed, 1)).alias("tokens_per_s"))
