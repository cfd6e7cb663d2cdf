"""Training telemetry, votes and the registry, as DataFrame functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def implicit_kl(df: DataFrame, beta: float = 0.1) -> DataFrame:
    """kl = (|r_chosen| + |r_rejected|) / (2 beta), margin by default their difference, warn above 8; rows without both go."""
    rows = df.where("r_chosen is not null and r_rejected is not null")
    margin = F.coalesce("margin", F.col("r_chosen") - F.col("r_rejected")) if "margin" in df.columns else F.col("r_chosen") - F.col("r_rejected")
    return rows.withColumns({"kl": (F.abs("r_chosen") + F.abs("r_rejected")) / (2 * beta), "margin": margin}).withColumn("warn", F.col("kl") > 8.0)


def divergence(df: DataFrame, window: int = 20, limit: float = 15.0) -> DataFrame:
    """By run: the first step at which the mean of the last ``window`` logged values is above the limit."""
    over = Window.partitionBy("run").orderBy("step").rowsBetween(1 - window, 0)
    seen = df.withColumns({"m": F.avg("kl").over(over), "k": F.count("kl").over(over)})
    return seen.where((F.col("k") == window) & (F.col("m") > limit)).groupBy("run").agg(F.min("step").alias("stop_step"))


def mean_kl(df: DataFrame) -> DataFrame:
    return df.groupBy("run").agg(F.avg("kl").alias("mean_kl"))


def subsample(df: DataFrame, parts: int = 8) -> DataFrame:
    """Every max(1, n div parts)-th row of a run, and its last."""
    over = Window.partitionBy("run")
    ranked = df.withColumns({"rn": F.row_number().over(over.orderBy("step")), "n": F.count(F.lit(1)).over(over)})
    return ranked.where(f"(rn - 1) % greatest(1, n div {parts}) = 0 or rn = n").drop("rn", "n")


def every_nth(df: DataFrame, n: int) -> DataFrame:
    return df.withColumn("rn", F.row_number().over(Window.partitionBy("run").orderBy("step"))).where(f"rn % {n} = 0").drop("rn")


def peak(df: DataFrame, key: str, value: str, *tie: str) -> DataFrame:
    """The row with the largest value by key, the first by ``tie`` on ties, without sorting a key's rows."""
    best = df.groupBy(key).agg(F.max(F.struct(F.col(value), *[(-F.col(t)).alias(t) for t in tie])).alias("b"))
    return best.select(key, f"b.{value}", *[(-F.col(f"b.{t}")).alias(t) for t in tie])


def last_by(df: DataFrame, key: str, value: str, *order: str) -> DataFrame:
    return df.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(value))


def votes_to_preferences(votes: DataFrame) -> DataFrame:
    """Winner's response as chosen; ties, self-pairs and invalid triplets go."""
    from ..schemas import preference_error

    a = F.col("winner") == "a"
    rows = votes.where("winner in ('a', 'b') and model_a <> model_b").select(
        "vote_id", "prompt", F.when(a, F.col("response_a")).otherwise(F.col("response_b")).alias("chosen"), F.when(a, F.col("response_b")).otherwise(F.col("response_a")).alias("rejected"), F.lit("votes").alias("source")
    )
    return rows.where(preference_error().isNull())


def best_of_to_pairs(clicks: DataFrame) -> DataFrame:
    """A best-of-n click as rows (winner, other): one for each column but the winner's; ties give none."""
    others = F.filter("columns", lambda c: c != F.col("winner"))
    return clicks.where("winner is not null").select("vote_id", "winner", F.explode(others).alias("other"))


def newest(df: DataFrame, n: int, *order, where: str | None = None) -> DataFrame:
    return (df.where(where) if where else df).orderBy(*order).limit(n)


def upsert_view(log: DataFrame, key: str, version: str) -> DataFrame:
    """The latest version of each key of an append-only log."""
    return log.groupBy(key).agg(F.max_by(F.struct(*[c for c in log.columns if c != key]), version).alias("r")).select(key, "r.*")


def fail_runs(runs: DataFrame, errors: DataFrame) -> DataFrame:
    """Runs with an error get status failed and the error behind earlier notes."""
    joined = runs.join(errors, "run_id", "left")
    note = F.concat(F.coalesce(F.concat("notes", F.lit(" | ")), F.lit("")), F.col("error"))
    return joined.withColumns({"notes": F.when(F.col("error").isNotNull(), note).otherwise(F.col("notes")), "status": F.when(F.col("error").isNotNull(), "failed").otherwise(F.col("status"))}).drop("error")


def readiness(checks: DataFrame) -> DataFrame:
    return checks.agg(F.when(F.coalesce(F.bool_and(F.col("status") == "ok"), F.lit(True)), 200).otherwise(207).alias("code"))


def label_tally(df: DataFrame, labels: str = "labels") -> DataFrame:
    """total, real and masked (-100) labels; a row without a real one can't be trained on."""
    real = F.size(F.filter(labels, lambda x: x != -100))
    return df.select("*", F.size(labels).alias("total"), real.alias("real"), (F.size(labels) - real).alias("masked"), F.exists(labels, lambda x: x != -100).alias("trainable"))


def batch_plan(free_gb, per_sample_gb):
    """(batch size, accumulation steps) columns."""
    size = F.least(F.lit(4), F.greatest(F.lit(1), F.floor(0.7 * free_gb / per_sample_gb)))
    return size, F.greatest(F.lit(1), F.floor(F.lit(16) / size))
