"""Scans of responses, judgements and prompts with their error rules; summaries; suites; the registry's tables and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.lexicon import is_technical
from .curation import hash_order


def eval_prompts(lines: DataFrame) -> DataFrame:
    """The prompt of each JSON line (value), else its instruction, else an empty text; unreadable lines fail the job."""
    read = F.from_json("value", "map<string,string>", {"mode": "FAILFAST"})
    return lines.select(read.alias("r")).select(F.coalesce(F.col("r")["prompt"], F.col("r")["instruction"], F.lit("")).alias("prompt"))


def responses(df: DataFrame, keys: list[str], order: str, failed: str = "error is not null") -> DataFrame:
    """The last response of each key of those that didn't fail; a report counts an empty error as none (``coalesce(error, '') <> ''``)."""
    rest = [c for c in df.columns if c not in keys]
    return df.where(f"not ({failed})").groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("r")).select(*keys, "r.*")


def judgements(lines: DataFrame, schema: str) -> DataFrame:
    """Judgements of JSON lines (value); blank and unreadable lines are left out."""
    read = F.from_json("value", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return lines.where("trim(value) <> ''").select(read.alias("j")).select("j.*").where("_bad is null").drop("_bad")


#: The keys of a written judgement, in order.
JUDGEMENT_KEYS = ("case_id", "suite", "model_a", "model_b", "verdict_ab", "verdict_ba", "final_verdict", "position_bias_observed", "rationale_ab", "dimension_scores_ab", "confidence_ab")


def judgement_json(df: DataFrame) -> DataFrame:
    """Judgements as JSON lines, nulls written out."""
    fields = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in JUDGEMENT_KEYS]
    return df.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"))


def unjudged(aligned: DataFrame, done: DataFrame, limit: int | None = None) -> DataFrame:
    """Cases to judge, the first ``limit`` of each suite by id, without those judged (or failed) before."""
    if limit is not None:
        aligned = aligned.withColumn("_n", F.row_number().over(Window.partitionBy("suite").orderBy("case_id"))).where(F.col("_n") <= limit).drop("_n")
    return aligned.join(done.select("suite", "case_id").distinct(), ["suite", "case_id"], "left_anti")


def summary(df: DataFrame, *keys: str) -> DataFrame:
    """How many were done and how many failed, by model or pair."""
    return df.groupBy(*keys).agg(F.count_if(F.col("error").isNull()).alias("completed"), F.count_if(F.col("error").isNotNull()).alias("failed"))


def suite_stats(cases: DataFrame) -> DataFrame:
    return cases.groupBy("suite").agg(F.count(F.lit(1)).alias("n_cases"), F.count_if("verifiable").alias("n_verifiable"), F.count_if(F.col("error").isNotNull()).alias("n_errors"))


def label_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.agg(F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) == 0).alias("negatives"))


def label_sample(df: DataFrame, key: str, text: str, n: int, seed: int = 42, technical_only: bool = False) -> DataFrame:
    """A seeded sample to be labelled by hand, texts cut to 500 characters; of rows that pass the keyword filter only, if so wished."""
    rows = df.where(is_technical(F.col(text))) if technical_only else df
    return rows.orderBy(hash_order(F.col(key), seed), key).limit(n).select(key, F.substring(text, 1, 500).alias("text"))


def hand_labels(spark: SparkSession, path: str) -> DataFrame:
    """(text, label) of a JSON array of objects with text and in_domain; objects without one of them are left out."""
    rows = spark.read.schema("text string, in_domain boolean").json(path, multiLine=True)
    return rows.where("text is not null and in_domain is not null").select("text", F.col("in_domain").cast("int").alias("label"))


#: Categories of the multi-turn suite that are kept, and what its cases have in common.
TURN_CATEGORIES, TURN_SUITE = ("coding", "reasoning", "extraction"), {"difficulty": 2, "verifiable": False, "suite": "mtbench_sub"}


def turn_subset(df: DataFrame, n: int = 30, categories: tuple[str, ...] = TURN_CATEGORIES, least: int = 20, seed: int = 42) -> DataFrame:
    """Cases from (question_id, category, turns): the first turn of questions of the kept categories if it is long enough; a seeded sample of n, all if they are fewer."""
    first = df.where(F.col("category").isin(*categories) & (F.size("turns") > 0)).withColumn("prompt", F.get("turns", F.lit(0)))
    picked = first.where(F.length("prompt") >= least).orderBy(hash_order(F.col("question_id"), seed), "question_id").limit(n)
    number = F.col("question_id").cast("string")
    intent = F.concat(F.lit("Category "), F.col("category"), F.lit(", question "), number, F.lit("."))
    return picked.select(F.concat(F.lit("mt_"), number).alias("id"), "prompt", intent.alias("intent"), *(F.lit(v).alias(k) for k, v in TURN_SUITE.items()), "category")


def probe_prompts(cases: DataFrame, order: str, n: int = 5, default: str = "What does a Python decorator do?") -> DataFrame:
    """The first n prompts, missing ones empty; without a case one default prompt."""
    first = cases.orderBy(order).limit(n).select(F.coalesce("prompt", F.lit("")).alias("prompt"))
    spare = cases.sparkSession.createDataFrame([(default,)], "prompt string")
    none = first.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(F.lit(True).alias("none"))
    return first.unionByName(spare.join(F.broadcast(none)).select("prompt"))  # one row, or none


#: The logged fields that a run's frame shows.
LOGGED = ("step", "rewards_margin", "rewards_accuracy", "implicit_kl")


def log_frame(records: DataFrame, n: int = 20) -> DataFrame:
    """The last n rows of a log (maps r) in order of step, with the logged fields as numbers and the mean divergence of the whole log."""
    rows = records.select(*(F.try_element_at("r", F.lit(c)).try_cast("double").alias(c) for c in LOGGED)).where("step is not null")
    mean = rows.agg(F.avg("implicit_kl").alias("mean_kl"))
    return rows.orderBy(F.desc("step")).limit(n).join(F.broadcast(mean)).orderBy("step")  # one row on the right


def suite_subset(df: DataFrame, key: str, prompt: str, n: int, least: int, form: str, seed: int = 42) -> DataFrame:
    """A seeded sample of n numbered as sampled, of which prompts shorter than ``least`` are then left out: id, prompt."""
    picked = df.orderBy(hash_order(F.col(key), seed), key).limit(n)
    numbered = picked.withColumn("_n", F.row_number().over(Window.orderBy(hash_order(F.col(key), seed), key)) - 1)  # n rows
    return numbered.where(F.length(prompt) >= least).select(F.format_string(form, "_n").alias("id"), F.col(prompt).alias("prompt"))


def latest_checkpoint(files: DataFrame) -> DataFrame:
    """By run, the checkpoint folder with the largest step that is whole: run, path, step."""
    step = files.withColumn("step", F.regexp_extract("path", r"checkpoint-(\d+)/?$", 1).try_cast("long")).where("step is not null and whole")
    return step.groupBy("run").agg(F.max(F.struct("step", "path")).alias("b")).select("run", "b.path", "b.step")


def eval_listing(reports: DataFrame, metrics: DataFrame, n: int = 20) -> DataFrame:
    """The newest reports by name with their metrics, if they have some."""
    newest = reports.orderBy(F.desc("eval_id")).limit(n)
    return newest.join(metrics, "eval_id", "left").orderBy(F.desc("eval_id"))


def run_table(runs: DataFrame) -> DataFrame:
    """Runs cut for display: ids to 12 characters, times to seconds."""
    return runs.withColumns({"run_id": F.substring("run_id", 1, 12), "started_at": F.substring(F.col("started_at").cast("string"), 1, 19)})


def plot_series(rates: DataFrame) -> DataFrame:
    """Rate, lengths of the interval's arms, and whether the first model is ahead."""
    return rates.select("*", (F.col("win_rate") - F.col("ci_low")).alias("below"), (F.col("ci_high") - F.col("win_rate")).alias("above"), (F.col("win_rate") > 0.5).alias("ahead"))


def artifacts_of(artifacts: DataFrame, runs: DataFrame) -> DataFrame:
    """Artifacts with their run's kind and status, in order of time."""
    return artifacts.join(runs.select("run_id", F.col("kind").alias("run_kind"), "status"), "run_id").orderBy("created_at", "artifact_id")


def publish_refs(models: DataFrame, artifacts: DataFrame, kinds: DataFrame) -> DataFrame:
    """For each model to publish (model_id, run_id, backend), the first artifact of the kind that fits its backend; null if none does.

    Artifacts without a time come last; ``artifact_id`` decides between those of one time and must tell them apart.
    """
    order = F.struct(F.col("created_at").isNull().alias("lost"), "created_at", "artifact_id")
    fit = models.join(kinds, "backend").join(artifacts, ["run_id", "kind"]).groupBy("model_id").agg(F.min_by("path", order).alias("ref"))
    return models.join(fit, "model_id", "left").select("model_id", "backend", "ref")


def served(log: DataFrame) -> DataFrame:
    """Enabled models of an append-only log (model_id, version, enabled, sort_order), the latest version of each, in their order."""
    rest = [c for c in log.columns if c != "model_id"]
    now = log.groupBy("model_id").agg(F.max_by(F.struct(*rest), "version").alias("m")).select("model_id", "m.*")
    return now.where("enabled = 1").orderBy("sort_order", "model_id")


def route(requests: DataFrame, models: DataFrame, fallback: str = "echo") -> DataFrame:
    """Requests with their model's engine, the fallback for a model without one; ``known`` is false for models that aren't served."""
    side = models.select("model_id", F.coalesce("backend", F.lit(fallback)).alias("engine"))
    return requests.join(side, "model_id", "left").withColumn("known", F.col("engine").isNotNull())


def blind_order(sessions: DataFrame, columns: list[str], seed: int = 42) -> DataFrame:
    """A session's columns in an order that its id and the seed decide."""
    each = F.array(*(F.struct(F.sha2(F.concat(F.lit(f"{seed}:{c}:"), F.col("session_id").cast("string")), 256).alias("h"), F.lit(c).alias("c")) for c in columns))
    return sessions.withColumn("columns", F.transform(F.array_sort(each), lambda s: s["c"]))
