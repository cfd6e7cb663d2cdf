"""Judging once: a table of calls, and a judging run that is resumed from it.

A call is known by the hash of who is asked and the prompt.  Prompts whose call is in the table aren't asked again; the others are
asked once each, however often they occur, in waves whose answers are written before anything reads them.  So filters, further
actions and a run after a loss read answers; only the wave that was lost is asked again.
"""

from __future__ import annotations

import itertools
import json
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strict_verdict
from ..sources.files import Files
from ..streaming.keyed_sink import KeyedSink
from .evaluation import align, ask_each, debias, judge_prompt
from .records import unjudged

CALLS = "call string, who string, raw string, answered boolean"


def call_key(who: str, prompt: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{len(who)}:{who}:"), prompt), 256)


class Calls:
    """Answers in ``<folder>/answers``; ``wave`` prompts are asked in a job."""

    def __init__(self, spark: SparkSession, folder: str, wave: int = 100_000):
        self.spark, self.folder, self.wave = spark, folder.rstrip("/"), wave

    def table(self) -> DataFrame:
        """(call, who, raw, answered), one row a call: the answer if one was given, null where all tries failed."""
        waves = Files(self.spark, self.folder).names("answers")
        if not waves:
            return self.spark.createDataFrame([], CALLS)
        # Each wave is named: Spark takes two reads of one folder in a plan for the same, whatever was written between them.
        all_ = self.spark.read.schema(CALLS).parquet(*(f"{self.folder}/answers/{w}" for w in waves))
        best = all_.groupBy("call").agg(F.max(F.struct("answered", "who", "raw")).alias("a"))
        return best.select("call", "a.who", "a.raw", "a.answered")

    def ask(self, prompts: DataFrame, prompt: str, who: str, fn: Callable[[list[str]], list[str | None]], again: bool = False) -> None:
        """Asks the prompts that the table doesn't have; with ``again`` those whose call failed, too.  Null prompts aren't asked."""
        known = self.table()
        known = known.where("answered") if again else known
        wanted = prompts.select(F.col(prompt).alias("prompt")).where("prompt is not null").withColumn("call", call_key(who, F.col("prompt")))
        todo = wanted.dropDuplicates(["call"]).join(known.select("call"), "call", "left_anti")
        run = uuid.uuid4().hex
        todo.write.parquet(f"{self.folder}/todo/{run}")
        todo = self.spark.read.parquet(f"{self.folder}/todo/{run}")
        waves = -(-todo.count() // self.wave)

        def answer(iterator):
            for batch in iterator:
                raw = ask_each(fn, batch.column(1).to_pylist())
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([who] * n), pa.array(raw, pa.string()), pa.array([r is not None for r in raw])], names=["call", "who", "raw", "answered"])

        for k in range(waves):
            part = todo.where(F.pmod(F.xxhash64("call"), F.lit(waves)) == k).select("call", "prompt")
            part.repartition(self.spark.sparkContext.defaultParallelism, "call").mapInArrow(answer, CALLS).write.mode("overwrite").parquet(f"{self.folder}/answers/{run}-{k}")
        Files(self.spark, self.folder).drop(f"todo/{run}")

    def answers(self, df: DataFrame, prompt: str, who: str, raw: str) -> DataFrame:
        """df with the column ``raw``: its prompt's answer; null if there is none."""
        side = self.table().select(F.col("call").alias("_call"), F.col("raw").alias(raw))
        return df.withColumn("_call", call_key(who, F.col(prompt))).join(side, "_call", "left").drop("_call")


def judge_once(pairs: DataFrame, who: str, judge_fn: Callable[[list[str]], list[str]], calls: Calls) -> DataFrame:
    """``judge`` by the table of calls: raw_ab, raw_ba, verdict_ab, verdict_ba and the debiased verdict."""
    c = F.col
    asked = pairs.withColumns({"_ab": judge_prompt(c("prompt"), c("intent"), c("response_a"), c("response_b")), "_ba": judge_prompt(c("prompt"), c("intent"), c("response_b"), c("response_a"))})
    calls.ask(asked.select(F.explode(F.array("_ab", "_ba")).alias("p")), "p", who, judge_fn)
    read = calls.answers(calls.answers(asked, "_ab", who, "raw_ab"), "_ba", who, "raw_ba").drop("_ab", "_ba")
    return debias(read.withColumns({"verdict_ab": strict_verdict("raw_ab"), "verdict_ba": strict_verdict("raw_ba")}))


def ask_until_readable(df: DataFrame, prompt: str, who: str, fn: Callable[[list[str]], list[str | None]], calls: Calls, simpler: Callable[[str, int], str], retries: int = 2) -> DataFrame:
    """Adds raw, verdict and tries: answers without a readable verdict are asked again, each time by a simpler prompt.

    Retries are calls like others: asked once a prompt, and read from the table by a run after a loss.
    """
    import pandas as pd

    calls.ask(df, prompt, who, fn)
    read = calls.answers(df, prompt, who, "raw").withColumns({"verdict": strict_verdict("raw"), "tries": F.lit(1)})
    for k in range(1, retries + 1):
        made = F.pandas_udf(lambda ps, k=k: pd.Series([None if p is None else simpler(p, k) for p in ps], dtype="object"), "string")
        asked = read.withColumn("_again", F.when(F.col("verdict").isNull(), made(F.col(prompt))))
        calls.ask(asked, "_again", who, fn)
        new = calls.answers(asked, "_again", who, "_raw").withColumn("_verdict", strict_verdict("_raw"))
        tried = F.col("_again").isNotNull()
        read = new.withColumns({"raw": F.when(tried, F.col("_raw")).otherwise(F.col("raw")), "verdict": F.coalesce("verdict", "_verdict"), "tries": F.when(tried, F.lit(k + 1)).otherwise(F.col("tries"))}).drop("_again", "_raw", "_verdict")
    return read


def generate_once(cases: DataFrame, model_id: str, generate_fn: Callable[[str], tuple[str, int]], calls: Calls) -> DataFrame:
    """Responses (case_id, suite, model_id, prompt, response, n_tokens, error) by the table of calls; an exception is an error text."""

    def fn(prompts: list[str]) -> list[str]:
        out = []
        for p in prompts:
            try:
                response, n = generate_fn(p)
                out.append(json.dumps({"response": response, "n_tokens": n, "error": None}))
            except Exception as e:  # a failed case must not fail the job
                out.append(json.dumps({"response": "", "n_tokens": 0, "error": str(e)}))
        return out

    calls.ask(cases, "prompt", model_id, fn)
    read = calls.answers(cases.select("id", "suite", "prompt"), "prompt", model_id, "_raw")
    return read.withColumn("r", F.from_json("_raw", "response string, n_tokens int, error string")).select(F.col("id").alias("case_id"), "suite", F.lit(model_id).alias("model_id"), "prompt", "r.*")


#: What makes a judgement one of its own.
JUDGED = ["suite", "case_id", "model_a", "model_b"]
_RUN = "suite string, case_id string, model_a string, model_b string, verdict_ab string, verdict_ba string, final_verdict string, position_bias_observed boolean"


def run_judging(responses: DataFrame, cases: DataFrame, models: list[str], who: str, judge_fn: Callable, calls: Calls, folder: str, limit: int | None = None) -> DataFrame:
    """Judge every pair of models on the cases that both answered and that ``folder`` has no judgement of; written there.

    Returns (model_a, model_b, completed, failed) of what this run judged.  A run that stopped is resumed by running it again:
    judgements that are written stay, answers that were given are read.
    """
    spark = responses.sparkSession
    sink = KeyedSink(folder, JUDGED, buckets=16)
    done = sink.rows(spark, _RUN)
    todo = None
    for a, b in itertools.combinations(models, 2):
        pair = (F.col("model_a") == a) & (F.col("model_b") == b)
        left = unjudged(align(responses, cases, a, b), done.where(pair), limit).withColumns({"model_a": F.lit(a), "model_b": F.lit(b)})
        todo = left if todo is None else todo.unionByName(left)
    if todo is None:
        return spark.createDataFrame([], "model_a string, model_b string, completed long, failed long")
    judged = judge_once(todo, who, judge_fn, calls).select(*[f.split()[0] for f in _RUN.split(", ")])
    epoch = max(sink.commits(spark), default=-1) + 1
    sink.write(judged.select(*(F.col(n).cast(t).alias(n) for n, t in (f.split() for f in _RUN.split(", ")))), epoch)
    new = spark.read.schema(_RUN).parquet(f"{folder.rstrip('/')}/epoch={epoch}")
    bad = F.col("final_verdict") == "failed"
    return new.groupBy("model_a", "model_b").agg(F.count_if(~bad).alias("completed"), F.count_if(bad).alias("failed"))
