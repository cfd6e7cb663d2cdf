"""Record schemas, and validity as column expressions that give an error text or null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.text import strip

_s = lambda *names: [T.StructField(n, T.StringType()) for n in names]

SFT = T.StructType(_s("instruction", "input", "response", "source"))
PREFERENCE = T.StructType(_s("prompt", "chosen", "rejected", "source"))
QUARANTINE = T.StructType(_s("raw", "source", "error", "stage"))
MESSAGES = T.ArrayType(T.StructType(_s("role", "content")))
EVAL_CASE = T.StructType([*_s("id", "prompt", "intent"), T.StructField("difficulty", T.IntegerType()), T.StructField("verifiable", T.BooleanType()), *_s("expected_answer", "suite", "category")])
RESPONSE = T.StructType([*_s("case_id", "suite", "model_id", "prompt", "response"), T.StructField("n_tokens", T.IntegerType()), T.StructField("time_seconds", T.DoubleType()), T.StructField("decode_params", T.MapType(T.StringType(), T.StringType())), *_s("error")])
JUDGEMENT = T.StructType([*_s("case_id", "suite", "model_a", "model_b", "verdict_ab", "verdict_ba", "final_verdict"), T.StructField("position_bias_observed", T.BooleanType()), *_s("rationale_ab"), T.StructField("dimension_scores_ab", T.MapType(T.StringType(), T.IntegerType()))])
VOTE = T.StructType(_s("vote_id", "session_id", "prompt", "response_a", "response_b", "model_a", "model_b", "winner", "created_at"))
RUN = T.StructType(_s("run_id", "kind", "status", "config_hash", "started_at", "finished_at", "notes"))
ARTIFACT = T.StructType(_s("artifact_id", "run_id", "kind", "path", "created_at"))

LEAST = 5


def _short(name: str) -> Column:
    return F.when(F.col(name).isNull(), F.lit(f"{name}: null")).when(F.length(name) < LEAST, F.lit(f"{name}: too short")).when(strip(F.col(name)) == "", F.lit(f"{name}: blank"))


def sft_error() -> Column:
    return F.coalesce(_short("instruction"), _short("response"), F.when(F.col("input").isNull(), F.lit("input: null")))


def preference_error() -> Column:
    same = F.when(strip(F.col("chosen")) == strip(F.col("rejected")), F.lit("chosen and rejected are identical"))
    return F.coalesce(_short("prompt"), _short("chosen"), _short("rejected"), same)


def prompt_text() -> Column:
    return F.when(F.col("input") != "", F.concat_ws("\n\n", "instruction", "input")).otherwise(F.col("instruction"))


def sft_full_text() -> Column:
    return F.concat(prompt_text(), F.lit("\n\n"), F.col("response"))


def preference_full_text() -> Column:
    return F.concat_ws("\n", "prompt", "chosen", "rejected")
