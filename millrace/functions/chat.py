"""Chat renderings of preference rows, and what training needs to know of a template."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import chatml


def generic(user: Column, assistant: Column) -> Column:
    """Plain markers, for models without a template of their own."""
    return F.concat(F.lit("### User:\n"), user, F.lit("\n\n### Assistant:\n"), assistant)


def sft_render(df: DataFrame, template=chatml) -> DataFrame:
    """(text, source) of instruction rows: the instruction with its input as the user's turn, the response as the answer; a missing input or source is empty."""
    one = lambda c: F.coalesce(F.col(c), F.lit("")) if c in df.columns else F.lit("")
    user = F.when(one("input") != "", F.concat_ws("\n\n", one("instruction"), one("input"))).otherwise(one("instruction"))
    return df.select(template(user, one("response")).alias("text"), one("source").alias("source"))


def preference_render(df: DataFrame, template=chatml) -> DataFrame:
    """prompt up to where the model goes on, and chosen and rejected as whole conversations; source is kept."""
    p = F.col("prompt")
    return df.select(
        template(p).alias("prompt"), template(p, F.col("chosen")).alias("chosen"), template(p, F.col("rejected")).alias("rejected"), "source",
        *[c for c in df.columns if c not in ("prompt", "chosen", "rejected", "source")],
    )


def response_template(render, user: str = "USER", assistant: str = "ASSISTANT") -> str:
    """What a template (texts to text) puts between a user's text and the answer."""
    text = render(user, assistant)
    at = text.index(user) + len(user)
    return text[at : text.index(assistant, at)]


#: Tokens that end an answer, in order of preference.
STOPS = ("<|im_end|>", "<|eot_id|>", "</s>", "<|endoftext|>")


def stop_tokens(special: list[str], eos: str) -> list[str]:
    return [t for t in STOPS if t in special] or [eos]


def default_system(rendered: Column) -> Column:
    """The system text that a ChatML template puts in by itself, or an empty one."""
    return F.regexp_extract(rendered, r"(?s)<\|im_start\|>system\n(.*?)<\|im_end\|>", 1)


def ttft_ms(start: Column, first: Column) -> Column:
    return F.round((first - start) * 1000, 1)


def backoff(attempt: int, hint: float = 0.0, jitter: float = 0.0) -> float:
    """Seconds to wait before the next call: the server's hint or powers of two up to a minute, and jitter."""
    return max(hint, min(60.0, 2.0**attempt)) + jitter
