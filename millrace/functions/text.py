"""Text functions as column expressions; exact Unicode forms that the JVM lacks as Arrow UDFs."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .normal import needing

WORDS = r"[\p{L}\p{N}_]+"


def strip(c: Column) -> Column:
    """Unicode white space off both ends (trim() takes blanks only)."""
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def collapse_whitespace(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"(?U)[^\S\n]+", " "), r"\n{3,}", "\n\n")


def unescape_basic(c: Column) -> Column:
    """The five basic entities, & last."""
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(sign))
    return c


_BLANKS, _LINES = re.compile(r"[^\S\n]+"), re.compile(r"\n{3,}")


def normalise_text(text: str | None) -> str | None:
    """Control characters out, NFC, white space collapsed, entities unescaped (after that), stripped."""
    if text is None:
        return None
    kept = text if text.isascii() and text.isprintable() else "".join(c for c in text if c in "\n\t" or unicodedata.category(c)[0] != "C")
    return html.unescape(_LINES.sub("\n\n", _BLANKS.sub(" ", unicodedata.normalize("NFC", kept)))).strip()


def normalise_texts(texts: list[str | None]) -> list[str | None]:
    """normalise_text of each; the classes of all signs tell which texts are left as they are and which need white space alone."""
    filled = [t or "" for t in texts]
    deep, light = needing(filled)
    out = [*texts]
    for k in np.flatnonzero(deep):
        out[k] = normalise_text(texts[k])
    for k in np.flatnonzero(light):
        out[k] = _LINES.sub("\n\n", _BLANKS.sub(" ", filled[k])).strip()
    return out


@F.pandas_udf(StringType())
def normalise(texts: pd.Series) -> pd.Series:
    values, out, at = [None if t is None else t for t in texts], [], 0
    while at < len(values):  # in slices of bounded size
        stop, size = at, 0
        while stop < len(values) and (stop == at or size + len(values[stop] or "") <= 1 << 20):
            size += len(values[stop] or "")
            stop += 1
        out += normalise_texts(values[at:stop])
        at = stop
    return pd.Series(out, dtype="object")


def word_tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(WORDS), F.lit(0))


def ngrams(tokens: Column, n: int) -> Column:
    """Word n-grams; fewer words than n are one gram, none give none."""
    grams = F.transform(F.sequence(F.lit(1), F.size(tokens) - n + 1), lambda i: F.array_join(F.slice(tokens, i, n), " "))
    return F.when(F.size(tokens) >= n, grams).when(F.size(tokens) > 0, F.array(F.array_join(tokens, " "))).otherwise(F.array().cast("array<string>"))


def char_shingles(c: Column, k: int = 5) -> Column:
    none = F.array().cast("array<string>")
    return F.when(F.length(c) >= k, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - k + 1), lambda i: F.substring(c, i, F.lit(k))))).otherwise(none)


def whitespace_tokens(c: Column) -> Column:
    return F.size(F.filter(F.split(c, r"(?U)[\s\x1c-\x1f]+"), lambda w: w != ""))


def strip_fences(c: Column) -> Column:
    """A text that begins with a code fence loses its lines that begin with one."""
    kept = F.array_join(F.filter(F.split(c, "\n"), lambda line: ~line.startswith("```")), "\n")
    return F.when(c.startswith("```"), kept).otherwise(c)


@F.pandas_udf(StringType())
def strict_verdict(raw: pd.Series) -> pd.Series:
    """The verdict of a judge's answer (fences off, strict JSON object, A, B or tie), else null."""
    import json

    def read(text):
        if text is None:
            return None
        text = text.strip()
        if text.startswith("```"):
            text = "\n".join(x for x in text.split("\n") if not x.startswith("```"))
        try:
            got = json.loads(text)
        except ValueError:
            return None
        verdict = got.get("verdict") if isinstance(got, dict) else None
        return verdict if verdict in ("A", "B", "tie") else None

    return raw.map(read, na_action="ignore")


def chatml(user: Column, assistant: Column | None = None, system: Column | None = None) -> Column:
    """ChatML; without an answer it ends where the model would go on."""
    parts = [F.lit("<|im_start|>system\n"), system, F.lit("<|im_end|>\n")] if system is not None else []
    parts += [F.lit("<|im_start|>user\n"), user, F.lit("<|im_end|>\n<|im_start|>assistant\n")]
    return F.concat(*parts, *([assistant, F.lit("<|im_end|>\n")] if assistant is not None else []))


def llama3(user: Column, assistant: Column, system: Column | None = None) -> Column:
    def block(role, c):
        return [F.lit(f"<|start_header_id|>{role}<|end_header_id|>\n\n"), c, F.lit("<|eot_id|>")]

    return F.concat(F.lit("<|begin_of_text|>"), *(block("system", system) if system is not None else []), *block("user", user), *block("assistant", assistant))


def telemetry_line(ttft_ms: Column, tokens_per_s: Column, n_tokens: Column) -> Column:
    return F.concat_ws(
        " · ", F.when(ttft_ms.isNotNull(), F.format_string("TTFT %.0fms", ttft_ms)), F.when(tokens_per_s.isNotNull(), F.format_string("%.1f tok/s", tokens_per_s)), F.format_string("%d tokens", n_tokens)
    )


def strip_ansi(c: Column) -> Column:
    """Without the escapes that colour a terminal's text."""
    return F.regexp_replace(c, r"\x1b\[[0-9;]*m", "")


def run_id_of(output: Column) -> Column:
    """The last run id that a command's output tells, null without one."""
    return F.try_element_at(F.regexp_extract_all(strip_ansi(output), F.lit(r"Run ID:\s*(\S+)"), F.lit(1)), F.lit(-1))


def tokens_per_second(n_tokens: Column, elapsed: Column) -> Column:
    return F.when((elapsed >= 0.1) & (n_tokens != 0), F.round(n_tokens / elapsed, 1))


def token_count(tokenize: Callable[[list[str]], list[int]] | None = None):
    """Token lengths by a pluggable tokenizer (texts to counts); white-space words by default."""
    if tokenize is None:
        return whitespace_tokens

    @F.pandas_udf("int")
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series(tokenize([t or "" for t in texts]))

    return count
