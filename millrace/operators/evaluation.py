"""Pairwise evaluation: pairs, alignment, judging seams, debiasing, win rates, intervals, ratings, galleries."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strict_verdict, whitespace_tokens


@dataclass(frozen=True)
class Dimension:
    name: str
    description: str
    weight: float = 1.0


#: Names and weights of the rubric's dimensions.
RUBRIC = (
    Dimension("Correctness", "Technical claims are true and code would run as shown; an error outweighs everything else.", 2.0),
    Dimension("Directness", "The answer comes first, without preamble or a repeated question."),
    Dimension("Concision", "Length fits the question, without padding."),
    Dimension("Actionability", "The reader can act at once: steps, code, a decision."),
    Dimension("Calibration", "Doubt is stated where the question is ambiguous or depends on versions."),
)


def rubric_text(rubric=RUBRIC) -> str:
    return "\n".join(f"- {d.name} (weight {d.weight:g}): {d.description}" for d in rubric)


def judge_prompt(prompt: Column, intent: Column, a: Column, b: Column, rubric=RUBRIC) -> Column:
    parts = [F.lit("## Question\n\n"), prompt, F.lit("\n\n## Intent\n\n"), intent, F.lit(f"\n\n## Criteria\n\n{rubric_text(rubric)}\n\n## Response A\n\n"), a, F.lit("\n\n## Response B\n\n"), b]
    names = ", ".join(f'"{d.name}": <int 1-5>' for d in rubric)
    task = f'\n\n## Task\n\nAnswer with JSON only: {{"verdict": "A" | "B" | "tie", "rationale": "...", "dimension_scores": {{{names}}}, "confidence": "high" | "medium" | "low"}}'
    return F.concat(*parts, F.lit(task))


def model_pairs(models: DataFrame, order: str, model: str) -> DataFrame:
    """Pairs in input order; the join is on the order alone, and one side is broadcast if models are few."""
    a, b = models.alias("a"), models.alias("b")
    return a.join(F.broadcast(b) if models.limit(1001).count() <= 1000 else b, F.col(f"a.{order}") < F.col(f"b.{order}")).select(F.col(f"a.{model}").alias("model_a"), F.col(f"b.{model}").alias("model_b"))


def align(responses: DataFrame, cases: DataFrame, model_a: str, model_b: str) -> DataFrame:
    """Cases that both models answered, by (suite, case_id), with the case's prompt and intent or defaults."""
    side = lambda m, n: responses.where((F.col("model_id") == m) & F.col("error").isNull()).select("suite", "case_id", F.col("response").alias(n), F.col("prompt").alias(f"{n}_prompt"))
    both = side(model_a, "response_a").join(side(model_b, "response_b"), ["suite", "case_id"])
    joined = both.join(cases.select("suite", F.col("id").alias("case_id"), "prompt", "intent"), ["suite", "case_id"], "left")
    return joined.select("suite", "case_id", F.coalesce("prompt", "response_a_prompt").alias("prompt"), F.coalesce("intent", F.lit("No intent recorded.")).alias("intent"), "response_a", "response_b")


def ask_each(judge_fn: Callable[[list[str]], list[str]], prompts: list[str]) -> list[str | None]:
    """A batch's answers; if its call fails, its prompts are asked one by one, so that only those that fail again are lost."""
    try:
        return [*judge_fn(prompts)] if prompts else []
    except Exception:  # a failed call must not fail the job
        return [None] if len(prompts) == 1 else [ask_each(judge_fn, [p])[0] for p in prompts]


def judge(pairs: DataFrame, judge_fn: Callable[[list[str]], list[str]]) -> DataFrame:
    """verdict_ab, verdict_ba by a pluggable judge (prompts to raw answers), both orders; a failed call is a null verdict.

    Every action asks once, whatever filters follow; ``judging.judge_once`` asks once for all actions.
    """
    call = F.pandas_udf(lambda prompts: pd.Series(ask_each(judge_fn, [*prompts]), dtype="object"), "string").asNondeterministic()
    c = F.col
    asked = pairs.withColumns({"raw_ab": call(judge_prompt(c("prompt"), c("intent"), c("response_a"), c("response_b"))), "raw_ba": call(judge_prompt(c("prompt"), c("intent"), c("response_b"), c("response_a")))})
    return debias(asked.withColumns({"verdict_ab": strict_verdict("raw_ab"), "verdict_ba": strict_verdict("raw_ba")}))


def echo_judge(verdict: str = "tie") -> Callable[[list[str]], list[str]]:
    return lambda prompts: ['{"verdict": "' + verdict + '"}' for _ in prompts]


def generate(cases: DataFrame, model_id: str, generate_fn: Callable[[str], tuple[str, int]], done: DataFrame | None = None) -> DataFrame:
    """Responses by a pluggable generator; an exception is an error text; cases already done are left out."""
    todo = cases if done is None else cases.join(done.where(F.col("model_id") == model_id).select("suite", F.col("case_id").alias("id")), ["suite", "id"], "left_anti")

    @F.pandas_udf("response string, n_tokens int, error string")
    def run(prompts: pd.Series) -> pd.DataFrame:
        rows = []
        for p in prompts:
            try:
                rows.append((*generate_fn(p), None))
            except Exception as e:  # a failed case must not fail the job
                rows.append(("", 0, str(e)))
        return pd.DataFrame(rows, columns=["response", "n_tokens", "error"])

    return todo.withColumn("r", run.asNondeterministic()("prompt")).select(F.col("id").alias("case_id"), "suite", F.lit(model_id).alias("model_id"), "prompt", "r.*")


def compare(requests: DataFrame, engines: dict[str, Callable[[str], str]]) -> DataFrame:
    """(request_id, model_id, response, time_ms, error) of requests (request_id, prompt): every engine answers every one, partition by partition.

    A failing engine gives an empty response and its error, which stops no other.
    """
    import time

    def run(batches):
        for rows in batches:
            out = []
            for request, model, prompt in zip(rows["request_id"], rows["model_id"], rows["prompt"]):
                began, response, error = time.perf_counter(), "", None
                try:
                    response = engines[model](prompt)
                except Exception as e:  # a failed call must not fail the job
                    error = str(e)
                out.append((request, model, response, round((time.perf_counter() - began) * 1000, 1), error))
            yield pd.DataFrame(out, columns=["request_id", "model_id", "response", "time_ms", "error"])

    each = requests.select("request_id", F.explode(F.array(*map(F.lit, engines))).alias("model_id"), "prompt")
    dealt = each.repartition(requests.sparkSession.sparkContext.defaultParallelism, "request_id", "model_id")
    kind = dict(requests.dtypes)["request_id"]
    return dealt.mapInPandas(run, f"request_id {kind}, model_id string, response string, time_ms double, error string")


def debias(df: DataFrame, strict: bool = False) -> DataFrame:
    """final_verdict and position_bias_observed from both orders' verdicts.

    The swapped verdict is turned back; a missing one counts as a tie (strict: as failed).
    """
    back = F.when(F.col("verdict_ba") == "A", "B").when(F.col("verdict_ba") == "B", "A").otherwise(F.coalesce("verdict_ba", F.lit("tie")))
    failed = F.col("verdict_ab").isNull() | (F.col("verdict_ba").isNull() if strict else F.lit(False))
    same = F.col("verdict_ab") == back
    final = F.when(failed, "failed").when(same & (F.col("verdict_ab") == "A"), "model_a").when(same & (F.col("verdict_ab") == "B"), "model_b").otherwise("tie")
    return df.withColumns({"final_verdict": final, "position_bias_observed": F.when(failed, F.lit(False)).otherwise(~same)})


def win_rate(df: DataFrame, *keys: str) -> DataFrame:
    """wins, losses, ties, failed and the rate with ties as halves (0.5 of none), by keys."""
    v = F.col("final_verdict")
    out = df.groupBy(*keys).agg(F.count_if(v == "model_a").alias("wins"), F.count_if(v == "model_b").alias("losses"), F.count_if(v == "tie").alias("ties"), F.count_if(~v.isin("model_a", "model_b", "tie") | v.isNull()).alias("failed"))
    n = F.col("wins") + F.col("losses") + F.col("ties")
    return out.withColumn("win_rate", F.when(n > 0, (F.col("wins") + 0.5 * F.col("ties")) / n).otherwise(0.5))


def bias_rate(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.coalesce(F.avg(F.coalesce("position_bias_observed", F.lit(False)).cast("double")), F.lit(0.0)).alias("bias_rate"))


#: Fixed value: the rate of verdicts that depend on the order above which a judge is said to be biased.
BIASED = 0.3


def biased(rate: Column) -> Column:
    return F.coalesce(rate > BIASED, F.lit(False))


def interval_places(resamples: int, level: float = 0.95) -> tuple[int, int]:
    alpha = 1 - level
    return math.floor(alpha / 2 * resamples), min(math.ceil((1 - alpha / 2) * resamples) - 1, resamples - 1)


def bootstrap(df: DataFrame, keys: list[str], resamples: int = 10_000, level: float = 0.95, seed: int = 42) -> DataFrame:
    """Percentile intervals of the win rate by keys.

    A resample's rate depends on its counts alone, so draws are multinomial in three counts: one row a group, whatever
    its size.  Groups without a valid verdict get (0.5, 0, 1).
    """
    low, high = interval_places(resamples, level)

    @F.pandas_udf("win_rate double, ci_low double, ci_high double, n long")
    def draw(wins: pd.Series, ties: pd.Series, losses: pd.Series) -> pd.DataFrame:
        rows = []
        for counts in zip(wins, ties, losses):
            n = int(sum(counts))
            if not n:
                rows.append((0.5, 0.0, 1.0, 0))
                continue
            got = np.random.default_rng(seed).multinomial(n, np.array(counts) / n, size=resamples)
            rates = np.sort((got[:, 0] + 0.5 * got[:, 1]) / n)
            rows.append(((counts[0] + 0.5 * counts[1]) / n, rates[low], rates[high], n))
        return pd.DataFrame(rows, columns=["win_rate", "ci_low", "ci_high", "n"])

    return win_rate(df, *keys).withColumn("b", draw("wins", "ties", "losses")).select(*keys, "b.*")


#: What a verdict is worth to the first model, in halves.
_WORTH = {"model_a": 2, "tie": 1, "model_b": 0}


def _choices(n: int, seed: int):
    """Endlessly, in arrays: the places below n that a seeded generator of the standard library chooses one after another.

    It takes as many high bits of each 32-bit number as n has and goes on to the next where they are n or more.
    """
    import random

    state = random.Random(seed).getstate()[1]
    bits = np.random.MT19937()
    bits.state = {"bit_generator": "MT19937", "state": {"key": np.array(state[:-1], np.uint32), "pos": state[-1]}}
    shift = np.uint64(32 - n.bit_length())
    while True:
        got = bits.random_raw(1 << 16) >> shift
        yield got[got < n].astype(np.int64)


def bootstrap_replay(verdicts: list[str], resamples: int = 10_000, level: float = 0.95, seed: int = 42) -> dict:
    """The interval by drawing verdicts one by one, as ``random.Random(seed).choice`` would, for ordered lists below 2^32."""
    worth = np.array([_WORTH[v] for v in verdicts if v in _WORTH], np.int64)
    n = len(worth)
    if not n:
        return {"win_rate": 0.5, "ci_low": 0.0, "ci_high": 1.0, "n": 0}
    sums, held, drawn, done = np.empty(resamples, np.int64), [], 0, 0
    for part in _choices(n, seed):
        held.append(part)
        drawn += len(part)
        whole = min(resamples - done, drawn // n)
        if whole:
            flat = np.concatenate(held)
            sums[done : done + whole] = worth[flat[: whole * n]].reshape(whole, n).sum(axis=1)
            held, drawn, done = [flat[whole * n :]], drawn - whole * n, done + whole
        if done == resamples:
            break
    rates = np.sort(sums / 2 / n)
    low, high = interval_places(resamples, level)
    return {"win_rate": round(float(worth.sum()) / 2 / n, 4), "ci_low": round(float(rates[low]), 4), "ci_high": round(float(rates[high]), 4), "n": n}


def replay_by(df: DataFrame, keys: list[str], order: str, resamples: int = 10_000, seed: int = 42) -> DataFrame:
    """``bootstrap_replay`` for the verdicts of each key in order: one task a key, which holds a number a verdict.  ``bootstrap`` is for groups without bound."""

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        got = bootstrap_replay([*rows.sort_values(order, kind="stable")["final_verdict"]], resamples, seed=seed)
        return pd.DataFrame([(*key, *got.values())], columns=[*keys, *got])

    schema = ", ".join(f"`{k}` {t}" for k, t in df.select(*keys).dtypes)
    return df.select(*keys, order, "final_verdict").groupBy(*keys).applyInPandas(run, f"{schema}, win_rate double, ci_low double, ci_high double, n long")


def bootstrap_hashed(df: DataFrame, keys: list[str], order: str, resamples: int = 50) -> DataFrame:
    """An interval whose draws are an integer hash of (resample, place), so that SQL can repeat them; rows of a key are numbered in order."""
    worth = F.when(F.col("final_verdict") == "model_a", 2).when(F.col("final_verdict") == "tie", 1).otherwise(0)
    placed = df.where("final_verdict <> 'failed'").select(*keys, (F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1).cast("long").alias("i"), worth.alias("w"))
    sized = placed.join(placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), keys)
    r = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(resamples - 1).cast("long"))).alias("r")
    draws = sized.select(*keys, "n", "i", r).selectExpr(*keys, "r", "n", "((r * 2654435761 + i * 40503 + 12345) % 4294967296) % n as j")
    rates = draws.join(sized.select(*keys, F.col("i").alias("j"), "w"), [*keys, "j"]).groupBy(*keys, "r").agg((F.sum("w") / (2.0 * F.max("n"))).alias("rate"))
    low, high = interval_places(resamples)
    return rates.groupBy(*keys).agg(F.sort_array(F.collect_list("rate")).alias("s")).select(*keys, F.col("s")[low].alias("ci_low"), F.col("s")[high].alias("ci_high"))


def token_lengths(responses: DataFrame) -> DataFrame:
    """Responses with ``length``: n_tokens, or words where it is 0."""
    return responses.withColumn("length", F.when(F.coalesce("n_tokens", F.lit(0)) != 0, F.col("n_tokens")).otherwise(whitespace_tokens(F.col("response"))))


def _too_long(df: DataFrame, tokens_a: str, tokens_b: str, ratio: float) -> DataFrame:
    longer = F.when(F.col("final_verdict") == "model_a", F.col(tokens_a) > ratio * F.col(tokens_b)).when(F.col("final_verdict") == "model_b", F.col(tokens_b) > ratio * F.col(tokens_a)).otherwise(F.lit(False))
    return df.withColumn("_gone", F.col(tokens_a).isNull() | F.col(tokens_b).isNull() | longer)


def length_controlled(df: DataFrame, tokens_a: str, tokens_b: str, *keys: str, ratio: float = 1.2) -> DataFrame:
    """Win rates without rows whose winner is over ``ratio`` times as long or whose response is missing; pct_discarded isn't rounded."""
    kept = F.col("_gone") == F.lit(False)
    marked = _too_long(df, tokens_a, tokens_b, ratio)
    # one aggregate for both: a discarded row's verdict is counted under a name of its own, which no count takes
    counts = win_rate(marked.withColumn("final_verdict", F.when(kept, F.coalesce("final_verdict", F.lit("failed"))).otherwise("_discarded")), *keys, "_gone")
    n = F.col("wins") + F.col("losses") + F.col("ties")
    out = counts.groupBy(*keys).agg(
        F.sum(F.when(kept, 0).otherwise(F.col("failed"))).alias("n_discarded"), F.sum(n + F.col("failed")).alias("n_total"),
        *(F.sum(F.when(kept, F.col(c)).otherwise(0)).alias(c) for c in ("wins", "losses", "ties", "failed")), F.coalesce(F.max(F.when(kept, F.col("win_rate"))), F.lit(0.5)).alias("win_rate"),
    )
    return out.withColumn("pct_discarded", F.lit(100.0) * F.col("n_discarded") / F.col("n_total"))


def length_controlled_interval(df: DataFrame, tokens_a: str, tokens_b: str, keys: list[str], ratio: float = 1.2, resamples: int = 10_000, seed: int = 42) -> DataFrame:
    """Intervals of the win rate over the rows that length control keeps, with n_discarded and pct_discarded; (0.5, 0, 1) where it keeps none."""
    marked = _too_long(df, tokens_a, tokens_b, ratio)
    verdict = F.when(F.col("_gone"), F.lit("_discarded")).otherwise(F.col("final_verdict"))
    rates = bootstrap(marked.withColumn("final_verdict", verdict), keys, resamples, seed=seed)
    sizes = marked.groupBy(*keys).agg(F.count_if("_gone").alias("n_discarded"), (F.lit(100.0) * F.count_if("_gone") / F.count(F.lit(1))).alias("pct_discarded"))
    return rates.join(sizes, keys) if keys else rates.crossJoin(F.broadcast(sizes))  # without keys, one row on either side


def cases_with_responses(cases: DataFrame, responses: DataFrame) -> DataFrame:
    """Responses (suite, case_id, ...) with their case's expected answer and whether it is verifiable; those of no case are left out."""
    known = cases.select("suite", F.col("id").alias("case_id"), "expected_answer", "verifiable")
    return responses.join(known, ["suite", "case_id"])


def _matched(df: DataFrame, expected: str, response: str) -> DataFrame:
    """Verifiable rows with an expected answer, a response and no error, and whether it is in there."""
    parts = F.split(F.lower(F.trim(F.col(expected))), r"\|")
    hit = F.exists(parts, lambda p: F.contains(F.lower(F.col(response)), F.trim(p)))
    usable = F.col("verifiable") & (F.coalesce(F.col(expected), F.lit("")) != "") & F.col(response).isNotNull()
    if "error" in df.columns:
        usable &= F.coalesce("error", F.lit("")) == ""
    return df.where(usable).withColumn("_hit", hit)


def exact_match(df: DataFrame, expected: str, response: str, *keys: str) -> DataFrame:
    """Share of verifiable rows without an error of which an alternative of the expected answer is in the response; 0 of none."""
    out = _matched(df, expected, response).groupBy(*keys).agg(F.count_if("_hit").alias("n_correct"), F.count(F.lit(1)).alias("n_verifiable"))
    return out.withColumn("score", F.when(F.col("n_verifiable") > 0, F.col("n_correct") / F.col("n_verifiable")).otherwise(0.0))


def exact_match_failures(df: DataFrame, expected: str, response: str, *keys: str) -> DataFrame:
    """The rows that exact match counts as wrong: keys, expected, and the response's first 100 characters."""
    return _matched(df, expected, response).where("not _hit").select(*keys, F.col(expected).alias("expected"), F.substring(response, 1, 100).alias("got_preview"))


def pairwise_matrix(df: DataFrame, *keys: str) -> DataFrame:
    """(keys, model, other, points): wins with ties as halves, both ways."""
    rows = F.explode(F.array(
        F.struct(F.col("model_a").alias("model"), F.col("model_b").alias("other"), F.when(F.col("final_verdict") == "model_a", 1.0).when(F.col("final_verdict") == "tie", 0.5).otherwise(0.0).alias("points")),
        F.struct(F.col("model_b").alias("model"), F.col("model_a").alias("other"), F.when(F.col("final_verdict") == "model_b", 1.0).when(F.col("final_verdict") == "tie", 0.5).otherwise(0.0).alias("points")),
    ))
    return df.where(F.col("final_verdict").isin("model_a", "model_b", "tie")).select(*keys, rows.alias("r")).groupBy(*keys, "r.model", "r.other").agg(F.sum("r.points").alias("points"))


def ratings(matrix: dict[tuple[str, str], float], mode: str = "reference", rounds: int = 200) -> dict[str, float]:
    """Ratings around 1000 from the (small) matrix of points.

    ``reference``: the damped update whose fixed point the published ratings use, with -10 for no points; ``mle``: the
    Bradley-Terry maximum by minorisation.
    """
    models = sorted({m for pair in matrix for m in pair})
    at = {m: i for i, m in enumerate(models)}
    points = np.zeros((len(models),) * 2)
    for (a, b), p in matrix.items():
        points[at[a], at[b]] += p
    games, won = points + points.T, points.sum(axis=1)
    s = np.zeros(len(models))
    if len(models) < 2:
        return dict.fromkeys(models, 1000.0)
    for _ in range(rounds):
        e = np.exp(s)
        rate = (games / (e[:, None] + e[None, :])).sum(axis=1)
        share = rate * e if mode == "reference" else rate
        s = np.where(share > 0, np.where(won > 0, np.log(np.maximum(won, 1e-300) / np.where(share > 0, share, 1)), -10.0), s)
        if mode != "reference":
            s = np.maximum(s - s.mean(), -10.0)
    return {m: round(float(1000 + 173.7 * (s[i] - s.mean())), 1) for m, i in at.items()}


def ratings_by(df: DataFrame, *keys: str, mode: str = "reference", rounds: int = 200) -> DataFrame:
    """(keys, model, elo): ratings of each key's judgements, fitted where the key's matrix is: a row for each ordered pair of models."""

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        points = {(a, b): p for a, b, p in zip(rows["model"], rows["other"], rows["points"])}
        return pd.DataFrame([(*key[: len(keys)], m, e) for m, e in ratings(points, mode, rounds).items()], columns=[*keys, "model", "elo"])

    matrix = pairwise_matrix(df, *keys)
    schema = "".join(f"`{k}` {t}, " for k, t in df.select(*keys).dtypes)
    if not keys:
        matrix = matrix.withColumn("_all", F.lit(0))
    return matrix.groupBy(*(keys or ["_all"])).applyInPandas(run, f"{schema}model string, elo double")


def ratings_frame(df: DataFrame, mode: str = "reference") -> DataFrame:
    """Ratings from all judgements."""
    return ratings_by(df, mode=mode)


def metrics_table(judged: DataFrame, responses: DataFrame | None = None, cases: DataFrame | None = None, resamples: int = 2000, seed: int = 42) -> DataFrame:
    """All metrics as one table (section, suite, model_a, model_b, name, value), rates to four places.

    Sections: pairwise (counts and, unless ``resamples`` is 0, the interval), per_suite, position_bias_rate, elo (by model_a); with responses
    (suite, case_id, model_id, response, n_tokens; one a key) length_controlled, and with cases (suite, id, expected_answer, verifiable) exact_match (by model_a).
    """
    pair, none = ["model_a", "model_b"], F.lit(None).cast("string")

    def section(df: DataFrame, name: str, places: dict) -> DataFrame:
        value = lambda c, k: F.col(c).cast("double") if k is None else F.round(c, k)
        rows = F.explode(F.array(*(F.struct(F.lit(c).alias("name"), value(c, k).alias("value")) for c, k in places.items())))
        at = [F.col(c).cast("string").alias(c) if c in df.columns else none.alias(c) for c in ("suite", *pair)]
        return df.select(F.lit(name).alias("section"), *at, rows.alias("r")).select("section", "suite", *pair, "r.*")

    counts = dict.fromkeys(("wins", "losses", "ties", "failed"))
    n = F.col("wins") + F.col("losses") + F.col("ties")
    parts = [
        section(win_rate(judged, *pair).withColumn("n", n), "pairwise", {**counts, "n": None, "win_rate": 4}),
        section(win_rate(judged, *pair, "suite").withColumn("n", n), "per_suite", {**counts, "n": None, "win_rate": 4}),
        section(bias_rate(judged, *pair), "position_bias_rate", {"bias_rate": 4}),
        section(ratings_by(judged).withColumnRenamed("model", "model_a"), "elo", {"elo": 1}),
    ]
    if resamples:
        parts.append(section(bootstrap(judged, pair, resamples, seed=seed), "pairwise", {"ci_low": 4, "ci_high": 4}))
    if responses is not None:
        lengths, both = token_lengths(responses), judged
        for side in ("a", "b"):
            said = lengths.select("suite", "case_id", F.col("model_id").alias(f"model_{side}"), F.col("length").alias(f"length_{side}"))
            both = both.join(said, ["suite", "case_id", f"model_{side}"], "left")
        if resamples:
            controlled = length_controlled_interval(both, "length_a", "length_b", pair, resamples=resamples, seed=seed)
            parts.append(section(controlled, "length_controlled", {"win_rate": 4, "ci_low": 4, "ci_high": 4, "n": None, "n_discarded": None, "pct_discarded": 4}))
        else:
            parts.append(section(length_controlled(both, "length_a", "length_b", *pair), "length_controlled", {"win_rate": 4, "n_discarded": None, "pct_discarded": 4}))
        if cases is not None:
            found = exact_match(cases_with_responses(cases, responses), "expected_answer", "response", "model_id")
            parts.append(section(found.withColumnRenamed("model_id", "model_a"), "exact_match", {"n_correct": None, "n_verifiable": None, "score": 4}))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def regression_gallery(judged: DataFrame, cases: DataFrame, responses: DataFrame, older: str, newer: str, order: list, n: int = 10, cut: int = 300) -> DataFrame:
    """The first n judgements by ``order`` with a rationale that ``newer`` lost to ``older``, on whichever side it stood.

    Cases and responses may be missing; of several responses to a case the first by text is shown.  Only the n rows are
    joined, with both responses cut to ``cut`` characters.
    """
    a, b = F.col("model_a"), F.col("model_b")
    lost = ((a == older) & (b == newer) & (F.col("final_verdict") == "model_a")) | ((a == newer) & (b == older) & (F.col("final_verdict") == "model_b"))
    first = judged.where(lost & (F.coalesce("rationale_ab", F.lit("")) != "")).orderBy(*order).limit(n)
    first = first.select("suite", "case_id", "rationale_ab", F.row_number().over(Window.orderBy(*order)).alias("_at"))  # n rows
    short = lambda c: F.when(F.length(c) > cut, F.concat(F.substring(c, 1, cut), F.lit("..."))).otherwise(c)
    at = F.col("model_id").isin(older, newer)
    said = responses.join(F.broadcast(first.select("suite", "case_id")), ["suite", "case_id"], "left_semi").where(at)
    sides = said.groupBy("suite", "case_id").agg(*(F.min(F.when(F.col("model_id") == m, F.col("response"))).alias(c) for m, c in ((older, "winner"), (newer, "loser"))))
    shown = first.join(sides, ["suite", "case_id"], "left").join(cases.select("suite", "case_id", "prompt", "intent"), ["suite", "case_id"], "left")
    return shown.orderBy("_at").select("suite", "case_id", "prompt", "intent", short(F.col("winner")).alias("winner_response"), short(F.col("loser")).alias("loser_response"), F.col("rationale_ab").alias("rationale"))


def deployment_delta(df: DataFrame, resamples: int = 1000) -> DataFrame:
    """Win rate less parity, and a reading of it."""
    rate = bootstrap(df, [], resamples)
    delta = F.col("win_rate") - 0.5
    return rate.withColumn("delta", delta).withColumn("reading", F.when(F.abs(delta) < 0.03, "no measurable change").when(delta < 0, "worse than parity").otherwise("better than parity"))


def length_percentiles(df: DataFrame, value: str, *keys: str, places=(0.5, 0.9, 0.95, 0.99)) -> DataFrame:
    """The element at index int(n * q) of the sorted values, by keys.

    Values are counted first, so windows run over distinct values, however many rows a key has.
    """
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("c"))
    over = Window.partitionBy(*keys)
    ranked = counted.withColumns({"upto": F.sum("c").over(over.orderBy(value)), "n": F.sum("c").over(over)})
    at = [F.min(F.when(F.col("upto") > F.floor(F.col("n") * F.lit(q)), F.col(value))).alias(f"p{round(q * 100)}") for q in places]
    return ranked.groupBy(*keys).agg(*at, F.max(value).alias("max"), F.max("n").alias("n"))
