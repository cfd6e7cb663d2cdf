import random

from pyspark.sql import functions as F

from millrace.functions import text as tx
from millrace.operators import curation as cu
from millrace.operators import evaluation as ev
from millrace.operators import near_dup as nd
from millrace.operators import telemetry as te
from millrace.plans import report
from millrace.plans.scratch import writer
from millrace.schemas import VOTE
from millrace.sources import loaders as ld
from millrace.streaming import streams


def test_exact_dedup_keeps_first(spark):
    df = spark.createDataFrame([(0, "a"), (1, "b"), (2, "a"), (3, None), (4, "")], "i int, t string")
    assert sorted(r["i"] for r in cu.exact_dedup(df, F.col("t"), ["i"]).collect()) == [0, 1, 3]


def test_decontamination_catches_short_copies_only(spark):
    index = cu.gram_index(spark.createDataFrame([("Reverse a list",)], "t string"), "t")
    df = spark.createDataFrame([(0, "reverse A list!"), (1, "how do I reverse a list in place"), (2, None)], "i int, t string")
    assert sorted(r["i"] for r in cu.decontaminate(df, "t", index).collect()) == [1, 2]


def test_near_dedup_equals_sequential_greedy(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    base = [" ".join(rng.choices(words, k=60)) for _ in range(6)]
    texts = [b if rng.random() < 0.3 else b.replace(f"w{rng.randrange(30)} ", "x ", 1) for b in base for _ in range(8)]
    rng.shuffle(texts)
    import pandas as pd

    taken, kept = set(), []
    for i, bands in enumerate(nd.band_hashes(pd.Series(texts))):
        keys = {(k, h) for k, h in enumerate(bands)}
        if not keys & taken:
            kept.append(i)
            taken |= keys
    df = spark.createDataFrame([*enumerate(texts)], "i long, t string")
    assert sorted(r["i"] for r in nd.near_dedup(df, "i", "t", writer(spark)).collect()) == kept


def test_win_rate_and_intervals(spark):
    df = spark.createDataFrame([("model_a",)] * 6 + [("model_b",)] * 2 + [("tie",)] * 2 + [("failed",)], "final_verdict string")
    assert ev.win_rate(df).first()["win_rate"] == 0.7
    got = ev.bootstrap(df, [], 1000).first()
    assert got["ci_low"] <= 0.7 <= got["ci_high"] and got["n"] == 10
    replay = ev.bootstrap_replay(["model_a"] * 6 + ["model_b"] * 2 + ["tie"] * 2, 1000)
    assert abs(replay["ci_low"] - got["ci_low"]) <= 0.1
    assert ev.interval_places(10_000) == (250, 9749) and ev.interval_places(1000) == (25, 974)


def test_always_first_judge_is_a_biased_tie(spark):
    pairs = spark.createDataFrame([("q", "i", "x", "y")], "prompt string, intent string, response_a string, response_b string")
    got = ev.judge(pairs, ev.echo_judge("A")).first()
    assert (got["final_verdict"], got["position_bias_observed"]) == ("tie", True)


def test_ratings():
    matrix = {("base", "sft"): 2, ("sft", "base"): 8, ("base", "dpo"): 1, ("dpo", "base"): 9, ("sft", "dpo"): 4, ("dpo", "sft"): 6}
    reference = ev.ratings(matrix)
    assert reference["dpo"] > reference["sft"] > reference["base"]
    assert ev.ratings({("a", "b"): 6, ("b", "a"): 4}) == {"a": 1000.0, "b": 1000.0}
    assert ev.ratings({("a", "b"): 6, ("b", "a"): 4}, "mle", 2000) == {"a": 1035.2, "b": 964.8}


def test_kl_and_guard(spark):
    one = te.implicit_kl(spark.createDataFrame([(1, 1, 0.4, -0.2), (1, 2, None, 1.0)], "run long, step long, r_chosen double, r_rejected double")).collect()
    assert len(one) == 1 and abs(one[0]["kl"] - 3.0) < 1e-9
    df = spark.createDataFrame([(1, i, 20.0) for i in range(1, 26)] + [(2, i, 1.0) for i in range(1, 26)], "run long, step long, kl double")
    assert [tuple(r) for r in te.divergence(df).collect()] == [(1, 20)]


def test_normalise_and_parsers(spark):
    assert [tx.normalise_text(x) for x in ("hello   world", "a\n\n\n\n\nb", "hello\x00world", "é", "a&nbsp;b", None)] == ["hello world", "a\n\nb", "helloworld", "é", "a\xa0b", None]
    df = spark.createDataFrame([("\n\nHuman: q1\n\nAssistant: a1\n\nHuman: q2\n\nAssistant: a2",), ("no turns",)], "t string")
    prompt, answer = ld.parse_transcript(F.col("t"))
    assert [tuple(r) for r in df.select(prompt, answer).collect()] == [("q2", "a2"), (None, None)]
    raw = spark.createDataFrame([('{"verdict": "A"}',), ('```json\n{"verdict": "tie"}\n```',), ('{"verdict": "C"}',), ('{"verdict": "A"} x',), ("[1]",), (None,)], "r string")
    assert [r[0] for r in raw.select(tx.strict_verdict("r")).collect()] == ["A", "tie", None, None, None, None]


def test_sources_route_bad_rows(spark):
    df = spark.createDataFrame([("What is it?", "", "A thing."), ("   ", "", "A thing."), ("What is it?", "", "ok")], "instruction string, input string, output string")
    good, bad = ld.route(ld.adapt(df, ld.CATALOG["alpaca_cleaned"]))
    assert good.count() == 1 and {r["error"] for r in bad.collect()} == {"instruction: too short", "response: too short"}


def test_suites_and_logs(spark, tmp_path):
    (tmp_path / "domain_v1.jsonl").write_text('{"id": "a", "prompt": "What now?", "intent": "x"}\n\nbad\n{"id": "b", "prompt": "no", "intent": "x"}\n')
    cases = ld.load_suite(spark, "domain_v1", f"file://{tmp_path}")
    assert [(r["id"], r["difficulty"], r["suite"]) for r in cases.collect()] == [("a", 2, "domain_v1")]
    assert ld.load_suite(spark, "none", f"file://{tmp_path}").count() == 0
    lines = spark.createDataFrame([('{"event": "x", "k": 1}',), ("x {",), ('{"event": "y"}',)], "value string")
    assert ld.log_records(lines, event="x", key="k").count() == 1


def test_dataset_writer_is_repeatable(spark, tmp_path):
    df = spark.createDataFrame([(i, f"Q{i}", f"A{i}") for i in range(20)], "i long, q string, a string")
    none = spark.createDataFrame([], "raw string")
    first = cu.write_dataset(df, none, f"file://{tmp_path}", "d", "i")
    assert len(first) == 12 and first == cu.write_dataset(df.repartition(3), none, f"file://{tmp_path}", "d", "i")
    assert spark.read.parquet(f"file://{tmp_path}/d/{first}/val").count() == 2
    assert ld.resolve_dataset(spark, f"file://{tmp_path}", first).endswith(first)


def test_report(spark):
    df = spark.createDataFrame([("a", "b", "s", "model_a", False), ("a", "b", "s", "tie", True)], "model_a string, model_b string, suite string, final_verdict string, position_bias_observed boolean")
    doc = report.metrics(df)
    assert doc["pairwise"]["a_vs_b"]["win_rate"] == 0.75 and doc["position_bias_rate"]["a_vs_b"] == 0.5
    page = report.to_html(report.markdown(doc))
    assert "<table>" in page and "a_vs_b" in page
    assert len(report.config_hash(report.merge_config({"a": {"b": 1}}, {"a": {"c": 2}}))) == 12


def test_streams(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    df = spark.createDataFrame([(1, i, 20.0) for i in range(1, 31)], "run long, step long, kl double")
    df.coalesce(1).write.mode("overwrite").json(f"file://{source}")
    stream = spark.readStream.schema(df.schema).json(f"file://{source}")
    q = streams.divergence_guard(stream).writeStream.format("memory").queryName("guard").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert [tuple(r) for r in spark.table("guard").collect()] == [(1, 20)]
    votes = spark.createDataFrame([("v1", "s", "a question", "first answer", "other answer", "m1", "m2", "b", "2024-01-01T00:00:00Z"), ("v2", "s", "a question", "first answer", "other answer", "m1", "m2", "tie", "2024-01-01T00:00:00Z")], VOTE)
    votes.write.json(f"file://{tmp_path}/votes")
    q = streams.read_votes(spark, f"file://{tmp_path}/votes").writeStream.foreachBatch(streams.votes_sink(f"file://{out}")).option("checkpointLocation", f"file://{tmp_path}/cp").start()
    q.processAllAvailable()
    q.stop()
    assert [r["chosen"] for r in spark.read.parquet(f"file://{out}/*").collect()] == ["other answer"]


def test_signature_estimates_similarity():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(500)]
    for share in (0.0, 0.1, 0.4):
        got = want = 0.0
        for _ in range(60):
            a = rng.choices(words, k=120)
            b = [rng.choice(words) if rng.random() < share else w for w in a]
            a, b = " ".join(a), " ".join(b)
            x, y = ({t[i : i + 5] for i in range(len(t) - 4)} for t in (a, b))
            want += len(x & y) / len(x | y) / 60
            got += float((nd.minima(a) == nd.minima(b)).mean()) / 60
        assert abs(got - want) < 0.03
    assert (nd.minima("abcdef") == nd.minima("abcdef")).all() and (nd.minima("a") == nd.minima("")).all()


def test_lexicon_forms_agree():
    import re

    from millrace.functions import lexicon

    rng = random.Random(6)
    parts = "python Java javascript c++ c++x go r  script code git error at in on Error: Traceback run running runtime def f( class X import os ``` CI/CD machine learning neural nets stack trace overflow command line not found debugger".split(" ")
    for _ in range(20_000):
        t = "".join(rng.choice(parts) + rng.choice([" ", "", "-", "_", "\n", ". "]) for _ in range(rng.randrange(1, 5)))
        assert bool(re.search(lexicon.ANY, t, re.I)) == bool(re.search(lexicon._grouped(), t, re.I)), t


def test_exact_dedup_keeps_one_row_of_ties(spark):
    df = spark.createDataFrame([(0, "a"), (0, "a"), (1, "b")], "i int, t string")
    assert sorted(r["i"] for r in cu.exact_dedup(df, F.col("t"), ["i"]).collect()) == [0, 1]


def test_templates_and_waits():
    from millrace.functions import chat

    assert chat.response_template(lambda u, a: f"<u>{u}</u><a>{a}</a>") == "</u><a>"
    assert chat.stop_tokens(["<|eot_id|>", "x"], "e") == ["<|eot_id|>"] and chat.stop_tokens([], "e") == ["e"]
    assert [chat.backoff(k) for k in (0, 3, 9)] == [1.0, 8.0, 60.0] and chat.backoff(1, 5.0, 0.5) == 5.5


def test_records(spark):
    from millrace.operators import records as rc

    lines = spark.createDataFrame([('{"prompt": "p", "instruction": "i"}',), ('{"instruction": "i"}',), ('{"x": 1}',)], "value string")
    assert [r[0] for r in rc.eval_prompts(lines).collect()] == ["p", "i", ""]
    rows = spark.createDataFrame([("a", 1, "x", None), ("a", 2, "y", "failed"), ("a", 0, "z", "")], "case_id string, ord int, response string, error string")
    assert rc.responses(rows, ["case_id"], "ord").first()["response"] == "x"
    assert rc.responses(rows.where("ord <> 1"), ["case_id"], "ord", "coalesce(error, '') <> ''").first()["response"] == "z"


def test_dataset_build_quarantines_and_keeps_first(spark):
    from millrace.plans.build import build_dataset

    rows = [(0, "What is it about?", "", "A long answer.", "s"), (1, "What is  it about?", "", "A long answer.", "s"), (2, "Hi", "", "A long answer.", "s"), (3, "\x00\x01abcd", "", "A long answer.", "s"), (4, "reverse a list", "", "Use reversed.", "s")]
    df = spark.createDataFrame(rows, "id long, instruction string, input string, response string, source string")
    built = build_dataset(df, "sft", "id", writer(spark), spark.createDataFrame([("Reverse a list",)], "prompt string"), near=True)
    assert [r["id"] for r in built.rows.collect()] == [0]
    assert sorted((r["stage"], r["error"]) for r in built.quarantine.collect()) == [("normalisation", "instruction: too short"), ("validation", "instruction: too short")]
    assert [(r["stage"], r["rows"]) for r in built.funnel.orderBy("stage_ord").collect()] == [("loaded", 5), ("validated", 4), ("quarantined", 2), ("after_dedup", 2), ("after_decontamination", 1), ("final", 1)]


def test_report_has_all_sections(spark):
    judged = spark.createDataFrame([("a", "b", "s", str(i), v, False) for i, v in enumerate(["model_a", "model_a", "tie", "model_b"])], "model_a string, model_b string, suite string, case_id string, final_verdict string, position_bias_observed boolean")
    said = [("s", str(i), m, "Yes it is", n) for i in range(4) for m, n in (("a", 30 if i == 0 else 10), ("b", 10))]
    responses = spark.createDataFrame(said, "suite string, case_id string, model_id string, response string, n_tokens int")
    cases = spark.createDataFrame([("s", "0", " YES |no", True), ("s", "1", "perhaps", True), ("s", "2", "", True)], "suite string, id string, expected_answer string, verifiable boolean")
    doc = report.metrics(judged, responses, cases)
    got = doc["length_controlled"]["a_vs_b"]
    assert (got["win_rate"], got["n"], got["n_discarded"], got["pct_discarded"]) == (0.5, 3, 1, 25.0)
    assert doc["exact_match"]["a"] == {"n_correct": 1, "n_verifiable": 2, "score": 0.5} and doc["pairwise"]["a_vs_b"]["wins"] == 2
    shown = ev.regression_gallery(judged.withColumn("rationale_ab", F.lit("why")), cases.selectExpr("suite", "id as case_id", "'p' as prompt", "'i' as intent"), responses, "a", "b", ["case_id"], 5, 3)
    gallery = [r.asDict() for r in shown.collect()]
    assert [r["case_id"] for r in gallery] == ["0", "1"] and gallery[0]["winner_response"] == "Yes..."
    page = report.markdown(doc, gallery=gallery, judge="J")
    for part in ("## Win rates", "## Exact match", "## Ratings", "## Position bias", "## Suite s", "## Lost cases", "## Method", "The judge was J"):
        assert part in page
    swapped = judged.selectExpr("model_b as model_a", "model_a as model_b", "suite", "case_id", "case final_verdict when 'model_a' then 'model_b' when 'model_b' then 'model_a' else final_verdict end as final_verdict", "'why' as rationale_ab")
    assert ev.regression_gallery(swapped, cases.selectExpr("suite", "id as case_id", "'p' as prompt", "'i' as intent"), responses, "a", "b", ["case_id"]).count() == 2


def test_exact_match_leaves_errors_out_and_scores_none_as_zero(spark):
    df = spark.createDataFrame([("x", "A thing", True, None), ("x", "a thing", True, "failed"), ("x", "b", True, ""), ("x", None, True, None)], "expected string, response string, verifiable boolean, error string").withColumn("expected", F.lit("thing"))
    assert ev.exact_match(df, "expected", "response").first().asDict() == {"n_correct": 1, "n_verifiable": 2, "score": 0.5}
    assert ev.exact_match(df.where("false"), "expected", "response").first()["score"] == 0.0
    assert [r["got_preview"] for r in ev.exact_match_failures(df, "expected", "response").collect()] == ["b"]


def test_config_files_and_settings(tmp_path):
    import pytest

    base, part = tmp_path / "base.yaml", tmp_path / "part.yaml"
    base.write_text("train: {beta: 0.1, steps: 5}\nname: x\n")
    part.write_text("train: {beta: 0.2}\n")
    shape = {"train": {"beta": float, "steps": int}, "name": str}
    assert report.load_config(str(base), [str(part)], ["train.steps=7"], shape) == {"train": {"beta": 0.2, "steps": 7}, "name": "x"}
    assert report.load_config(str(tmp_path / "none"), [str(part)]) == {"train": {"beta": 0.2}}
    for components, settings in (([str(tmp_path / "none")], []), ([], ["train.beta=x"]), ([], ["other=1"]), ([], ["train.steps=true"]), ([], ["name.x=1"]), ([], ["nothing"])):
        with pytest.raises(report.ConfigError):
            report.load_config(str(base), components, settings, shape)


def test_chat_judge_tries_again():
    import json

    import pytest

    from millrace.functions.judges import ChatJudge, JudgeError, LocalJudge, retrying

    answers, waits = [], []

    def server(url, headers, body, timeout):
        got = answers.pop(0)
        if isinstance(got, Exception):
            raise got
        return got

    judge = ChatJudge("m", "http://x/v1/", lambda: "k", post=server, sleep=waits.append, jitter=lambda: 0.0)
    good = (200, {}, json.dumps({"choices": [{"message": {"content": "A"}}]}).encode())
    answers[:] = [(429, {"retry-after": "9"}, b""), OSError("no net"), (503, {"retry-after": "Mon"}, b""), good]
    assert judge(["p"]) == ["A"] and waits == [9.0, 2.0, 4.0]
    answers[:] = [(401, {}, b"")]
    with pytest.raises(JudgeError):
        judge(["p"])
    answers[:] = [(500, {}, b"")] * 6
    with pytest.raises(JudgeError):
        judge(["p"])
    assert not answers
    local = LocalJudge("n", lambda: ((lambda t: [*t]), "".join, lambda ids, most: ids[-2:]), longest=3)
    assert local(["abcdef"]) == ["bc"]
    said = iter([["?", "A"], ["?"], ["B"]])
    assert retrying(lambda prompts: next(said), lambda a: a != "?")(["x", "y"]) == ["B", "A"]


def test_failed_judge_calls_are_null_verdicts(spark):
    def judge(prompts):
        if any("bad" in p for p in prompts):
            raise RuntimeError("down")
        return ['{"verdict": "A"}' for _ in prompts]

    pairs = spark.createDataFrame([("bad", "i", "x", "y"), ("good", "i", "x", "y")], "prompt string, intent string, response_a string, response_b string").coalesce(1)
    assert {r["prompt"]: (r["verdict_ab"], r["final_verdict"]) for r in ev.judge(pairs, judge).collect()} == {"bad": (None, "failed"), "good": ("A", "tie")}


def test_registry(spark, tmp_path):
    import pytest

    from millrace.operators.registry import Registry, list_files, run_folders

    r = Registry(spark, f"file://{tmp_path}/registry")
    rows = lambda schema, *values: spark.createDataFrame([*values], schema)
    state = lambda name, *columns: sorted(map(tuple, r.table(name).select(*columns).collect()), key=str)
    assert r.table("runs").count() == 0 and r.served().count() == 0
    r.start_runs(rows("run_id string, kind string, started_at string, notes string", ("sft-1", "sft", "t1", "n"), ("dpo-1", "dpo", "t2", None), ("sft-2", "sft", "t3", None)))
    with pytest.raises(ValueError):
        r.start_runs(rows("run_id string, kind string", ("x", "sft"), ("sft-1", "sft")))
    with pytest.raises(ValueError):
        r.put("runs", rows("run_id string, kind string", (None, "sft")))
    with pytest.raises(ValueError):
        r.put("runs", rows("run_id string, colour string", ("x", "red")))
    with pytest.raises(KeyError):
        r.complete_runs(rows("run_id string, finished_at string", ("none", "t")))
    r.fail(rows("run_id string, finished_at string, error string", ("sft-1", "t4", "oom"), ("sft-2", "t4", None)))
    r.complete_runs(rows("run_id string, finished_at string, metrics_json string", ("dpo-1", "t5", "{}")))
    assert state("runs", "run_id", "kind", "status", "notes", "finished_at") == [("dpo-1", "dpo", "completed", None, "t5"), ("sft-1", "sft", "failed", "n | oom", "t4"), ("sft-2", "sft", "failed", "unknown error", "t4")]
    # two writers that saw the same row and change different columns of it, and one that clears a column
    r.put("runs", rows("run_id string, git_sha string", ("sft-1", "abc")))
    r.put("runs", rows("run_id string, config_hash string, finished_at string", ("sft-1", "def", None)))
    assert state("runs", "run_id", "git_sha", "config_hash", "finished_at")[1] == ("sft-1", "abc", "def", None)
    r.put("datasets", rows("dataset_id string, sha256 string, n_rows long", ("d", "hash", 5), ("e", "other", 1)))
    r.put("datasets", rows("dataset_id string, n_rows long", ("d", 6)))
    assert state("datasets", "dataset_id", "sha256", "n_rows") == [("d", "hash", 6), ("e", "other", 1)]
    r.publish(rows("model_id string, backend string, sort_order int", ("m", "local", 2), ("k", "local", 1)))
    r.unpublish(rows("model_id string", ("m",)))
    assert [m["model_id"] for m in r.served().collect()] == ["k"] and [m["backend"] for m in r.served(False).collect()] == ["local"] * 2
    for f in ("sft-2/adapter/adapter_config.json", "sft-2/checkpoints/checkpoint-9/trainer_state.json", "sft-2/checkpoints/checkpoint-10/trainer_state.json", "sft-2/checkpoints/checkpoint-11/w.bin", "sft-3/log", "dpo-1/log", "stray"):
        (tmp_path / "runs" / f).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "runs" / f).write_text("x")
    found = {x["run_id"]: (x["complete"], x["latest_step"]) for x in run_folders(list_files(spark, f"file://{tmp_path}/runs"), "sft").collect()}
    assert found == {"sft-2": (True, 10), "sft-3": (False, None)}


def test_plain_answers_pass_through_and_last_rows_win(spark):
    df = spark.createDataFrame([("What is it?", "A fine thing", "A bad thing")], "prompt string, chosen string, rejected string")
    assert ld.adapt(df, ld.CATALOG["ultrafeedback"]).first()["chosen"] == "A fine thing"
    rows = spark.createDataFrame([("k", 1, 1, "x"), ("k", 2, 1, "y"), ("k", 2, 2, "z"), ("j", 0, 0, None)], "k string, a int, b int, v string")
    assert {r["k"]: r["v"] for r in ld.latest_per_key(rows, ["k"], [F.col("a"), F.col("b")]).collect()} == {"k": "z", "j": None}


def test_manifest_takes_what_the_caller_says(spark, tmp_path):
    import json

    import pytest

    df = spark.createDataFrame([(i, f"Q{i}") for i in range(10)], "i long, q string")
    none = spark.createDataFrame([], "raw string")
    digest = cu.write_dataset(df, none, f"file://{tmp_path}", "d", "i", kind="preference", funnel={"loaded": 10})
    doc = json.loads((tmp_path / "d" / digest / "manifest.json").read_text())
    assert doc["kind"] == "preference" and doc["funnel"] == {"loaded": 10} and doc["sources"] == []
    assert {"name", "content_hash", "n_train", "n_val", "n_total", "val_ratio", "seed", "filter_eval", "token_stats", "decontamination"} <= {*doc}
    with pytest.raises(TypeError):
        cu.write_dataset(df, none, f"file://{tmp_path}", "d", "i", other={})


def test_loading_by_spec_and_limit(spark, tmp_path):
    import json

    import pytest

    turns = [("q", None, "prompter", "What is a list?", None), ("a", "q", "assistant", "A sequence of things.", 0), ("b", "q", "assistant", "Another answer.", 1), ("c", None, "assistant", "An orphan's answer.", 0)]
    (tmp_path / "threads.jsonl").write_text("".join(json.dumps(dict(zip(("message_id", "parent_id", "role", "text", "rank"), t), lang="en")) + "\n" for t in turns))
    got = ld.load_source(spark, f"file://{tmp_path}/threads.jsonl", ld.CATALOG["oasst1"]).collect()
    assert [(r["instruction"], r["response"], r["error"]) for r in got] == [("What is a list?", "A sequence of things.", None)]
    (tmp_path / "plain").mkdir()
    for k in range(3):
        (tmp_path / "plain" / f"{k}.json").write_text("".join(json.dumps({"instruction": f"Question {k}{i}", "input": "", "output": "An answer"}) + "\n" for i in range(4)))
    spec = ld.CATALOG["alpaca_cleaned"]
    read = lambda n: sorted(r["instruction"] for r in ld.adapt(spark.read.json(f"file://{tmp_path}/plain"), spec).collect())[:n]
    df = ld.load_all(spark, {"alpaca_cleaned": f"file://{tmp_path}/plain/0.json", "none": "x"}, 3)
    assert sorted(r["instruction"] for r in df.collect()) == read(3)
    spark.createDataFrame([(f"Question {i:03d}", "", "An answer") for i in range(300)], "instruction string, input string, output string").coalesce(1).sortWithinPartitions("instruction").write.parquet(f"file://{tmp_path}/p")
    assert sorted(r["instruction"] for r in ld.load_source(spark, f"file://{tmp_path}/p", spec, 5).collect()) == [f"Question {i:03d}" for i in range(5)]
    with pytest.raises(ValueError):
        ld.load_all(spark, {"none": "x"})


def test_many_models(spark):
    models = spark.range(1100).selectExpr("id", "concat('m', id) as name")
    assert ev.model_pairs(models, "id", "name").count() == 1100 * 1099 // 2


def test_publish_refs_takes_the_first_of_lines_alike(spark, tmp_path):
    """Lines of one date and number go by their place in the files, whatever file Spark reads first; missing dates and numbers last."""
    import duckdb

    from millrace.plans.queries import ORACLES, publish_refs

    con = duckdb.connect()
    con.sql("set threads = 1")
    (tmp_path / "lineitem.parquet").mkdir()
    line = "select o::bigint as l_orderkey, p::bigint as l_partkey, case when o % 2 = 0 then 'R' else 'N' end as l_returnflag, t::timestamp as l_shipdate, n::int as l_linenumber"
    files = (("0", 1, 0, 40), ("1", 2, 0, 4000), ("2", 3, 20, 60))  # file 1 is the largest, so Spark reads it first
    for name, part, a, b in files:
        con.sql(f"copy ({line} from (select i // 2 as o, {part} * 100000 + i as p, timestamp '2020-01-01' as t, 1 as n from range({a}, {b}) r(i))) to '{tmp_path}/lineitem.parquet/{name}.parquet'")
    odd = "(-2, 7, null, 1), (-2, 8, timestamp '2020-01-02', null), (-2, 9, timestamp '2020-01-02', 3), (-3, null, timestamp '2020-01-01', 1), (-3, 5, timestamp '2020-01-01', 1)"
    con.sql(f"copy ({line} from (values {odd}) v(o, p, t, n)) to '{tmp_path}/lineitem.parquet/3.parquet'")
    con.sql(f"copy (select i::bigint as o_orderkey from range(-3, 2010) r(i) union all select null) to '{tmp_path}/orders.parquet'")
    con.sql(f"create view lineitem as select * from read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    con.sql(f"create view orders as select * from '{tmp_path}/orders.parquet'")
    got = sorted(map(tuple, publish_refs(spark, str(tmp_path)).select("model_id", "backend", "ref").collect()), key=str)
    refs = {r[0]: r[2] for r in got}
    assert [refs[k] for k in (0, 19, 20, -2, -3, 2005)] == ["p/100000", "p/100038", "p/200040", "p/9", "p/", None]
    assert got == sorted(con.sql(ORACLES["publish_refs"]).project("model_id, backend, ref").fetchall(), key=str)
