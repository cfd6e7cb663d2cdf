"""Sources, records, telemetry, chat and report functions that had no test of their own, and grouped statistics against plain Python."""

import json
import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import chat
from millrace.functions import text as tx
from millrace.operators import curation as cu
from millrace.operators import evaluation as ev
from millrace.operators import records as rc
from millrace.operators import telemetry as te
from millrace.plans import report
from millrace.sources import loaders as ld


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


# Sources.


def test_sources_of_both_kinds(spark, tmp_path):
    (tmp_path / "main").mkdir()
    (tmp_path / "main" / "train_prefs.jsonl").write_text(json.dumps({"prompt": "What is it?", "chosen": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a good answer"}], "rejected": [{"role": "assistant", "content": "a bad answer"}]}) + "\n")
    (tmp_path / "plain.jsonl").write_text("".join(json.dumps({"instruction": f"Say number {k}", "input": "", "output": "x" * k}) + "\n" for k in range(3, 8)))
    paths = {"alpaca_cleaned": f"file://{tmp_path}/plain.jsonl", "ultrafeedback": f"file://{tmp_path}/{{revision}}/{{split}}.jsonl"}
    both = ld.load_all(spark, paths, 4)
    assert {(r["kind"], r["source"], r["source_ord"]): r["count"] for r in both.groupBy("kind", "source", "source_ord").count().collect()} == {("sft", "alpaca_cleaned", 0): 4, ("preference", "ultrafeedback", 1): 1}
    good, bad = ld.route(both)
    assert good.count() == 3 and bad.count() == 2 and json.loads(bad.first()["raw"])["source"] == "alpaca_cleaned"
    pref, sft = ld.of_kind(good, "preference"), ld.of_kind(good, "sft")
    assert (pref.first()["chosen"], pref.first()["rejected"]) == ("a good answer", "a bad answer") and "instruction" not in pref.columns
    assert sorted(r["response"] for r in sft.collect()) == ["xxxxx", "xxxxxx"] and "prompt" not in sft.columns


def test_suites_and_labels(spark, tmp_path):
    for name in ("s1", "s2"):
        (tmp_path / f"{name}.jsonl").write_text("".join(json.dumps({"id": f"{name}{k}", "prompt": f"prompt {k}", "intent": "i"}) + "\n" for k in range(3)))
    folder = f"file://{tmp_path}"
    assert sorted((r["suite"], r["id"]) for r in ld.load_suites(spark, ["s1", "none", "s2"], folder, 2).collect()) == [("s1", "s10"), ("s1", "s11"), ("s2", "s20"), ("s2", "s21")]
    assert ld.load_suites(spark, [], folder).collect() == []
    (tmp_path / "labels.json").write_text(json.dumps([{"text": "a", "in_domain": True}, {"text": "b\nc", "in_domain": False}, {"text": "d"}, {"in_domain": True}]))
    labels = rc.hand_labels(spark, f"{folder}/labels.json")
    assert sorted(map(tuple, labels.collect())) == [("a", 1), ("b\nc", 0)]
    assert tuple(rc.label_counts(labels).first()) == (1, 1)


def test_multi_turn_subset(spark):
    long = "a question that is long enough"
    rows = [(k, random.Random(k).choice(["coding", "extraction"]), [long, "x"]) for k in range(40)] + [(90, "writing", [long]), (91, "coding", ["short"]), (92, "coding", []), (93, "coding", None), (94, None, [long])]
    df = spark.createDataFrame(rows, "question_id long, category string, turns array<string>")
    got = rc.turn_subset(df, 30).collect()
    assert len(got) == 30 == len({r["id"] for r in got}) and {r["prompt"] for r in got} == {long}
    assert got[0]["intent"] == f"Category {got[0]['category']}, question {got[0]['id'][3:]}." and (got[0]["difficulty"], got[0]["verifiable"], got[0]["suite"]) == (2, False, "mtbench_sub")
    assert {r["id"] for r in got} == {r["id"] for r in rc.turn_subset(df.repartition(4), 30).collect()} and rc.turn_subset(df, 100).count() == 40


def test_probe_prompts(spark):
    df = spark.createDataFrame([(k, f"p{k}" if k != 2 else None) for k in range(9)], "k long, prompt string")
    assert sorted(r["prompt"] for r in rc.probe_prompts(df, "k").collect()) == ["", "p0", "p1", "p3", "p4"]
    assert [r["prompt"] for r in rc.probe_prompts(df.limit(0), "k", default="d").collect()] == ["d"]


def test_log_frame(spark):
    lines = [json.dumps({"step": k, "rewards_margin": k / 2, "rewards_accuracy": 0.5, "implicit_kl": float(k)}) for k in range(30)] + ['{"step": 99}', '{"note": "x"}']
    got = rc.log_frame(ld.log_records(spark.createDataFrame([(x,) for x in lines], "value string"))).collect()
    assert [r["step"] for r in got] == [*map(float, range(11, 30)), 99.0]
    assert {r["mean_kl"] for r in got} == {14.5} and got[-1]["implicit_kl"] is None and got[0]["rewards_margin"] == 5.5


def test_manifests_and_hashes(spark, tmp_path):
    for k in "ab":
        (tmp_path / k).mkdir()
        (tmp_path / k / "manifest.json").write_text(json.dumps({"content_hash": f"{k * 12}"}))
    now = ld.manifests(spark, f"file://{tmp_path}")
    assert sorted(r["content_hash"] for r in now.collect()) == ["a" * 12, "b" * 12]
    assert [r["content_hash"] for r in ld.new_manifests(now, now.where("content_hash like 'a%'")).collect()] == ["b" * 12]
    assert one(spark, ld.last_hash_token(F.lit("wrote 0123abcd then deadbeef01 xyz12345678 1234567")), ld.last_hash_token(F.lit("none"))) == ("deadbeef01", None)
    df = ld.with_order(spark.createDataFrame([(2, "x"), (1, "x")], "a int, t string"), "a")
    assert cu.exact_dedup(df, F.col("t"), ["_ord"]).first()["a"] == 1


# Samples and splits.


def test_samples_and_limits(spark):
    rows = [(k, "python code" if k % 2 else "weather", k / 100) for k in range(100)]
    df = spark.createDataFrame(rows, "k long, t string, s double")
    picked = rc.label_sample(df, "k", "t", 10, technical_only=True)
    assert picked.count() == 10 and {r["text"] for r in picked.collect()} == {"python code"}
    new = cu.admitted_sample(df, "k", "s", 0.2, 0.3)
    assert sorted(r["k"] for r in new.collect()) == [*range(20, 30)] and cu.admitted_sample(df, "k", "s", 0.0, 0.9).count() == 15
    train, val = cu.limit_splits(df, df.where("k >= 50"), 25, "k")
    assert [r["k"] for r in train.orderBy("k").collect()] == [*range(25)] and sorted(r["k"] for r in val.collect()) == [50, 51]
    assert cu.limit_splits(df, df, 3, "k")[1].count() == 1
    firsts = cu.exact_dedup(df, F.col("t"), ["k"], "copies")
    assert tuple(cu.dedup_stats(firsts).first()) == (100, 2, 98) and tuple(cu.dedup_stats(firsts.where("k > 5")).first()) == (0, 0, 0)


# Telemetry.


def test_gates_and_tallies(spark):
    df = spark.createDataFrame([(r, s) for r in (1, 2) for s in range(1, 8)], "run long, step long")
    assert sorted(map(tuple, te.every_nth(df, 3).collect())) == [(1, 3), (1, 6), (2, 3), (2, 6)]
    runs = spark.createDataFrame([("a", "running", "old"), ("b", "running", None), ("c", "done", "kept")], "run_id string, status string, notes string")
    failed = te.fail_runs(runs, spark.createDataFrame([("a", "lost"), ("b", "lost")], "run_id string, error string"))
    assert sorted(map(tuple, failed.select("run_id", "status", "notes").collect())) == [("a", "failed", "old | lost"), ("b", "failed", "lost"), ("c", "done", "kept")]
    checks = spark.createDataFrame([("a", "ok"), ("b", "bad")], "name string, status string")
    assert [te.readiness(c).first()[0] for c in (checks, checks.where("name = 'a'"), checks.limit(0))] == [207, 200, 200]
    labels = spark.createDataFrame([([-100, 5, 6],), ([-100, -100],), ([],)], "labels array<int>")
    assert [(r["total"], r["real"], r["masked"], r["trainable"]) for r in te.label_tally(labels).collect()] == [(3, 2, 1, True), (2, 0, 2, False), (0, 0, 0, False)]
    assert [one(spark, *te.batch_plan(F.lit(free), F.lit(per))) for free, per in ((10.0, 1.0), (1.0, 2.0), (3.0, 1.0))] == [(4, 4), (1, 16), (2, 8)]


# Texts and chat.


def test_templates_and_lines(spark):
    u, a, s = F.lit("U"), F.lit("A"), F.lit("S")
    assert one(spark, tx.llama3(u, a), tx.llama3(u, a, s), chat.generic(u, a)) == (
        "<|begin_of_text|><|start_header_id|>user<|end_header_id|>\n\nU<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\nA<|eot_id|>",
        "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\nS<|eot_id|><|start_header_id|>user<|end_header_id|>\n\nU<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\nA<|eot_id|>",
        "### User:\nU\n\n### Assistant:\nA",
    )
    assert one(spark, chat.default_system(F.lit("<|im_start|>system\nBe\nkind<|im_end|>\n<|im_start|>user\nx")), chat.default_system(F.lit("<|im_start|>user\nx"))) == ("Be\nkind", "")
    assert one(spark, chat.ttft_ms(F.lit(1.0), F.lit(1.23456)), tx.telemetry_line(F.lit(12.3), F.lit(4.56), F.lit(7)), tx.telemetry_line(F.lit(None).cast("double"), F.lit(None).cast("double"), F.lit(0))) == (234.6, "TTFT 12ms · 4.6 tok/s · 7 tokens", "0 tokens")
    assert one(spark, tx.strip_fences(F.lit('```json\n{"a": 1}\n```')), tx.strip_fences(F.lit("x\n```"))) == ('{"a": 1}', "x\n```")
    df = spark.createDataFrame([("a b  c\x1cd",), ("",), (None,)], "t string")
    assert [r[0] for r in df.where("t is not null").select(tx.token_count()(F.col("t"))).collect()] == [4, 0]
    assert [r[0] for r in df.select(tx.token_count(lambda ts: [len(t) for t in ts])("t")).collect()] == [8, 0, 0]


def test_sft_batch(spark):
    rows = [("Do it", "with this", "Done", "s1"), ("Do it", "", "Done", None), (None, None, None, "s2")]
    df = spark.createDataFrame(rows, "instruction string, input string, response string, source string")
    plain = lambda u, a: F.concat(u, F.lit("|"), a)
    assert [tuple(r) for r in chat.sft_render(df, plain).collect()] == [("Do it\n\nwith this|Done", "s1"), ("Do it|Done", ""), ("|", "s2")]
    assert chat.sft_render(df.drop("source", "input")).columns == ["text", "source"]


# Records and reports.


def test_tables_for_display(spark):
    runs = spark.createDataFrame([("sft-20240101-000000-abcd", "2024-01-01T00:00:00.123456")], "run_id string, started_at string")
    assert tuple(rc.run_table(runs).first()) == ("sft-20240101", "2024-01-01T00:00:00")
    rates = spark.createDataFrame([(0.75, 0.5, 0.875), (0.5, 0.25, 0.625)], "win_rate double, ci_low double, ci_high double")
    assert [(r["below"], r["above"], r["ahead"]) for r in rc.plot_series(rates).collect()] == [(0.25, 0.125, True), (0.25, 0.125, False)]
    assert report.sweep_table([{"beta": 0.1, "win_rate": 0.5, "mean_kl": None}]) == "| beta | win_rate | mean_kl |\n|-|-|-|\n| 0.1 | 0.5 |  |\n"
    from datetime import datetime

    assert report.run_id("sft", "abcdef", datetime(2024, 1, 2, 3, 4, 5)) == "sft-20240102-030405-abcd"


def verdicts(rng, n):
    return [(rng.choice(["s", "t"]), f"c{k:04d}", *rng.choice([("base", "sft"), ("base", "dpo"), ("sft", "dpo")]), rng.choice(["model_a", "model_a", "model_b", "tie", "failed", None]), rng.random() < 0.2) for k in range(n)]


JUDGED = "suite string, case_id string, model_a string, model_b string, final_verdict string, position_bias_observed boolean"


def plain_replay(found, resamples, seed):
    valid = [v for v in found if v in ("model_a", "model_b", "tie")]
    worth, rng, n = {"model_a": 1.0, "model_b": 0.0, "tie": 0.5}, random.Random(seed), len(valid)
    if not n:
        return (0.5, 0.0, 1.0, 0)
    rates = sorted(sum(worth[rng.choice(valid)] for _ in range(n)) / n for _ in range(resamples))
    low, high = ev.interval_places(resamples)
    return (round(sum(map(worth.get, valid)) / n, 4), round(rates[low], 4), round(rates[high], 4), n)


@pytest.mark.parametrize("seed", [42, 7])
def test_replay_draws_what_the_generator_draws(spark, seed):
    rng = random.Random(seed)
    for n in (1, 2, 3, 63, 64, 65, 200):
        found = rng.choices(["model_a", "model_b", "tie", "failed"], k=n)
        got = ev.bootstrap_replay(found, 300, seed=seed)
        assert tuple(got.values()) == plain_replay(found, 300, seed)
    rows = verdicts(rng, 150)
    got = ev.replay_by(spark.createDataFrame(rows, JUDGED).repartition(5), ["suite", "model_b"], "case_id", 200, seed)
    want = {k: plain_replay([r[4] for r in rows if (r[0], r[3]) == k], 200, seed) for k in {(r[0], r[3]) for r in rows}}
    assert {(r["suite"], r["model_b"]): (r["win_rate"], r["ci_low"], r["ci_high"], r["n"]) for r in got.collect()} == want


def test_ratings_of_each_suite(spark):
    rows = verdicts(random.Random(1), 300)
    df = spark.createDataFrame(rows, JUDGED)
    for mode in ("reference", "mle"):
        got = {(r["suite"], r["model"]): r["elo"] for r in ev.ratings_by(df, "suite", mode=mode).collect()}
        for suite in ("s", "t"):
            points = {(r["model"], r["other"]): r["points"] for r in ev.pairwise_matrix(df.where(F.col("suite") == suite)).collect()}
            assert {m: e for (s, m), e in got.items() if s == suite} == ev.ratings(points, mode)
    assert ev.ratings_by(df.limit(0), "suite").collect() == [] and ev.ratings_frame(df).count() == 3


def test_all_metrics_are_one_table(spark):
    rows = verdicts(random.Random(2), 200)
    df = spark.createDataFrame(rows, JUDGED)
    said = spark.createDataFrame([(r[0], r[1], m, f"{m} answers {r[1]}", 5 + (m == "base")) for r in rows for m in r[2:4]], "suite string, case_id string, model_id string, response string, n_tokens int")
    cases = spark.createDataFrame([(r[0], r[1], "base|zzz", True) for r in rows], "suite string, id string, expected_answer string, verifiable boolean")
    doc = report.metrics(df, said, cases, resamples=200)
    own = [r[4] for r in rows if r[2:4] == ("base", "sft")]
    pair = doc["pairwise"]["base_vs_sft"]
    wins, losses, ties = (own.count(v) for v in ("model_a", "model_b", "tie"))
    assert (pair["wins"], pair["losses"], pair["ties"], pair["n"]) == (wins, losses, ties, wins + losses + ties)
    assert pair["win_rate"] == round((wins + ties / 2) / (wins + losses + ties), 4) and pair["ci_low"] <= pair["win_rate"] <= pair["ci_high"]
    assert doc["models"] == ["base", "dpo", "sft"] and doc["suites"] == ["s", "t"] and {*doc["per_suite"]["s"]["base_vs_sft"]} == {"wins", "losses", "ties", "failed", "n", "win_rate"}
    assert doc["exact_match"]["base"]["score"] == 1.0 and doc["exact_match"]["sft"]["score"] == 0.0
    assert doc["length_controlled"]["base_vs_sft"]["n_discarded"] == 0 and set(doc["elo"]) == {"base", "dpo", "sft"}
    assert "base_vs_sft" in report.markdown(doc)


# Comparisons, retries, both dedups, outputs.


def test_compare_isolates_a_failing_engine(spark):
    def broken(p):
        raise ValueError(f"no {p}")

    got = ev.compare(spark.createDataFrame([(1, "a"), (2, "b")], "request_id long, prompt string"), {"up": str.upper, "broken": broken})
    rows = sorted((r["request_id"], r["model_id"], r["response"], r["error"]) for r in got.collect())
    assert rows == [(1, "broken", "", "no a"), (1, "up", "A", None), (2, "broken", "", "no b"), (2, "up", "B", None)]
    assert all(r["time_ms"] >= 0 for r in got.collect()) and ev.compare(spark.createDataFrame([], "request_id long, prompt string"), {"up": str.upper}).count() == 0


def test_unreadable_answers_are_asked_again(spark, tmp_path):
    from millrace.operators.judging import Calls, ask_until_readable

    def fn(prompts):
        return ['{"verdict": "A"}' if p in ("good", "late#2") else None if p == "gone" else "mumble" for p in prompts]

    df = spark.createDataFrame([("good",), ("late",), ("never",), ("gone",), (None,)], "p string")
    got = ask_until_readable(df, "p", "j", fn, Calls(spark, f"file://{tmp_path}"), lambda p, k: f"{p}#{k}")
    assert {r["p"]: (r["verdict"], r["tries"]) for r in got.collect()} == {"good": ("A", 1), "late": ("A", 3), "never": (None, 3), "gone": (None, 3), None: (None, 1)}


def test_both_dedups_and_what_they_take(spark):
    from millrace.operators import near_dup as nd
    from millrace.plans.scratch import writer

    long = " ".join(f"w{k}" for k in range(80))
    df = spark.createDataFrame([(0, long), (1, long), (2, long + " x"), (3, "another text"), (None, long)], "id long, t string")
    for verify in (None, 0.85):
        rows, stats = nd.deduplicate(df, "id", "t", writer(spark), verify)
        assert tuple(stats.first()) == (2, 1, 3) and rows.columns == ["id", "t"] and rows.count() == 2
    rows, stats = nd.deduplicate(df.limit(0), "id", "t", writer(spark))
    assert rows.collect() == [] and tuple(stats.first()) == (0, 0, 0)


def test_outputs_and_flags(spark):
    said = F.lit("\x1b[32mRun ID: sft-1\x1b[0m\nRun ID:  \x1b[1;31mdpo-2\x1b[0m done")
    assert one(spark, tx.strip_ansi(F.lit("\x1b[1;31mred\x1b[0m")), tx.run_id_of(said), tx.run_id_of(F.lit("nothing"))) == ("red", "dpo-2", None)
    assert one(spark, ev.biased(F.lit(0.31)), ev.biased(F.lit(0.3)), ev.biased(F.lit(None).cast("double"))) == (True, False, False)
