"""Judging once, resumed runs and the keyed sink, with calls and files counted."""

import os

import pytest
from pyspark.sql import functions as F

from millrace.operators import evaluation as ev
from millrace.operators import judging as jd
from millrace.sources.files import Files
from millrace.streaming.keyed_sink import KeyedSink

PAIRS = "case_id string, prompt string, intent string, response_a string, response_b string"


def counting(path, answer=lambda p: '{"verdict": "A"}'):
    """A judge that notes each prompt in a file; the workers are on this machine."""

    def judge(prompts):
        with open(path, "a") as f:
            f.writelines("x\n" for _ in prompts)
        return [answer(p) for p in prompts]

    return judge


def lines(path):
    return len(open(path).readlines()) if os.path.exists(path) else 0


def some_pairs(spark):
    return spark.createDataFrame([("1", "q", "i", "x", "y"), ("2", "q", "i", "x", "y"), ("3", "q", "i", "z", "y"), ("4", None, "i", "z", "y")], PAIRS)


def test_a_filter_on_verdicts_asks_no_second_time(spark, tmp_path):
    log = str(tmp_path / "log")
    judged = ev.judge(some_pairs(spark).where("prompt is not null"), counting(log)).where("verdict_ab = 'A' and final_verdict = 'tie'")
    assert judged.count() == 3 and lines(log) == 6


def test_prompts_are_asked_once(spark, tmp_path):
    log, calls = str(tmp_path / "log"), jd.Calls(spark, f"file://{tmp_path}/calls", wave=2)
    judged = jd.judge_once(some_pairs(spark), "j", counting(log), calls)
    assert lines(log) == 4  # two orders of two different pairs
    assert judged.where("final_verdict = 'tie'").count() == 3 and judged.where("position_bias_observed").count() == 3
    assert [r["final_verdict"] for r in judged.where("case_id = '4'").collect()] == ["failed"]
    jd.judge_once(some_pairs(spark), "j", counting(log), calls).collect()
    assert lines(log) == 4
    jd.judge_once(some_pairs(spark), "another", counting(log), calls).collect()
    assert lines(log) == 8


def test_failed_calls_are_kept_apart_and_asked_again_if_wanted(spark, tmp_path):
    def fails(prompts):
        if any("z" in p for p in prompts):
            raise ValueError("no")
        return ['{"verdict": "B"}' for _ in prompts]

    calls = jd.Calls(spark, f"file://{tmp_path}/calls")
    prompts = spark.createDataFrame([("a",), ("z",), ("b",), ("a",)], "p string")
    calls.ask(prompts, "p", "j", fails)
    assert sorted((r["raw"] is None, r["answered"]) for r in calls.table().collect()) == [(False, True), (False, True), (True, False)]
    calls.ask(prompts, "p", "j", lambda ps: ["late" for _ in ps])
    assert {r["p"]: r["raw"] for r in calls.answers(prompts, "p", "j", "raw").collect()}["z"] is None
    calls.ask(prompts, "p", "j", lambda ps: ["late" for _ in ps], again=True)
    assert {r["p"]: r["raw"] for r in calls.answers(prompts, "p", "j", "raw").collect()} == {"a": '{"verdict": "B"}', "b": '{"verdict": "B"}', "z": "late"}


def test_a_lost_wave_alone_is_asked_again(spark, tmp_path):
    log, flag, calls = str(tmp_path / "log"), tmp_path / "flag", jd.Calls(spark, f"file://{tmp_path}/calls", wave=10)
    flag.touch()
    prompts = spark.range(40).select(F.col("id").cast("string").alias("p"))
    half = F.pmod(F.xxhash64(jd.call_key("j", F.col("p"))), F.lit(4)) == 2
    lost = {r["p"] for r in prompts.where(half).collect()}

    def dies(asked):
        if flag.exists() and lost & {*asked}:
            os._exit(1)
        return counting(log)(asked)

    with pytest.raises(Exception):
        calls.ask(prompts, "p", "j", dies)
    before = lines(log)
    assert 0 < before < 40
    flag.unlink()
    calls.ask(prompts, "p", "j", dies)
    assert calls.table().where("answered").count() == 40
    assert lines(log) <= 40 + len(lost)


def responses(spark, models, cases):
    rows = [(s, c, m, f"prompt {c}", f"{m} says {c}", None) for m in models for s, c in cases] + [("s", "c9", models[0], "p", "", "timeout")]
    return spark.createDataFrame(rows, "suite string, case_id string, model_id string, prompt string, response string, error string")


def test_a_run_is_resumed(spark, tmp_path):
    log, folder = str(tmp_path / "log"), f"file://{tmp_path}/judgements"
    calls = jd.Calls(spark, f"file://{tmp_path}/calls")
    cases = [("s", f"c{k}") for k in range(4)] + [("t", "c0")]
    said = responses(spark, ["base", "sft", "dpo"], cases)
    known = spark.createDataFrame([("s", "c0", "prompt c0", "why")], "suite string, id string, prompt string, intent string")
    run = lambda limit=None: {(r["model_a"], r["model_b"]): (r["completed"], r["failed"]) for r in jd.run_judging(said, known, ["base", "sft", "dpo"], "j", counting(log), calls, folder, limit).collect()}
    pairs = [("base", "sft"), ("base", "dpo"), ("sft", "dpo")]
    assert run(1) == dict.fromkeys(pairs, (2, 0)) and lines(log) == 12
    assert run() == dict.fromkeys(pairs, (3, 0)) and lines(log) == 30
    assert run() == {} and lines(log) == 30
    rows = KeyedSink(folder, jd.JUDGED).rows(spark)
    assert rows.count() == rows.select(*jd.JUDGED).distinct().count() == 15


def test_generation_is_once_and_keeps_errors(spark, tmp_path):
    def generate(p):
        if p == "bad":
            raise ValueError("no")
        return p.upper(), 3

    cases = spark.createDataFrame([("1", "s", "ok"), ("2", "s", "bad"), ("3", "s", "ok")], "id string, suite string, prompt string")
    got = jd.generate_once(cases, "m", generate, jd.Calls(spark, f"file://{tmp_path}/calls"))
    assert sorted(tuple(r[c] for c in ("case_id", "response", "n_tokens", "error")) for r in got.collect()) == [("1", "OK", 3, None), ("2", "", 0, "no"), ("3", "OK", 3, None)]
    plain = ev.generate(cases, "m", generate, spark.createDataFrame([("m", "s", "1")], "model_id string, suite string, case_id string"))
    assert sorted(tuple(r[c] for c in ("case_id", "response", "error")) for r in plain.where("n_tokens >= 0").collect()) == [("2", "", "no"), ("3", "OK", None)]


# The sink.


def batch(spark, *ks, v="v"):
    return spark.createDataFrame([(k, f"{v}{k}") for k in ks], "k long, _k string")


def have(sink, spark):
    return sorted(((r["k"], r["_k"]) for r in sink.rows(spark).collect()), key=str)


def test_batches_run_again_lose_and_double_nothing(spark, tmp_path):
    sink = KeyedSink(f"file://{tmp_path}/sink", ["k"], buckets=4, most=2)
    assert sink.rows(spark) is None and sink.rows(spark, "k long").collect() == []
    sink.write(batch(spark, 1, 2, 2, None), 0)
    sink.write(batch(spark, 1, 2, None), 0)
    sink.write(batch(spark, 2, 3, None, v="w"), 1)
    sink.write(batch(spark, 2, 3, None, v="w"), 1)
    sink.write(batch(spark, 1, 2, None), 0)
    assert have(sink, spark) == sorted([(1, "v1"), (2, "v2"), (None, "vNone"), (3, "w3")], key=str)
    sink.write(batch(spark).limit(0), 2)
    assert len(have(sink, spark)) == 4


def test_a_batch_that_stops_before_its_commit_is_written_anew(spark, tmp_path, monkeypatch):
    sink = KeyedSink(f"file://{tmp_path}/sink", ["k"], buckets=2)
    sink.write(batch(spark, 1), 0)
    with monkeypatch.context() as m:
        m.setattr(Files, "put", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            sink.write(batch(spark, 1, 2, 3), 1)
    assert have(sink, spark) == [(1, "v1")]
    sink.write(batch(spark, 1, 2, 4), 1)
    assert have(sink, spark) == [(1, "v1"), (2, "v2"), (4, "v4")]
    sink.write(batch(spark, 3, 4), 2)
    assert have(sink, spark) == [(1, "v1"), (2, "v2"), (3, "v3"), (4, "v4")]


def test_many_batches_read_few_files(spark, tmp_path, monkeypatch):
    """However many batches came before, one reads at most ``most`` folders of keys a bucket."""
    sink = KeyedSink(f"file://{tmp_path}/sink", ["k"], buckets=2, most=3)
    read = []
    held = KeyedSink._held

    def noted(self, spark, places, buckets):
        read.append(sum(len(places.get(str(b), [])) for b in buckets))
        return held(self, spark, places, buckets)

    monkeypatch.setattr(KeyedSink, "_held", noted)
    for epoch in range(14):
        sink.write(batch(spark, 2 * epoch, 2 * epoch + 1, 2 * epoch + 2), epoch)
    assert [k for k, _ in have(sink, spark)] == sorted(range(29), key=str) or {k for k, _ in have(sink, spark)} == {*range(29)}
    assert len(have(sink, spark)) == 29 and max(read) <= 6


def test_stream_into_the_sink(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    schema = "k long, _k string"
    batch(spark, 1, 2).coalesce(1).write.mode("append").json(f"file://{source}")
    sink = KeyedSink(f"file://{tmp_path}/sink", ["k"], buckets=2)
    for ks in ((2, 3), (3, 4)):
        q = spark.readStream.schema(schema).json(f"file://{source}").writeStream.foreachBatch(sink.write).option("checkpointLocation", f"file://{tmp_path}/cp").trigger(availableNow=True).start()
        q.awaitTermination()
        batch(spark, *ks).coalesce(1).write.mode("append").json(f"file://{source}")
    assert [k for k, _ in have(sink, spark)] == [1, 2, 3]
