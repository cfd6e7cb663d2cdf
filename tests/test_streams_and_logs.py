"""Token streams that end apart, the log folder's source in batch and as a tail, and the older stream functions."""

import json
import random

import pandas as pd
from pyspark.sql import functions as F

from millrace.sources import loaders as ld
from millrace.sources import log_folder as lf
from millrace.streaming import streams
from millrace.streaming import token_streams as tk


def delta(text):
    return "data: " + json.dumps({"choices": [{"delta": {"content": text}}]})


def run_once(stream, folder, name, mode="append"):
    q = stream.writeStream.format("parquet").option("path", f"file://{folder}/{name}").option("checkpointLocation", f"file://{folder}/{name}-cp").trigger(availableNow=True).outputMode(mode).start()
    q.awaitTermination()
    assert q.exception() is None


def put(folder, name, rows):
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def line(stream, seq, second, value=None, error=None):
    return {"stream_id": stream, "seq": seq, "ts": f"2024-01-01T00:00:{second:02d}Z", "value": value, "error": error}


def test_streams_end_apart(spark, tmp_path):
    """Two interleaved streams, one of which ends and one fails, and one that falls silent."""
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    stream = tk.events(spark.readStream.schema(tk.LINE).json(f"file://{source}"), gap_ms=5000)

    def step(k, rows):
        put(source, f"{k}.json", rows)
        run_once(stream, out, "events")

    step(0, [line("a", 0, 1, delta("A0")), line("b", 0, 1, delta("B0")), line("a", 2, 1, "data: [DONE]"), line("a", 1, 1, delta("A1")), line("c", 0, 1, delta("C0")), line("b", 1, 1, "data: {broken")])
    step(1, [line("a", 3, 2, delta("late words")), line("b", 2, 2, None, "connection lost"), line("b", 3, 2, delta("never")), line("d", 0, 2, delta("D0"))])
    step(2, [line("d", 1, 20, delta("D1")), line("d", 2, 20, delta("") + "x")])
    step(3, [line("d", 3, 21, delta("D2")), line("c", 1, 21, delta("too late"))])
    step(4, [line("d", 4, 22, "data: [DONE]"), line("b", 9, 22, delta("never"))])
    got = {}
    for r in sorted(spark.read.parquet(f"file://{out}/events").collect(), key=lambda r: (r["seq"], r["kind"])):
        got.setdefault(r["stream_id"], []).append((r["kind"], r["content"]))
    assert got["a"] == [("token", "A0"), ("token", "A1"), ("end", None)]
    assert got["b"] == [("token", "B0"), ("error", "connection lost")]
    assert got["c"] == [("token", "C0"), ("timeout", None)]
    assert [e for e in got["d"] if e[0] != "timeout"][-1] in [("end", None), ("token", "D0")] and got["d"][0] == ("token", "D0")


def test_ndjson_and_sse_lines():
    assert [tk.sse_line(x) for x in (delta("hi"), "data: [DONE]", ": ping", "data: 3", 'data: {"choices": []}', 'data: {"choices": [{"delta": {"content": ""}}]}', "data:x")] == [("hi", False), (None, True)] + [(None, False)] * 5
    assert [tk.ndjson_line(x) for x in ('{"message": {"content": "hi"}}', '{"done": true}', '{"message": {"content": "x"}, "done": true}', "{", "[1]", '{"message": null}')] == [("hi", False), (None, True), ("x", True)] + [(None, False)] * 3


def test_streams_at_rest_and_fan_in(spark):
    own = lambda rows: spark.createDataFrame(rows, "seq long, ts string, value string, error string")
    lines = tk.fan_in({"x": own([(0, None, delta("a"), None), (2, None, delta("c"), None), (1, None, "data: [DONE]", None)]), "y": own([(0, None, delta("b"), None), (1, None, None, "gone"), (2, None, delta("d"), None)]), "z": own([(0, None, delta("e"), None)]).drop("error")})
    got = sorted(tuple(r) for r in tk.batch_events(lines).collect())
    assert got == [("x", 0, "token", "a"), ("x", 1, "end", None), ("y", 0, "token", "b"), ("y", 1, "error", "gone"), ("z", 0, "token", "e")]
    assert tk.batch_events(lines.limit(0)).collect() == []


def test_content_by_stream(spark):
    rows = [("a", 0, delta("1")), ("b", 1, delta("2")), ("a", 2, "data: [DONE]"), ("b", 3, delta("3")), ("a", 4, delta("4"))]
    df = spark.createDataFrame(rows, "s string, _ord long, value string")
    assert sorted(r["content"] for r in ld.sse_content(df, "s").collect()) == ["1", "2", "3"]
    assert sorted(r["content"] for r in ld.sse_content(df).collect()) == ["1", "2"]
    said = spark.createDataFrame([("a", 0, '{"message": {"content": "x"}}'), ("a", 1, '{"done": true}'), ("b", 2, "{")], "s string, _ord long, value string")
    assert sorted(map(tuple, ld.ndjson_content(said, "s").collect())) == [("a", 0, "x", False), ("a", 1, None, True)]


# The log folder.


def logs(rng, n):
    kinds = ['{"event": "step", "run_id": "r1", "k": %d}', '{"event": "end", "run_id": "r2", "k": %d}', "step {not json %d", "", '{"event": 5, "run_id": null, "k": %d}', '{"event": "step", "text": "é日本 %d"}', "[%d]"]
    return [k % i if "%d" in k else k for i, k in enumerate(rng.choices(kinds, k=n))]


def plain(folder):
    out = []
    for f in sorted(folder.iterdir()):
        at = 0
        for raw in f.read_bytes().split(b"\n"):
            if raw.strip():
                try:
                    got = json.loads(raw)
                except ValueError:
                    got = None
                own = [got.get(c) if isinstance(got, dict) else None for c in lf.FIELDS]
                out.append((f.name, at, raw.decode(), *(x if isinstance(x, str) or x is None else json.dumps(x) for x in own)))
            at += len(raw) + 1
    return out


def test_lines_in_any_blocks(spark, tmp_path):
    rng = random.Random(3)
    folder = tmp_path / "log"
    assert lf.read_log(spark, f"file://{folder}").collect() == []
    folder.mkdir()
    for name, n in (("b.jsonl", 60), ("a.jsonl", 5), ("c.jsonl", 0)):
        (folder / name).write_text("\n".join(logs(rng, n)) + ("\n" if n == 60 else ""))
    (folder / "other.txt").write_text("{}\n")
    want = [r for r in plain(folder) if r[0].endswith(".jsonl")]
    for block in (1, 7, 64, 1 << 20):
        assert [tuple(r) for r in lf.read_log(spark, f"file://{folder}", block=block).orderBy("file", "pos").collect()] == want
    read = lf.read_log(spark, f"file://{folder}")
    for test, fits in (("event = 'step'", lambda r: r[3] == "step"), ("file = 'a.jsonl'", lambda r: r[0] == "a.jsonl"), ("event = '5'", lambda r: r[3] == "5"), ("run_id = 'r2' and event = 'end'", lambda r: r[3:] == ("end", "r2")), ("event is null", lambda r: r[3] is None)):
        assert sorted(tuple(r) for r in read.where(test).collect()) == sorted(r for r in want if fits(r))


def test_pushed_tests_leave_files_out(tmp_path):
    from pyspark.sql.datasource import EqualTo

    for name in ("a.jsonl", "b.jsonl"):
        (tmp_path / name).write_text('{"event": "x"}\n{"event": "y"}\n')
    reader = lf._Batch({"path": str(tmp_path)})
    pushed = [EqualTo(("file",), "b.jsonl"), EqualTo(("event",), "y")]
    assert [*reader.pushFilters(pushed)] == pushed
    pieces = reader.partitions()
    assert [p.file for p in pieces] == ["b.jsonl"] and [r[2] for r in reader.read(pieces[0])] == ['{"event": "y"}']


def test_the_tail_goes_on_where_it_was(spark, tmp_path):
    """Lines that are added, a line that isn't whole yet, new files and a restart: in the end the rows of a batch read, each once."""
    rng = random.Random(4)
    folder, out = tmp_path / "log", tmp_path / "out"
    folder.mkdir()
    lines = logs(rng, 40)
    (folder / "b.jsonl").write_text("\n".join(lines[:10]) + "\n" + '{"event": "ha')
    run_once(lf.tail_log(spark, f"file://{folder}", block=50), out, "tail")
    first = spark.read.parquet(f"file://{out}/tail").count()
    assert first == len([r for r in plain(folder) if r[0] == "b.jsonl"]) - 1
    with open(folder / "b.jsonl", "a") as f:
        f.write('lf"}\n' + "\n".join(lines[10:25]) + "\n")
    (folder / "a.jsonl").write_text("\n".join(lines[25:]) + "\n")
    for _ in range(2):  # the second time there is nothing new
        run_once(lf.tail_log(spark, f"file://{folder}", block=50), out, "tail")
        got = sorted(tuple(r) for r in spark.read.parquet(f"file://{out}/tail").collect())
        assert got == sorted(plain(folder)) == sorted(tuple(r) for r in lf.read_log(spark, f"file://{folder}").collect())


# Older functions without a test of their own.


def test_log_tail_and_running_mean(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.txt").write_text('{"event": "x", "run_id": "r", "v": 1}\n{"event": "y"}\nx {\n')
    tail = streams.tail_logs(spark, f"file://{source}", event="x", run_id="r")
    run_once(tail.select(F.col("r")["v"].alias("v")), tmp_path, "tail")
    assert [r["v"] for r in spark.read.parquet(f"file://{tmp_path}/tail").collect()] == ["1"]
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "k string, v double")
    df.coalesce(1).write.json(f"file://{tmp_path}/values")
    q = streams.running_mean(spark.readStream.schema(df.schema).json(f"file://{tmp_path}/values"), "k", "v").writeStream.format("memory").queryName("means").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("means").collect())) == [("a", 2.0, 2), ("b", None, 0)]


def test_stream_telemetry(spark):
    rows = [("a", f"2024-01-01 00:00:{s:02d}") for s in (0, 1, 2, 4)] + [("b", "2024-01-01 00:00:00"), ("a", "2024-01-01 01:00:00")]
    df = spark.createDataFrame(rows, "stream_id string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    got = sorted((r["stream_id"], r["n_tokens"], r["tokens_per_s"]) for r in streams.stream_telemetry(df).collect())
    assert sorted(got, key=str) == sorted([("a", 4, 1.0), ("a", 1, None), ("b", 1, None)], key=str)


def test_spoken_frames_are_in_order():
    rows = pd.DataFrame([(1, delta("b"), None), (2, "data: [DONE]", None), (3, delta("c"), None)], columns=["seq", "value", "error"])
    assert tk.spoken(rows, "sse") == ([(1, "token", "b"), (2, "end", None)], True)
