"""Token streams by key: each ends by its own sentinel, error or time-out, and stops no other.

Lines are rows (stream_id, seq, ts, value, error); ``events`` gives rows (stream_id, seq, kind, content): a token with its text, one end, one error with
its message, or one time-out.  A stream's state is whether it is over and when it was last heard of.  Timers go by event time: a stream that says
nothing for ``gap`` ends with a time-out, and the state of one that is over is forgotten after ``keep``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

#: Columns of a line and of an event.
LINE = "stream_id string, seq long, ts timestamp, value string, error string"
EVENT = "stream_id string, seq long, kind string, content string"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def sse_line(line: str) -> tuple[str | None, bool]:
    """(text, over) of a line of server-sent events: the first choice's delta; other lines and unreadable frames say nothing."""
    if not line.startswith("data: "):
        return None, False
    frame = line[6:]
    if frame == "[DONE]":
        return None, True
    try:
        said = json.loads(frame)["choices"][0]["delta"].get("content")
    except (ValueError, LookupError, TypeError, AttributeError):
        return None, False
    return (said if isinstance(said, str) and said else None), False


def ndjson_line(line: str) -> tuple[str | None, bool]:
    """(text, over) of a JSON line with a message and a flag; unreadable lines say nothing."""
    try:
        frame = json.loads(line)
        said = (frame.get("message") or {}).get("content")
    except (ValueError, AttributeError):
        return None, False
    return (said if isinstance(said, str) and said else None), frame.get("done") is True


FORMS = {"sse": sse_line, "ndjson": ndjson_line}


def spoken(rows: pd.DataFrame, form: str) -> tuple[list[tuple], bool]:
    """Events (seq, kind, content) of one stream's lines in order, up to its end, and whether it is over."""
    out, read = [], FORMS[form]
    for seq, value, error in zip(rows["seq"], rows["value"], rows["error"]):
        if isinstance(error, str):
            return [*out, (seq, "error", error)], True
        text, over = read(value) if isinstance(value, str) else (None, False)
        if text is not None:
            out.append((seq, "token", text))
        if over:
            return [*out, (seq, "end", None)], True
    return out, False


def _frame(stream: str, events: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame([(stream, *e) for e in events], columns=["stream_id", "seq", "kind", "content"])


class _Streams(StatefulProcessor):
    def __init__(self, form: str, gap_ms: int, keep_ms: int):
        self.form, self.gap_ms, self.keep_ms = form, gap_ms, keep_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("stream", "over boolean, heard long, seq long")

    def _wake(self, at: int) -> None:
        for timer in [*self.handle.listTimers()]:
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(at)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        over, heard, last = self.state.get() if self.state.exists() else (False, 0, -1)
        lines = pd.concat([*rows])
        if over:
            return
        lines = lines.sort_values("seq", kind="stable")
        events, over = spoken(lines, self.form)
        heard = max(heard, int(lines["ts"].max().value // 1_000_000))
        self.state.update((over, heard, max(last, int(lines["seq"].max()))))
        self._wake(heard + (self.keep_ms if over else self.gap_ms))
        if events:
            yield _frame(key[0], events)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        over, heard, last = self.state.get() if self.state.exists() else (True, 0, -1)
        if over:
            self.state.clear()
            return
        self.state.update((True, heard, last))
        self.handle.registerTimer(heard + self.gap_ms + self.keep_ms)
        yield _frame(key[0], [(last + 1, "timeout", None)])

    def close(self) -> None:
        pass


def events(lines: DataFrame, form: str = "sse", gap_ms: int = 60_000, keep_ms: int = 3_600_000, delay: str = "0 seconds") -> DataFrame:
    """Events of a stream of lines; ``form`` is sse or ndjson.

    A batch of lines may hold many streams, interleaved; within a batch a stream's lines are taken in order of seq.  Lines behind a
    stream's end are dropped, and lines later than ``delay`` are late.  State is kept in RocksDB, which the session is told if it
    has Spark's default.
    """
    spark = lines.sparkSession
    if not spark.conf.get(_PROVIDER, "").endswith("RocksDBStateStoreProvider"):
        spark.conf.set(_PROVIDER, _ROCKS)
    known = lines.withColumn("error", F.col("error") if "error" in lines.columns else F.lit(None).cast("string"))
    rows = known.select(*(F.col(n).cast(t).alias(n) for n, t in (f.split() for f in LINE.split(", ")))).withWatermark("ts", delay)
    return rows.groupBy("stream_id").transformWithStateInPandas(_Streams(form, gap_ms, keep_ms), EVENT, "append", "eventtime")


def fan_in(streams: dict[str, DataFrame]) -> DataFrame:
    """Several columns' lines (seq, ts, value and perhaps error) as one stream: stream_id names the column.  A column that fails
    sends a row with an error, and ``events`` ends that column alone."""
    parts = [s.withColumns({"stream_id": F.lit(name), "error": F.col("error") if "error" in s.columns else F.lit(None).cast("string")}) for name, s in streams.items()]
    return reduce(DataFrame.unionByName, parts)


def batch_events(lines: DataFrame, form: str = "sse") -> DataFrame:
    """The same of lines that are at rest, without time-outs: a stream is one task's work, of which only its lines are held."""

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        return _frame(key[0], spoken(rows.sort_values("seq", kind="stable"), form)[0])

    known = lines.withColumn("error", F.col("error") if "error" in lines.columns else F.lit(None).cast("string"))
    return known.select(F.col("stream_id").cast("string").alias("stream_id"), F.col("seq").cast("long").alias("seq"), "value", "error").groupBy("stream_id").applyInPandas(run, EVENT)
