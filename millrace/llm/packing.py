"""Sequence packing by few-document length patterns fitted with non-negative least squares.

The histogram of piece lengths (at most ``capacity`` entries, whatever the corpus) is all the driver sees.  Patterns of
one to four lengths that nearly fill a sequence are enumerated from it; repeat counts are fitted to the histogram by
non-negative least squares and rounded down; what is left of the histogram is packed best-fit, each step repeating one
combination as often as its lengths last.  The plan maps runs of ranks within a length to runs of sequences, so every
piece finds its place from its rank: ranks are counted within tasks and offset by prefix sums over tasks, no window
gathers the pieces of one length.

Defined results: a null text is an empty text, whose sequence is the closing id alone; longer documents than
``capacity`` are cut into full pieces and a shorter last one; texts of any length are encoded whole; null ids and repeated
rows are packed each; ties of lengths are broken by task and place in it, so only numbers of sequences differ; other
columns, whatever their names, are ignored; no rows give no rows.
"""

from __future__ import annotations

import bisect
import os
import zlib
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, batches, maybe_broadcast


class ChunkIds:
    """Blank-delimited chunk of text to its ids as little-endian bytes, in two bounded generations.

    The tokenizer's pre-tokens never cross white space, so a text's ids are those of its chunks in order; chunks that
    hold other white space go to the tokenizer as they are.  Where lower-casing is one to one (Latin-1) chunks are known by
    their lower case, unless the text may hold a special token, which is known by its case.  A Latin-1 letter or a digit, which
    normalisation leaves one letter or digit, and a stop behind it are never one pre-token, so they are parted.  A chunk
    of Latin-1 letters alone is one pre-token and needs the tokenizer's model only.
    """

    STOPS = r"([A-Za-z0-9À-ÖØ-öø-ÿ])([.,;:!?])"

    def __init__(self, path: str, limit: int = 100_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.model, self.shown = self.tokenizer.model, byte_signs()
        self.limit, self.now, self.older = limit, {}, {}

    def add(self, chunks: list[str]) -> None:
        """Encodes chunks that aren't known yet, together."""
        if len(self.now) > self.limit:
            self.older, self.now = self.now, {}
        new = []
        for c in chunks:
            if (known := self.older.get(c)) is not None:
                self.now[c] = known
            elif c.isascii() and c.isalpha():
                self.now[c] = array("I", [t.id for t in self.model.tokenize(c.lower())]).tobytes()
            elif c.isalpha() and is_latin(c):
                self.now[c] = array("I", [t.id for t in self.model.tokenize(c.lower().encode().decode("latin-1").translate(self.shown))]).tobytes()
            else:
                new.append(c)
        encoded = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        self.now.update((c, array("I", e.ids).tobytes()) for c, e in zip(new, encoded))

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row and where each text's begin, with the end; each distinct chunk is looked up once."""
        low = pa.array([t if "<|" in t or not is_latin(t) else t.lower() for t in texts], pa.string())
        split = pc.split_pattern(pc.replace_substring_regex(pc.replace_substring(low, "\n", " "), self.STOPS, r"\1 \2"), " ")
        coded = split.flatten().dictionary_encode()
        kinds, which = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        parts = [*map(self.now.get, kinds)]
        if None in parts:
            self.add([c for c, p in zip(kinds, parts) if p is None])
            parts = [self.now[c] if p is None else p for c, p in zip(kinds, parts)]
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        flat = np.frombuffer(b"".join(parts), "<u4")
        counts = lengths[which]
        ends = np.concatenate([[0], np.cumsum(counts)])
        take = np.repeat((np.cumsum(lengths) - lengths)[which] - ends[:-1], counts) + np.arange(ends[-1])
        return flat[take], ends[split.offsets.to_numpy()]


def byte_signs() -> dict[int, str]:
    """The sign by which a byte-level vocabulary writes a byte: itself if it can be seen, else one after U+0100 in order."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(seen)]
    return {b: chr(b) for b in seen} | {b: chr(256 + k) for k, b in enumerate(rest)}


_KNOWN: dict[str, ChunkIds] = {}


def known_chunks(path: str) -> ChunkIds:
    """The worker's cache: tasks that a worker runs one after another share it."""
    if path not in _KNOWN:
        _KNOWN[path] = ChunkIds(path)
    return _KNOWN[path]


def is_latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def pieces(docs: DataFrame, path: str, capacity: int = 4096, closing: int = 1, keep_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, task, nth (rank among the task's pieces of that length)[, ids]."""

    def run(iterator):
        from pyspark import TaskContext

        task, known, counts = TaskContext.get().partitionId(), known_chunks(path), {}
        end = np.array([closing], "<u4").tobytes()
        for part, texts in batches(iterator, size=512):
            rows: list[tuple] = []
            flat, bounds = known.ids(texts)
            for doc, begin, stop in zip(part.column(0).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                data = flat[begin:stop].tobytes() + end
                for k, at in enumerate(range(0, len(data), 4 * capacity)):
                    own = data[at : at + 4 * capacity]
                    n = len(own) // 4
                    nth = counts.get(n, 0)
                    counts[n] = nth + 1
                    rows.append((doc, k, at // 4, n, zlib.crc32(own), task, nth, np.frombuffer(own, "<i4") if keep_ids else None))
            columns = [*zip(*rows)]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()] + [pa.list_(pa.int32())] * keep_ids
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"] + ["ids"] * keep_ids)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long" + ", ids array<int>" * keep_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def enumerate_patterns(lengths: np.ndarray, counts: np.ndarray, capacity: int, fills: int = 12) -> list[tuple[int, ...]]:
    """Patterns of one to four lengths: each length with itself alone, a best partner, and best last of three and four.

    The middle members come from ``fills`` quantiles of the histogram, so there are at most (2 + 2 * fills) * capacity.
    """
    present = np.zeros(capacity + 1, np.int64)
    present[lengths] = lengths
    best = np.maximum.accumulate(present)  # the largest present length up to each
    at = np.searchsorted(np.cumsum(counts), np.linspace(0, counts.sum() - 1, fills).astype(np.int64), side="right")
    middles = [*dict.fromkeys(lengths[np.minimum(at, len(lengths) - 1)].tolist())]
    found = {(int(x),) for x in lengths}
    for x in lengths.tolist():
        if (y := int(best[capacity - x])) > 0:
            found.add(tuple(sorted((x, y), reverse=True)))
        for m in middles:
            if (rest := capacity - x - m) > 0 and (y := int(best[rest])) > 0:
                found.add(tuple(sorted((x, m, y), reverse=True)))
                if rest - m > 0 and (z := int(best[rest - m])) > 0:
                    found.add(tuple(sorted((x, m, m, z), reverse=True)))
    return sorted(found, reverse=True)


def fit_repeats(patterns: list[tuple[int, ...]], counts: np.ndarray, capacity: int, rounds: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - histogram|^2 / 2 + waste . x, by accelerated projected gradients.

    A's columns are the patterns; the small linear term prefers fuller ones among equal fits.
    """
    column = np.repeat(np.arange(len(patterns)), [len(p) for p in patterns])
    row = np.array([*chain.from_iterable(patterns)], np.int64)
    target = counts.astype(float)
    scale = max(1.0, target.max(initial=1.0))
    target = target / scale
    waste = np.array([capacity - sum(p) for p in patterns], float) / capacity * 0.02
    apply = lambda x: np.bincount(row, x[column], len(target))
    back = lambda y: np.bincount(column, y[row], len(patterns))
    v = np.ones(len(patterns))
    for _ in range(20):
        v = back(apply(v))
        norm = np.linalg.norm(v)
        v /= norm or 1.0
    step = 1.0 / (norm or 1.0)
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0.0, y - step * (back(apply(y) - target) + waste))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x * scale


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) whose lengths add up to the histogram, none above capacity."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    out: list[tuple[tuple[int, ...], int]] = []
    if left[capacity]:
        out.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    lengths = np.flatnonzero(left)
    if len(lengths):
        patterns = enumerate_patterns(lengths, left[lengths], capacity)
        repeats = np.floor(fit_repeats(patterns, left, capacity)).astype(np.int64)
        for k in sorted(np.flatnonzero(repeats).tolist(), key=lambda i: (capacity - sum(patterns[i]), -int(repeats[i]))):
            p = patterns[k]
            if sum(p) < 0.998 * capacity:
                continue  # its lengths do better among the residuals
            n = min(int(repeats[k]), *(int(left[x]) // p.count(x) for x in set(p)))
            if n > 0:
                out.append((p, n))
                for x in p:
                    left[x] -= n
    # Residuals: the longest first, each time filled with the longest that fits.
    alive = sorted(np.flatnonzero(left).tolist())
    while alive:
        used: dict[int, int] = {}
        members, room = [], capacity
        while True:
            i = bisect.bisect_right(alive, room) - 1
            while i >= 0 and left[alive[i]] <= used.get(alive[i], 0):
                i -= 1
            if i < 0:
                break
            x = alive[i]
            take = min(room // x, int(left[x]) - used.get(x, 0))
            members += [x] * take
            used[x] = used.get(x, 0) + take
            room -= x * take
        n = min(int(left[x]) // m for x, m in used.items())
        out.append((tuple(members), n))
        for x, m in used.items():
            left[x] -= m * n
        alive = [x for x in alive if left[x]]
    return out


def places(steps: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, ranks, first sequence, per sequence, offset): ranks r of a length in [first, first + ranks)
    go to sequence first sequence + (r - first) // per, at offset + length * ((r - first) % per)."""
    rank: dict[int, int] = {}
    out, sequence = [], 0
    for members, n in steps:
        offset = 0
        for x in dict.fromkeys(members):
            per = members.count(x)
            first = rank.get(x, 0)
            out.append((x, first, per * n, sequence, per, offset))
            rank[x] = first + per * n
            offset += per * x
        sequence += n
    return out


def pack(docs: DataFrame, path: str, capacity: int = 4096, closing: int = 1, keep_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    cut = scratch.save(pieces(docs, path, capacity, closing, keep_ids), "pieces")
    by_task = scratch.save(cut.groupBy("length", "task").agg((F.max("nth") + 1).alias("n")), "by_task")
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = scratch.save(by_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases")
    histogram = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    rows = places(plan(histogram, capacity))
    where: dict[int, list] = {}
    for length, *place in rows:
        where.setdefault(length, []).append(place)
    tables = {x: np.array(sorted(p), np.int64) for x, p in where.items()}  # the plan: bounded by the histogram, not the corpus
    shared = spark.sparkContext.broadcast(tables)
    ranked = cut.join(maybe_broadcast(bases), ["length", "task"]).withColumn("rank", F.col("base") + F.col("nth"))

    @F.pandas_udf("sequence_id long, offset long")
    def place_of(length, rank):
        import pandas as pd

        lengths, ranks = length.to_numpy(), rank.to_numpy()
        sequence, offset = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
        order = np.argsort(lengths, kind="stable")
        edges = np.flatnonzero(np.diff(lengths[order])) + 1
        for own in np.split(order, edges):
            if len(own):
                t = shared.value[int(lengths[own[0]])]
                i = np.searchsorted(t[:, 0], ranks[own], side="right") - 1
                first, _, base, per, at = t[i].T
                sequence[own] = base + (ranks[own] - first) // per
                offset[own] = at + lengths[own] * ((ranks[own] - first) % per)
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    placed = ranked.withColumn("place", place_of("length", "rank"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("place.sequence_id").alias("sequence_id"), F.col("place.offset").alias("offset"), *["ids"] * keep_ids)
