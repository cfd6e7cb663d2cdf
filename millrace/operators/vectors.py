"""Vectors: cosine to the nearest of many centroids, k-means with several starts at once, and the domain filter they make."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lexicon import is_technical
from ..plans.scratch import writer
from .curation import best_threshold, hash_order, threshold_scores

#: Bytes of centroids that are broadcast at once, and rows that are multiplied at a time.
BLOCK_BYTES, SLICE = 32 << 20, 1024
#: Unit vectors' components as integers, whose sums don't depend on their order.
FIXED = 1 << 30


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.sqrt((vectors * vectors).sum(axis=1, keepdims=True)), 1e-8)


def matrix_of(vectors: list) -> np.ndarray:
    """Vectors as rows; shorter ones count as filled up with zeros, and so do null components."""
    width = max((len(v) for v in vectors), default=0)
    if all(len(v) == width for v in vectors):
        return np.nan_to_num(np.array([*map(np.asarray, vectors)], np.float64).reshape(len(vectors), width), nan=0.0)
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors):
        row[: len(v)] = np.nan_to_num(np.asarray(v, np.float64), nan=0.0)
    return out


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each unit vector the largest product with a unit centroid, and which centroid that is (the first of equals)."""
    width = max(vectors.shape[1], centroids.shape[1])
    vectors, centroids = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m for m in (vectors, centroids))
    products = vectors @ centroids.T
    which = products.argmax(axis=1)
    return products[np.arange(len(products)), which], which


def similarity(vector: Column, matrix: Callable[[], np.ndarray]) -> Column:
    """The largest cosine of a vector to the rows of a (unit) matrix, by block products; null for a null vector."""

    def run(vectors: pd.Series) -> pd.Series:
        out, centroids = np.full(len(vectors), np.nan), matrix()
        here = np.flatnonzero(vectors.notna().to_numpy())
        for a in range(0, len(here), SLICE):
            at = here[a : a + SLICE]
            out[at] = nearest(unit_rows(matrix_of([vectors.iloc[k] for k in at])), centroids)[0]
        return pd.Series(out).astype(object).where(~np.isnan(out), None)

    return F.pandas_udf(run, "double")(vector)


def best_similarity(vector: str, centroids: list[list[float]]) -> Column:
    """The largest cosine to any of the given unit centroids."""
    held = np.array(centroids, np.float64)
    return similarity(F.col(vector), lambda: held)


def with_similarity(df: DataFrame, vector: str, centroids: DataFrame, name: str = "s", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Adds the largest cosine to any of the unit ``centroid`` rows, however many.  Rows with equal or null keys stay rows of their own.

    Centroids are broadcast, as a matrix, in blocks of a checked size.  If they are more than a block, the rows go by the blocks
    one after another with the largest value so far, written in between; there is no cross join and no grouping.  Without
    centroids, and for a null vector, it is null.
    """
    context = df.sparkSession.sparkContext
    n, width = centroids.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("centroid")), F.lit(1))).first()
    blocks = max(1, -(-n * width * 8 // block_bytes))
    if not n:
        return df.withColumn(name, F.lit(None).cast("double"))
    save = writer(df.sparkSession)
    if blocks > 1:
        centroids = save(centroids.select("centroid", F.pmod(F.monotonically_increasing_id(), F.lit(blocks)).alias("block")), "centroids")
    rows = df
    for k in range(blocks):
        own = centroids if blocks == 1 else centroids.where(F.col("block") == k)
        part = own.select("centroid").collect()
        if not part:
            continue
        held = context.broadcast(matrix_of([r["centroid"] for r in part]))
        s = similarity(F.col(vector), lambda held=held: held.value)
        rows = rows.withColumn(name, s if name not in rows.columns or rows is df else F.greatest(name, s))
        if blocks > 1:
            rows = save(rows, f"after-{k}")
    return rows


def _partial_sums(df: DataFrame, starts: np.ndarray) -> list[tuple]:
    """For each start and cluster: count, integer sum of its unit vectors, and (over 2^20) the sum of their distances.

    One aggregation for all starts: a task adds up its own rows, a second exchange adds up the tasks' sums, one row a cluster.
    """
    held = df.sparkSession.sparkContext.broadcast(starts)
    schema = "start int, cluster int, n long, inertia long, total binary"

    def batch_of(sums: dict) -> pa.RecordBatch:
        rows = [(s, c, n, i, t.astype("<i8").tobytes()) for (s, c), (n, i, t) in sums.items()]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["start", "cluster", "n", "inertia", "total"])

    def add(sums: dict, key, n, inertia, total) -> None:
        if key in sums:
            a, b, c = sums[key]
            n, inertia, total = n + a, inertia + b, total + c
        sums[key] = (n, inertia, total)

    def own(iterator):
        sums: dict = {}
        for batch in iterator:
            unit = unit_rows(matrix_of(batch.column(0).to_pylist()))
            fixed = np.rint(unit * FIXED).astype(np.int64)
            for s, centroids in enumerate(held.value):
                best, which = nearest(unit, centroids)
                far = np.rint(np.maximum(2 - 2 * best, 0) * (1 << 20)).astype(np.int64)
                for c in np.unique(which).tolist():
                    at = which == c
                    add(sums, (s, c), int(at.sum()), int(far[at].sum()), fixed[at].sum(axis=0))
        yield batch_of(sums)

    def both(iterator):
        sums: dict = {}
        for batch in iterator:
            for s, c, n, i, t in zip(*(batch.column(k).to_pylist() for k in range(5))):
                add(sums, (s, c), n, i, np.frombuffer(t, "<i8"))
        yield batch_of(sums)

    first = df.select("v").mapInArrow(own, schema)
    return [tuple(r) for r in first.repartition("start", "cluster").mapInArrow(both, schema).collect()]


def kmeans_centroids(df: DataFrame, vector: str, k: int = 5, starts: int = 10, seed: int = 42, rounds: int = 100) -> np.ndarray:
    """k unit centroids of unit vectors: of ``starts`` seeded starts the one of least inertia, all stepped together.

    A start's centroids are rows that a seeded order of the vectors names.  Each round is one aggregation; sums are of integers,
    so they don't depend on the partitioning.  A cluster without rows keeps its centroid; a start is done when its inertia falls no
    more.  Only as many rows as there are centroids come to the driver.
    """
    rows = df.where(F.col(vector).isNotNull()).select(F.col(vector).cast("array<double>").alias("v"))
    order = hash_order(F.concat_ws(",", F.transform("v", lambda x: x.cast("string"))), seed)
    picked = [r["v"] for r in rows.select("v", order.alias("h")).distinct().orderBy("h").limit(starts * k).collect()]
    if not picked:
        return np.zeros((0, 0))
    k = min(k, len(picked))
    starts = len(picked) // k
    now = unit_rows(matrix_of(picked[: starts * k])).reshape(starts, k, -1)
    best, before = now.copy(), np.full(starts, np.iinfo(np.int64).max)
    for _ in range(rounds):
        inertia, new = np.zeros(starts, np.int64), now.copy()
        for s, c, _, far, total in _partial_sums(rows, now):
            inertia[s] += far
            mean = np.frombuffer(total, "<i8").astype(np.float64)
            new[s, c] = unit_rows(mean[None, :])[0] if mean.any() else now[s, c]
        better = inertia < before
        best[better], before[better] = now[better], inertia[better]
        if not better.any():
            break
        now = new
    return best[int(before.argmin())]


def fitted_threshold(df: DataFrame, score: str, label: str, thresholds: list[float], default: float = 0.45) -> DataFrame:
    """One row: the threshold with the best F1 on labelled rows (the least of equals), and that F1."""
    return best_threshold(threshold_scores(df.where(F.col(label).isNotNull()), score, label, thresholds), default)


def domain_filter(df: DataFrame, text: str | None = None, vector: str | None = None, centroids: DataFrame | None = None, threshold: float | DataFrame = 0.45, score: str = "s") -> DataFrame:
    """Keywords for recall, then similarity for precision: rows with at least the threshold, a number or a fitted one-row table.

    The score stays as a column.  Without ``text`` the first stage, without ``vector`` and ``centroids`` the second is left out.
    """
    kept = df.where(is_technical(F.col(text))) if text else df
    if not vector or centroids is None:
        return kept
    scored = with_similarity(kept, vector, centroids, score)
    if isinstance(threshold, DataFrame):
        one = threshold.select(F.col("threshold").alias("_least"))
        return scored.join(F.broadcast(one), F.col(score) >= F.col("_least")).drop("_least")  # one row
    return scored.where(F.col(score) >= threshold)
