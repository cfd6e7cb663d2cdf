"""Hard negatives: for each anchor and positive, the best-scoring rows of other labels inside a band of scores.

Rows are dealt into blocks of bounded size, and each anchor is sent to every block, so the work is the stated one, anchors
times rows, without a cross join: anchors carry the block's number as a join key, and a task reads a block's rows and then
its anchors as one sorted stream, so it holds one block and a few anchors at a time.  Within a block an anchor's integer
scores for all rows are computed, and sorted by score and id; its best rows of the same label are read off for the positives.
In a second pass each positive's upper limit is found in the sorted scores by binary search, and the first rows of other
labels are read from there down to the lower limit.  What a block gives is bounded, and the best of all blocks are merged in
windows that Spark limits before their shuffle, so results don't depend on the blocks.

Defined results: rows with a null label, a null vector, or a null or non-finite component take no part; shorter vectors count
as filled up with zeros; components beyond 64 bits are the nearest such number, and scores beyond wrap around; rows that
share an id are rows of their own, each a neighbour of the other; a null id takes part, after all others among ties, and is
never an anchor unless it is marked as one; other columns, whatever their names, are ignored; without rows or anchors there are no results.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, give_back, numbered

#: Rows of a block at most (on average), and anchors scored at a time.
BLOCK_ROWS, SLICE = 16_384, 64


def packed(vectors: DataFrame, scale: float) -> DataFrame:
    """row, id, label, anchor, wide, vec: components as floor(scale * x), in 16 bits each or, if some don't fit, in 64."""

    def run(iterator):
        low, high = -(2.0**63), np.nextafter(2.0**63, 0)
        for batch in iterator:
            lists = batch.column(4)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            flat = np.clip(np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale), low, high).astype(np.int64)
            parts = [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            wide = [bool(len(v)) and (int(v.min()) < -32768 or int(v.max()) > 32767) for v in parts]
            data = [v.tobytes() if w else v.astype(np.int16).tobytes() for v, w in zip(parts, wide)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(wide, pa.bool_()), pa.array(data, pa.binary())], names=["row", "id", "label", "anchor", "wide", "vec"])

    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    rows = vectors.where(F.col("label").isNotNull() & F.col("vector").isNotNull()).where(sound)
    return rows.select("row", "id", "label", "anchor", "vector").mapInArrow(run, "row long, id long, label long, anchor boolean, wide boolean, vec binary")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    vectors = [np.frombuffer(v, np.int64 if w else np.int16) for v, w in zip(batch.column("vec").to_pylist(), batch.column("wide").to_pylist())]
    out = np.zeros((len(vectors), max(map(len, vectors), default=0)), np.int64)
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    return out


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((sum(map(len, parts)), max(p.shape[1] for p in parts)), np.int64)
    at = 0
    for p in parts:
        out[at : at + len(p), : p.shape[1]] = p
        at += len(p)
    return out


class Block:
    """A block's rows in order of id, nulls last."""

    def __init__(self, parts: list[pa.RecordBatch]):
        table = pa.Table.from_batches(parts)
        self.rows, self.labels = table["row"].to_numpy(), table["label"].to_numpy()
        self.ids = table["id"].to_pylist()
        self.matrix = _joined([*map(_matrix, parts)])
        self.most = float(np.abs(self.matrix.astype(np.float64)).max(initial=0))

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Exact integer products: in doubles where no sum can pass 53 bits, else in 64-bit integers."""
        d = min(anchors.shape[1], self.matrix.shape[1])
        a, m = anchors[:, :d], self.matrix[:, :d]
        if d * self.most * float(np.abs(a.astype(np.float64)).max(initial=0)) < 2.0**53:
            if not hasattr(self, "double"):
                self.double = self.matrix.astype(np.float64)
            return (a.astype(np.float64) @ self.double[:, :d].T).astype(np.int64)
        with np.errstate(over="ignore"):
            return a @ m.T


def _streamed(rows: DataFrame, anchors: DataFrame, blocks: int, extra: str, schema: str, read) -> DataFrame:
    """``read(block, anchor batch, scores, orders)`` for each block and each few of the anchors, which get ``extra`` columns."""
    names = [*rows.columns, "kind", "block", extra]
    kind = dict(anchors.dtypes)[extra]
    side = rows.withColumns({"kind": F.lit(0), "block": F.pmod(F.xxhash64("row"), F.lit(blocks)), extra: F.lit(None).cast(kind)})
    other = anchors.withColumns({"kind": F.lit(1), "block": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))})
    stream = side.select(names).unionByName(other.select(names)).repartition(min(blocks, 4096), "block")
    ordered = stream.sortWithinPartitions("block", "kind", F.col("id").isNull(), "id", "row")

    def run(iterator):
        give_back()
        parts, now, block = [], None, None
        for batch in iterator:
            at = batch.column("block").to_numpy() * 2 + batch.column("kind").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]
            for a, b in zip(cuts, cuts[1:]):
                part = batch.slice(a, b - a)
                number, kind = divmod(int(at[a]), 2) if b > a else (now, 0)
                if number != now:
                    now, parts, block = number, [], None
                if kind == 0:
                    parts.append(part)
                    continue
                if not parts:
                    continue  # a block without rows
                block = block or Block(parts)
                for k in range(0, part.num_rows, SLICE):
                    own = part.slice(k, SLICE)
                    scores = block.scores(_matrix(own))
                    # rows stand in order of id, so that a stable sort is one by score and id
                    found = read(block, own, scores, np.argsort(-scores, axis=1, kind="stable"))
                    if found.num_rows:
                        yield found
        give_back()

    return ordered.mapInArrow(run, schema)


def mine(vectors: DataFrame, k: int = 10, n_positives: int = 5, low: int = 30, high: int = 90, scale: float = 256) -> DataFrame:
    """From vectors (id, vector, label, anchor): anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    An anchor's positives are its ``n_positives`` best other rows of the same label; a positive's negatives the ``k`` best
    rows of other labels whose score is from ``low`` to ``high`` percent of the positive's.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    plain = vectors.select(F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector"), F.col("label").cast("long").alias("label"), F.coalesce(F.col("anchor").cast("boolean"), F.lit(False)).alias("anchor"))
    given, row = numbered(plain, scratch)
    rows = scratch.save(packed(given.withColumnRenamed(row, "row"), scale), "packed")
    n = rows.count()
    blocks = max(1, -(-n // BLOCK_ROWS), min(spark.sparkContext.defaultParallelism, -(-n // 1024)))
    anchors = rows.where("anchor").withColumn("none", F.lit(None).cast("int"))

    def best(block: Block, own: pa.RecordBatch, scores: np.ndarray, orders: np.ndarray) -> pa.RecordBatch:
        out = []
        for i, (anchor, label) in enumerate(zip(own.column("row").to_pylist(), own.column("label").to_pylist())):
            order = orders[i]
            same = order[(block.labels[order] == label) & (block.rows[order] != anchor)][:n_positives]
            out += [(anchor, block.ids[j], int(block.rows[j]), int(scores[i, j])) for j in same.tolist()]
        columns = [*zip(*out)] or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["row", "id", "other", "score"])

    def first(df: DataFrame, keys: list[str], score: str, ident: str, most: int, name: str) -> DataFrame:
        over = Window.partitionBy(*keys).orderBy(F.desc(score), F.col(ident).isNull(), ident, "other")
        return df.withColumn(name, F.row_number().over(over)).where(F.col(name) <= most)

    near = first(_streamed(rows, anchors, blocks, "none", "row long, id long, other long, score long", best), ["row"], "score", "id", n_positives, "n")
    chosen = near.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("n", "score", "id"))).alias("positives"))  # n_positives at most
    asked = scratch.save(rows.where("anchor").join(chosen, "row"), "asked")

    def behind(block: Block, own: pa.RecordBatch, scores: np.ndarray, orders: np.ndarray) -> pa.RecordBatch:
        out = []
        for i, (anchor, ident, label, positives) in enumerate(zip(*(own.column(c).to_pylist() for c in ("row", "id", "label", "positives")))):
            order = orders[i]
            down = -scores[i, order]
            unlike = np.flatnonzero(block.labels[order] != label)
            for p in positives:
                most, least = p["score"] * high // 100, -(-p["score"] * low // 100)
                if least > most:
                    continue
                begin, end = np.searchsorted(down, [-most, -least + 1])
                a = np.searchsorted(unlike, begin)
                places = unlike[a : a + k]
                out += [(anchor, ident, p["n"], p["id"], p["score"], block.ids[j], int(block.rows[j]), int(scores[i, j])) for j in order[places[places < end]].tolist()]
        columns = [*zip(*out)] or [()] * 8
        names = ["row", "anchor_id", "n", "positive_id", "positive_score", "negative_id", "other", "negative_score"]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    kinds = "row long, anchor_id long, n long, positive_id long, positive_score long, negative_id long, other long, negative_score long"
    found = first(_streamed(rows, asked, blocks, "positives", kinds, behind), ["row", "n"], "negative_score", "negative_id", k, "rank")
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


#: The same, for tables whose ids are unique and whose scores doubles hold exactly.
ORACLE = """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as e
    from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, a.label = b.label as same, b.vec_id as other, list_inner_product(a.e, b.e)::bigint as score from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
p as (select anchor_id, other as positive_id, score as positive_score from s where same qualify row_number() over (partition by anchor_id order by score desc, other) <= 5),
n as (select p.*, other as negative_id, score as negative_score, row_number() over (partition by p.anchor_id, positive_id order by score desc, other)::integer as rank
    from p join s on s.anchor_id = p.anchor_id and not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 10
"""
