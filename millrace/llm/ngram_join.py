"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters, and its components.

1. One pass over the texts makes each document's set of word shingles (64-bit hashes), its size and signature, and counts
   shingles and words into fixed arrays of cells.  A cell's count bounds the frequency of what falls into it, so the least
   of a shingle's cell and its words' cells is the rarity by which all sets are ordered; any total order gives the same
   links, a good one gives few candidates.  The arrays have a fixed size and are summed within tasks first.
2. Documents with equal sets are one node, the least doc_id of them.
3. A second pass emits each set's prefix.  Tokens that only one node has are dropped.
4. Nodes of a token are paired with the pivots of the token (of each class of lengths, the node in which it comes first),
   so groups of near copies give a few times as many pairs as members; what links is joined into components.  Only
   pairs of nodes that share a token and are in different components and in the same or adjoining classes of lengths
   then follow, at the token's place in the shorter node's index prefix, joined by token and class, so that a token of
   many nodes is split by class.  So each pair that could link is verified once or already connected, and copies of
   one another never emit all their pairs.
5. Verification: a suffix filter (split at the middle element) before the exact intersection of both sets.

Defined results: lower-casing touches A-Z only; a null or empty text, or one without words, has no shingles and links
with nothing (its component is itself); fewer words than a shingle make one shingle; rows that share a doc_id are one
node; a null doc_id links with nothing; texts of any length are read whole, and ties in rarity are broken by the hash; other
columns, whatever their names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, WordHashes, batches, components, maybe_broadcast, mix, pack_counts, shingle_hashes, sum_counters, unpack_counts

SHINGLE_CELLS, WORD_CELLS, BLOCK = 1 << 21, 1 << 19, 1 << 18


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()  # bytes: A-Z only, and exactly the six blanks


def first_pass(docs: DataFrame, k: int) -> DataFrame:
    """Rows of two kinds: (doc_id, n, signature) of documents, and (block, counts) of cells."""

    def run(iterator):
        hashes = WordHashes()
        cells = np.zeros(SHINGLE_CELLS + WORD_CELLS, np.uint32)
        waiting, held = [], 0

        def settle():
            nonlocal cells, held
            if waiting:
                cells += np.bincount(np.concatenate(waiting), minlength=len(cells)).astype(np.uint32)
                waiting.clear()
                held = 0

        for part, texts in batches(iterator, binary=True):
            sizes, signatures = [], []
            for t in texts:
                h = hashes.of(words_of(t))
                s = np.unique(shingle_hashes(h, k))
                sizes.append(len(s))
                signatures.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                waiting.append((s & np.uint64(SHINGLE_CELLS - 1)).astype(np.int64))
                waiting.append((mix(h) & np.uint64(WORD_CELLS - 1)).astype(np.int64) + SHINGLE_CELLS)
                held += len(s) + len(h)
                if held > 1 << 20:
                    settle()
            none = pa.nulls(len(sizes))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int32()), pa.array(signatures, pa.binary()), none.cast(pa.int32()), none.cast(pa.binary())], names=["doc_id", "n", "signature", "block", "counts"])
        settle()
        for b in range(0, len(cells), BLOCK):
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), pa.array([b // BLOCK], pa.int32()), pa.array([pack_counts(cells[b : b + BLOCK])], pa.binary())],
                names=["doc_id", "n", "signature", "block", "counts"],
            )

    return docs.mapInArrow(run, "doc_id long, n int, signature binary, block int, counts binary")


def rarity(parts: DataFrame) -> np.ndarray:
    """Cell counts on a logarithmic scale of bytes; its size is fixed."""
    out = np.zeros(SHINGLE_CELLS + WORD_CELLS, np.uint8)
    for r in sum_counters(parts).collect():
        counts = unpack_counts(bytes(r["counts"])).astype(float)
        out[r["block"] * BLOCK : r["block"] * BLOCK + BLOCK] = np.minimum(255, np.round(8 * np.log2(1 + counts)))
    return out


def prefixes(docs: DataFrame, scale, k: int, percent: int) -> DataFrame:
    """(token, doc_id, n, pos, class) for the prefix of each document's ordered set; sets that link are of the same or adjoining classes."""
    edges = [1]  # a class is the sizes from one edge to before the next; a set of size n links with sizes up to 100 * n / percent
    while edges[-1] < 2**31:
        edges.append(edges[-1] * 100 // percent + 1)
    edges = np.array(edges)

    def run(iterator):
        hashes, levels = WordHashes(), scale.value
        for part, texts in batches(iterator, binary=True):
            tokens, sizes, places, ids = [], [], [], []
            for doc, t in zip(part.column(0).to_pylist(), texts):
                h = hashes.of(words_of(t))
                if not len(h) or doc is None:
                    continue
                s = shingle_hashes(h, k)
                of_words = levels[(mix(h) & np.uint64(WORD_CELLS - 1)).astype(np.int64) + SHINGLE_CELLS]
                width = min(k, len(h))
                least = reduce(np.minimum, [of_words[i : i + len(s)] for i in range(width)])
                s, first = np.unique(s, return_index=True)
                rank = np.minimum(levels[(s & np.uint64(SHINGLE_CELLS - 1)).astype(np.int64)], least[first])
                n = len(s)
                size = n - -(-percent * n // 100) + 1
                order = np.argsort((rank.astype(np.uint64) << np.uint64(56)) | (s >> np.uint64(8)), kind="stable")[:size]
                tokens.append(s[order].view(np.int64))
                sizes.append(n)
                places.append(size)
                ids.append(doc)
            if ids:
                reps = np.array(places)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens)), pa.array(np.repeat(np.array(ids, np.int64), reps)), pa.array(np.repeat(np.array(sizes, np.int32), reps)), pa.array(np.concatenate([np.arange(r, dtype=np.int32) for r in places])),
                     pa.array(np.repeat(np.searchsorted(edges, np.array(sizes), side="right").astype(np.int32), reps))],
                    names=["token", "doc_id", "n", "pos", "class"],
                )

    return docs.mapInArrow(run, "token long, doc_id long, n int, pos int, class int")


def sets_of(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, shingles): sorted hashes."""

    def run(iterator):
        hashes = WordHashes()
        for part, texts in batches(iterator, size=256, binary=True):
            arrays = [np.unique(shingle_hashes(hashes.of(words_of(t)), k)).view(np.int64) for t in texts]
            arrays = [np.sort(a) for a in arrays]
            offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays)))], names=["doc_id", "shingles"])

    return docs.mapInArrow(run, "doc_id long, shingles array<long>")


def far(x: np.ndarray, y: np.ndarray, most: int, depth: int = 2) -> bool:
    """The suffix filter: whether x and y surely differ in more than ``most`` elements."""

    def least(x, y, depth):
        if not depth or not len(x) or not len(y):
            return abs(len(x) - len(y))
        middle = len(y) // 2
        at = int(np.searchsorted(x, y[middle]))
        return least(x[:at], y[:middle], depth - 1) + least(x[at:], y[middle:], depth - 1)

    return least(x, y, depth) > most


def verified(scratch: Scratch, docs: DataFrame, pairs: DataFrame, k: int, percent: int, name: str) -> DataFrame:
    """The pairs (a, b) that link, written."""

    def run(iterator):
        for batch in iterator:
            keep = []
            xs, ys = batch.column(2), batch.column(3)
            for i in range(batch.num_rows):
                x, y = xs[i].values.to_numpy(), ys[i].values.to_numpy()
                both = len(x) + len(y)
                needed = -(-percent * both // (100 + percent))
                if far(x, y, both - 2 * needed):
                    keep.append(False)
                    continue
                inter = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * inter >= percent * (both - inter))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    needed = scratch.save(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), f"{name}-needed")
    sets = scratch.save(sets_of(docs.join(maybe_broadcast(needed), "doc_id").select("doc_id", "text"), k), f"{name}-sets")
    with_a = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a")
    with_b = with_a.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y")
    out = scratch.save(with_b.mapInArrow(run, "a long, b long"), f"{name}-links")
    scratch.drop(f"{name}-sets")
    return out


def _passes(x: str, y: str, percent: int) -> str:
    """Length and positional filter of two prefix rows."""
    length = f"100 * least({x}.n, {y}.n) >= {percent} * greatest({x}.n, {y}.n)"
    position = f"{100 + percent} * least({x}.n - {x}.pos, {y}.n - {y}.pos) >= {percent} * ({x}.n + {y}.n)"
    return f"{length} and {position}"


def join_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_shingles, component_id.  Links: 100 * intersection >= percent * union."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    first = scratch.save(first_pass(docs, k), "first")
    nodes = first.where("block is null").select("doc_id", "n", "signature")
    levels = rarity(first.where("block is not null"))
    scale = spark.sparkContext.broadcast(levels)
    copies = scratch.save(nodes.where("signature is not null and doc_id is not null").groupBy("signature").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("rows")).where("rows > 1").drop("rows"), "copies")
    nodes = scratch.save(nodes.join(maybe_broadcast(copies), "signature", "left").select("doc_id", "n", F.expr("if(doc_id is null, null, coalesce(rep, doc_id))").alias("rep")), "nodes")
    scratch.drop("first")
    # Rows that share a doc_id are one node: it stays among the tokens if one of its texts is nobody's copy, and is linked to the others' nodes.
    ids = nodes.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.bool_and(F.expr("doc_id <> rep")).alias("copies"))
    ids = scratch.save(ids.where("rows > 1"), "ids")
    same = nodes.join(maybe_broadcast(ids.select("doc_id")), "doc_id").where("doc_id <> rep").select(F.least("doc_id", "rep").alias("a"), F.greatest("doc_id", "rep").alias("b")).distinct()
    same = scratch.save(same, "same")

    prefix = scratch.save(prefixes(docs, scale, k, percent), "prefix")
    shared = prefix.groupBy("token").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo <> hi").select("token")
    own = maybe_broadcast(ids.where("not copies").select("doc_id"))
    gone = scratch.save(nodes.where("doc_id <> rep").select("doc_id").distinct().join(own, "doc_id", "left_anti"), "gone")
    hits = scratch.save(prefix.join(shared, "token").join(maybe_broadcast(gone), "doc_id", "left_anti").select("token", "doc_id", "n", "pos", "class"), "hits")
    scratch.drop("prefix")

    pivots = hits.groupBy("token", "class").agg(F.min(F.struct("pos", "n", "doc_id")).alias("p")).select("token", "class", "p.*")
    near = pivots.select("token", F.explode(F.expr("array(class - 1, class, class + 1)")).alias("class"), "pos", "n", "doc_id")
    stars = hits.alias("x").join(near.alias("y"), F.expr(f"x.token = y.token and x.class = y.class and x.doc_id <> y.doc_id and {_passes('x', 'y', percent)}"))
    stars = scratch.save(stars.select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b")).distinct(), "stars")
    links = verified(scratch, docs, stars, k, percent, "star")
    so_far = components(scratch, links.unionByName(same), name="cc1")

    placed = hits.join(so_far, hits["doc_id"] == so_far["node"], "left").select("token", "doc_id", "n", "pos", "class", F.coalesce("component", "doc_id").alias("c"))
    placed = scratch.save(placed, "placed")
    mixed = placed.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("token")
    placed = scratch.save(placed.join(mixed, "token").where(f"pos < n - ceil({percent}.0 * n / 100) + 1"), "mixed")
    index = f"n - ceil({2 * percent} * n / {100 + percent}.0) + 1"
    shorter = placed.where(f"pos < {index}").select("token", "doc_id", "n", "pos", "c", F.explode(F.expr("array(class, class + 1)")).alias("class"))
    on = f"x.token = y.token and x.class = y.class and x.c <> y.c and (x.n < y.n or x.n = y.n and x.doc_id < y.doc_id) and {_passes('x', 'y', percent)}"
    rest = shorter.alias("x").join(placed.alias("y"), F.expr(on)).select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b")).distinct()
    rest = scratch.save(rest.join(stars, ["a", "b"], "left_anti"), "rest")
    more = verified(scratch, docs, rest, k, percent, "rest")
    final = components(scratch, links.unionByName(same).unionByName(more), name="cc2")
    out = nodes.join(final, nodes["rep"] == final["node"], "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
