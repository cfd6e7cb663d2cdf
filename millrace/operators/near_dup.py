"""Near dedup: the first row of those that are alike stays, by MinHash bands and, if asked, by the true similarity.

Rows are told apart by a number of their own and ordered by their key, rows without one last.  Rows of one text are alike in
all bands, so only the first of each text takes part, and the others go.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .curation import exact_dedup

#: Shape of the signature: 128 minima in 8 bands of 16 rows, for a similarity of 0.85; twice the bands where pairs are verified.
PERMUTATIONS, BANDS, VERIFIED_BANDS, SHINGLE = 128, 8, 16, 5
_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD)


def _stirred(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX[1]
    return h ^ (h >> np.uint64(29))


def _donors() -> np.ndarray:
    """For each bin, the order in which it asks the others for a value if it has none: fixed, and its own for each."""
    bins = np.arange(PERMUTATIONS, dtype=np.uint64)
    return np.argsort(_stirred((bins[:, None] * np.uint64(PERMUTATIONS) + bins + np.uint64(1)) * _MIX[0]), axis=1, kind="stable")


def shingles(text: str) -> np.ndarray:
    """The hashes of the text's character 5-grams, sorted, with repeats."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    n = max(0, len(points) - SHINGLE + 1)
    h = np.zeros(n, np.uint64)
    for i in range(SHINGLE):
        h = _stirred(h * _MIX[0] + points[i : i + n] + np.uint64(1))
    h.sort()
    return h


def minima(text: str) -> np.ndarray:
    """The 128 minima of one permutation of the text's character 5-grams: the hash's high bits are a gram's bin.

    An empty bin takes the value of the first bin in its own order that has one, mixed with the asking bin's number only
    through that order, so equal sets give equal signatures and a bin agrees with the chance of the sets' similarity.
    """
    h = shingles(text)
    n = len(h)
    if not n:
        return np.full(PERMUTATIONS, np.iinfo(np.uint64).max)
    width = np.uint64(64 - 7)
    bins = np.arange(PERMUTATIONS, dtype=np.uint64)
    first = np.searchsorted(h, bins << width)
    filled = np.flatnonzero(np.diff(np.append(first, n)) > 0)
    low = np.zeros(PERMUTATIONS, np.uint64)
    low[filled] = h[first[filled]]
    if len(filled) < PERMUTATIONS:
        has = np.zeros(PERMUTATIONS, bool)
        has[filled] = True
        global _DONORS
        if _DONORS is None:
            _DONORS = _donors()
        donor = _DONORS[np.arange(PERMUTATIONS), has[_DONORS].argmax(axis=1)]
        low = np.where(has, low, low[donor])
    return low


_DONORS = None


def band_hashes(texts: pd.Series, bands: int = BANDS) -> pd.Series:
    import xxhash

    out = []
    for t in texts:
        rows = minima(t or "").reshape(bands, -1)
        out.append([xxhash.xxh64_intdigest(r.tobytes(), i) - (1 << 63) for i, r in enumerate(rows)])
    return pd.Series(out)


def similar(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Whether two sorted arrays of distinct hashes have a Jaccard similarity of at least ``least``; their lengths may rule it out."""
    if not len(a) or not len(b) or min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= least * (len(a) + len(b) - both)


def near_dedup(df: DataFrame, key: str, text: str, scratch: Callable[[DataFrame, str], DataFrame], verify: float | None = None, bands: int | None = None, pivots: int = 64) -> DataFrame:
    """Greedy first-wins near dedup: a row goes if an earlier row that stays shares a band with it and, if ``verify`` is given, has at least that similarity.

    ``scratch`` writes a table and reads it again.  Null texts are empty; texts too short for a shingle share all bands, but
    where pairs are verified only equal ones are alike.
    """
    row = next(c for c in ("_row", "__row", "___row") if c not in df.columns)
    rows = scratch(df.withColumn(row, F.monotonically_increasing_id()), "rows")
    at = F.struct(F.col(key).isNull().alias("lost"), F.col(key).alias("key"), F.col(row).alias("row"))
    firsts = rows.groupBy(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).agg(F.min(at).alias("at"))
    firsts = scratch(firsts.select(F.col("at.row").alias("id")), "firsts")
    n = bands or (BANDS if verify is None else VERIFIED_BANDS)
    hashed = F.pandas_udf(lambda texts: band_hashes(texts, n), "array<long>")
    # hashed where the texts are, so that no text is shuffled
    every = rows.select(F.col(row).alias("id"), at.alias("at"), F.posexplode(hashed(F.col(text).cast("string"))).alias("band", "h"))
    found = scratch(every.join(firsts, "id", "left_semi"), "bands")
    texts = rows.select(F.col(row).alias("id"), F.col(text).cast("string").alias("text"))
    kept = _independent(found, scratch) if verify is None else _verified(found, texts, scratch, verify, pivots)
    return rows.join(kept.withColumnRenamed("id", row), row, "left_semi").drop(row)


def deduplicate(df: DataFrame, key: str, text: str, scratch: Callable[[DataFrame, str], DataFrame], verify: float | None = None) -> tuple[DataFrame, DataFrame]:
    """Exact, then near dedup: the rows that stay, and one row of exact_removed, near_removed, total_removed."""
    names = df.columns
    firsts = scratch(exact_dedup(df, F.col(text), [key], "_copies"), "exact")
    kept = scratch(near_dedup(firsts, key, text, scratch, verify), "near")
    seen = firsts.agg(F.coalesce(F.sum("_copies"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("texts"))
    left = kept.agg(F.count(F.lit(1)).alias("kept"))
    stats = seen.join(F.broadcast(left))  # one row on either side
    return kept.select(names), stats.select((F.col("n") - F.col("texts")).alias("exact_removed"), (F.col("texts") - F.col("kept")).alias("near_removed"), (F.col("n") - F.col("kept")).alias("total_removed"))


def _independent(bands: DataFrame, scratch) -> DataFrame:
    """The lexicographically first maximal independent set over bands, which is greedy first-wins.

    A row stays once it is the first undecided one in all its bands and none of them has a row that stays; rows of a band
    with one that stays go.  Band minima are aggregates, so no pairs of a band are made.
    """
    undecided, kept, turn = bands, None, 0
    while True:  # each round decides the first undecided row at least
        turn += 1
        first = undecided.groupBy("band", "h").agg(F.min("at").alias("first"))
        new = undecided.join(first, ["band", "h"]).groupBy("id").agg(F.bool_and(F.col("at") == F.col("first")).alias("stays")).where("stays").select("id")
        new = scratch(new, f"kept-{turn}")
        kept = new if kept is None else kept.unionByName(new)
        taken = bands.join(new, "id", "left_semi").select("band", "h").distinct()
        gone = undecided.join(taken, ["band", "h"], "left_semi").select("id").distinct()
        undecided = scratch(undecided.join(gone, "id", "left_anti"), f"undecided-{turn}")
        if undecided.isEmpty():
            return kept


def _verified(bands: DataFrame, texts: DataFrame, scratch, least: float, pivots: int) -> DataFrame:
    """The same over pairs that share a band and are similar.

    In each round the first ``pivots`` undecided rows of a band are compared with all its later ones.  A row all of
    whose earlier band mates have been compared with it can be decided: it goes if a similar earlier one stays, and stays if all
    of them go.  The first undecided row is such a row, so every round decides some; nearly always one round decides all.
    """
    shared = bands.groupBy("band", "h").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = scratch(bands.join(shared, ["band", "h"]), "shared")
    kept = scratch(bands.join(shared.select("id").distinct(), "id", "left_anti").select("id").distinct(), "alone")
    packed = scratch(_packed(texts.join(shared.select("id").distinct(), "id", "left_semi")), "packed")
    undecided, edges, turn = shared, None, 0
    while not undecided.isEmpty():
        turn += 1
        place = F.row_number().over(Window.partitionBy("band", "h").orderBy("at"))  # limited before its shuffle
        first = scratch(undecided.withColumn("rank", place).where(F.col("rank") <= pivots + 1).select("band", "h", "id", "rank"), f"first-{turn}")
        meetings = scratch(_meetings(undecided, first, pivots), f"meetings-{turn}")
        new = scratch(_similar_pairs(meetings, packed, least), f"edges-{turn}")
        edges = new if edges is None else edges.unionByName(new)
        waiting = undecided.join(first, ["band", "h", "id"], "left_anti").select("id").distinct()  # has an earlier mate yet to be compared with
        ready = scratch(undecided.select("id").distinct().join(waiting, "id", "left_anti"), f"ready-{turn}")
        edges = scratch(edges.distinct(), f"all-edges-{turn}")
        gone, step = None, 0
        while True:  # along chains of similar rows
            step += 1
            alive = edges if gone is None else edges.join(gone.withColumnRenamed("id", "u"), "u", "left_anti")
            free = ready.join(alive.select(F.col("v").alias("id")).distinct(), "id", "left_anti")
            stay = scratch(free, f"stay-{turn}-{step}")
            if stay.isEmpty():
                break
            kept = kept.unionByName(stay)
            lost = scratch(edges.join(stay.withColumnRenamed("id", "u"), "u", "left_semi").select(F.col("v").alias("id")).distinct(), f"gone-{turn}-{step}")
            gone = lost if gone is None else gone.unionByName(lost)
            decided = stay.unionByName(lost)
            ready = scratch(ready.join(decided, "id", "left_anti"), f"ready-{turn}-{step}")
            undecided = scratch(undecided.join(decided, "id", "left_anti"), f"undecided-{turn}-{step}")
        if gone is not None:
            edges = edges.join(gone.withColumnRenamed("id", "u"), "u", "left_anti")
    return kept.distinct()


def _packed(texts: DataFrame) -> DataFrame:
    def run(iterator):
        for batch in iterator:
            data = [zlib.compress((t or "").encode("utf-8", "surrogatepass"), 1) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["id", "packed"])

    return texts.select("id", "text").mapInArrow(run, "id long, packed binary")


def _meetings(members: DataFrame, first: DataFrame, pivots: int, part: int = 512) -> DataFrame:
    """(band, h, part, id, others): where a row meets which earlier pivots of its bands; each of these once, and in as few bands as it takes.

    Alike rows share many bands, most of which have no pivot that the row doesn't meet in another.  The members of a large band
    are dealt out into parts.
    """
    lists = first.where(F.col("rank") <= pivots).groupBy("band", "h").agg(F.expr("transform(array_sort(collect_list(struct(rank, id))), x -> x.id)").alias("pivots"))  # so many at most
    own = members.select("band", "h", "id", "size").join(first, ["band", "h", "id"], "left").join(lists, ["band", "h"])
    earlier = own.withColumn("others", F.expr("slice(pivots, 1, int(coalesce(rank - 1, size(pivots))))")).where(F.size("others") > 0)
    bands = earlier.groupBy("id").agg(F.array_sort(F.collect_list(F.struct((-F.size("others")).alias("few"), "band", "h", "size", "others"))).alias("bands"))  # one a band at most
    kept = F.expr("""aggregate(bands, struct(cast(array() as array<bigint>) as seen, cast(array() as array<struct<band: int, h: bigint, size: bigint, others: array<bigint>>>) as kept),
        (done, b) -> if(size(array_except(b.others, done.seen)) = 0, done, struct(array_union(done.seen, b.others) as seen, concat(done.kept, array(struct(b.band as band, b.h as h, b.size as size, array_except(b.others, done.seen) as others))) as kept)),
        done -> done.kept)""")
    parts = F.greatest(F.lit(1), F.ceil(F.col("size") / part)).cast("long")
    return bands.select("id", F.explode(kept).alias("b")).select("b.*", "id").select("band", "h", F.pmod(F.xxhash64("id"), parts).alias("part"), "id", "others")


def _similar_pairs(meetings: DataFrame, packed: DataFrame, least: float) -> DataFrame:
    """(u, v): pivots u and the rows v that meet them, with a similarity of at least ``least``.

    Texts are sent compressed, a row's to the bands where it meets some pivot and a pivot's to the parts where some row meets it:
    a task reads some parts as a sorted stream and holds one part's pivots.
    """
    columns = ["band", "h", "part", "kind", "id", "others"]
    own = meetings.withColumn("kind", F.lit(1)).select(columns)
    pivot = meetings.select("band", "h", "part", F.explode("others").alias("id")).distinct()
    pivot = pivot.withColumns({"kind": F.lit(0), "others": F.lit(None).cast("array<long>")}).select(columns)
    stream = own.unionByName(pivot).join(packed, "id")
    ordered = stream.repartition("band", "h", "part").sortWithinPartitions("band", "h", "part", "kind")

    def run(iterator):
        now, held = None, {}
        for batch in iterator:
            u, v = [], []
            for band, h, p, kind, ident, others, data in zip(*(batch.column(c).to_pylist() for c in (*columns, "packed"))):
                if (band, h, p) != now:
                    now, held = (band, h, p), {}
                own = np.unique(shingles(zlib.decompress(data).decode("utf-8", "surrogatepass")))
                if kind == 0:
                    held[ident] = own
                    continue
                for other in others:
                    if similar(held[other], own, least):
                        u.append(other)
                        v.append(ident)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return ordered.select(*columns, "packed").mapInArrow(run, "u long, v long")
