"""Curation: exact dedup, decontamination, thresholds, splits, hashes, the funnel and the dataset writer."""

from __future__ import annotations

import json
from collections.abc import Callable
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.grams import GramIndex, Words, gram_strings
from ..functions.lexicon import is_technical
from ..functions.text import normalise
from ..plans.scratch import writer


def normalise_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    return df.withColumns({f: normalise(F.col(f)) for f in fields})


def exact_dedup(df: DataFrame, text: Column, order: list[str], copies: str | None = None) -> DataFrame:
    """The first row of each text, by sha256: earliest places are combined before the shuffle, no window holds a group.

    Rows that also tie in the order columns are told apart by a number of their own, so one row a text stays.  ``copies``
    names a column for how many rows had the text.
    """
    keyed = df.withColumn("_key", F.sha2(F.coalesce(text, F.lit("")), 256)).withColumn("_at", F.struct(*order))
    whole = F.struct(*[c for c in df.columns])
    first = keyed.groupBy("_key").agg(F.min_by(whole, "_at").alias("_row"), F.count(F.lit(1)).alias("_n"))
    return first.select("_row.*", *([F.col("_n").alias(copies)] if copies else []))


def dedup_stats(firsts: DataFrame, copies: str = "copies") -> DataFrame:
    """n_rows, n_kept, exact_removed from the first rows of each text with their numbers of copies."""
    n = F.col(copies)
    return firsts.agg(F.coalesce(F.sum(n), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_kept"), F.coalesce(F.sum(n - 1), F.lit(0)).alias("exact_removed"))


def gram_index(prompts: DataFrame, text: str, n: int = 13) -> DataFrame:
    """The distinct word n-grams of all prompts as strings (gram); a shorter prompt is one gram as a whole."""

    def run(iterator):
        for batch in iterator:
            yield pa.RecordBatch.from_arrays([pa.array(gram_strings(batch.column(0).to_pylist(), n), pa.string())], names=["gram"])

    return prompts.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "gram string").distinct()


def with_overlap(df: DataFrame, text: str, index: DataFrame, n: int = 13, most: int = 64 << 20, block: int = 1 << 20) -> DataFrame:
    """Adds ``overlap``: how many distinct n-grams of a row's text are in the index.  Rows are judged one by one, whatever their keys.

    An index of up to ``most`` bytes is broadcast, sorted by hash, and looked up where the rows are, so that no gram is
    exploded and nothing is shuffled.  A larger one is split by hash into blocks of about ``block`` grams; a row's hashes go to
    the blocks that may hold them, and only rows with a hit there are looked at as strings.
    """
    spark = df.sparkSession
    grams, size = index.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("gram") + 16), F.lit(0))).first()
    if size <= most:
        held = spark.sparkContext.broadcast(GramIndex([r["gram"] for r in index.collect()], n))
        # not deterministic for the planner's sake alone: a filter on the count must not count again
        count = F.pandas_udf(lambda texts: held.value.series(texts), "long").asNondeterministic()
        return df.withColumn("overlap", count(F.col(text).cast("string")))
    save = writer(spark)
    row = next(c for c in ("_row", "__row", "___row") if c not in df.columns)
    rows = save(df.withColumn(row, F.monotonically_increasing_id()), "rows")
    bits = max(1, -(-grams // block) - 1).bit_length()
    hit = _block_hits(rows.select(row, F.col(text).cast("string").alias("text")), index, n, bits, row)
    maybe = save(rows.select(row, F.col(text).cast("string").alias("text")).join(hit, row, "left_semi"), "maybe")
    counts = _row_grams(maybe, row, n).join(index, "gram", "left_semi").groupBy(row).agg(F.count(F.lit(1)).alias("overlap"))
    return rows.join(counts, row, "left").drop(row).withColumn("overlap", F.coalesce("overlap", F.lit(0)))


def _row_grams(rows: DataFrame, row: str, n: int) -> DataFrame:
    """(row, gram): the distinct grams of each row's text."""

    def run(iterator):
        for batch in iterator:
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = gram_strings([text], n)
                yield pa.RecordBatch.from_arrays([pa.array([k] * len(own), pa.int64()), pa.array(own, pa.string())], names=[row, "gram"])

    return rows.select(row, "text").mapInArrow(run, f"{row} long, gram string")


def _block_hits(rows: DataFrame, index: DataFrame, n: int, bits: int, row: str) -> DataFrame:
    """Rows with a gram whose hash the index has, found block by block: a task reads a block's hashes, then the rows' that go there."""
    schema, names = f"block long, kind int, {row} long, hashes binary", ["block", "kind", row, "hashes"]

    def dealt(kind: int, key, hashes: np.ndarray):
        hashes = np.unique(hashes)
        block = (hashes >> np.uint64(64 - bits)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(block, prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(hashes)]):
            yield int(block[a]), kind, key, hashes[a:b].tobytes()

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        columns = [*zip(*found)] or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.binary()))], names=names)

    def of_index(iterator):
        for batch in iterator:
            yield batch_of([*dealt(0, None, GramIndex.hash(batch.column(0).to_pylist()))])

    def of_rows(iterator):
        for batch in iterator:
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield batch_of([*dealt(1, k, Words([text]).grams(n)[0])])

    def merged(iterator):
        now, parts, held = None, [], None
        for batch in iterator:
            found = []
            for block, kind, k, data in zip(*(c.to_pylist() for c in batch.columns)):
                if block != now:
                    now, parts, held = block, [], None
                hashes = np.frombuffer(data, np.uint64)
                if kind == 0:
                    parts.append(hashes)
                    continue
                if held is None:
                    held = np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
                if len(held) and (held[np.minimum(np.searchsorted(held, hashes), len(held) - 1)] == hashes).any():
                    found.append(k)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=[row])

    both = index.select("gram").mapInArrow(of_index, schema).unionByName(rows.select(row, "text").mapInArrow(of_rows, schema))
    return both.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(merged, f"{row} long").distinct()


def contaminated(df: DataFrame, key: str, text: str, index: DataFrame, n: int = 13, min_overlap: int = 1, **sizes) -> DataFrame:
    """(key, overlap) of each row that shares at least ``min_overlap`` distinct grams with the index."""
    return with_overlap(df.select(key, text), text, index, n, **sizes).where(F.col("overlap") >= min_overlap).select(key, "overlap")


def decontaminate(df: DataFrame, text: str, index: DataFrame, n: int = 13, min_overlap: int = 1, **sizes) -> DataFrame:
    """The rows that share fewer; a null or wordless text shares none."""
    return with_overlap(df, text, index, n, **sizes).where(F.col("overlap") < min_overlap).drop("overlap")


def keyword_filter(df: DataFrame, text: str) -> DataFrame:
    return df.where(is_technical(F.col(text)))


def unit(v: Column) -> Column:
    norm = F.greatest(F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))), F.lit(1e-8))
    return F.transform(v, lambda x: x.cast("double") / norm)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def group_centroids(df: DataFrame, group: str, vector: str) -> DataFrame:
    """Means of unit vectors by group, again of unit length: one row a group."""
    flat = df.select(group, F.posexplode(unit(F.col(vector))).alias("i", "x")).groupBy(group, "i").agg(F.avg("x").alias("x"))
    return flat.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("c")).withColumn("centroid", unit(F.col("c"))).drop("c")


def embed(encode: Callable[[list[str]], np.ndarray]):
    """A pluggable embedding model (texts to a matrix) as an Arrow UDF."""

    @F.pandas_udf("array<float>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([*np.asarray(encode([t or "" for t in texts]), np.float32)])

    return run


def threshold_scores(df: DataFrame, score: str, label: str, thresholds: list[float]) -> DataFrame:
    """threshold, tp, fp, fn, f1 (0 where undefined) over all rows, in one pass without a cross join."""
    hit = lambda t: F.col(score) >= t
    sums = []
    for i, t in enumerate(thresholds):
        for name, c in (("tp", hit(t) & (F.col(label) == 1)), ("fp", hit(t) & (F.col(label) == 0)), ("fn", ~hit(t) & (F.col(label) == 1))):
            sums.append(F.count_if(c).alias(f"{name}{i}"))
    rows = F.explode(F.array(*(F.struct(F.lit(t).alias("threshold"), *(F.col(f"{n}{i}").alias(n) for n in ("tp", "fp", "fn"))) for i, t in enumerate(thresholds))))
    f1 = F.when(2 * F.col("tp") + F.col("fp") + F.col("fn") > 0, 2.0 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn"))).otherwise(0.0)
    return df.agg(*sums).select(rows.alias("r")).select("r.*").withColumn("f1", f1)


def best_threshold(scores: DataFrame, default: float = 0.45) -> DataFrame:
    best = scores.agg(F.max(F.struct("f1", (-F.col("threshold")).alias("t"))).alias("b"))
    return best.select(F.when(F.col("b.f1") > 0, -F.col("b.t")).otherwise(default).alias("threshold"), F.col("b.f1").alias("f1"))


def hash_order(key: Column, seed: int) -> Column:
    """A seeded order that any engine repeats."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)


def split(df: DataFrame, key: str, val_ratio: float, seed: int = 42, edge: int = 10_000) -> DataFrame:
    """Adds ``split``: the first max(1, int(n * ratio)) rows of the seeded order are val.

    The order is by the hash of the key, rows with one key and rows without by the hash of all their columns, so that no row
    is lost and no key weighs on one task.  The cut is found from counts by the hash's next 16 bits, as often as it takes until
    at most ``edge`` rows (or equal ones) share the prefix; only these are ranked.
    """
    encoded = F.sha2(encoded_row(df.columns), 256)
    keyed = df.withColumn("_h", F.concat(F.coalesce(hash_order(F.col(key), seed), encoded), encoded))
    prefix, before, size, n_val = "", 0, None, None
    while size is None or (size > edge and len(prefix) < 128 and before + size > n_val):
        counted = keyed.where(F.col("_h").startswith(prefix)).groupBy(F.substring("_h", len(prefix) + 1, 4).alias("p")).agg(F.count(F.lit(1)).alias("n"))
        counts = sorted(counted.collect())  # at most 65,536 rows
        if n_val is None:
            n_val = max(1, int(sum(r["n"] for r in counts) * val_ratio))
        if not counts:
            return df.withColumn("split", F.lit("train"))
        for r in counts:
            size = r["n"]
            if before + size >= n_val:
                prefix += r["p"]
                break
            before += size
    at = F.substring("_h", 1, len(prefix))
    rank = F.row_number().over(Window.orderBy("_h", key)) + before
    rest = keyed.where(at != prefix).withColumn("split", F.when(at < prefix, "val").otherwise("train"))
    return rest.unionByName(keyed.where(at == prefix).withColumn("split", F.when(rank <= n_val, "val").otherwise("train"))).drop("_h")


def encoded_row(columns: list[str]) -> Column:
    """The values of some columns as one text, equal only for equal values, nulls among them."""
    return F.concat_ws(",", *map(_encoded, columns))


def _encoded(column: str) -> Column:
    """A value as text that tells null from empty and where it ends."""
    c = F.col(f"`{column}`").cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.length(c).cast("string"), F.lit(":"), c))


def sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    return df.orderBy(hash_order(F.col(key), seed), key).limit(n)


def newly_admitted(df: DataFrame, score: str, low: float, high: float) -> DataFrame:
    """Rows that a lower threshold lets in and a higher one doesn't."""
    return df.where((F.col(score) >= low) & ~(F.col(score) >= high))


def admitted_sample(df: DataFrame, key: str, score: str, low: float, high: float, n: int = 15, seed: int = 0) -> DataFrame:
    """A seeded sample of the newly admitted rows, all if they are fewer."""
    return sample(newly_admitted(df, score, low, high), key, n, seed)


def limit_splits(train: DataFrame, val: DataFrame, n: int, *order: str) -> tuple[DataFrame, DataFrame]:
    """The first n rows of train and the first max(1, n div 10) of val."""
    return train.orderBy(*order).limit(n), val.orderBy(*order).limit(max(1, n // 10))


def content_lanes(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: n, lane0 to lane3: the sums modulo 2^64 of the four 64-bit parts of the rows' SHA-256.

    The state is of constant size and sums are added up in partial aggregates, so any order and any partitioning of the
    same rows gives the same, and the lanes of two datasets add up to those of their union.
    """
    hashed = df.select(F.sha2(encoded_row(columns), 256).alias("h"))
    part = lambda i: F.conv(F.substring("h", 16 * i + 1, 16), 16, 10).cast("decimal(28,0)")
    total = lambda i: F.coalesce(F.sum(part(i)), F.lit(0).cast("decimal(38,0)")) % F.lit(Decimal(1 << 64))
    return hashed.agg(F.count(F.lit(1)).alias("n"), *(total(i).cast("decimal(38,0)").cast("string").alias(f"lane{i}") for i in range(4)))


def content_hash(df: DataFrame, columns: list[str]) -> DataFrame:
    """The content hash of a dataset's rows, whatever their order: 12 digits of the hash of their lanes."""
    lanes = F.concat_ws(",", F.col("n").cast("string"), *(F.col(f"lane{i}") for i in range(4)))
    return content_lanes(df, columns).select(F.substring(F.sha2(lanes, 256), 1, 12).alias("content_hash"))


def funnel(flagged: DataFrame, stages: list[tuple[str, Column]]) -> DataFrame:
    """(stage_ord, stage, rows) from per-row conditions, or numbers of rows that a row stands for, in one pass."""
    counted = flagged.agg(*[F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(f"s{i}") for i, (_, c) in enumerate(stages)])
    rows = F.array(*[F.struct(F.lit(i).cast("long").alias("stage_ord"), F.lit(n).alias("stage"), F.col(f"s{i}").alias("rows")) for i, (n, _) in enumerate(stages)])
    return counted.select(F.explode(rows).alias("r")).select("r.*")


#: Keys of a manifest that the caller may give, and their values if not given.
_ABOUT = {"sources": [], "funnel": {}, "filter_eval": {}, "token_stats": {}, "decontamination": {}}


def write_dataset(df: DataFrame, quarantine: DataFrame, folder: str, name: str, key: str, val_ratio: float = 0.1, seed: int = 42, kind: str = "sft", keep_key: bool = True, **about) -> str:
    """Write train, val, quarantine and manifest under <folder>/<name>/<content hash>; an identical dataset is kept as it is.

    Without ``keep_key`` the key decides the split alone.  ``about`` may give the manifest's sources (a list), funnel, filter_eval, token_stats and decontamination (dicts).
    """
    if unknown := set(about) - {*_ABOUT}:
        raise TypeError(f"a manifest has no {sorted(unknown)}")
    spark = df.sparkSession
    parts = split(df, key, val_ratio, seed)
    digest = content_hash(parts, [c for c in df.columns if c != key] + ["split"]).first()["content_hash"]
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    final = fs_path(f"{folder}/{name}/{digest}")
    fs = final.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(final):
        staged = f"{folder}/{name}/.staged-{digest}"
        for part in ("train", "val"):
            parts.where(F.col("split") == part).drop("split", *([] if keep_key else [key])).write.mode("overwrite").parquet(f"{staged}/{part}")
        if not quarantine.isEmpty():
            quarantine.write.mode("overwrite").json(f"{staged}/quarantine")
        sizes = {r["split"]: r["count"] for r in parts.groupBy("split").count().collect()}
        manifest = _ABOUT | about | {"name": name, "kind": kind, "content_hash": digest, "n_train": sizes.get("train", 0), "n_val": sizes.get("val", 0), "n_total": sum(sizes.values()), "val_ratio": val_ratio, "seed": seed, "columns": [c for c in df.columns if keep_key or c != key], "key": key}
        out = fs.create(fs_path(f"{staged}/manifest.json"))
        out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        out.close()
        if not fs.rename(fs_path(staged), final) and not fs.exists(final):
            raise OSError(f"{staged} couldn't be moved to {final}")
    out = fs.create(fs_path(f"{folder}/{name}/latest_hash"), True)
    out.write(bytearray(digest.encode()))
    out.close()
    return digest
