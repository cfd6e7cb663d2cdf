"""Shared pieces of the corpus operators: scratch tables, Arrow iteration, hashing, counters, components.

Nothing here keeps rows on the driver.  Intermediate tables go, as Parquet, to the folder that the session names
in ``spark.checkpoint.dir``.  A local session without that setting gets a folder under the temp directory; on a cluster,
where such a folder would be another one on each machine, it is an error.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What a written side may have at most to be broadcast: rows, and bytes as they are in its files.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of whole texts are kept small, in the executor's memory and the worker's; a size that was set stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":  # Spark's default
        spark.conf.set(key, str(rows))


class Scratch:
    """A folder of written tables; a lost executor rereads them instead of recomputing or failing."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        small_batches(spark)
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            root = f"file://{tempfile.gettempdir()}/millrace-checkpoints"
        self.dir = f"{root.rstrip('/')}/millrace-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.dir}/{name}")
        return self.spark.read.parquet(f"{self.dir}/{name}")

    def drop(self, name: str = "") -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.dir}/{name}" if name else self.dir)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def maybe_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only if the (already written) table has at most ``limit`` rows and ``most`` bytes; else a shuffle join."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= most and df.count() <= limit else df


def unused(name: str, taken: list[str]) -> str:
    """``name``, with as many underscores before it as it takes to be none of ``taken`` in whatever case."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def numbered(docs: DataFrame, scratch: Scratch, name: str = "numbered") -> tuple[DataFrame, str]:
    """The rows with a number of their own that stays the same however often they are read, and the number's column.

    Rows that come straight from files are numbered by file and place in it; others are written once with their numbers.
    """
    row = unused("row", docs.columns)
    node = docs._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().head()
    if node.nodeName() != "LogicalRelation" or "row_index" not in _metadata_fields(docs):
        return scratch.save(docs.withColumn(row, F.monotonically_increasing_id()), name), row
    path = unused("path", [*docs.columns, row])
    located = docs.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(row))
    files = located.select(path).distinct().select(path, F.row_number().over(Window.orderBy(path)).cast("long").alias(f"{path}_no"))  # as many rows as files
    files = scratch.save(files, name)
    return located.join(maybe_broadcast(files), path).withColumn(row, F.shiftleft(f"{path}_no", 40) + F.col(row)).select(*(F.col(f"`{c}`") for c in docs.columns), row), row


def _metadata_fields(docs: DataFrame) -> str:
    """The fields of the hidden column that file sources have, or nothing."""
    try:
        return docs.select("_metadata").schema.simpleString()
    except AnalysisException:
        return ""


def batches(iterator, text_at: int = 1, size: int = 1024, binary: bool = False):
    """Slices of Arrow batches as (columns before text_at as lists, texts); null texts come out empty."""
    give_back()
    for whole in iterator:
        for at in range(0, whole.num_rows, size):
            part = whole.slice(at, size)
            texts = part.column(text_at)
            if binary:
                texts = texts.cast(pa.binary())
            empty = b"" if binary else ""
            yield part, [t if t is not None else empty for t in texts.to_pylist()]
    give_back()


def give_back() -> None:
    """Returns freed memory to the system at a task's start and end, as workers live on idle beside the next stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


class WordHashes(dict):
    """Word bytes to a 64-bit hash, computed once per worker; emptied when it has ``limit`` words."""

    def __init__(self, limit: int = 150_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xFF51AFD7ED558CCD)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(_ODD[4])
    return h ^ (h >> np.uint64(29))


def shingle_hashes(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """One 64-bit hash for each k-word window; a shorter sequence is one shingle as a whole; none without words."""
    n = len(word_hashes)
    if not n:
        return word_hashes
    width = min(k, n)
    h = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        h = mix(h * np.uint64(_ODD[1]) + word_hashes[i : i + n - width + 1])
    return h


def pack_counts(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.astype("<u8").tobytes(), 1)


def unpack_counts(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), "<u8")


def sum_counters(parts: DataFrame, key: str = "block", value: str = "counts") -> DataFrame:
    """Element-wise sums of packed counter arrays by key: first within partitions, then across them.

    A worker holds one array a key, whatever the number of rows; keys must be few and arrays of fixed length.
    """

    def add(iterator):
        sums: dict[int, np.ndarray] = {}
        for batch in iterator:
            for k, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                got = unpack_counts(data.as_py())
                sums[k] = sums[k] + got if k in sums else got
        for k, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([pack_counts(total)], pa.binary())], names=[key, value])

    schema = f"{key} int, {value} binary"
    first = parts.select(key, value).mapInArrow(add, schema)
    return first.repartition(key).mapInArrow(add, schema)


def components(scratch: Scratch, links: DataFrame, a: str = "a", b: str = "b", name: str = "cc") -> DataFrame:
    """Connected components of links by alternating large and small stars: (node, component), component the least node.

    Each round is written to scratch; a node links only to lesser ones in its neighbourhood, so no group of edges is
    gathered, and minima are combined before the shuffle.  Nodes without links don't appear.
    """
    spark = scratch.spark
    edges = scratch.save(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), f"{name}-0"
    )
    before, last, turn = None, f"{name}-0", 0
    while True:  # each round lowers some label or is the last
        turn += 1
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(down, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*")
            .where("u <> v")
            .distinct()
        )
        edges = scratch.save(small, f"{name}-{turn}")
        scratch.drop(last)
        last = f"{name}-{turn}"
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots).distinct()
