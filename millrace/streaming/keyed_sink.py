"""A resumable sink: rows whose key it has never written, each batch once, however many batches came before.

``<folder>/epoch=N`` has a batch's rows, ``<folder>/_keys/epoch=N/bucket=B`` the hashes of their keys, and ``<folder>/_commits/N``, written
last and as a whole, says for each bucket which epochs' key files hold all its keys.  A batch reads the last commit and the key
files of the buckets that its own keys fall in, of which there are never more than ``most`` a bucket: a bucket with so many gets
one new file with all of them.  A batch that stopped before its commit is written anew; one that was committed is left alone.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.curation import encoded_row
from ..sources.files import Files


class KeyedSink:
    """One writer at a time; null keys are keys like others, and of rows of one key in a batch one is written."""

    def __init__(self, folder: str, keys: list[str], buckets: int = 64, most: int = 8):
        self.folder, self.keys, self.buckets, self.most = folder.rstrip("/"), keys, buckets, most

    def _hash(self) -> Column:
        return F.unhex(F.substring(F.sha2(encoded_row(self.keys), 256), 1, 32))

    def commits(self, spark: SparkSession) -> list[int]:
        return sorted(int(n) for n in Files(spark, self.folder).names("_commits") if n.isdigit())

    def _held(self, spark: SparkSession, places: dict[str, list[int]], buckets: list[int]) -> DataFrame | None:
        paths = [f"{self.folder}/_keys/epoch={e}/bucket={b}" for b in buckets for e in places.get(str(b), [])]
        return spark.read.schema("k binary").parquet(*paths) if paths else None

    def write(self, batch: DataFrame, epoch: int) -> None:
        """For foreachBatch."""
        spark = batch.sparkSession
        files, commits = Files(spark, self.folder), self.commits(spark)
        if epoch in commits:
            return
        places: dict[str, list[int]] = json.loads(files.read(f"_commits/{commits[-1]}"))["places"] if commits else {}
        names = batch.columns
        key = next(k for k in ("_k", "__k", "___k") if k not in names)
        keyed = batch.withColumn(key, self._hash())
        bucket = F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")
        own = [r[0] for r in keyed.select(bucket.alias("b")).distinct().collect()]  # at most ``buckets`` rows
        rows = keyed.dropDuplicates([key])
        held = self._held(spark, places, own)
        if held is not None:
            rows = rows.join(held.withColumnRenamed("k", key), key, "left_anti")
        rows.select(names).write.mode("overwrite").parquet(f"{self.folder}/epoch={epoch}")
        written = spark.read.schema(batch.schema).parquet(f"{self.folder}/epoch={epoch}").withColumn(key, self._hash())
        fresh = written.select(F.col(key).alias("k"), bucket.alias("bucket"))
        full = [b for b in own if len(places.get(str(b), [])) >= self.most]
        if full:
            old = self._held(spark, places, full)
            fresh = fresh.unionByName(old.select("k", F.pmod(F.xxhash64("k"), F.lit(self.buckets)).cast("int").alias("bucket")))
        fresh.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/_keys/epoch={epoch}")
        for name in files.names(f"_keys/epoch={epoch}"):
            if name.startswith("bucket="):
                b = name.removeprefix("bucket=")
                places[b] = [epoch] if int(b) in full else [*places.get(b, []), epoch]
        files.put(f"_commits/{epoch}", json.dumps({"places": places}, sort_keys=True))

    def rows(self, spark: SparkSession, schema=None) -> DataFrame | None:
        """The rows of all committed batches; without a batch an empty table of ``schema``, or None."""
        paths = [f"{self.folder}/epoch={e}" for e in self.commits(spark)]
        if not paths:
            return spark.createDataFrame([], schema) if schema else None
        reader = spark.read.schema(schema) if schema else spark.read
        return reduce(DataFrame.unionByName, [reader.parquet(*paths)])
