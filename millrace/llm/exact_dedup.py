"""Exact duplicates by distributed most-significant-digit radix partitioning.

A digit is a block of successive bytes; widths grow from round to round, so that a text of n bytes needs about
log8(n / 64) rounds.  In each round the rows of a group are split by (digit, whether the text ended in it); a group is
done when it has one row or has ended, and only rows of other groups go on, with the bytes not yet read.  Equality is
that of the bytes themselves; no digest decides it.

A digit's count and largest id are combined before the shuffle and found by (group, digit, salt), so that a text with a
third of all rows is spread over as many tasks as the number of rows asks for and no task gathers a group.  Each round is a
written table, of which the rows that go on are dropped once the next round is written.

Defined results: a null text counts as empty; all empty texts are equal; texts of any length are compared whole; of equal
texts the row with the largest doc_id stays (of rows equal in doc_id too, one); a null doc_id is less than any other; other
columns, whatever their names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, batches

FIRST_WIDTH, GROWTH = 64, 8


def normalised(docs: DataFrame) -> DataFrame:
    """doc_id, rest (the text's UTF-8 with A-Z in lower case), text_sha256."""

    def run(iterator):
        for part, texts in batches(iterator, binary=True):
            low = [t.lower() for t in texts]  # bytes: only A-Z change
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(low, pa.binary()), pa.array([hashlib.sha256(t).hexdigest() for t in low], pa.string())],
                names=["doc_id", "rest", "text_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, rest binary, text_sha256 string")


def radix_groups(docs: DataFrame, salts: int = 32, salt_rows: int = 100_000) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256, rounds."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    active = normalised(docs).withColumns({"row": F.monotonically_increasing_id(), "group": F.lit(0).cast("long"), "rest": F.col("rest")})
    active = scratch.save(active, "round-0")
    salts = max(salts, active.count() // salt_rows)
    results, width, turn = [], FIRST_WIDTH, 0
    while True:
        turn += 1
        keys = ["group", "digit", "ended", "salt"]
        tagged = active.withColumns({
            "digit": F.substring("rest", 1, width), "ended": F.octet_length("rest") <= width, "salt": (F.col("row") % salts).cast("int"),
        })
        partial = tagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", "row")).alias("top"))
        total = partial.groupBy("group", "digit", "ended").agg(F.sum("n").alias("n"), F.max("top").alias("top"), F.collect_set("salt").alias("salts"))
        total = total.select("group", "digit", "ended", "n", "top", F.explode("salts").alias("salt"))
        split = tagged.join(total, keys).select(
            "doc_id", "row", "text_sha256", F.col("top.row").alias("group"), F.col("top.doc_id").alias("keep_id"), "n",
            (F.col("ended") | (F.col("n") == 1)).alias("done"), F.when(~F.col("ended") & (F.col("n") > 1), F.expr(f"substring(rest, {width + 1})")).alias("rest"),
        )
        split.write.partitionBy("done").mode("overwrite").parquet(f"{scratch.dir}/split-{turn}")
        scratch.drop("round-0" if turn == 1 else f"split-{turn - 1}/done=false")
        split = spark.read.schema(split.schema).parquet(f"{scratch.dir}/split-{turn}")
        results.append(split.where("done").select(
            "doc_id", "keep_id", F.col("n").alias("group_size"), (F.col("row") == F.col("group")).alias("kept"), "text_sha256", F.lit(turn).alias("rounds"),
        ))
        active = split.where("not done").select("doc_id", "rest", "text_sha256", "row", "group")
        if active.isEmpty():
            break
        width *= GROWTH
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out
