"""A corpus pipeline in five stages: toxicity, quality rules, line dedup, n-gram Jaccard join, best-fit packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs.  All but the last return the columns of ``documents``.

Defined results: decisions are by row, so rows that share a doc_id, or have none, are documents of their own; of near
duplicates the row with the least doc_id stays (one without an id only if none has one, of equal ids the first row read); a
document whose lines all go in line dedup goes; empty and null texts pass toxicity and fail the quality rules; texts of any
length are read whole; columns other than those of ``documents`` are left out; an empty table passes through as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import Scratch, maybe_broadcast, numbered, table
from millrace.llm.line_dedup import dedup_lines
from millrace.llm.ngram_join import join_components
from millrace.llm.packing import pack
from millrace.llm.quality import verdicts
from millrace.llm.queries import tokenizer_path
from millrace.llm.toxicity import clean_rows, fit, held_out

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _numbered(spark: SparkSession, docs: DataFrame) -> tuple[Scratch, DataFrame]:
    """The rows with numbers of their own, written, by which decisions are carried."""
    scratch = Scratch(spark)
    return scratch, numbered(docs.select(*COLUMNS), scratch)[0]


def _without(scratch: Scratch, rows: DataFrame, gone: DataFrame) -> DataFrame:
    gone = scratch.save(gone.select(F.col("doc_id").alias("row")), "gone")
    return rows.join(maybe_broadcast(gone), "row", "left_anti").select(*COLUMNS)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lexicon = fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out()))
    return clean_rows(docs.select(*COLUMNS), lexicon)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scratch, rows = _numbered(spark, docs)
    return _without(scratch, rows, verdicts(rows.select(F.col("row").alias("doc_id"), "text", "lang", "source")).where("not kept"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = dedup_lines(docs.select(*COLUMNS))
    left = kept.where("n_equal + n_near = 0 or trim(replace(text, '\n', '')) <> ''")
    return left.withColumn("n_chars", F.when(F.col("n_equal") + F.col("n_near") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scratch, rows = _numbered(spark, docs)
    found = join_components(rows.select(F.col("row").alias("doc_id"), "text"), k=5, percent=80)
    sizes = found.groupBy("component_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    linked = scratch.save(found.join(sizes, "component_id").select("component_id", F.col("doc_id").alias("row")), "linked")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    named = scratch.save(rows.select("doc_id", "row").join(linked, "row").select("component_id", "row", order.alias("order")), "named")
    first = named.groupBy("component_id").agg(F.min("order").alias("first")).select(F.col("first.row").alias("row"))
    return _without(scratch, rows, named.join(first, "row", "left_anti").select(F.col("row").alias("doc_id")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, tokenizer_path("word_bpe_49k.json"), capacity=4096)


STAGES = [
    ("toxicity", toxicity_stage), ("quality rules", quality_stage), ("line dedup", line_stage),
    ("n-gram Jaccard join", near_stage), ("best-fit packing", packing_stage),
]

#: The stages can't be expressed in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage-{k}")
        if k:
            scratch.drop(f"stage-{k - 1}")
    return docs
