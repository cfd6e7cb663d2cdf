"""The registered queries of the corpus operators and the SQL that some of them can be held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import Scratch, table


def tokenizer_path(name: str) -> str:
    """Where the vocabulary files are; they aren't part of this repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import summary

    return summary(table(spark, sf_dir, "documents"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_score import scores

    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return scores(table(spark, sf_dir, "documents"), good)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .byte_bpe import encode_documents

    return encode_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_multi_50k.tiktoken"), ("n_tokens", "ids_sha256", "decoded_sha256"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import radix_groups

    return radix_groups(table(spark, sf_dir, "documents")).drop("rounds")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), capacity=4096)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import verdicts

    return verdicts(table(spark, sf_dir, "documents"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import join_components

    return join_components(table(spark, sf_dir, "documents"), k=3, percent=90)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import read_archives, write_archives

    folder = f"{Scratch(spark).dir}/archives"
    manifest = write_archives(table(spark, sf_dir, "pages"), folder, least_bytes=0)
    return read_archives(manifest, folder, ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import dedup_lines

    kept = dedup_lines(table(spark, sf_dir, "documents"))
    return kept.selectExpr("doc_id", "n_lines", "n_equal", "n_near", "coalesce(text, '') as kept_text")


def op11_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sentence_pieces import encode_documents

    return encode_documents(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), ("n_tokens", "ids_sha256", "decoded_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .hard_negatives import mine

    label = "case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label"
    return mine(table(spark, sf_dir, "embeddings").selectExpr("vec_id as id", "embedding as vector", label, "vec_id % 100 = 0 as anchor"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .conversations import damaged, repair

    return repair(table(spark, sf_dir, "conversations"), damaged)


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_license_scan, op3_lm_score, op4_byte_bpe, op5_exact_dedup, op6_best_fit_packing,
        op7_quality_rules, op8_ngram_join, op9_warc, op10_line_dedup, op11_sentence_pieces, op12_hard_negatives, op13_conversation_repair,
    )
}

_EXACT = r"""
with n as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
g as (select t, max(doc_id) as keep_id, count(*) as group_size from n group by t)
select n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id as kept, sha256(n.t) as text_sha256
from n join g on n.t = g.t
"""


def _oracles() -> dict[str, str]:
    from . import hard_negatives, line_dedup

    return {"op5_exact_dedup": _EXACT, "op10_line_dedup": line_dedup.ORACLE, "op12_hard_negatives": hard_negatives.ORACLE}


ORACLES = _oracles()
