"""Null ids, repeated rows and columns whose names clash with an operator's own: each operator's defined result."""

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from millrace.llm import byte_bpe, exact_dedup, licenses, line_dedup, lm_score, ngram_join, packing, quality, toxicity, warc
from millrace.llm.common import Scratch, numbered

LINE = "these are more than six words of one line"
TEXT = f"{LINE}\nand a second line that has enough words\nshort"
ROWS = [
    (None, TEXT, None, None, None), (None, "an id is null here too but the words are others of course", "en", None, 1), (7, TEXT, "en", "s", 1), (7, TEXT, "en", "s", 1),
    (8, TEXT.upper(), None, "s", None), (9, None, None, None, None), (9, "", "", "", 0), (10, "y " * 60_000, "en", "s", 5), (10, "z" * 100_000, "en", "s", 5),
]
CLASHING = "n rest row group digit ended salt line_no near p s m h c at key w words n_lines n_words kept score token pos distance all x0 piece held_out toxic signature rep node a b gone __gone".split()


@pytest.fixture(scope="module")
def odd(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.withColumns({c: F.lit(None).cast("string") if k % 2 else F.lit(k) for k, c in enumerate(CLASHING)}).repartition(2).cache()


def found(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def by(rows):
    return sorted(rows, key=str)


def test_toxicity(odd, spark):
    labels = spark.createDataFrame([(7, 1, "x"), (None, 1, "x"), (8, None, "x"), (7, 0, "x")], "doc_id long, toxic int, text string")
    got = toxicity.toxicity(odd, labels)
    assert found(got, "doc_id") == by((r[0],) for r in ROWS) and got.where("score is null or held_out is null or predicted is null").isEmpty()
    lexicon = toxicity.Lexicon({"others": 9.0}, {})
    clean = toxicity.clean_rows(odd, lexicon)
    assert clean.columns == odd.columns and clean.count() == len(ROWS) - 1


def test_licenses(odd):
    assert found(licenses.summary(odd), "doc_id", "licences") == by((r[0], "") for r in ROWS)


def test_lm_score(odd, spark):
    targets = spark.createDataFrame([(7,), (7,), (None,)], "doc_id long")
    assert found(lm_score.scores(odd, targets), "doc_id") == by((r[0],) for r in ROWS)


def test_byte_bpe(odd):
    got = byte_bpe.encode_documents(odd, P.path("byte_bpe_multi_50k.tiktoken"), ("n_tokens", "decoded"))
    assert by((r[0], bytes(r[1]).decode()) for r in got.select("doc_id", "decoded").collect()) == by((r[0], r[1] or "") for r in ROWS)


def test_exact_dedup(odd):
    keep = {TEXT.lower(): (8, 4), "": (9, 2)}
    got = exact_dedup.radix_groups(odd)
    assert found(got, "doc_id", "keep_id", "group_size") == by((r[0], *keep.get((r[1] or "").lower(), (r[0], 1))) for r in ROWS)
    assert got.where("kept").count() == len({(r[1] or "").lower() for r in ROWS})


def test_packing(odd):
    got = packing.pack(odd, P.path("word_bpe_49k.json"), capacity=4096)
    assert got.where("start = 0").count() == len(ROWS)
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).where("n > 4096 or n <> end").isEmpty()


def test_quality(odd):
    got = quality.verdicts(odd)
    assert found(got, "doc_id") == by((r[0],) for r in ROWS) and got.where("kept is null").isEmpty()
    assert found(got.where("doc_id = 9"), "n_words", "kept") == [(0, False)] * 2


def test_ngram_join(odd):
    got = found(ngram_join.join_components(odd, 3, 90), "doc_id", "component_id")
    assert got == by((r[0], 7 if r[0] == 8 else r[0]) for r in ROWS)


def test_line_dedup(odd):
    got = line_dedup.dedup_lines(odd)
    assert set(odd.columns) | {"n_equal", "n_near"} == set(got.columns) and got.count() == len(ROWS)
    assert {r[0] for r in got.where("doc_id in (7, 8)").select("text").collect()} == {""}  # all lines are in the row without an id
    assert found(got.where("doc_id is null"), "text") == by([(TEXT,), (ROWS[1][1],)])


def test_line_dedup_loses_no_line(spark):
    """Rows that share an id or have none: each line is left at least once, wherever it first comes."""
    u = "this line is in one row of the table alone"
    rows = [(1, LINE), (10, LINE), (10, u), (None, f"a\nb\nc\n{LINE}"), (None, f"a\nb\nc\n{u} too"), (None, None), (10, f"x\n{u}\n" * 200 + "last")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = [(r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(docs).collect()]
    # The rows without an id come first; the longer near line comes first too, so u itself goes.
    assert by(got) == by([(None, f"a\nb\nc\n{LINE}"), (None, f"{u} too"), (None, None), (1, ""), (10, ""), (10, ""), (10, "x\nlast")])


def test_warc(spark):
    pages = spark.createDataFrame([(None, None, "<p>"), (3, "u", "<p>"), (3, "u", "<p>"), (4, "u", "<p>"), (4, "v", "<p>"), (2, None, None), (1, "", "")], "page_id long, url string, html string")
    pages = pages.withColumns({c: F.lit("x") for c in ("payload_digest", "row", "file", "record_type", "offset")})
    folder = f"{Scratch(spark).dir}/archives"
    got = warc.read_archives(warc.write_archives(pages, folder, least_bytes=0), folder, ("page_id", "payload_bytes", "record_type"))
    assert found(got, "page_id", "payload_bytes") == by([(None, 3), (3, 3), (3, 3), (4, 3), (4, 3), (2, 0), (1, 0)])
    assert got.where("record_type = 'response'").count() == 3  # of the equal rows each


def test_rows_of_files_are_numbered_without_a_copy(odd, spark):
    scratch = Scratch(spark)
    written = scratch.save(odd.repartition(5), "written")
    rows, row = numbered(written.where("n_chars is null or n_chars >= 0").select("doc_id", "text", "row"), scratch)
    assert row == "_row" and rows.columns == ["doc_id", "text", "row", "_row"]
    assert rows.select(row).distinct().count() == len(ROWS) and found(rows, row, "doc_id", "text") == found(rows.repartition(3), row, "doc_id", "text")
    assert "LogicalRDD" not in str(rows._jdf.queryExecution().analyzed()) and found(rows, "doc_id") == by((r[0],) for r in ROWS)
    twice, row = numbered(written.select("doc_id").union(written.select("doc_id")), scratch, "twice")
    assert twice.select(row).distinct().count() == 2 * len(ROWS)
