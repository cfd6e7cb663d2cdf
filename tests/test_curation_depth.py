"""Decontamination, near dedup, splits and content hashes against plain Python, on null, repeated and clashing keys too."""

import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.functions import grams as gr
from millrace.functions.text import char_shingles, ngrams, word_tokens
from millrace.operators import curation as cu
from millrace.operators import near_dup as nd
from millrace.plans.scratch import writer

WORDS = ["a", "the", "ΑΣ", "İx", "foo_1", "日本", "½", "é", "x" * 30, " ", "-", "́"]


def plain_grams(text, n):
    w = re.findall(r"\w+", (text or "").lower())
    return {" ".join(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {" ".join(w)} if w else set()


def some_texts(rng, n):
    return [None, "", " ", "a"] + ["".join(rng.choice(WORDS) + rng.choice([" ", ". ", "\n", ""]) for _ in range(rng.randint(0, 30))) for _ in range(n)]


@pytest.mark.parametrize("n", [1, 3, 13])
def test_rolled_hashes_find_what_strings_find(n):
    texts = some_texts(random.Random(n), 800)
    held = set().union(*(plain_grams(t, n) for t in texts[::7]))
    assert {*gr.gram_strings(texts[::7], n)} == held
    index = gr.GramIndex(sorted(held), n)
    want = [len(plain_grams(t, n) & held) for t in texts]
    assert index.overlaps(texts).tolist() == want and [*index.series(pd.Series(texts, dtype=object))] == want
    assert not gr.GramIndex([], n).overlaps(texts).any()


def test_equal_hashes_are_told_apart_as_strings(monkeypatch):
    monkeypatch.setattr(gr, "stirred", lambda h: h & np.uint64(3))
    texts = [" ".join(p) for p in zip("abcdefgh" * 3, "hgfedcba" * 3, "aabbccdd" * 3)]
    index = gr.GramIndex(sorted({g for t in texts[:3] for g in plain_grams(t, 2)}), 2)
    assert index.overlaps(texts).tolist() == [len(plain_grams(t, 2) & {g for t in texts[:3] for g in plain_grams(t, 2)}) for t in texts]


def test_sql_grams_are_the_same(spark):
    texts = [(t,) for t in some_texts(random.Random(2), 100)]
    df = spark.createDataFrame(texts, "t string").select("t", ngrams(word_tokens(F.col("t")), 3).alias("g"), char_shingles(F.col("t")).alias("c"))
    for r in df.collect():
        if r["t"] is not None:
            assert {*r["g"]} == plain_grams(r["t"], 3)
            assert {*r["c"]} == {r["t"][i : i + 5] for i in range(len(r["t"]) - 4)}


@pytest.mark.parametrize("sizes", [{}, {"most": 0}, {"most": 0, "block": 40}])
def test_rows_are_judged_one_by_one(spark, sizes):
    """An index that is broadcast, or split into one or several blocks, gives the same; null, repeated and clashing keys are rows."""
    rng = random.Random(4)
    texts = some_texts(rng, 200)
    prompts = [(t,) for t in texts[::9]]
    held = set().union(*(plain_grams(t, 3) for (t,) in prompts))
    rows = [(rng.choice([None, k, 7]), t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "_row long, t string").repartition(3)
    index = cu.gram_index(spark.createDataFrame(prompts, "p string"), "p", 3)
    order = lambda r: (r[0] is None, r[0] or 0, r[1] or "", r[1] is None)
    for least in (1, 2):
        left = cu.decontaminate(df, "t", index, 3, least, **sizes)
        assert left.columns == ["_row", "t"]
        assert sorted(map(tuple, left.collect()), key=order) == sorted((r for r in rows if len(plain_grams(r[1], 3) & held) < least), key=order)
    hit = cu.contaminated(df, "_row", "t", index, 3, **sizes)
    want = [(k, len(plain_grams(t, 3) & held)) for k, t in rows]
    assert sorted(map(tuple, hit.collect()), key=lambda r: (r[0] is None, r)) == sorted((w for w in want if w[1]), key=lambda r: (r[0] is None, r))


def test_no_rows_and_no_index(spark):
    none = spark.createDataFrame([], "i long, t string")
    some = spark.createDataFrame([(1, "a b c")], "i long, t string")
    for sizes in ({}, {"most": -1}):
        assert cu.decontaminate(none, "t", cu.gram_index(some, "t"), **sizes).collect() == []
        assert cu.decontaminate(some, "t", cu.gram_index(none, "t"), **sizes).count() == 1


# Near dedup.


def greedy(rows, verify=None, bands=nd.BANDS):
    """Texts in order of (key is null, key), ties as they come: the indexes that stay."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    signs = [*nd.band_hashes(pd.Series([t for _, t in rows], dtype=object), bands)]
    sets = [{t[i : i + 5] for i in range(len(t) - 4)} for t in (t or "" for _, t in rows)]
    kept = []
    for k in order:
        def alike(j):
            if (rows[k][1] or "") == (rows[j][1] or ""):
                return True
            if not any(a == b for a, b in zip(signs[k], signs[j])):
                return False
            return verify is None or len(sets[k] & sets[j]) >= verify * len(sets[k] | sets[j]) > 0

        if not any(alike(j) for j in kept):
            kept.append(k)
    return sorted(kept)


def near_texts(rng, n, copies):
    words = [f"w{i}" for i in range(60)]
    base = [" ".join(rng.choices(words, k=rng.choice([20, 60, 120]))) for _ in range(n)]
    out = [None, "", "abc", "abd", "abc"]
    for b in base:
        for _ in range(copies):
            w = b.split()
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                w[rng.randrange(len(w))] = rng.choice(words)
            out.append(" ".join(w))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize(("verify", "bands", "pivots"), [(None, None, 64), (0.85, None, 64), (0.85, 32, 1)])
def test_near_dedup_is_greedy_on_odd_keys(spark, verify, bands, pivots):
    rng = random.Random(8)
    texts = near_texts(rng, 7, 9)
    rows = [(rng.choice([None, k, k, 3]), t, k) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id long, t string, _row long").coalesce(1)
    got = nd.near_dedup(df, "id", "t", writer(spark), verify, bands, pivots)
    assert got.columns == ["id", "t", "_row"]
    assert sorted(r["_row"] for r in got.collect()) == greedy([r[:2] for r in rows], verify, bands or (nd.BANDS if verify is None else nd.VERIFIED_BANDS))


def test_near_dedup_of_nothing(spark):
    none = spark.createDataFrame([], "id long, t string")
    assert nd.near_dedup(none, "id", "t", writer(spark)).collect() == []
    assert nd.near_dedup(none, "id", "t", writer(spark), verify=0.85).collect() == []


def test_bands_recall_similar_pairs():
    """Of pairs with a similarity of 0.85 or more the bands of the verified form have at least nine in ten in common."""
    texts = [t for t in near_texts(random.Random(9), 25, 8) if t and len(t) > 20]
    sets = [{t[i : i + 5] for i in range(len(t) - 4)} for t in texts]
    signs = [*nd.band_hashes(pd.Series(texts), nd.VERIFIED_BANDS)]
    pairs = [(i, j) for j in range(len(texts)) for i in range(j) if len(sets[i] & sets[j]) >= 0.85 * len(sets[i] | sets[j])]
    found = sum(any(a == b for a, b in zip(signs[i], signs[j])) for i, j in pairs)
    assert len(pairs) > 200 and found >= 0.9 * len(pairs)


def test_verified_query(spark, sf):
    from millrace.plans.queries import near_dup_verified

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    kept = greedy(rows, 0.85, nd.VERIFIED_BANDS)
    assert sorted(r["doc_id"] for r in near_dup_verified(spark, sf).collect()) == sorted(rows[k][0] for k in kept)


# Splits and content hashes.


@pytest.mark.parametrize("edge", [10_000, 1])
def test_split_keeps_every_row(spark, edge):
    """Null, repeated and clashing keys: no row is lost, the first tenth is val, and the split is the same in any partitioning."""
    rows = [(None, f"n{k}") for k in range(40)] + [(7, f"r{k}") for k in range(40)] + [(7, "same")] * 30 + [(k, f"u{k}") for k in range(100, 190)]
    df = spark.createDataFrame(rows, "id long, _t string")
    got = sorted(map(tuple, cu.split(df, "id", 0.1, edge=edge).collect()), key=str)
    assert sorted(map(str, (r[:2] for r in got))) == sorted(map(str, rows))
    assert sum(r[2] == "val" for r in got) == 20
    assert got == sorted(map(tuple, cu.split(df.repartition(5), "id", 0.1, edge=edge).collect()), key=str)
    assert [r[2] for r in cu.split(df.where("id = 100"), "id", 0.1).collect()] == ["val"]
    assert cu.split(df.where("id = 0"), "id", 0.1).collect() == []


def test_content_hash_is_of_the_rows_alone(spark):
    rows = [(k, None if k % 3 == 0 else "" if k % 3 == 1 else f"t{k}", "x" * (k % 4)) for k in range(30)]
    df = spark.createDataFrame(rows, "i long, t string, u string")
    digest = lambda d: cu.content_hash(d, ["t", "u"]).first()["content_hash"]
    assert digest(df) == digest(df.repartition(7)) == digest(df.orderBy("u")) and len(digest(df)) == 12
    others = [df.withColumn("t", F.coalesce("t", F.lit(""))), df.where("i > 0"), df.union(df.limit(1)), df.withColumn("t", F.when(F.col("i") == 5, "t").otherwise(F.col("t"))), df.select("i", F.concat_ws("", "t", "u").alias("t"), F.lit("").alias("u"))]
    assert len({digest(df), *map(digest, others)}) == 6
    lanes = lambda d: [int(x) for x in cu.content_lanes(d, ["t", "u"]).first()]
    assert lanes(df) == [(a + b) % 2**64 for a, b in zip(lanes(df.where("i < 10")), lanes(df.where("i >= 10")))]
    assert lanes(df.where("i < 0")) == [0] * 5


def test_datasets_are_written_whole_and_checked_when_resolved(spark, tmp_path):
    from millrace.sources import loaders as ld

    folder = f"file://{tmp_path}"
    rows = [(None if k % 4 == 0 else k % 9, f"Q{k}", None) for k in range(60)]
    df = spark.createDataFrame(rows, "i long, q string, a string")
    digest = cu.write_dataset(df, spark.createDataFrame([("x",)], "raw string"), folder, "d", "i")
    path = ld.resolve_dataset(spark, folder, digest)
    back = spark.read.parquet(f"{path}/train").union(spark.read.parquet(f"{path}/val"))
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert spark.read.json(f"{path}/quarantine").count() == 1
    registry = spark.createDataFrame([(digest, path), ("000000000000", "nowhere")], "content_hash string, path string")
    assert ld.resolve_dataset(spark, f"{folder}/elsewhere", digest, registry) == path
    with pytest.raises(LookupError):
        ld.resolve_dataset(spark, folder, "123456789abc", registry)
    spark.createDataFrame([(1, "other", None)], "i long, q string, a string").write.mode("overwrite").parquet(f"{path}/val")
    with pytest.raises(ValueError):
        ld.resolve_dataset(spark, folder, digest)


def test_verified_texts_travel_once(spark):
    """Rows of one group meet each earlier pivot once: what is sent grows with the rows and not with their bands, and no pair is left out."""
    rng = random.Random(12)
    base = [rng.choices([f"w{i}" for i in range(300)], k=400) for _ in range(4)]
    rows = [(b * 100 + k, " ".join([*base[b], f"x{k}"])) for b in range(4) for k in range(12)]
    names, sent = [], {}

    def keep(df, name, save=writer(spark)):
        names.append(name)
        return sent.setdefault(name, save(df, name))

    df = spark.createDataFrame(rows, "id long, t string").coalesce(1)
    assert sorted(r["id"] for r in nd.near_dedup(df, "id", "t", keep, verify=0.85).collect()) == [0, 100, 200, 300]
    bands = {}
    for r in sent["bands"].collect():
        bands.setdefault((r["band"], r["h"]), []).append((r["at"]["key"], r["id"]))
    pairs = {(u, v) for m in bands.values() for i, (_, v) in enumerate(sorted(m)) for _, u in sorted(m)[:i]}
    met = [(u, r["id"]) for r in sent["meetings-1"].collect() for u in r["others"]]
    assert len(met) == len(set(met)) and set(met) == pairs
    assert sent["meetings-1"].count() <= 1.5 * len(rows) < sum(map(len, bands.values()))
    largest = max(sum(len(x or b"") for r in t.collect() for x in r if isinstance(x, (bytes, bytearray))) for t in sent.values())
    assert largest < sum(len(t) for _, t in rows)
