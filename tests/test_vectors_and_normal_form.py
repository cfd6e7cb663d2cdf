"""Centroids, k-means and the fitted domain filter against plain NumPy; normal form against the text-by-text form."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.functions import text as tx
from millrace.functions.normal import needing
from millrace.operators import curation as cu
from millrace.operators import vectors as ve


def units(m):
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-8)


@pytest.mark.parametrize(("n", "block"), [(10, 32 << 20), (5000, 32 << 20), (10, 200), (5000, 100_000)])
def test_similarity_to_many_centroids(spark, n, block):
    """One block or several give the same; rows with equal or null keys are rows of their own, null vectors have no score."""
    rng = np.random.default_rng(n)
    centroids, vectors = units(rng.normal(size=(n, 8))), rng.normal(size=(50, 8))
    rows = [(None if k % 5 == 0 else k % 3, v.tolist(), k) for k, v in enumerate(vectors)] + [(1, None, 50), (2, [0.0] * 8, 51)]
    df = spark.createDataFrame(rows, "s long, v array<double>, place int").repartition(3)
    got = ve.with_similarity(df.drop("s").withColumn("id", F.lit(1)), "v", spark.createDataFrame([(c.tolist(),) for c in centroids], "centroid array<double>"), block_bytes=block)
    found = {r["place"]: r["s"] for r in got.collect()}
    want = (units(vectors) @ centroids.T).max(axis=1)
    assert len(found) == 52 and found[50] is None and found[51] == 0.0
    assert np.allclose([found[k] for k in range(50)], want, atol=1e-12)
    literal = df.select("place", ve.best_similarity("v", centroids.tolist()).alias("s")).collect()
    assert {r["place"]: r["s"] for r in literal} == pytest.approx(found)


def test_without_centroids(spark):
    df = spark.createDataFrame([([1.0],)], "v array<double>")
    assert [r["s"] for r in ve.with_similarity(df, "v", spark.createDataFrame([], "centroid array<double>")).collect()] == [None]
    assert ve.kmeans_centroids(df.limit(0), "v").shape == (0, 0)


def plain_kmeans(vectors, order, k, starts, rounds=100):
    """Lloyd's steps from the same starts one by one; the least inertia wins."""
    x, best = units(vectors), None
    for s in range(starts):
        now, before, kept = x[order[s * k : (s + 1) * k]], None, None
        for _ in range(rounds):
            p = x @ now.T
            which = p.argmax(axis=1)
            inertia = np.rint(np.maximum(2 - 2 * p.max(axis=1), 0) * (1 << 20)).sum()
            if before is not None and inertia >= before:
                break
            before, kept = inertia, now
            now = np.array([units(x[which == c].sum(axis=0)[None])[0] if (which == c).any() else now[c] for c in range(k)])
        if best is None or before < best[0]:
            best = (before, kept)
    return best[1]


def test_kmeans_steps_all_starts_together(spark):
    import hashlib

    rng = np.random.default_rng(4)
    base = rng.normal(size=(6, 5)) * 2
    vectors = np.array([base[k % 6] + rng.normal(scale=0.6, size=5) for k in range(150)])
    df = spark.createDataFrame([(v.tolist(),) for v in vectors] + [(None,)], "v array<double>")
    said = [r[0] for r in df.where("v is not null").select(F.concat_ws(",", F.transform("v", lambda x: x.cast("string")))).collect()]
    rows = [r[0] for r in df.where("v is not null").select("v").collect()]
    order = sorted(range(len(rows)), key=lambda k: hashlib.sha256(f"42:{said[k]}".encode()).hexdigest())
    want = plain_kmeans(np.array(rows), order, 4, 6)
    for frame in (df, df.repartition(7)):
        got = ve.kmeans_centroids(frame, "v", k=4, starts=6)
        assert np.allclose(sorted(got.tolist()), sorted(want.tolist()), atol=1e-6)


def test_fitted_filter_is_the_best_cut(spark, sf):
    from millrace.plans.queries import domain_filter_fitted

    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = e.collect()
    found = ve.kmeans_centroids(e.where("label < 3"), "embedding", k=5)
    scores = (units(np.array([r["embedding"] for r in rows], np.float64)) @ found.T).max(axis=1)
    labels = np.array([-1 if r["label"] is None else int(r["label"] < 3) for r in rows])

    def f1(t):
        tp, fp, fn = ((scores >= t) & (labels == 1)).sum(), ((scores >= t) & (labels == 0)).sum(), ((scores < t) & (labels == 1)).sum()
        return 2 * tp / (2 * tp + fp + fn) if 2 * tp + fp + fn else 0.0

    best = max((round(f1(t / 100), 12), -t) for t in range(5, 100, 5))
    want = {r["vec_id"] for r, s in zip(rows, scores) if s >= -best[1] / 100}
    assert {r["vec_id"] for r in domain_filter_fitted(spark, sf).collect()} == want


def test_thresholds_and_both_stages(spark):
    rows = [("python code", [1.0, 0.0], 0.9, 1), ("python code", [0.0, 1.0], 0.2, 0), ("nice weather", [1.0, 0.0], 0.8, 1), (None, None, 0.1, 0)]
    df = spark.createDataFrame(rows, "t string, v array<double>, score double, label int")
    one = spark.createDataFrame([([1.0, 0.0],)], "centroid array<double>")
    assert ve.domain_filter(df, text="t").count() == 2
    assert ve.domain_filter(df, text="t", vector="v", centroids=one).count() == 1
    assert ve.domain_filter(df, vector="v", centroids=one, threshold=0.5).count() == 2
    fitted = ve.fitted_threshold(df, "score", "label", [0.1, 0.3, 0.5, 0.95])
    assert tuple(fitted.first()) == (0.3, 1.0)
    assert ve.domain_filter(df, vector="v", centroids=one, threshold=fitted).count() == 2
    assert tuple(ve.fitted_threshold(df.where("label = 0"), "score", "label", [0.1]).first()) == (0.45, 0.0)
    embedded = spark.createDataFrame([("ab",), (None,)], "t string").select(cu.embed(lambda ts: np.array([[len(t), 1.0] for t in ts]))("t").alias("v"))
    assert [[*r["v"]] for r in embedded.collect()] == [[2.0, 1.0], [0.0, 1.0]]


SIGNS = ["a", " ", "  ", "\n", "\n\n\n", "\t", "é", "e", "́", "각", "각", "&amp;", "&", "&nbsp;", "\xa0", " ", "\x1c", "\x85", "\0", "​", "﻿", "ﬁ", "Å", "क़", "ি", "া", "\U000e0001", "", "x", "　", "\r", "\x0b", "͏", "𝅗𝅥", "ά", ";"]


def test_normal_form_of_whole_batches():
    rng = random.Random(3)
    texts = [None, "", " ", "\n", "plain", "a b", "a\nb", " a", "a ", "a\n"] + ["".join(rng.choices(SIGNS, k=rng.randint(0, 8))) for _ in range(30_000)]
    texts += ["".join(chr(c) for c in (rng.choice([rng.randint(0, 0xD7FF), rng.randint(0xE000, 0x2FFFF), rng.randint(32, 126)]) for _ in range(rng.randint(1, 5)))) for _ in range(30_000)]
    assert tx.normalise_texts(texts) == [tx.normalise_text(t) for t in texts]
    assert tx.normalise_texts([]) == []


def test_every_sign_alone_and_behind_others():
    singles = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    assert tx.normalise_texts(singles) == [*map(tx.normalise_text, singles)]
    for lead in ("a", "ᄀ", "가", "ে"):
        texts = [lead + chr(c) + "z" for c in (*range(0x3100), *range(0xA000, 0xD7A4), *range(0xF900, 0x11000), *range(0x11000, 0x12000)) if not 0xD800 <= c < 0xE000]
        assert tx.normalise_texts(texts) == [*map(tx.normalise_text, texts)]


def test_plain_texts_are_left_alone():
    deep, light = needing(["one line\nand another, with é", "two  blanks", "x&y", ""])
    assert deep.tolist() == [False, False, True, False] and light.tolist() == [False, True, False, False]
    assert [*tx.normalise.func(pd.Series(["a" * (1 << 20), " b ", None]))] == ["a" * (1 << 20), "b", None]
