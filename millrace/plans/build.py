"""The dataset build: load, validate, normalise, filter, dedup, decontaminate, project, write; rows, quarantine and funnel."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lexicon import is_technical
from ..functions.text import whitespace_tokens
from ..operators import curation as cu
from ..operators import evaluation as ev
from ..operators import near_dup as nd
from ..operators import vectors as ve
from ..schemas import PREFERENCE, SFT, preference_error, preference_full_text, prompt_text, sft_error, sft_full_text
from ..sources.loaders import CATALOG, load_all, of_kind
from .scratch import writer


@dataclass
class Built:
    """rows (key and the record's columns), quarantine (raw, source, error, stage), funnel (stage_ord, stage, rows); about: what a manifest says of the build."""

    rows: DataFrame
    quarantine: DataFrame
    funnel: DataFrame
    about: dict = field(default_factory=dict)


@dataclass
class Domain:
    """The second stage of the domain filter: an embedding (texts to a matrix), the unit centroids and the least similarity."""

    encode: Callable[[list[str]], np.ndarray]
    centroids: DataFrame
    threshold: float = 0.45
    about: dict = field(default_factory=dict)


#: Thresholds that are tried.
THRESHOLDS = (0.3, 0.35, 0.4, 0.45, 0.5, 0.55, 0.6)


def fit_domain(prompts: DataFrame, encode: Callable[[list[str]], np.ndarray], labels: DataFrame | None = None, k: int = 5, thresholds: tuple[float, ...] = THRESHOLDS, default: float = 0.45) -> Domain:
    """Centroids of the evaluation's prompts, and the threshold that tells hand-labelled texts (text, label) best, if there are some."""
    spark, embedded = prompts.sparkSession, cu.embed(encode)
    found = ve.kmeans_centroids(prompts.select(embedded("prompt").alias("v")), "v", k)
    centroids = spark.createDataFrame([(c.tolist(),) for c in found], "centroid array<double>")
    if labels is None:
        return Domain(encode, centroids, default)
    scored = ve.with_similarity(labels.select("label", embedded("text").alias("v")), "v", centroids).select("label", "s")
    tried = [r.asDict() for r in cu.threshold_scores(scored, "s", "label", [*thresholds]).collect()]  # a row a threshold
    best = max(tried, key=lambda r: (r["f1"], -r["threshold"]))
    threshold = best["threshold"] if best["f1"] > 0 else default
    return Domain(encode, centroids, threshold, {"threshold": threshold, "f1_by_threshold": {f"{r['threshold']:g}": round(r["f1"], 4) for r in tried}, "n_labelled": labels.count()})


def _bad(df: DataFrame, columns: list[str], stage: str) -> DataFrame:
    return df.where("error is not null").select(F.to_json(F.struct(*columns)).alias("raw"), "source", "error", F.lit(stage).alias("stage"))


def build_dataset(
    df: DataFrame, kind: str, key: str, save, eval_prompts: DataFrame | None = None, technical_only: bool = False, near: bool = False, n: int = 13, domain: Domain | None = None, verify: float | None = None
) -> Built:
    """Build from records (key, the kind's columns) in the order of ``key``; ``save(df, name)`` writes a stage and reads it again.

    Decontamination looks at the prompt's side, and dedup at whole texts, the first row of each staying; near duplicates are verified
    if ``verify`` gives a similarity.
    """
    columns = (SFT if kind == "sft" else PREFERENCE).names
    error = sft_error if kind == "sft" else preference_error
    prompt, whole = (prompt_text(), sft_full_text()) if kind == "sft" else (F.col("prompt"), preference_full_text())
    checked = save(df.select(key, *columns).withColumn("error", error()), "checked")
    valid = checked.where("error is null").drop("error")
    normal = save(cu.normalise_fields(valid, columns[:3]).withColumn("error", error()), "normal")
    bad = _bad(checked, columns, "validation").unionByName(_bad(normal, columns, "normalisation"))
    rows, counts, about = normal.where("error is null").drop("error"), [("loaded", checked), ("validated", valid), ("quarantined", bad)], {}
    if technical_only:
        rows = save(rows.where(is_technical(prompt)), "technical")
        counts.append(("after_keyword", rows))
    if domain is not None:
        embedded = rows.withColumn("_vector", cu.embed(domain.encode)(prompt))
        rows = save(ve.domain_filter(embedded, vector="_vector", centroids=domain.centroids, threshold=domain.threshold, score="_s").drop("_vector", "_s"), "near-domain")
        counts.append(("after_embedding", rows))
        about["filter_eval"] = domain.about
    rows = save(cu.exact_dedup(rows, whole, [key]), "distinct")
    if near:
        rows = save(nd.near_dedup(rows.withColumn("_whole", whole), key, "_whole", save, verify).drop("_whole"), "apart")
    counts.append(("after_dedup", rows))
    if eval_prompts is not None:
        judged = save(cu.with_overlap(rows.withColumn("_prompt", prompt), "_prompt", cu.gram_index(eval_prompts, "prompt", n), n).drop("_prompt"), "judged")
        rows = judged.where("overlap = 0").drop("overlap")
        about["decontamination"] = {"n_dropped": judged.where("overlap > 0").count(), "ngram": n}
        counts.append(("after_decontamination", rows))
    counts.append(("final", rows))
    parts = [part.agg(F.lit(i).cast("long").alias("stage_ord"), F.lit(name).alias("stage"), F.count(F.lit(1)).alias("rows")) for i, (name, part) in enumerate(counts)]
    funnel = parts[0]
    for p in parts[1:]:
        funnel = funnel.unionByName(p)
    return Built(rows, bad, funnel, about)


def build_from_sources(
    spark: SparkSession, paths: dict[str, str], kind: str, folder: str, name: str, limit: int | None = None, val_ratio: float = 0.1, seed: int = 42, catalog=CATALOG, **options
) -> tuple[str, Built]:
    """From sources to a written dataset: (content hash, what was built); ``options`` are build_dataset's.

    Rows keep the order of the sources and of their files, whatever the partitioning.  The split goes by the rows' content, so
    the same sources give the same dataset.  The manifest says what was loaded, dropped, fitted and how long the texts are.
    """
    save = writer(spark)
    loaded = save(of_kind(load_all(spark, {k: p for k, p in paths.items() if k in catalog and catalog[k].kind == kind}, limit, catalog), kind), "loaded")
    place = F.struct("source_ord", F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("row"))
    built = build_dataset(loaded.select("*", place.alias("_place")), kind, "_place", save, **options)
    columns = (SFT if kind == "sft" else PREFERENCE).names
    rows = save(built.rows.select(F.sha2(cu.encoded_row(columns), 256).alias("_key"), *columns), "final")
    whole = sft_full_text() if kind == "sft" else preference_full_text()
    lengths = ev.length_percentiles(rows.select(whitespace_tokens(whole).alias("tokens")), "tokens").first()
    about = built.about | {
        "sources": [r.asDict() for r in rows.groupBy("source").agg(F.count(F.lit(1)).alias("rows")).orderBy("source").collect()],
        "funnel": {r["stage"]: r["rows"] for r in built.funnel.orderBy("stage_ord").collect()}, "token_stats": lengths.asDict() if lengths else {},
    }
    digest = cu.write_dataset(rows, built.quarantine, folder, name, "_key", val_ratio, seed, kind, keep_key=False, **about)
    return digest, built
