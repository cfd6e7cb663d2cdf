"""From sources to a written dataset, by both kinds, with the domain filter's two stages and the manifest."""

import json

import numpy as np
from pyspark.sql import functions as F

from millrace.plans import build as bd
from millrace.sources import loaders as ld


def letters(texts):
    """A toy embedding: how often some letters occur."""
    return np.array([[t.count(c) + 0.01 for c in "pyx"] for t in texts], np.float32)


def test_sft_from_two_sources(spark, tmp_path):
    rows = [{"instruction": f"Write python code {k}", "input": "", "output": f"yyy print({k})"} for k in range(30)]
    rows += [rows[3], {"instruction": "Write python xxxxxxxxxxxxxxxx", "input": "", "output": "not near"}, {"instruction": "The weather is nice", "input": "", "output": "It is so"}, {"instruction": "no", "input": "", "output": "x"}]
    (tmp_path / "a.json").write_text("\n".join(map(json.dumps, rows)))
    (tmp_path / "b.json").write_text("\n".join(json.dumps({"instruction": f"Write python code {k}", "context": "", "response": f"yyy print({k})", "category": c}) for k, c in ((3, "closed_qa"), (40, "closed_qa"), (41, "brainstorming"))))
    paths = {"alpaca_cleaned": f"file://{tmp_path}/a.json", "dolly_15k": f"file://{tmp_path}/b.json", "ultrafeedback": "nowhere", "none": "nowhere"}
    prompts = spark.createDataFrame([("Write python code 7",), ("python python yy",), ("pppyy yyy",)], "prompt string")
    labels = spark.createDataFrame([("python yyy", 1), ("xxxxxx", 0), ("python yy code", 1), ("pxxxxxxx", 0)], "text string, label int")
    domain = bd.fit_domain(prompts, letters, labels, k=2)
    assert domain.about["n_labelled"] == 4 and domain.about["f1_by_threshold"][f"{domain.threshold:g}"] == 1.0
    run = lambda: bd.build_from_sources(spark, paths, "sft", f"file://{tmp_path}/out", "d", technical_only=True, domain=domain, near=False, eval_prompts=prompts)
    digest, built = run()
    path = ld.resolve_dataset(spark, f"file://{tmp_path}/out", digest)
    manifest = json.loads((tmp_path / "out" / "d" / digest / "manifest.json").read_text())
    assert manifest["funnel"] == {"loaded": 36, "validated": 35, "quarantined": 1, "after_keyword": 34, "after_embedding": 33, "after_dedup": 31, "after_decontamination": 30, "final": 30}
    assert manifest["decontamination"] == {"n_dropped": 1, "ngram": 13} and manifest["filter_eval"]["threshold"] == domain.threshold
    assert manifest["sources"] == [{"source": "alpaca_cleaned", "rows": 29}, {"source": "dolly_15k", "rows": 1}] and manifest["token_stats"]["n"] == 30
    assert (manifest["n_train"], manifest["n_val"], manifest["columns"]) == (27, 3, ["instruction", "input", "response", "source"])
    assert spark.read.parquet(f"{path}/train").columns == manifest["columns"] and spark.read.json(f"{path}/quarantine").first()["stage"] == "validation"
    assert run()[0] == digest
    few, _ = bd.build_from_sources(spark, paths, "sft", f"file://{tmp_path}/out", "few", limit=2)
    assert json.loads((tmp_path / "out" / "few" / few / "manifest.json").read_text())["funnel"]["loaded"] == 4


def test_preferences_with_near_duplicates(spark, tmp_path):
    long = " ".join(f"word{k}" for k in range(60))
    rows = [{"prompt": "Which is it?", "chosen": long + tail, "rejected": "the other one"} for tail in ("", " a", " b")] + [{"prompt": "And this?", "chosen": "a good answer", "rejected": "a good answer "}, {"prompt": "And that?", "chosen": "a good answer", "rejected": "a bad answer"}]
    (tmp_path / "p.json").write_text("\n".join(map(json.dumps, rows)))
    for verify in (None, 0.85):
        digest, built = bd.build_from_sources(spark, {"py_dpo": f"file://{tmp_path}/p.json"}, "preference", f"file://{tmp_path}/out", f"p{verify}", near=True, verify=verify, val_ratio=0.5)
        assert sorted(r["chosen"] for r in built.rows.collect()) == ["a good answer", long]
        assert {r["stage"]: r["rows"] for r in built.funnel.collect()} == {"loaded": 5, "validated": 4, "quarantined": 1, "after_dedup": 2, "final": 2}
        path = ld.resolve_dataset(spark, f"file://{tmp_path}/out", digest)
        assert spark.read.parquet(f"{path}/val").count() == 1 and spark.read.parquet(f"{path}/train").count() == 1


def test_domain_without_labels(spark):
    prompts = spark.createDataFrame([("python",)], "prompt string")
    domain = bd.fit_domain(prompts, letters)
    assert domain.threshold == 0.45 and domain.centroids.count() == 1 and domain.about == {}
    bad = spark.createDataFrame([("xxxx", 1), ("pppp", 0)], "text string, label int")
    assert bd.fit_domain(prompts, letters, bad.withColumn("label", F.lit(0)), default=0.2).threshold == 0.2
