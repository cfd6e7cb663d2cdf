"""Driver-side documents from small results: metrics, report, configuration and identity hashes."""

from __future__ import annotations

import copy
import hashlib
import html
import json
import os
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evaluation as ev


def merge_config(*parts: dict) -> dict:
    """Later parts win; nested sections merge."""
    out: dict = {}
    for part in parts:
        for k, v in part.items():
            out[k] = merge_config(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else copy.deepcopy(v)
    return out


class ConfigError(ValueError):
    """A configuration that can't be used; the message names the file or key."""


def override(config: dict, settings: list[str]) -> dict:
    """The configuration with settings such as ``train.beta=0.2``, whose values are read as YAML."""
    out = copy.deepcopy(config)
    for setting in settings:
        path, equals, value = setting.partition("=")
        *outer, last = path.split(".")
        if not equals or not all([*outer, last]):
            raise ConfigError(f"{setting}: want key.key=value")
        at = out
        for k in outer:
            at = at.setdefault(k, {})
            if not isinstance(at, dict):
                raise ConfigError(f"{path}: {k} is not a section")
        at[last] = _yaml(value)
    return out


def faults(config: dict, shape: dict, under: str = "") -> list[str]:
    """What of a configuration doesn't fit a shape (key to type, tuple of types, or section): unknown keys and wrong types."""
    out = []
    for k, v in config.items():
        want, name = shape.get(k), f"{under}{k}"
        if want is None:
            out.append(f"{name}: unknown")
        elif isinstance(want, dict):
            out += faults(v, want, f"{name}.") if isinstance(v, dict) else [f"{name}: want a section"]
        elif not isinstance(v, want) or (isinstance(v, bool) and bool not in (want if isinstance(want, tuple) else (want,))):
            out.append(f"{name}: wrong type {type(v).__name__}")
    return out


def load_config(base: str | None, components: list[str] = (), settings: list[str] = (), shape: dict | None = None) -> dict:
    """Base file (may be missing), components in order (must be there), settings; then held against the shape, if one is given."""
    parts = []
    for path, needed in [(base, False), *((c, True) for c in components)]:
        if path is None or not os.path.exists(path):
            if needed:
                raise ConfigError(f"{path}: no such file")
            continue
        with open(path, encoding="utf-8") as f:
            part = _yaml(f.read()) or {}
        if not isinstance(part, dict):
            raise ConfigError(f"{path}: not a mapping")
        parts.append(part)
    out = override(merge_config(*parts), [*settings])
    if shape is not None and (bad := faults(out, shape)):
        raise ConfigError("; ".join(bad))
    return out


def _yaml(text: str):
    try:
        import yaml
    except ImportError as e:
        raise ConfigError("reading a configuration needs PyYAML") from e
    try:
        return yaml.safe_load(text)
    except yaml.YAMLError as e:
        raise ConfigError(str(e)) from e


def config_hash(config: dict) -> str:
    return hashlib.sha256(json.dumps(config, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()[:12]


def run_id(kind: str, digest: str, now: datetime | None = None) -> str:
    return f"{kind}-{(now or datetime.now(timezone.utc)):%Y%m%d-%H%M%S}-{digest[:4]}"


def metrics(judged: DataFrame, responses: DataFrame | None = None, cases: DataFrame | None = None, resamples: int = 2000) -> dict:
    """``metrics_table`` as a document: a few rows for each pair, suite and model, collected at once."""
    out: dict = {"models": set(), "suites": set(), "pairwise": {}, "per_suite": {}, "position_bias_rate": {}, "elo": {}, "length_controlled": {}, "exact_match": {}}
    for section, suite, a, b, name, value in ev.metrics_table(judged, responses, cases, resamples).collect():
        out["models"] |= {a, b} - {None}
        value = value if value is None or name in ("win_rate", "ci_low", "ci_high", "bias_rate", "elo", "score", "pct_discarded") else int(value)
        key, into = a if b is None else f"{a}_vs_{b}", out[section]
        if section == "per_suite":
            out["suites"].add(suite)
            into = into.setdefault(suite, {})
        if section in ("position_bias_rate", "elo"):
            into[key] = value
        else:
            into.setdefault(key, {})[name] = value
    return out | {"models": sorted(out["models"]), "suites": sorted(out["suites"])}


def write_json(doc: dict, path: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        json.dump(doc, f, indent=2, sort_keys=True)


#: Said under every report; {judge} is the judge's name.
NOTES = (
    "Each pair was judged in both orders; a verdict counts only if both orders agree, else it is a tie.",
    "A tie is half a win for either model; failed judgements are left out.",
    "Length control leaves out cases whose winner is over a fifth longer than the loser.",
    "Intervals are percentiles of resampled cases, at 95 percent.",
    "Exact match asks whether an expected answer is in the response, whatever its case.",
    "The judge was {judge}; a judge may favour models of its own family.",
)


def markdown(doc: dict, title: str = "Evaluation", gallery: list[dict] = (), judge: str = "not stated", about: dict | None = None) -> str:
    """The report: results, ratings, position bias, suites, lost cases (rows of ``regression_gallery``) and notes on method."""
    number = lambda v, k: f"{v[k]:.4f} [{v['ci_low']:.4f}, {v['ci_high']:.4f}]"
    controlled = doc.get("length_controlled", {})
    lines = [f"# {title}", ""] + [f"- {k}: {v}" for k, v in (about or {}).items()]
    lines += ["", "## Win rates", "", "| pair | win rate and interval | n | length-controlled |", "|-|-|-|-|"]
    lines += [f"| {k} | {number(v, 'win_rate')} | {v['n']} | {number(controlled[k], 'win_rate') if k in controlled else ''} |" for k, v in sorted(doc["pairwise"].items())]
    if doc.get("exact_match"):
        lines += ["", "## Exact match", "", "| model | score | n |", "|-|-|-|"] + [f"| {m} | {v['score']:.4f} | {v['n_verifiable']} |" for m, v in sorted(doc["exact_match"].items())]
    lines += ["", "## Ratings", ""] + [f"- {m}: {e:.1f}" for m, e in sorted(doc["elo"].items(), key=lambda x: -x[1])]
    lines += ["", "## Position bias", ""] + [f"- {k}: {v:.3f}" + (" (over 0.30)" if v > 0.3 else "") for k, v in sorted(doc["position_bias_rate"].items())]
    for suite, pairs in sorted(doc["per_suite"].items()):
        lines += ["", f"## Suite {suite}", "", "| pair | win rate | n |", "|-|-|-|"] + [f"| {k} | {v['win_rate']:.4f} | {v['n']} |" for k, v in sorted(pairs.items())]
    if gallery:
        lines += ["", "## Lost cases"]
        for r in gallery:
            lines += ["", f"### {r['case_id']}", ""] + [f"- {k}: {' '.join(str(r[k]).split())}" for k in ("prompt", "intent", "winner_response", "loser_response", "rationale") if r[k]]
    lines += ["", "## Method", ""] + [f"- {n.format(judge=judge)}" for n in NOTES]
    return "\n".join(lines) + "\n"


def to_html(text: str) -> str:
    """A small reader of the report's own Markdown: headings, lists, tables, paragraphs."""
    out, block = [], ""
    for line in [*text.split("\n"), ""]:
        kind = "ul" if line.startswith("- ") else "table" if line.startswith("|") else ""
        if block and kind != block:
            out.append(f"</{block}>")
        if kind and kind != block:
            out.append(f"<{kind}>")
        block = kind
        if kind == "ul":
            out.append(f"<li>{html.escape(line[2:])}</li>")
        elif kind == "table" and set(line) - set("|-"):
            out.append("<tr>" + "".join(f"<td>{html.escape(c.strip())}</td>" for c in line.strip("|").split("|")) + "</tr>")
        elif line.startswith("#"):
            level = len(line) - len(line.lstrip("#"))
            out.append(f"<h{level}>{html.escape(line.lstrip('# '))}</h{level}>")
        elif line and not kind:
            out.append(f"<p>{html.escape(line)}</p>")
    return "\n".join(out)


def sweep_table(rows: list[dict], columns: tuple[str, ...] = ("beta", "win_rate", "mean_kl")) -> str:
    head = ["| " + " | ".join(columns) + " |", "|" + "-|" * len(columns)]
    return "\n".join(head + ["| " + " | ".join("" if r.get(c) is None else str(r[c]) for c in columns) + " |" for r in rows]) + "\n"
