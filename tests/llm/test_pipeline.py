"""Every stage of the pipeline, on all that its predecessor kept, against a plain one written over again here."""

import math
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from millrace.llm import quality, toxicity
from millrace.llm.common import Scratch

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def plain_evidence(text, lexicon):
    """Clause by clause and hit by hit, with windows looked at directly instead of machines."""
    total, clause = 0.0, (text or "").lower()
    for end in toxicity.CLAUSE_END:
        clause = clause.replace(end, "\n")
    for part in clause.split("\n"):
        kinds = [lexicon.read(t) for t in toxicity.TOKEN.findall(part)]
        for i, (kind, weight) in enumerate(kinds):
            before = [k for k, _ in kinds[:i]]
            target = toxicity.TARGET in [k for k, _ in kinds[max(0, i - 4) : i + 5]]
            negated, reported = toxicity.NEGATION in before[-3:], toxicity.REPORT in before
            scale = (toxicity.NEGATED if negated else 1) * (toxicity.REPORTED if reported else 1)
            if kind == toxicity.INSULT:
                total += weight * scale * (toxicity.DIRECTED if target else toxicity.BARE)
            elif kind == toxicity.VIOLENT and target:
                total += weight * scale * (toxicity.ANNOUNCED if toxicity.FUTURE in before[-3:] else 1)
    return total


def is_toxic(text, lexicon):
    return 1 / (1 + math.exp(min(700, lexicon.offset - lexicon.slope * plain_evidence(text, lexicon)))) >= 0.5


def least_core(x, floor, core):
    """Mean and covariance of the settled core of least determinant, from three starts, in numpy."""

    def at(values, share):
        return np.sort(values)[max(math.ceil(share * len(values)), 1) - 1]

    def step(mean, cov):
        d = np.einsum("ri,ij,rj->r", x - mean, np.linalg.inv(cov), x - mean)
        place = np.floor(np.log1p(np.maximum(d, 0)) * quality.STEPS_OF_ONE)
        best = x[place <= at(place, core)]
        return best.mean(0), np.cov(best.T, bias=True) + np.diag(floor)

    middle = np.array([at(c, 0.5) for c in x.T])
    scale = np.maximum(np.sqrt(floor), [(at(c, 0.75) - at(c, 0.25)) / 1.349 for c in x.T])
    squashed = np.round(quality.GRID * np.tanh((x - middle) / scale)) / quality.GRID
    tried = [
        (middle, np.diag(scale**2)), (x.mean(0), np.cov(x.T, bias=True) + np.diag(floor)),
        (middle, np.cov(squashed.T, bias=True) * np.outer(scale, scale) + np.diag(floor)),
    ]
    now = min((step(*step(*t)) for t in tried), key=lambda e: round(np.linalg.slogdet(e[1])[1], 9))
    while True:
        after = step(*now)
        if np.linalg.slogdet(after[1])[1] >= np.linalg.slogdet(now[1])[1] - 1e-9:
            return now
        now = after


def good(rows, core=0.75, weight=60):
    """Texts by the base rules and by robust distances from the statistics of all rows at hand, in numpy."""
    counts, floors = {}, {}
    for i, r in rows.items():
        text = r["text"] or ""
        w = text.encode().split()
        windows = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        often = {x: windows.count(x) for x in set(windows)} if len(set(windows)) < len(windows) else {}
        repeats = len({k + j for k, x in enumerate(windows) if often.get(x, 1) > 1 for j in range(5)})
        if len(w) < 10 or 100 * repeats > 20 * len(w):
            continue
        chars, lines = sum(len(x.decode()) for x in w), [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
        shares = [
            math.log(len(w) + 1), math.log((chars + 200) / (len(w) + 40)), math.sqrt(sum(c in "#*$%&|<>" for c in text) / (chars + 100)),
            math.sqrt((len(lines) - len(set(lines))) / (len(lines) + 10)), math.sqrt(repeats / (len(w) + 50)), math.sqrt(sum("A" <= c <= "Z" for c in text) / (chars + 100)),
        ]
        counts[i] = [math.floor(v * 512 + 0.5) for v in shares]
        floors[i] = [0.05**2, 0.02**2, *(0.25 / n for n in ((chars + 100) / 3, len(lines) + 10, (len(w) + 50) / 10, chars + 100))]

    def estimate(group):
        x, floor = np.array([counts[i] for i in group], float), np.mean([floors[i] for i in group], axis=0) * 512**2
        mean, cov = least_core(x, floor, core) if len(x) > 1 else (x[0], np.diag(floor))
        return math.ceil(core * len(x)), mean, (cov - np.diag(floor)) * quality.CONSISTENCY + np.diag(floor)

    kept, known = set(), {}
    for key in {(rows[i]["lang"], rows[i]["source"]) for i in counts}:
        groups = [(), (key[0],), key]
        mean = cov = None
        for g in groups:
            if g not in known:
                known[g] = estimate([i for i in counts if (rows[i]["lang"], rows[i]["source"])[: len(g)] == g])
            n, m, c = known[g]
            share = 1 if mean is None else n / (n + weight * core)
            mean, cov = (m, c) if mean is None else (share * m + (1 - share) * mean, share * c + (1 - share) * cov)
        own = [i for i in counts if (rows[i]["lang"], rows[i]["source"]) == key]
        x = np.array([counts[i] for i in own]) - mean
        kept |= {i for i, d in zip(own, np.einsum("ri,ij,rj->r", x, np.linalg.inv(cov), x)) if d <= quality.CUTOFF_6}
    return kept


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(p != q for p, q in zip(a, b)) <= 1
    return len(b) == len(a) + 1 and any(b[:j] + b[j + 1 :] == a for j in range(len(b)))


def less_lines(rows):
    """Texts less their lines that repeat an earlier one or are one word away from it; a text of which none is left goes."""
    first, gone = {}, set()
    for i in sorted(rows):
        for k, line in enumerate((rows[i]["text"] or "").split("\n")):
            words = tuple(line.lower().strip(" ").split(" "))
            if words != ("",):
                gone.add((i, k)) if words in first else first.setdefault(words, (i, k))
    by_length = {}
    for words in (w for w in first if len(w) >= 6):
        by_length.setdefault(len(words), []).append(words)
    for words, place in first.items():
        for n in (len(words) - 1, len(words), len(words) + 1) if len(words) >= 6 else ():
            if any(first[o] < place and one_edit(words, o) for o in by_length.get(n, ())):
                gone.add(place)
    out = {}
    for i, r in rows.items():
        lines = (r["text"] or "").split("\n")
        left = [x for k, x in enumerate(lines) if (i, k) not in gone]
        if len(left) == len(lines):
            out[i] = r
        elif "".join(left).strip(" "):
            out[i] = r | {"text": "\n".join(left), "n_chars": len("\n".join(left))}
    return out


def groups(rows):
    sets, low = {}, {i: i for i in rows}
    for i, r in rows.items():
        w = (r["text"] or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(len(w) - 4, 1))} if w else set()
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in rows:
        before = dict(low)
        for a, b in pairs:
            low[a] = low[b] = min(low[a], low[b])
        if low == before:
            return low
    return low


def test_stages(spark, sf):
    from tokenizers import Tokenizer

    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    lexicon = toxicity.fit(docs, labels.select("doc_id", "toxic").where(~toxicity.held_out()))
    # Copies wrapped anew have no line in common with their original, so only the near-duplicate stage can find them.
    wrapped = docs.where("doc_id % 7 = 0 and text like '%\n%'").selectExpr("doc_id + 100000 as doc_id", "replace(text, '\n', ' ') as text", "lang", "source", "n_chars")
    docs = Scratch(spark).save(docs.unionByName(wrapped), "documents")
    rows = {r["doc_id"]: r.asDict() for r in docs.collect()}
    assert len(rows) == docs.count()
    plain = [
        lambda rows: {i: r for i, r in rows.items() if not is_toxic(r["text"], lexicon)},
        lambda rows: {i: rows[i] for i in good(rows)},
        less_lines,
        lambda rows: {i: rows[i] for i, low in groups(rows).items() if i == low},
    ]
    scratch = Scratch(spark)
    for k, ((name, stage), same) in enumerate(zip(corpus_pipeline.STAGES, plain)):
        docs, before, rows = scratch.save(stage(spark, docs, sf), str(k)), rows, same(rows)
        assert rows != before, name
        assert docs.columns == corpus_pipeline.COLUMNS
        assert sorted(docs.collect(), key=lambda r: r["doc_id"]) == [tuple(rows[i][c] for c in docs.columns) for i in sorted(rows)], name

    tokenizer, by_doc, fill = Tokenizer.from_file(P.path("word_bpe_49k.json")), {}, {}
    for r in corpus_pipeline.STAGES[4][1](spark, docs, sf).collect():
        by_doc.setdefault(r["doc_id"], []).append(r)
        fill.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert by_doc.keys() == rows.keys()
    for i, own in by_doc.items():
        ids = np.array([*tokenizer.encode(rows[i]["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        assert sorted((r["start"], r["length"], r["ids_crc32"]) for r in own) == [
            (at, len(ids[at : at + 4096]), zlib.crc32(ids[at : at + 4096].tobytes())) for at in range(0, len(ids), 4096)
        ]
    for places in fill.values():
        ends = np.cumsum([0, *(n for _, n in sorted(places))])
        assert [at for at, _ in sorted(places)] == ends[:-1].tolist() and ends[-1] <= 4096


def test_odd_tables(spark, sf):
    """Null and repeated ids, repeated rows, null and empty texts, extra columns and no rows, through all stages."""
    docs, labels = (spark.read.parquet(f"{sf.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    clean = docs.join(labels.where("quality = 1 and toxic = 0"), "doc_id").where("n_chars between 600 and 3000 and lang = 'en'")
    texts = [r["text"] for r in clean.dropDuplicates(["text"]).orderBy("doc_id").limit(4).collect()]
    rows = [(None, texts[0], "en", "s", 1), (None, texts[1], "en", "s", 1), (5, texts[2], None, None, None), (5, texts[3].replace("\n", " "), "en", "s", 1)]
    rows += [(5, texts[3], "en", "s", 1), (6, None, "en", "s", 1), (7, "", "en", "s", 0), (None, None, None, None, None), (5, texts[2], None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 as row", "'x' as component_id")
    scratch = Scratch(spark)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = scratch.save(stage(spark, docs, sf), str(k))
        if k < 4:
            assert docs.columns == corpus_pipeline.COLUMNS
        if k == 3:
            left = {(r["doc_id"], " ".join(r["text"].split())) for r in docs.collect()}
            assert left == {(None, " ".join(texts[0].split())), (None, " ".join(texts[1].split())), *((5, " ".join(t.split())) for t in texts[2:4])}
            assert docs.count() == 4
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        none = scratch.save(stage(spark, none, sf), f"none-{k}")
        assert none.count() == 0
