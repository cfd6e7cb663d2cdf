"""The corpus operators against brute force, round trips and odd rows."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from millrace.llm import byte_bpe, exact_dedup, licenses, line_dedup, lm_score, ngram_join, packing, quality, toxicity, warc
from millrace.llm.common import Scratch, numbered

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BPE, WORDS = P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json")


def corpus():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(300)]
    texts = [None, "", "   ", "\n\n", "one", "One", "It's 'll re's  \n\n x́ ÄÖ １２ 漢字 😀", "x" * 5000, "word. " * 9000]
    for _ in range(25):
        t = [rng.choice(words) for _ in range(rng.randint(12, 150))]
        texts += [" ".join(t)] * rng.choice([1, 1, 2, 5])
        for _ in range(rng.choice([0, 1, 3])):
            u = [*t]
            for _ in range(rng.choice([1, 1, 4])):
                u[rng.randrange(len(u))] = rng.choice(words)
            texts.append("\n".join([" ".join(u[: len(u) // 2]), " ".join(u[len(u) // 2 :])]).upper() if rng.random() < 0.2 else " ".join(u))
    return [(i, t, rng.choice(["en", "de", None]), "s", 0) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_byte_bpe(docs, none):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BPE, "rb"))}
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = byte_bpe.encode_documents(docs, BPE, ("n_tokens", "ids", "piece_offsets", "piece_ids", "decoded", "ids_sha256"))
    texts = {r[0]: r[1] or "" for r in corpus()}
    for r in got.collect():
        t = texts[r["doc_id"]]
        assert r["ids"] == plain.encode_ordinary(t) and bytes(r["decoded"]).decode() == t and r["n_tokens"] == len(r["ids"])
        assert r["piece_offsets"][-1] == len(t) and sum(r["piece_ids"]) == r["n_tokens"]
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, r["ids"])).encode()).hexdigest()
    assert byte_bpe.decode_ids(got.select("doc_id", "ids"), BPE).count() == len(texts)
    assert byte_bpe.encode_documents(none, BPE).count() == 0


def test_byte_bpe_random_text():
    import tiktoken

    codec = byte_bpe.Codec(BPE)
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    rng = random.Random(1)
    texts = ["".join(rng.choices(" '\n\tstrevmldAé1²!?  ", k=rng.randint(0, 60))) for _ in range(3000)]
    for t, (ids, _, _) in zip(texts, codec.encode(texts)):
        assert ids == plain.encode_ordinary(t), t


def test_exact_dedup(docs, none):
    groups: dict[bytes, list[int]] = {}
    for i, t, *_ in corpus():
        groups.setdefault((t or "").encode().lower(), []).append(i)
    want = {(i, max(g), len(g), i == max(g), hashlib.sha256(k).hexdigest()) for k, g in groups.items() for i in g}
    got = exact_dedup.radix_groups(docs)
    assert {tuple(r[:5]) for r in got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()} == want
    assert exact_dedup.radix_groups(none).count() == 0


def test_ngram_join(docs, none):
    sets = {}
    for i, t, *_ in corpus():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + 3]) for j in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set()
    for percent in (90, 60):
        low = {i: i for i in sets}
        for _ in range(len(sets)):
            changed = False
            for a in sets:
                for b in sets:
                    if low[a] != low[b] and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                        low[a] = low[b] = min(low[a], low[b])
                        changed = True
            if not changed:
                break
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join_components(docs, 3, percent).collect()}
        assert got == {i: (len(sets[i]), low[i]) for i in sets}
    assert ngram_join.join_components(none).count() == 0


def test_line_dedup(docs, none):
    lines = [(i, k, x.strip(" ").lower()) for i, t, *_ in corpus() for k, x in enumerate((t or "").split("\n"))]
    lines = [(i, k, x) for i, k, x in lines if x]
    first, gone = {}, set()
    for i, k, x in lines:
        gone.add((i, k)) if x in first else first.setdefault(x, (i, k))

    def near(a, b):
        a, b = sorted((a.split(" "), b.split(" ")), key=len)
        if len(a) == len(b):
            return sum(p != q for p, q in zip(a, b)) <= 1
        return len(b) == len(a) + 1 and any(b[:j] + b[j + 1 :] == a for j in range(len(b)))

    long = {x: at for x, at in first.items() if x.count(" ") >= 5}
    for x, at in long.items():
        if any(p < at and abs(x.count(" ") - y.count(" ")) <= 1 and near(x, y) for y, p in long.items()):
            gone.add(at)
    rows, row = numbered(docs, Scratch(docs.sparkSession))
    got = line_dedup.drops(rows.select("doc_id", row, "text")).join(rows.select("doc_id", row), row)
    assert {(r["doc_id"], r["line_no"]) for r in got.collect()} == gone
    kept = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) if t is not None else None for i, t, *_ in corpus()}
    assert {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs).collect()} == kept
    assert line_dedup.dedup_lines(none).count() == 0


def test_packing(docs, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    rows = packing.pack(docs, WORDS, capacity=512).collect()
    by_doc: dict[int, list] = {}
    by_sequence: dict[int, list] = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for i, t, *_ in corpus():
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        own = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [r["start"] for r in own] == [*range(0, len(ids), 512)]
        assert all(zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for r in own)
    for own in by_sequence.values():
        end = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == end
            end += r["length"]
        assert end <= 512
    assert len(by_sequence) <= 1.05 * sum(r["length"] for r in rows) / 512 + 1
    assert packing.pack(none, WORDS).count() == 0


def test_packing_ids_are_the_tokenizers():
    """Every text, special tokens written out and letters that lower-casing parts among them."""
    from tokenizers import Tokenizer

    tokenizer, known, rng = Tokenizer.from_file(WORDS), packing.ChunkIds(WORDS, limit=3000), random.Random(4)
    odd = ["İ", "İ.", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "<|", "|>", "\u0307", "ﬁ", "ß", "ẞ", "Σ", "ς", "क़", "\u037e", "K", "'s", "'", "ﬀ.", "\u0301", "é", "É!", "\xa0", "\u3000", "\x85", "\x1c", "\t", "\r\n", "漢", "😀", "²", "Ⅷ", "٣.", "="]
    plain = list("aB9.,;:!?éÉßµªÿ×÷\x00\x7f") + ["\n", " ", " ", "word", "Word.", "end:"]
    for turn in range(40):
        texts = ["".join(rng.choices(odd + plain * 2 if turn % 2 else plain + odd[turn // 2 % len(odd) :][:2], k=rng.randint(0, 12))) for _ in range(300)]
        flat, ends = known.ids(texts)
        for t, a, b in zip(texts, ends[:-1], ends[1:]):
            assert flat[a:b].tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


def test_quality(docs, none):
    rows = {r["doc_id"]: r for r in quality.verdicts(docs).collect()}
    assert len(rows) == len(corpus())
    for i, t, *_ in corpus():
        w = (t or "").encode().split()
        windows = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        seen: dict = {}
        for x in windows:
            seen[x] = seen.get(x, 0) + 1
        covered = {k + j for k, x in enumerate(windows) if seen[x] > 1 for j in range(5)}
        r, lines = rows[i], [x for x in (t or "").split("\n") if x.strip(" \t\x0b\x0c\r")]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"]) == (len(w), sum(len(x.decode()) for x in w), len(covered))
        assert (r["n_symbols"], r["n_dup_lines"]) == (sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)))
        assert r["base_failed"] == (len(w) < 10 or 100 * len(covered) > 20 * len(w)) and not (r["base_failed"] and r["kept"])
    assert quality.verdicts(none).count() == 0


def test_toxicity(spark, sf, none):
    lexicon = toxicity.Lexicon({"moron": 5.0}, {"idio": 6.0})
    rows = ["you are a moron", "he said you are a moron", "you are not a moron", "a calm text", None, "", "I will kill you", "kill the process", "idiotic. fine"]
    got = [r["score"] for r in toxicity.score(spark.createDataFrame([*enumerate(rows)], "doc_id long, text string").coalesce(1), lexicon).orderBy("doc_id").collect()]
    assert got[0] > got[1] > got[3] and got[0] > got[2] and got[3] == got[4] == got[5] and got[6] > 0.5 > got[7] and got[8] > 0.5
    docs, labels = (spark.read.parquet(f"{sf.replace('0.001', '0.1')}/{t}.parquet") for t in ("documents", "labels"))
    judged = toxicity.toxicity(docs, labels).where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    hit = sum(r[0] == r[1] == 1 for r in judged)
    assert hit / sum(r[1] for r in judged) > 0.85 and hit / sum(r[0] for r in judged) > 0.9
    assert toxicity.toxicity(none, spark.createDataFrame([], "doc_id long, toxic int")).count() == 0


def test_licenses(spark, none):
    mit = "MIT License\n\n" + "\n\n".join(licenses.SENTENCES[k][0] + "." for k in ("mit-grant", "mit-notice", "as-is"))
    assert [m[0] for m in licenses.scan_text(mit)] == ["MIT"]
    assert [m[0] for m in licenses.scan_text("Prose here.\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License. More.")] == ["CC-BY-NC-4.0", "MIT"]
    assert licenses.scan_text("A licence is discussed here, not granted.") == []
    df = spark.createDataFrame([(1, "Licensed under the Apache License, Version 2.0."), (2, None)], "doc_id long, text string")
    assert {(r["doc_id"], r["licences"]) for r in licenses.summary(df).collect()} == {(1, "Apache-2.0"), (2, "")}
    assert licenses.summary(none).count() == 0


def test_lm_score(docs, spark, none):
    targets = spark.createDataFrame([(i,) for i in range(9, 30)], "doc_id long")
    rows = {r["doc_id"]: r for r in lm_score.scores(docs, targets).collect()}
    assert len(rows) == len(corpus()) and rows[0]["score"] is None
    for r in rows.values():
        if r["score"] is not None:
            assert abs(r["score"] - (r["target_loss"] - r["background_loss"])) < 1e-9
    inside = np.mean([rows[i]["score"] for i in range(9, 30)])
    assert inside < np.mean([rows[i]["score"] for i in range(35, len(rows))])
    assert lm_score.scores(none, targets).count() == 0


def test_warc(spark):
    rng = random.Random(2)
    html = [None, "", "<p>a</p>", "<p>a</p>", "é" * 300_000, *("".join(rng.choices("abc<>", k=4000)) for _ in range(30)), "<p>a</p>"]
    pages = spark.createDataFrame([(i, f"http://x/{i} y", h) for i, h in enumerate(html)], "page_id long, url string, html string").repartition(3)
    folder = f"{Scratch(spark).dir}/archives"
    manifest = warc.write_archives(pages, folder)
    first: dict = {}
    for i, h in enumerate(html):
        first.setdefault(h or "", i)
    want = {(i, len((h or "").encode()), warc.digest_of((h or "").encode()), "response" if first[h or ""] == i else "revisit", None if first[h or ""] == i else first[h or ""]) for i, h in enumerate(html)}
    for split in (700, 1 << 20):
        got = warc.read_archives(manifest, folder, ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"), split)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert warc.write_archives(pages.limit(0), folder + "-none").count() == 0


def test_warc_reads_in_many_tasks_and_reports_damage(spark):
    rng = random.Random(3)
    pages = spark.createDataFrame([(i, "u", "".join(rng.choices("abcdef", k=3000))) for i in range(60)], "page_id long, url string, html string").coalesce(1)
    folder = f"{Scratch(spark).dir}/archives"
    manifest = warc.write_archives(pages, folder)
    columns = ("page_id", "record_type", "path", "start", "length")
    got = warc.read_archives(manifest, folder, columns, 4000)
    size = manifest.first()["bytes"]
    assert got.rdd.getNumPartitions() == -(-size // 4000) and got.count() == 60
    tasks = {r[0] for r in got.selectExpr("spark_partition_id()").collect()}
    assert len(tasks) > 8
    places = sorted((r["start"], r["length"]) for r in got.collect())
    path = f"{folder}/{got.first()['path']}".removeprefix("file://")
    whole = open(path, "rb").read()
    for k in (0, 7, 31):  # a header's magic, then a payload's middle, then a cut file
        at, n = places[k]
        for data in (whole[:at] + b"xxxx" + whole[at + 4 :], whole[: at + n // 2] + b"\0" * 9 + whole[at + n // 2 + 9 :], whole[: at + n // 2]):
            open(path, "wb").write(data)
            cut = manifest.selectExpr("path", f"{len(data)}L as bytes", "records")
            for split in (4000, 1 << 20):
                rows = warc.read_archives(cut, folder, columns, split).collect()
                assert [r["start"] for r in rows if r["record_type"] == "corrupt"] == [at]
                assert len(rows) == (60 if len(data) == len(whole) else k + 1)
