"""Conversation repair, hard negatives and pieces against brute force, the library, and their defined results on odd rows."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import conversations as cv
from millrace.llm import hard_negatives as hn
from millrace.llm import sentence_pieces as sn
from millrace.llm.queries import op11_sentence_pieces, op12_hard_negatives, op13_conversation_repair, tokenizer_path

PIECES = tokenizer_path("piece_bpe_32k.model")
SHAPE = re.compile("(s?(ua)+)?")


# Conversations.


def damage(rows):
    """(conv, turn, role, text) rows of one table, in their order, after damage."""
    out = []
    for conv, turn, role, text in rows:
        conv, turn_, role, text = conv, turn, " " if role is None else role, " " if text is None else text
        what = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if what == 0:
            continue
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        out += [(conv, turn_, "user" if what == 4 else role, text)] * (2 if what == 3 else 1)
    return out


def first_faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def every_edit(rows, faults):
    """(cost, audit, lines) of every way to edit, with up to two inserts at a place."""
    gaps = [[("", [])], [("I", [x]) for x in ("user:", "assistant:")], [("II", [x, y]) for x in ("user:", "assistant:") for y in ("user:", "assistant:")]]
    gaps = [g for some in gaps for g in some]
    parts = []
    for (_, _, role, text), fault in zip(rows, faults):
        late = fault == "truncated"
        turn = [(3, "D", [])]
        if fault not in ("blank", "duplicate"):
            turn += [(late, "K", [f"{role}:{text}"]), (2 + late, "R", [f"user:{text}"]), (2 + late, "R", [f"assistant:{text}"])]
        parts += [[(2 * len(a), a, lines) for a, lines in gaps], turn]
    parts.append([(2 * len(a), a, lines) for a, lines in gaps])
    for way in itertools.product(*parts):
        lines = [x for _, _, own in way for x in own]
        yield sum(c for c, _, _ in way), "".join(a for _, a, _ in way), lines


def cheapest_by_strings(rows, faults):
    """The same by whole audits a state, edit by edit, for longer conversations."""
    roles = {"u": "user", "a": "assistant"}

    def settle(best):  # inserts, any number, until nothing falls
        while True:
            new = dict(best)
            for shape, (cost, audit, lines) in best.items():
                r = "a" if shape == "u" else "u"
                way = (cost + 2, audit + "I", lines + [f"{roles[r]}:"])
                at = {"a": "a", "u": "u"}[r]
                if at not in new or way[:2] < new[at][:2]:
                    new[at] = way
            if new == best:
                return best
            best = new

    best = {"": (0, "", [])}
    for (_, _, role, text), fault in zip(rows, faults):
        new, late = {}, fault == "truncated"

        def offer(shape, way):
            if shape not in new or way[:2] < new[shape][:2]:
                new[shape] = way

        for shape, (cost, audit, lines) in settle(best).items():
            offer(shape, (cost + 3, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            need = "a" if shape == "u" else "u"
            offer(need, (cost + 2 + late, audit + "R", lines + [f"{roles[need]}:{text}"]))
            if role[:1] == need or (role[:1] == "s" and shape == ""):
                offer(role[:1], (cost + late, audit + "K", lines + [f"{role}:{text}"]))
        best = new
    return min(way for shape, way in settle(best).items() if shape in ("", "a"))


def expected(table, hurt=True, cheapest=cheapest_by_strings):
    out = {}
    for conv in {r[0] for r in table}:
        rows = damage([r for r in table if r[0] == conv]) if hurt else [r for r in table if r[0] == conv]
        rows.sort(key=lambda r: (r[1] is not None, r[1] or 0))
        rows = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
        faults = first_faults(rows)
        turns = [r[1] for r in rows if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, lines = cheapest(rows, faults)
        out[conv] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def got(df):
    return {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in df.collect()}


TURNS = "conv_id long, turn long, role string, text string"


def some_turns(rng, n_convs, most, texts=("a.", "b!", "c", " ", "", "d? ", "e\n", None), roles=("user", "assistant", "system", "tool", "", None, "unknown")):
    return [(c, rng.choice([t, t, t, t + 2, None]), rng.choice(roles[:3] * 4 + roles), rng.choice(texts) if rng.random() < 0.4 else f"{rng.random()}.") for c in range(n_convs) for t in range(rng.randint(0, most))]


def test_programme_against_every_edit():
    rng = random.Random(5)
    for _ in range(60):
        rows = [(0, 0, r, x) for _, _, r, x in damage(some_turns(rng, 1, 3))]
        rows, faults = rows[:3], first_faults(rows[:3])
        cost, audit, lines = min(w for w in every_edit(rows, faults) if SHAPE.fullmatch("".join(x[:1] for x in w[2])))
        audit_, lines_, cost_ = cv.Segment([r[2] for r in rows], [r[3] for r in rows], faults).edits(cv.EMPTY, None)
        assert (cost_, audit_, lines_) == (cost, audit, lines)
        assert cheapest_by_strings(rows, faults)[:2] == (cost, audit)


@pytest.mark.parametrize(("turns", "chars"), [(4096, 1 << 17), (2, 1 << 17), (4096, 12)])
def test_repair_against_strings(spark, monkeypatch, turns, chars):
    """Conversations whole, across partitions and cut into segments of two turns or of few characters give the same."""
    monkeypatch.setattr(cv, "SEGMENT_TURNS", turns)
    monkeypatch.setattr(cv, "SEGMENT_CHARS", chars)
    rng = random.Random(7)
    table = some_turns(rng, 60, 9) + [(None, k, rng.choice(["user", "assistant"]), f"x{k}.") for k in range(25)] + [(99, k // 2, "user", "same.") for k in range(20)]
    df = spark.createDataFrame(table, TURNS).withColumnRenamed("turn", "TURN").selectExpr("conv_id", "turn", "role", "text", "1 as place", "'x' as fault").coalesce(1)
    assert got(cv.repair(df, cv.damaged)) == expected(table)
    assert got(cv.repair(df)) == expected(table, hurt=False)


def test_repair_of_all_conversations(spark, sf):
    table = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(op13_conversation_repair(spark, sf)) == expected(table)


def test_repair_of_nothing(spark):
    assert cv.repair(spark.createDataFrame([], TURNS)).collect() == []
    lost = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert got(cv.repair(spark.createDataFrame([(lost, 0, "user", "a.")], TURNS), cv.damaged)) == {lost: (0, 0, 0, 0, 0, 0, "", empty)}


# Hard negatives.


def mined(rows, k=10, n_positives=5, low=30, high=90):
    """rows of (id, vector, label, anchor) -> sorted results, by plain lists."""
    sound = [(i, [int(np.floor(256 * x)) for x in v], lab, anchor) for i, v, lab, anchor in rows if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, (anchor, v, label, is_anchor) in enumerate(sound):
        if not is_anchor:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), (i is None, i or 0), m) for m, (i, w, _, _) in enumerate(sound) if m != n))
        for s, _, m in [x for x in scored if sound[x[2]][2] == label][:n_positives]:
            other = [x for x in scored if sound[x[2]][2] != label and low * -s <= 100 * -x[0] <= high * -s][:k]
            out += [(anchor, sound[m][0], r, sound[o][0], -s, -t) for r, (t, _, o) in enumerate(other, 1)]
    return sorted(out, key=lambda r: [(x is None, x) for x in r])


VECTORS = "id long, vector array<float>, label int, anchor boolean"


def mined_here(spark, rows, **more):
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 as block", "2 as kind", "3 as row").repartition(3)
    return sorted(map(tuple, hn.mine(df, **more).collect()), key=lambda r: [(x is None, x) for x in r])


@pytest.mark.parametrize("block", [16_384, 7])
def test_mining_against_lists(spark, monkeypatch, block):
    monkeypatch.setattr(hn, "BLOCK_ROWS", block)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(12, 6)).astype(np.float32)
    rows = [(int(k), (base[k % 12] + rng.normal(scale=0.3, size=6)).astype(np.float32).tolist(), int(rng.integers(3)), k % 10 == 0) for k in range(90)]
    rows += [(500, rows[3][1], 1, True), (500, rows[3][1], 2, False), (501, rows[3][1], 1, False), (502, rows[3][1], 0, False)] * 2  # ties and repeated ids
    rows += [(None, rows[5][1], 0, False), (600, None, 1, True), (601, [1.0, None], 1, True), (602, [float("nan")] * 6, 1, True), (603, [float("inf")] * 6, 1, False), (604, rows[0][1], None, True)]
    rows += [(700, [], 1, True), (701, [1.0], 1, True), (702, [3000.0] * 6, 1, True), (703, [-3000.0, 2999.0] * 3, 2, True)]
    got_rows = mined_here(spark, rows)
    assert got_rows == mined(rows) and len(got_rows) > 100
    assert mined_here(spark, rows, k=3, n_positives=2, low=-20, high=100) == mined(rows, 3, 2, -20, 100)


def test_mining_of_nothing(spark):
    assert mined_here(spark, [(1, [1.0], 1, False), (2, [1.0], 1, False)]) == []
    assert mined_here(spark, [(1, [1.0], 1, True)]) == []
    assert hn.mine(spark.createDataFrame([], VECTORS)).collect() == []


def test_mining_query(spark, sf):
    rows = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 and r["label"] is not None else r["label"], r["vec_id"] % 100 == 0) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert sorted(map(tuple, op12_hard_negatives(spark, sf).collect())) == mined(rows)


# Pieces.


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=PIECES)


ODD = [" ", "  ", "   ", "\n", "a", "the", "ing", "tion", "▁", "é", "é", "中", "😀", "\0", "<0x0A>", "<s>", "</s>", "<unk>", "12", ".", "'", "İ", "​", "\r", "\t", "�", "𝔘", "a" * 70, " " * 90]


def test_pieces_against_library(library):
    rng = random.Random(11)
    texts = ["", " ", "▁", "▁" * 70 + "x", "ab " * 300, "x" * 5000] + ["".join(rng.choices(ODD, k=rng.randint(0, 30))) for _ in range(3000)]
    texts += ["".join(chr(rng.choice([rng.randint(0, 0xD7FF), rng.randint(0xE000, 0x2FFFF), rng.randint(32, 126)])) for _ in range(rng.randint(1, 60))) for _ in range(500)]
    coder = sn.PieceModel(PIECES, limit=300)  # forgets often
    for a in range(0, len(texts), 500):
        part = texts[a : a + 500]
        ids, bounds = coder.encode(pa.array(part))
        own = [ids[x:y].tolist() for x, y in zip(bounds, bounds[1:])]
        assert own == library.encode(part)
        assert [d.decode() for d in coder.decode(ids, bounds)] == [library.decode(i) for i in own]


def test_decoding_any_ids(library):
    rng = random.Random(12)
    lists = [[rng.choice([rng.randint(0, 2), rng.randint(3, 258), rng.randint(259, 31999), 35, 29871]) for _ in range(rng.randint(0, 8))] for _ in range(4000)]
    bounds = np.concatenate([[0], np.cumsum([*map(len, lists)])])
    flat = np.array([i for ids in lists for i in ids], np.int32)
    assert [d.decode() for d in sn.model(PIECES).decode(flat, bounds)] == [library.decode(ids) for ids in lists]


def test_piece_columns_and_odd_rows(spark, library):
    rows = [(1, "a  b", "x"), (1, "a  b", "x"), (None, "▁c", "y"), (2, None, "z"), (3, "", "z"), (4, "word " * 60_000 + "x" * 60_000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = sn.encode_documents(df, PIECES, ("n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256"))
    want = []
    for key, text, _ in rows:
        ids = library.encode(text or "")
        said = library.decode(ids)
        want.append((key, len(ids), ids, said, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(said.encode()).hexdigest()))
    order = lambda r: (r[0] is None, r[0], r[1])
    assert sorted(map(tuple, out.collect()), key=order) == sorted(want, key=order)
    again = sn.decode_ids(out, PIECES)
    assert sorted((r["doc_id"] or 0, r["decoded"]) for r in again.collect()) == sorted((w[0] or 0, w[3]) for w in want)
    assert sn.encode_documents(df.limit(0), PIECES).collect() == []


def test_piece_query(spark, sf, library):
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode(r["text"] or "")
        want[r["doc_id"]] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in op11_sentence_pieces(spark, sf).collect()} == want


# Repeated ids of the n-gram join.


def test_rows_of_one_id_are_one_node(spark):
    """Links of any of an id's texts count for the id, whichever of its texts are copies; against plain sets."""
    from millrace.llm.ngram_join import join_components

    rng = random.Random(21)
    words = [f"w{k}" for k in range(400)]
    base = [rng.sample(words, 40) for _ in range(12)]
    for turn in range(3):
        rows = [(1, base[0]), (2, base[0]), (2, base[1]), (3, base[1] + ["more"]), (9, base[2]), (9, base[3]), (4, base[2]), (5, base[3]), (None, base[2]), (7, [])]
        rows += [(rng.randint(10, 25), base[rng.randrange(4, 12)] + rng.sample(words, rng.choice([0, 0, 1]))) for _ in range(25 * turn)]
        sets = [{tuple(w[i : i + 3]) for i in range(len(w) - 2)} for _, w in rows]
        top = {k: k for k, _ in rows if k is not None}

        def root(k):
            while top[k] != k:
                k = top[k]
            return k

        for (a, _), x in zip(rows, sets):
            for (b, _), y in zip(rows, sets):
                if None not in (a, b) and x and 100 * len(x & y) >= 90 * len(x | y) and root(a) != root(b):
                    top[max(root(a), root(b))] = min(root(a), root(b))
        df = spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id long, text string").repartition(3)
        got = {(r["doc_id"], r["component_id"]) for r in join_components(df, k=3, percent=90).collect()}
        assert got == {(k, None if k is None else root(k)) for k, _ in rows}


# Rows that language-model scoring sends.


def test_rows_sent_grow_as_the_text_does(spark):
    """However many blocks there are, a chunk sends a row for each that it has a key for: never more than keys, in proportion to the text."""
    from millrace.llm import lm_score

    rng = random.Random(31)

    def sent(n, blocks):
        rows = [(k // 8, False, " ".join(f"w{rng.randrange(10**6)}" for _ in range(30))) for k in range(n)]
        docs = spark.createDataFrame(rows, "chunk int, is_target boolean, text string").coalesce(1).sortWithinPartitions("chunk")
        asked = lm_score.requests(lm_score.packed(docs, "chunk int, is_target boolean, text binary"), blocks).collect()
        keys = sum(len(lm_score.unplanes(r["keys"])) for r in asked)
        assert len({(r["chunk"], r["block"]) for r in asked}) == len(asked) <= keys <= n * 62
        return len(asked)

    few, many = sent(16, 2**31 - 1), sent(64, 2**31 - 1)
    assert 3.5 * few < many < 4.5 * few
    assert sent(16, 3) == 2 * 3


def test_a_block_is_answered_in_little_memory():
    """Sums of what all chunks count, in each chunk's order; at the peak under 56 bytes a key beside the batch that Spark hands over."""
    import tracemalloc

    import pyarrow as pa

    from millrace.llm import lm_score

    class Asked:
        def groupBy(self, *_):
            return self

        def applyInArrow(self, run, _):
            return run

    rng = np.random.default_rng(5)
    pool = np.unique(np.append(rng.integers(0, 1 << 62, 400_000).astype(np.uint64), lm_score.START))
    parts = [np.sort(rng.choice(pool, n, replace=False)) for n in (1, 50_000, 7, *[100_000] * 8)]
    parts[1] = np.unique(np.append(parts[1], lm_score.START))
    counts = [rng.integers(0, 1 << 40, (2, len(p))).astype(np.uint64) for p in parts]
    batch = pa.table({"chunk": pa.array(range(len(parts)), pa.int32()), "block": pa.array([0] * len(parts), pa.int32()), "keys": [lm_score.planes(np.diff(p, prepend=np.uint64(0))) for p in parts], "counts": [lm_score.planes(c.ravel()) for c in counts]})
    run = lm_score.answers(Asked())
    tracemalloc.start()
    got = run(batch)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    keys, place = np.unique(np.concatenate(parts), return_inverse=True)
    sums = np.zeros((2, len(keys)), np.uint64)
    for model in (0, 1):
        np.add.at(sums[model], place, np.concatenate(counts, axis=1)[model])
    word = (keys % 2 == 0) & (keys != lm_score.START)
    assert [got[c].to_pylist() for c in ("n", "n_target", "kinds")] == [[int(v)] + [0] * (len(parts) - 1) for v in (sums[0, word].sum(), sums[1, word].sum(), word.sum())]
    for p, back in zip(parts, got["counts"].to_pylist()):
        assert (lm_score.unplanes(back).reshape(2, -1) == sums[:, np.searchsorted(keys, p)]).all()
    assert peak < 56 * len(place), peak / len(place)
