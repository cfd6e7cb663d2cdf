"""Language-model scores by cross-entropy difference.

A target and a background bigram model share one vocabulary (all words of the corpus) and one smoothing, so their losses
differ by what they have seen alone.  Words and bigrams are counted exactly over all documents.  A token's loss under a
model is -log2 of its interpolated probability; a document's score is its mean loss under the target less that under the
background, so lower is closer to the target.  Each document is left out of the models that score it: its own counts are
taken off those of the background, and off those of the target if it is a target row, so that a document isn't told by its
own words.  Both models grow with the corpus: the background is counted over all of it, the target over all its rows.

Words and bigrams are known by 63-bit hashes, of which two of a billion are equal with a chance of about one in twenty.
Texts are dealt into chunks and hashes into blocks, as many of each as the corpus' counted size asks for.  A chunk sends
each block its distinct hashes, sorted, with their counts; the block adds up those of all chunks and answers in the same
order; the chunk's texts, read again, are scored with the answers.  So a task holds a chunk or a block, a hash appears
once a chunk whatever its count, a chunk sends no more rows than it has hashes and takes no turn for a block that it has nothing for, so
that the work is in proportion to the text however many blocks there are, and only three totals reach the driver.

Defined results: a null or empty text has no tokens, and null losses and score; target rows are those whose id is in the
target table, so a row without an id is none; without any the models differ only by smoothing; repeated rows are counted and
scored each, and each leaves out one of them; texts of any length are read whole; other columns, whatever their names, are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, WordHashes, batches, give_back, maybe_broadcast, mix

#: Bytes of text a chunk, and a block.
CHUNK, BLOCK = 4 << 20, 4 << 20
#: Keys, or words, whose sums or losses are held at a time.
PIECE = 1 << 17
#: Weight of the bigram estimate, and what is added to every word's count.
WEIGHT, ADDED = 0.6, 0.5
#: The start of a text.  Words have even keys, bigrams odd ones.
START = np.uint64(2)
ONE = np.uint64(1)


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def keys_of(text: bytes, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the start and the words of a text, and of its bigrams."""
    words = words_of(text)
    single = np.full(len(words) + 1, START)
    single[1:] = hashes.of(words) & ~ONE
    return single, mix(mix(single[:-1] + ONE) + single[1:]) | ONE


def planes(values: np.ndarray) -> bytes:
    """64-bit values by place of their bytes, so that the high ones compress when they are written."""
    return values.astype("<u8").reshape(-1, 1).view(np.uint8).T.tobytes()


def unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, sorted, the sums of their counts (a row a model), and the place of each key among them."""
    distinct, place = np.unique(keys, return_inverse=True)
    return distinct, np.stack([np.bincount(place, c, len(distinct)).astype(np.int64) for c in counts]), place


def packed(docs: DataFrame, schema: str) -> DataFrame:
    """The three columns of docs, the last of which is a text, with the text compressed for the shuffle."""
    names = docs.columns

    def run(iterator):
        for part, texts in batches(iterator, text_at=2, binary=True):
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([zlib.compress(t, 1) for t in texts], pa.binary())], names=names)

    return docs.mapInArrow(run, schema)


def requests(docs: DataFrame, blocks: int) -> DataFrame:
    """(chunk, block, keys, counts) of docs (chunk, is_target, packed text), whose partitions are sorted by chunk."""

    def counted(waiting):
        every, first = np.concatenate([k for k, _ in waiting]), [k for k, target in waiting if target]
        every.sort()
        starts = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        counts = np.zeros((2, len(starts)), np.int64)
        counts[0] = np.diff(starts, append=len(every))
        keys = every[starts]
        if first:
            own, n = np.unique(np.concatenate(first), return_counts=True)
            counts[1, np.searchsorted(keys, own)] = n
        return keys, counts

    def merged(waiting, earlier):
        done = [*earlier, *([counted(waiting)] if waiting else [])]
        return done[0] if len(done) == 1 else summed(np.concatenate([k for k, _ in done]), np.concatenate([c for _, c in done], axis=1))[:2]

    def sent(chunk, waiting, earlier):
        keys, counts = merged(waiting, earlier)
        of = block_of(keys, blocks)
        first = np.flatnonzero(np.diff(of, prepend=np.uint64(blocks)))  # the blocks that have a key, however many there are
        at = of[first].tolist()
        parts = [slice(a, b) for a, b in zip(first.tolist(), [*first[1:].tolist(), len(keys)])]
        columns = [pa.array([chunk] * len(at), pa.int32()), pa.array(at, pa.int32()), pa.array([planes(np.diff(keys[p], prepend=np.uint64(0))) for p in parts], pa.binary()), pa.array([planes(counts[:, p].ravel()) for p in parts], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["chunk", "block", "keys", "counts"])

    def run(iterator):
        hashes, waiting, earlier, held, now = WordHashes(), [], [], 0, None
        for part, texts in batches(iterator, text_at=2, binary=True):
            for chunk, target, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), texts):
                if chunk != now and (waiting or earlier):
                    yield sent(now, waiting, earlier)
                    waiting, earlier, held = [], [], 0
                now = chunk
                single, pairs = keys_of(zlib.decompress(t), hashes)
                if not len(pairs):
                    continue
                waiting.append((np.concatenate([single, pairs]), target))
                held += len(single) + len(pairs)
                if held > 1 << 22:  # more than a chunk has, unless its rows repeat
                    waiting, earlier, held = [], [merged(waiting, earlier)], 0
        if waiting or earlier:
            yield sent(now, waiting, earlier)

    return docs.mapInArrow(run, "chunk int, block int, keys binary, counts binary")


def block_of(keys: np.ndarray, blocks: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)


def ordered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places of keys in sorted order, where each distinct one starts in it, and whether that is a word."""
    order = np.argsort(keys).astype(np.uint32 if len(keys) < 1 << 32 else np.int64)
    starts = np.ones(len(keys), bool)
    for at in range(0, len(keys), PIECE):
        part = keys[order[max(at - 1, 0) : at + PIECE]]
        starts[max(at, 1) : at + PIECE] = part[1:] != part[:-1]
    starts = np.flatnonzero(starts)
    distinct = keys[order[starts]]
    return order, starts, (distinct & ONE == 0) & (distinct != START)


def answers(asked: DataFrame) -> DataFrame:
    """(chunk, block, counts) in the order of the keys asked for; and a block's words and kinds, in its first row alone."""

    def run(rows):
        give_back()
        parts = [unplanes(k.as_buffer()) for k in rows["keys"]]
        ends = np.cumsum([0, *map(len, parts)])
        keys = np.concatenate(parts)
        del parts
        for at, end in zip(ends.tolist(), ends[1:].tolist()):
            np.cumsum(keys[at:end], out=keys[at:end])
        order, starts, word = ordered(keys)
        del keys
        counts = np.empty((2, len(order)), np.uint64)
        for c, at, end in zip(rows["counts"], ends.tolist(), ends[1:].tolist()):
            counts[:, at:end] = unplanes(c.as_buffer()).reshape(2, -1)
        totals = [0, 0, int(word.sum())]
        cuts = np.unique([*np.searchsorted(starts, np.arange(0, len(order), PIECE)), len(starts)]).tolist()
        for x, y in zip(cuts, cuts[1:]):  # each count becomes its key's sum, some keys at a time
            first, last = starts[x], starts[y] if y < len(starts) else len(order)
            of, sizes = order[first:last], np.diff(starts[x:y], append=last)
            for model in (0, 1):
                sums = np.add.reduceat(counts[model, of], starts[x:y] - first)
                totals[model] += int(sums[word[x:y]].sum())
                counts[model, of] = np.repeat(sums, sizes)
        del order, starts
        back = np.empty(16 * int(ends[-1]), np.uint8)
        for at, end in zip(ends.tolist(), ends[1:].tolist()):
            back[16 * at : 16 * end].reshape(8, -1)[:] = np.ascontiguousarray(counts[:, at:end]).astype("<u8", copy=False).reshape(-1, 1).view(np.uint8).T
        back = pa.Array.from_buffers(pa.large_binary(), rows.num_rows, [None, pa.py_buffer(16 * ends), pa.py_buffer(back)]).cast(pa.binary())
        totals = [[v] + [0] * (rows.num_rows - 1) for v in totals]
        return pa.table([rows["chunk"], rows["block"], back, *(pa.array(v, pa.int64()) for v in totals)], names=["chunk", "block", "counts", "n", "n_target", "kinds"])

    return asked.groupBy("block").applyInArrow(run, "chunk int, block int, counts binary, n long, n_target long, kinds long")


def losses(before: np.ndarray, word: np.ndarray, pair: np.ndarray, total: np.ndarray, kinds: int) -> np.ndarray:
    """Bits of words from the counts of the word before, of the word and of both; one kind more stands for unseen words."""
    floor = (word + ADDED) / (total + ADDED * (kinds + 1))
    follow = np.divide(pair, before, out=np.zeros(len(before)), where=before > 0)
    weight = np.where(before > 0, WEIGHT, 0.0)
    return -np.log2(weight * follow + (1 - weight) * floor)


def own_counts(keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each key of texts one after another, how often its own text has it."""
    out, at = np.empty(len(keys), np.int32), 0
    for n in sizes.tolist():
        _, place, counts = np.unique(keys[at : at + n], return_inverse=True, return_counts=True)
        out[at : at + n] = counts[place]
        at += n
    return out


def scores(docs: DataFrame, targets: DataFrame, chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_tokens, target_loss, background_loss, score; ``targets`` has doc_id."""
    scratch = Scratch(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, blocks = size // chunk + 1, size // block + 1
    docs = docs.withColumn("chunk", F.expr(f"int(pmod(xxhash64(doc_id, text), {chunks}))"))
    chosen = scratch.save(targets.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().withColumn("is_target", F.lit(True)), "targets")
    docs = docs.join(maybe_broadcast(chosen), "doc_id", "left").withColumn("is_target", F.coalesce("is_target", F.lit(False)))
    flagged = packed(docs.select("chunk", "is_target", "text"), "chunk int, is_target boolean, text binary")
    found = scratch.save(answers(requests(flagged.repartitionById(chunks, F.col("chunk")).sortWithinPartitions("chunk"), blocks)), "answers")
    total = [v or 0 for v in found.agg(F.sum("n_target"), F.sum("n"), F.sum("kinds")).first()]

    def text_losses(single, pair, sizes, target, counts):
        """Mean losses under both models, and of their difference, of texts of so many words, by the places of their keys among the counts."""
        first = np.cumsum(sizes + 1) - sizes - 1
        last, starts = first + sizes, np.cumsum(sizes) - sizes
        # What a text has of its own: its words and the start, and its bigrams.
        own_single, own_pair = own_counts(single, sizes + 1), own_counts(pair, sizes)
        before, word = np.delete(single, last), np.delete(single, first)
        own_before, own_word = np.delete(own_single, last), np.delete(own_single, first)
        target = np.repeat(target, sizes)
        length, found = np.repeat(sizes, sizes), []
        for c, n, out in ((counts[1], total[0], target), (counts[0], total[1], 1)):
            found.append(losses((c[before] - out * own_before).astype(float), c[word] - out * own_word, c[pair] - out * own_pair, n - out * length, total[2]))
        return [np.add.reduceat(v, starts) / sizes for v in (*found, found[0] - found[1])]

    def scored(rows, held, back):
        """A batch of a chunk's rows (doc_id, (is target, text's digest)) by the keys of its distinct texts and the answered counts; empties both."""
        per_text = {}
        full = [d for d, (_, pairs) in held.items() if len(pairs)]
        if full:
            sizes = np.array([len(held[d][1]) for d in full])
            keys = np.concatenate([*(held[d][0] for d in full), *(held[d][1] for d in full)])
            held.clear()
            distinct, place = np.unique(keys, return_inverse=True)
            kinds = len(distinct)
            del keys, distinct
            place = place.astype(np.uint32 if kinds < 1 << 32 else np.int64)
            counts = np.concatenate(back, axis=1) if back else np.zeros((2, 0), np.int64)
            back.clear()
            if counts.shape[1] != kinds:
                raise RuntimeError("the texts read to be scored aren't those that were counted")
            single, pair = place[: sizes.sum() + len(sizes)], place[sizes.sum() + len(sizes) :]
            ends = np.cumsum(sizes)
            cuts = np.unique([0, *np.searchsorted(ends, np.arange(PIECE, ends[-1], PIECE)), len(sizes)]).tolist()
            for a, b in zip(cuts, cuts[1:]):
                at = int(ends[a - 1]) if a else 0
                sums = text_losses(single[at + a : ends[b - 1] + b], pair[at : ends[b - 1]], sizes[a:b], np.array([t for t, _ in full[a:b]], np.int32), counts)
                per_text |= {d: (int(n), *map(float, v)) for d, n, *v in zip(full[a:b], sizes[a:b], *sums)}
        columns = [*zip(*(per_text.get(d, (0, None, None, None)) for _, d in rows))]
        kinds_of = [pa.int64(), pa.float64(), pa.float64(), pa.float64()]
        ids = pa.array([i for i, _ in rows], pa.int64())
        return pa.RecordBatch.from_arrays([ids, *(pa.array(c, k) for c, k in zip(columns, kinds_of))], names=["doc_id", "n_tokens", "target_loss", "background_loss", "score"])

    def run(iterator):
        hashes, now = WordHashes(), None
        rows, held, back = [], {}, []
        for part, texts in batches(iterator, text_at=3, binary=True):
            for at, which, doc_id, t, counts in zip(*(part.column(k).to_pylist() for k in range(3)), texts, part.column(4).to_pylist()):
                if at != now and rows:
                    yield scored(rows, held, back)
                    rows, held, back = [], {}, []
                now = at
                if which >= 0:
                    back.append(unplanes(counts).reshape(2, -1).view(np.int64))
                    continue
                t = zlib.decompress(t)
                known = (which == -2, xxhash.xxh3_128_digest(t))
                rows.append((doc_id, known))
                if known not in held:
                    held[known] = keys_of(t, hashes)
        if rows:
            yield scored(rows, held, back)

    # A chunk's texts come first (block -2 if of the target, else -1), then its answers in the order of blocks, which is that of the keys.
    coded = F.when(F.col("is_target"), F.col("chunk") * 2 + 1).otherwise(F.col("chunk") * 2)
    texts = packed(docs.select(coded.cast("long").alias("chunk"), "doc_id", "text"), "chunk long, doc_id long, text binary")
    texts = texts.select(F.expr("int(chunk div 2)").alias("chunk"), F.expr("int(-1 - chunk % 2)").alias("block"), "doc_id", "text", F.lit(None).cast("binary").alias("counts"))
    replies = found.select("chunk", "block", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("text"), "counts")
    both = texts.unionByName(replies).repartitionById(chunks, F.col("chunk")).sortWithinPartitions("chunk", "block")
    return both.mapInArrow(run, "doc_id long, n_tokens long, target_loss double, background_loss double, score double")
