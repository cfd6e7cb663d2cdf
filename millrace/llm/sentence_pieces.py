"""SentencePiece BPE encoding and decoding by tables of distinct chunks.

A chunk is a run of blanks and the word behind it.  No piece of the model goes on across a blank behind a letter (checked
when a model is read), so a text's ids are those of its chunks in order.  The texts of a slice are cut into chunks by array
operations on their bytes, their distinct chunks are put in a table, each is segmented once, and the ids are joined back by
position: one gather for the whole slice.  A worker keeps what it has segmented in two bounded generations, so a chunk that
is common is segmented once a worker; a table for all the corpus would send each place of each word through a shuffle,
which costs more than a word's segmentation.  Ids are decoded by a gather from a table of byte strings.

Segmenting and decoding are done here; the library is asked only for what the model's file holds.

Defined results: a null text is an empty text, which has no ids; repeated rows and null ids give a row each; texts of any
length are encoded whole (a slice holds at least one text); other columns, whatever their names, are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back

#: The sign that stands for a blank in pieces.
BLANK = "▁"
_NONE = 1 << 40


def _one_sign_a_byte(error):
    return "�" * (error.end - error.start), error.end


codecs.register_error("one-sign-a-byte", _one_sign_a_byte)


class PieceModel:
    """A BPE model with byte fallback, identity normalisation and a blank put before each text."""

    def __init__(self, path: str, limit: int = 400_000):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces, scores = [sp.id_to_piece(i) for i in range(n)], [sp.get_score(i) for i in range(n)]
        self.byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        if not all(sp.is_byte(int(i)) for i in self.byte_ids) or sp.normalize(" ①  a ") != f"{BLANK * 2}①{BLANK * 2}a{BLANK}":
            raise ValueError("only models with byte fallback, identity normalisation and a dummy prefix are read")
        if any(BLANK in pieces[i].lstrip(BLANK) for i in plain):
            raise ValueError("a piece of this model crosses a blank")
        places = {s: k for k, s in enumerate(sorted({scores[i] for i in plain}, reverse=True))}
        self.ranks = {pieces[i]: places[scores[i]] for i in plain}
        self.longest = max(map(len, self.ranks))
        # Symbols: pieces by their ids, then the characters that are in a piece but are none themselves.
        lone = sorted({c for p in self.ranks for c in p} - {*self.ranks})
        self.symbols = {pieces[i]: i for i in plain} | {c: n + k for k, c in enumerate(lone)}
        self.width = n + len(lone)
        self.lone, self.point_of = np.arange(max(1, self.width)) >= n, np.zeros(self.width, np.int64)
        self.point_of[n:] = [ord(c) for c in lone]
        self.symbol_of = np.full(0x110000, -1, np.int32)
        for c, i in self.symbols.items():
            if len(c) == 1:
                self.symbol_of[ord(c)] = i
        halves = ((a, b, p) for p in self.ranks for k in range(1, len(p)) if (a := self.symbols.get(p[:k])) is not None and (b := self.symbols.get(p[k:])) is not None)
        found = sorted((a * self.width + b, self.ranks[p], self.symbols[p]) for a, b, p in halves)
        self.pair_keys, self.pair_ranks, self.pair_symbols = (np.array(x, np.int64) for x in zip(*found))
        said = {i: pieces[i].replace(BLANK, " ").encode() for i in plain} | {int(i): bytes([b]) for b, i in enumerate(self.byte_ids)}
        self.said = pa.array([said.get(i, b"" if sp.is_control(i) else " ⁇ ".encode()) for i in range(n)], pa.binary())
        self.led = np.array([pieces[i].startswith(BLANK) for i in range(n)])
        self.silent = np.array([sp.is_control(i) for i in range(n)])
        self.decimal = pa.array([f"{i},".encode() for i in range(n)], pa.binary())
        self.limit, self.now, self.older = limit, {}, {}

    def parts(self, word: str) -> list[str]:
        """The pieces of a long word: the adjacent pair of best score, leftmost first, is merged until none is a piece."""
        get, n = self.ranks.get, len(word)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]  # where the part that starts at i ends, and the one before it starts
        live, queue = bytearray(b"\1") * n, []

        def offer(i: int) -> None:
            if i >= 0 and (j := after[i]) < n and after[j] - i <= self.longest and (r := get(word[i : after[j]])) is not None:
                heapq.heappush(queue, (r, i, after[j]))

        for i in range(n - 1):
            offer(i)
        while queue:
            _, i, end = heapq.heappop(queue)
            j = after[i] if live[i] else n
            if j >= n or after[j] != end:
                continue  # one of the two has grown meanwhile
            live[j], after[i] = 0, end
            if end < n:
                before[end] = i
            offer(before[i])
            offer(i)
        return [word[i : after[i]] for i in range(n) if live[i]]

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each two symbols the rank and the symbol of what they merge into; _NONE where that is no piece."""
        keys = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        hit = (self.pair_keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(hit, self.pair_ranks[at], _NONE), self.pair_symbols[at]

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all words in a row, and of which word each is.

        All words are merged in step: in each turn the best pair of every word, its leftmost among equals, becomes one
        symbol, and words without a pair are done.  Symbols below zero are characters that no piece has.
        """
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        symbol = self.symbol_of[points].astype(np.int64)
        symbol[symbol < 0] = -1 - points[symbol < 0]
        word = np.repeat(np.arange(len(words)), [*map(len, words)])
        done = []

        def rank(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Of the pairs that begin at these places, of which the next place may be another word's, or none."""
            after = np.minimum(at + 1, len(symbol) - 1)
            ranks, become = self.pairs(symbol[at], symbol[after])
            ranks[(word[after] != word[at]) | (after == at)] = _NONE
            return ranks, become

        ranks, become = rank(np.arange(len(symbol)))
        while len(symbol):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.repeat(np.minimum.reduceat(ranks, first), np.diff(first, append=len(word)))
            if (over := best == _NONE).any():
                done.append((symbol[over], word[over]))
                going = ~over
                symbol, word, ranks, become, best = symbol[going], word[going], ranks[going], become[going], best[going]
            at = np.flatnonzero(ranks == best)
            at = at[np.diff(word[at], prepend=-1) > 0]
            symbol[at] = become[at]
            kept = np.ones(len(symbol), bool)
            kept[at + 1] = False
            symbol, word, ranks, become = symbol[kept], word[kept], ranks[kept], become[kept]
            at -= np.arange(len(at))
            changed = np.concatenate([at, at[at > 0] - 1])
            ranks[changed], become[changed] = rank(changed)
        symbol, word = (np.concatenate(x) for x in zip(*done)) if done else (symbol, word)
        order = np.argsort(word, kind="stable")
        return symbol[order], word[order]

    def segment(self, chunks: list[str]) -> list[bytes]:
        """The ids of each chunk, as bytes."""
        words = [c.replace(" ", BLANK) for c in chunks]
        long = [k for k, w in enumerate(words) if len(w) > 64]
        symbol, word = self.merged([w if len(w) <= 64 else "" for w in words])
        for k in long:
            own = [self.symbols.get(p, -1 - ord(p[0])) for p in self.parts(words[k])]
            at = np.searchsorted(word, k)
            symbol, word = np.insert(symbol, at, own), np.insert(word, at, np.full(len(own), k))
        ids, lengths = self.spelt(symbol)
        ends = np.concatenate([[0], np.cumsum(np.bincount(word, lengths, len(words)).astype(np.int64) * 4)]).tolist()
        data = ids.tobytes()
        return [data[a:b] for a, b in zip(ends, ends[1:])]

    def spelt(self, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbols, those that are no pieces spelt as the bytes of their UTF-8, and how many ids each has."""
        lone = np.flatnonzero(self.lone[np.maximum(symbol, 0)] | (symbol < 0))
        points = np.where(symbol[lone] < 0, -1 - symbol[lone], self.point_of[np.maximum(symbol[lone], 0)])
        size = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        lengths = np.ones(len(symbol), np.int64)
        lengths[lone] = size
        ids = np.repeat(symbol, lengths).astype(np.int32)
        at = (np.cumsum(lengths) - lengths)[lone]
        for n, lead in enumerate((0, 0xC0, 0xE0, 0xF0), 1):
            own = size == n
            for j in range(n):
                byte = points[own] >> 6 * (n - 1 - j)
                ids[at[own] + j] = self.byte_ids[byte | lead if j == 0 else byte & 0x3F | 0x80]
        return ids, lengths

    def known(self, chunks: list[str]) -> list[bytes]:
        """The ids of each (distinct) chunk as bytes; what a worker has segmented is kept in two generations."""
        if len(self.now) > self.limit:
            self.older, self.now = self.now, {}
        now, older, found = self.now, self.older, [*map(self.now.get, chunks)]
        new = []
        for k, got in enumerate(found):
            if got is None:
                chunk = chunks[k]
                if (got := older.get(chunk)) is None:
                    new.append(k)
                else:
                    found[k] = now[chunk] = got
        for k, got in zip(new, self.segment([chunks[k] for k in new])):
            found[k] = got
            if len(chunks[k]) <= 64:
                now[chunks[k]] = got
        return found

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin, with the end."""
        chunks, bounds = split_chunks(texts)
        table = chunks.dictionary_encode()
        ids = self.known(table.dictionary.to_pylist())
        ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) // 4)])
        flat = pa.array(np.frombuffer(b"".join(ids), np.int32))
        lists = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), flat)
        joined = lists.take(table.indices)
        counts = np.concatenate([[0], np.cumsum(pc.list_value_length(joined).to_numpy(zero_copy_only=False))]).astype(np.int64)
        return joined.flatten().to_numpy(zero_copy_only=False), counts[bounds]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The UTF-8 bytes that the ids between each two bounds stand for.

        The blank before a text goes; control ids say nothing; bytes between two other ids that are no text become U+FFFD.
        """
        data, ends = gathered(self.said, ids)
        begun = np.append(self.led[ids], False)
        silent = np.flatnonzero(self.silent[ids])
        out = []
        for a, b, own in zip(bounds[:-1].tolist(), bounds[1:].tolist(), np.split(silent, np.searchsorted(silent, bounds[1:-1])) if len(bounds) > 1 else []):
            text, at = b"", a
            for stop in [*own.tolist(), b]:
                if at < stop:
                    part = bytes(data[ends[at] + int(begun[at] and not text) : ends[stop]])
                    try:
                        part.decode()
                    except UnicodeDecodeError:
                        part = part.decode("utf-8", "one-sign-a-byte").encode()
                    text += part
                at = stop + 1
            out.append(text)
        return out


def gathered(table: pa.BinaryArray, at: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The entries of a table of byte strings one after another, and where each begins, with the end."""
    taken = table.cast(pa.large_binary()).take(pa.array(at, pa.int32()))
    _, ends, data = taken.buffers()
    return memoryview(data or b""), np.frombuffer(ends, np.int64)[taken.offset : taken.offset + len(taken) + 1]


def split_chunks(texts: pa.StringArray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The chunks of all texts, each text begun with a blank, and the number of the first chunk of each text, with the end.

    The sign for blanks, where a text has it, is a blank to the model, and so it is here.
    """
    texts = pc.replace_substring(texts.cast(pa.large_string()), BLANK, " ")
    led = pc.if_else(pc.equal(texts, ""), pa.scalar("", pa.large_string()), pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string())))
    _, ends, data = led.buffers()
    ends = np.frombuffer(ends, np.int64)[led.offset : led.offset + len(led) + 1]
    data = np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    begins = data == 32
    begins[1:] &= data[:-1] != 32
    begins[ends[:-1][np.diff(ends) > 0]] = True
    at = np.flatnonzero(begins)
    offsets = np.append(at, len(data)).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))), np.searchsorted(at, ends)


_MODELS: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """The worker's model: tasks that a worker runs one after another share its table."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def slices(iterator, size: int = 4 << 20):
    """(ids, texts) of at most ``size`` bytes of text, or of one text."""
    give_back()
    for batch in iterator:
        ids, texts = batch.column(0), pc.fill_null(batch.column(1), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)) if len(texts) else []
        at, before = 0, 0
        while at < len(texts):
            stop = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
            yield ids.slice(at, stop - at), texts.slice(at, stop - at)
            at, before = stop, int(ends[stop - 1])
    give_back()


_KINDS = {"n_tokens": ("long", pa.int64()), "ids": ("array<int>", pa.list_(pa.int32())), "decoded": ("string", pa.string()), "ids_sha256": ("string", pa.string()), "decoded_sha256": ("string", pa.string())}


def encode_documents(docs: DataFrame, path: str, columns: tuple[str, ...] = ("n_tokens", "ids")) -> DataFrame:
    """Per row: doc_id and the asked columns; ``path`` names the model's file on every executor.

    n_tokens; ids; decoded (the text that the ids stand for); ids_sha256 and decoded_sha256 (digests of the decimal ids
    joined by commas and of the decoded text, made where the ids are, so that they needn't leave the worker).
    """

    def run(iterator):
        coder = model(path)
        for keys, texts in slices(iterator):
            ids, bounds = coder.encode(texts)
            made = {"n_tokens": np.diff(bounds)}
            if "ids" in columns:
                made["ids"] = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
            if "ids_sha256" in columns:
                data, ends = gathered(coder.decimal, ids)
                places = ends[bounds].tolist()
                made["ids_sha256"] = [hashlib.sha256(data[a : max(a, b - 1)]).hexdigest() for a, b in zip(places, places[1:])]
            if {"decoded", "decoded_sha256"} & {*columns}:
                decoded = coder.decode(ids, bounds)
                made |= {"decoded": [d.decode() for d in decoded]} if "decoded" in columns else {}
                made["decoded_sha256"] = [hashlib.sha256(d).hexdigest() for d in decoded]
            yield pa.RecordBatch.from_arrays([keys, *(made[c] if isinstance(made[c], pa.Array) else pa.array(made[c], _KINDS[c][1]) for c in columns)], names=["doc_id", *columns])

    schema = "doc_id long, " + ", ".join(f"{c} {_KINDS[c][0]}" for c in columns)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """Per row with doc_id and ids: doc_id, decoded; null ids, and null among ids, stand for nothing."""

    def run(iterator):
        coder = model(path)
        for batch in iterator:
            lists = [[i for i in ids or () if i is not None] for ids in batch.column(1).to_pylist()]
            bounds = np.concatenate([[0], np.cumsum([*map(len, lists)])]).astype(np.int64)
            flat = np.fromiter((i for ids in lists for i in ids), np.int32, int(bounds[-1]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([d.decode() for d in coder.decode(flat, bounds)], pa.string())], names=["doc_id", "decoded"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, decoded string")
