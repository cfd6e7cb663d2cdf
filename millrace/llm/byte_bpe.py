"""Byte-level BPE by vectorised pre-tokenisation and cached pair merging.

Boundaries are found without regex.  Codepoints index an array of classes; look-ahead (the last white space of a run,
an apostrophe before a contraction's letters) is local and folded into the symbols; what is left is a finite automaton
of eight states.  Its transition functions are composed by an associative scan in two levels: within blocks for all
start states at once, then over the blocks, and a last pass replays each block from its true start state.  The slices
between boundaries go to a cache of merged pieces; ids decode through a table of byte strings, and the codepoint
offset of each piece is kept beside its count of ids, so any span of ids leads back to its text.

Defined results: a null text is an empty text, which has no ids; repeated rows give repeated results; texts of any
length are encoded whole, in chunks that never cut a text; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import unicodedata
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches

# Symbols that the automaton reads.
LETTER, NUMBER, OTHER, SPACE_LAST, WHITE_LAST, WHITE_IN, APOSTROPHE_1, APOSTROPHE_2, RESET = range(9)
# States: after a token of one class, after a space that the next class may join, inside or after a contraction.
S_LETTER, S_NUMBER, S_OTHER, S_SPACE, S_WHITE, S_ONE_LEFT, S_TWO_LEFT, S_CLOSED = range(8)
N_STATES, N_SYMBOLS, BLOCK = 8, 9, 256
#: Unicode White_Space.
WHITE = (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


@functools.cache
def classes() -> np.ndarray:
    out = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            out[c] = LETTER
        elif kind == "N":
            out[c] = NUMBER
    out[list(WHITE)] = WHITE_IN
    return out


@functools.cache
def machine() -> tuple[np.ndarray, np.ndarray]:
    """Next state and boundary flag by symbol * N_STATES + state."""
    follow, start = np.zeros((N_SYMBOLS, N_STATES), np.uint8), np.zeros((N_SYMBOLS, N_STATES), bool)
    home = {LETTER: S_LETTER, NUMBER: S_NUMBER, OTHER: S_OTHER}
    for state in range(N_STATES):
        for symbol in range(N_SYMBOLS):
            if symbol == RESET:
                follow[symbol, state], start[symbol, state] = S_CLOSED, True
            elif symbol == SPACE_LAST:
                follow[symbol, state], start[symbol, state] = S_SPACE, True
            elif symbol == WHITE_LAST:
                follow[symbol, state], start[symbol, state] = S_CLOSED, True
            elif symbol == WHITE_IN:
                follow[symbol, state], start[symbol, state] = S_WHITE, state != S_WHITE
            elif symbol in (APOSTROPHE_1, APOSTROPHE_2):
                if state in (S_OTHER, S_SPACE):  # part of a run of other signs: no contraction
                    follow[symbol, state] = S_OTHER
                else:
                    follow[symbol, state], start[symbol, state] = (S_ONE_LEFT if symbol == APOSTROPHE_1 else S_TWO_LEFT), True
            elif state == S_TWO_LEFT:
                follow[symbol, state] = S_ONE_LEFT
            elif state == S_ONE_LEFT:
                follow[symbol, state] = S_CLOSED
            else:
                follow[symbol, state] = home[symbol]
                start[symbol, state] = state not in (home[symbol], S_SPACE)
    return follow.ravel(), start.ravel()


def symbols(points: np.ndarray, resets: np.ndarray) -> np.ndarray:
    """Symbols of codepoints; at ``resets`` stand separators between texts."""
    s = classes()[points]
    s[resets] = RESET
    white = s == WHITE_IN
    last = np.flatnonzero(white[:-1] & ~white[1:] & (s[1:] != RESET))
    s[last] = np.where(points[last] == 32, SPACE_LAST, WHITE_LAST)
    a = np.flatnonzero(points[:-1] == 39)
    if len(a):
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        one, two = padded[a + 1], padded[a + 2]
        is_one = np.isin(one, [ord(c) for c in "stmd"])
        is_two = np.zeros(len(a), bool)
        for pair in ("re", "ve", "ll"):
            is_two |= (one == ord(pair[0])) & (two == ord(pair[1]))
        s[a[is_one]] = APOSTROPHE_1
        s[a[is_two]] = APOSTROPHE_2
    return s


def scan(s: np.ndarray) -> np.ndarray:
    """Boundary flags by the two-level scan of transition functions."""
    follow, start = machine()
    n = len(s)
    blocks = -(-n // BLOCK)
    padded = np.full(blocks * BLOCK, RESET, np.uint8)
    padded[:n] = s
    rows = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T)
    maps = np.tile(np.arange(N_STATES, dtype=np.uint8), (blocks, 1))
    for row in rows:  # composes the functions of all blocks, column by column
        maps = follow[row[:, None] * np.uint8(N_STATES) + maps]
    at, entry = S_CLOSED, np.empty(blocks, np.uint8)
    for i, m in enumerate(maps.tolist()):  # composes over the blocks
        entry[i] = at
        at = m[at]
    flags = np.empty((BLOCK, blocks), bool)
    for j, row in enumerate(rows):
        step = row * np.uint8(N_STATES) + entry
        flags[j] = start[step]
        entry = follow[step]
    return flags.T.ravel()[:n]


def pretokenise(texts: list[str]) -> list[list[int]]:
    """For each text the codepoint offsets of its pieces, ended by the text's length."""
    lengths = [len(t) for t in texts]
    joined = "\0".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    begins = np.array([0, *accumulate(x + 1 for x in lengths)], np.int64)
    if not len(points):
        return [[0] for _ in texts]
    starts = np.flatnonzero(scan(symbols(points, begins[1:-1] - 1)))
    cuts = np.searchsorted(starts, begins[:-1]).tolist() + [len(starts)]
    out = []
    for i, length in enumerate(lengths):
        own = starts[cuts[i] : cuts[i + 1]] - begins[i]
        if i + 1 < len(lengths) and len(own):
            own = own[own < length]
        out.append([*own.tolist(), length])
    return out


def merge(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Ids of one piece: the pair of least rank, leftmost first, is merged until none is left."""
    if piece in ranks:
        return (ranks[piece],)
    n = len(piece)
    get, none = ranks.get, 1 << 40
    if n <= 64:
        cuts = [*range(n + 1)]
        pairs = [get(piece[i : i + 2], none) for i in range(n - 1)]  # of the part at i with the next one
        while pairs and (best := min(pairs)) < none:
            i = pairs.index(best)
            del cuts[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = get(piece[cuts[i] : cuts[i + 2]], none)
            if i:
                pairs[i - 1] = get(piece[cuts[i - 1] : cuts[i + 1]], none)
        return tuple([ranks[piece[a:b]] for a, b in zip(cuts, cuts[1:])])
    end = [*range(1, n + 1)]  # of the part that starts at i
    back = [*range(-1, n - 1)]
    live = [True] * n

    def rank(i: int):
        j = end[i]
        return ranks.get(piece[i : end[j]]) if j < n else None

    heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(i)) is not None]
    heapq.heapify(heap)
    while heap:
        r, i, stop = heapq.heappop(heap)
        if not live[i] or end[i] >= n or end[end[i]] != stop or rank(i) != r:
            continue
        j = end[i]
        live[j] = False
        end[i] = end[j]
        if end[i] < n:
            back[end[i]] = i
        for k in (i, back[i]):
            if k >= 0 and (x := rank(k)) is not None:
                heapq.heappush(heap, (x, k, end[end[k]]))
    return tuple(ranks[piece[i : end[i]]] for i in range(n) if live[i])


class Merged(dict):
    """Piece to ids.  Of two generations of ``limit`` pieces each the older is forgotten, so memory is bounded."""

    def __init__(self, ranks: dict[bytes, int], limit: int):
        super().__init__()
        self.ranks, self.limit, self.older = ranks, limit, {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.older.get(piece)
        if ids is None:
            ids = merge(piece.encode("utf-8"), self.ranks)
        if len(piece) <= 64:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """Encodes and decodes by a rank file: lines of a base64 token and its rank."""

    def __init__(self, path: str, cache: int = 250_000):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_of = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.merged = Merged(self.ranks, cache)

    def encode(self, texts: list[str], chunk: int = 1 << 20):
        """Yields for each text (ids, piece offsets in codepoints, count of ids of each piece)."""
        at = 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size + len(texts[stop]) <= chunk):
                size += len(texts[stop]) + 1
                stop += 1
            for text, cuts in zip(texts[at:stop], pretokenise(texts[at:stop])):
                pieces = [*map(self.merged.__getitem__, [text[a:b] for a, b in zip(cuts, cuts[1:])])]
                yield [*chain.from_iterable(pieces)], cuts, pieces
            at = stop

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_COLUMNS = {
    "n_tokens": ("long", pa.int64()), "ids": ("array<int>", pa.list_(pa.int32())), "piece_offsets": ("array<int>", pa.list_(pa.int32())),
    "piece_ids": ("array<int>", pa.list_(pa.int32())), "decoded": ("binary", pa.binary()), "ids_sha256": ("string", pa.string()), "decoded_sha256": ("string", pa.string()),
}


def encode_documents(docs: DataFrame, path: str, columns: tuple[str, ...] = ("n_tokens", "ids", "piece_offsets", "piece_ids")) -> DataFrame:
    """Per row: doc_id and the asked columns.

    ids; piece_offsets (start of each piece in codepoints, then the length); piece_ids (ids of each piece); decoded
    (bytes of the decoded ids); ids_sha256 and decoded_sha256 (digests of the decimal ids and of the decoded bytes, made
    where the ids are, so that they needn't leave the worker).  ``path`` names the rank file on every executor.
    """

    def run(iterator):
        codec = Codec(path)
        decimal = [str(i) for i in range(len(codec.bytes_of))]
        for part, texts in batches(iterator, size=256):
            out: dict[str, list] = {c: [] for c in columns}
            for ids, cuts, pieces in codec.encode(texts):
                if "decoded" in out or "decoded_sha256" in out:
                    decoded = codec.decode(ids)
                for c, values in out.items():
                    if c == "n_tokens":
                        values.append(len(ids))
                    elif c == "ids":
                        values.append(ids)
                    elif c == "piece_offsets":
                        values.append(cuts)
                    elif c == "piece_ids":
                        values.append([*map(len, pieces)])
                    elif c == "decoded":
                        values.append(decoded)
                    elif c == "ids_sha256":
                        values.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                    else:
                        values.append(hashlib.sha256(decoded).hexdigest())
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(v, _COLUMNS[c][1]) for c, v in out.items())], names=["doc_id", *columns])

    schema = "doc_id long, " + ", ".join(f"{c} {_COLUMNS[c][0]}" for c in columns)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """Per row with doc_id and ids: doc_id, decoded (bytes); null ids decode to no bytes."""

    def run(iterator):
        codec = Codec(path)
        for batch in iterator:
            values = [codec.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.binary())], names=["doc_id", "decoded"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, decoded binary")
