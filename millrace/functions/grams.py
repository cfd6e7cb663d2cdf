"""Word n-grams of whole batches as rolled hashes, and an index of them that is looked up by binary search.

Texts of a batch are one array of codepoints.  A class array finds the words, each word is hashed once, and an n-gram's hash
is the difference of two prefix sums of a polynomial in the words' hashes, so no gram is built.  A bitmap lets most
grams go, the sorted index decides on the rest, and those that it holds are compared as strings.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import pyarrow as pa

#: Odd multipliers of the polynomials, in 64 bits, and of the mixing function.
_WORD, _GRAM, _STIR = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD))


@functools.cache
def word_signs() -> np.ndarray:
    """Which codepoints are part of a word: letters, numbers and the underscore."""
    out = np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)
    out[ord("_")] = True
    return out


def stirred(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _STIR
    return h ^ (h >> np.uint64(29))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Words:
    """The lower-cased words of some texts: where each begins and ends, its hash, and the first word of each text (with the end)."""

    def __init__(self, texts: list[str | None]):
        low = [(t or "").lower() for t in texts]
        self.joined = "\n".join(low)
        points = np.frombuffer(self.joined.encode("utf-32-le", "surrogatepass"), "<u4")
        inside = np.concatenate([[False], word_signs()[points], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.begins, self.ends = edges[::2], edges[1::2]
        firsts = np.concatenate([[0], np.cumsum(np.fromiter((len(t) + 1 for t in low), np.int64, len(low)))])
        self.bounds = np.searchsorted(self.begins, firsts)
        self.hashes = self._hashes(points)

    def _hashes(self, points: np.ndarray) -> np.ndarray:
        sizes = self.ends - self.begins
        if not len(sizes):
            return np.zeros(0, np.uint64)
        at = np.repeat(self.begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())  # the words' signs
        place = at - np.repeat(self.begins, sizes)
        weighed = stirred(points[at].astype(np.uint64) + np.uint64(1)) * powers(_WORD, int(sizes.max()))[place]
        return stirred(np.add.reduceat(weighed, np.cumsum(sizes) - sizes) + sizes.astype(np.uint64))

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, first word, number of words) of every n-gram; a text of fewer words than n is one gram, one of none has none."""
        count, total = np.diff(self.bounds), len(self.hashes)
        first = np.arange(total)
        whole = np.repeat(self.bounds[1:], count) - first  # words from here to the text's end
        long = np.repeat(count, count) >= n
        starts = np.sort(np.concatenate([first[long & (whole >= n)], self.bounds[:-1][(count > 0) & (count < n)]]))
        sizes = np.where(long[starts], n, whole[starts]) if len(starts) else np.zeros(0, np.int64)
        forth, back = powers(_GRAM, total), powers(np.uint64(pow(int(_GRAM), -1, 1 << 64)), total)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.hashes * forth, dtype=np.uint64)])
        return stirred((sums[starts + sizes] - sums[starts]) * back[starts] + sizes.astype(np.uint64)), starts, sizes

    def gram(self, first: int, size: int) -> str:
        return " ".join(self.joined[a:b] for a, b in zip(self.begins[first : first + size], self.ends[first : first + size]))


def gram_strings(texts: list[str | None], n: int) -> list[str]:
    """The distinct grams of all texts."""
    words = Words(texts)
    _, starts, sizes = words.grams(n)
    return [*{words.gram(a, s) for a, s in zip(starts.tolist(), sizes.tolist())}]


class GramIndex:
    """Gram strings in order of their hashes."""

    def __init__(self, strings: list[str], n: int):
        self.n = n
        hashes = self.hash(strings)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.strings = hashes[order], pa.array(strings, pa.large_string()).take(pa.array(order))
        self.shift = np.uint64(64 - max(10, min(26, (16 * len(strings)).bit_length())))
        self.seen = np.zeros(1 << (64 - int(self.shift)), bool)
        self.seen[self.hashes >> self.shift] = True

    @staticmethod
    def hash(strings: list[str]) -> np.ndarray:
        """Hashes of grams that are given as strings, whatever their numbers of words."""
        words = Words(strings)
        return words.grams(1 << 40)[0]

    def holds(self, gram: str, h: np.uint64) -> bool:
        a, b = np.searchsorted(self.hashes, h, "left"), np.searchsorted(self.hashes, h, "right")
        return any(self.strings[int(k)].as_py() == gram for k in range(a, b))

    def overlaps(self, texts: list[str | None]) -> np.ndarray:
        """For each text, how many distinct grams of it the index holds."""
        words = Words(texts)
        hashes, starts, sizes = words.grams(self.n)
        maybe = np.flatnonzero(self.seen[hashes >> self.shift])
        if len(maybe) and len(self.hashes):
            near = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
            maybe = maybe[self.hashes[near] == hashes[maybe]]
        found: list[set] = [set() for _ in texts]
        text = np.searchsorted(words.bounds, starts[maybe], "right") - 1
        for k, t in zip(maybe.tolist(), text.tolist()):
            if (gram := words.gram(starts[k], sizes[k])) not in found[t] and self.holds(gram, hashes[k]):
                found[t].add(gram)
        return np.fromiter(map(len, found), np.int64, len(found))

    def series(self, texts: pd.Series) -> pd.Series:
        """The same for a batch, in slices of bounded size."""
        values, out, at = [*texts], [], 0
        while at < len(values):
            stop, size = at, 0
            while stop < len(values) and (stop == at or size + len(values[stop] or "") <= 1 << 20):
                size += len(values[stop] or "")
                stop += 1
            out.append(self.overlaps(values[at:stop]))
            at = stop
        return pd.Series(np.concatenate(out) if out else np.zeros(0, np.int64))
