"""Which texts of a batch need work to be in normal form, by classes of their codepoints; only those go one by one."""

from __future__ import annotations

import functools
import unicodedata

import numpy as np

#: Classes: to be stripped, part of a composition, an entity's begin, a blank other than the plain one, a blank, a line feed.
STRIP, COMPOSE, ENTITY, ODD_BLANK, BLANK, LINE = (1 << k for k in range(6))


@functools.cache
def classes() -> np.ndarray:
    out = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        if unicodedata.category(chr(c))[0] == "C":
            out[c] = STRIP
    for c in (9, 10):
        out[c] = 0
    # What canonical forms touch: characters that decompose or have a combining class, those second in a decomposition, Hangul's parts.
    second = set()
    for c in range(0x30000):
        parts = unicodedata.decomposition(chr(c))
        if parts and not parts.startswith("<"):
            if unicodedata.normalize("NFC", chr(c)) != chr(c):
                out[c] |= COMPOSE
            second.update(int(p, 16) for p in parts.split()[1:])
        if unicodedata.combining(chr(c)):
            out[c] |= COMPOSE
    out[[*second, *range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]] |= COMPOSE
    for c in range(0x3001):
        if chr(c).isspace() and c != 10:
            out[c] |= BLANK | (ODD_BLANK if c != 32 else 0)
    out[10] |= LINE
    out[ord("&")] |= ENTITY
    return out


def needing(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(texts that have to be stripped, composed or unescaped; of the others, those whose white space has to change)."""
    n = len(texts)
    lengths = np.fromiter(map(len, texts), np.int64, n)
    # The line feed behind each text parts it from the next and belongs to neither.
    points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = classes()[points]
    stops = np.cumsum(lengths + 1) - 1
    starts = stops - lengths
    deep = np.bitwise_or.reduceat(kinds, starts) & (STRIP | COMPOSE | ENTITY) if n else np.zeros(0, np.uint8)
    blank, line = (kinds & BLANK) > 0, (kinds & LINE) > 0
    line[stops] = False
    white = blank | line
    marks = (kinds & ODD_BLANK) > 0
    marks[:-1] |= blank[:-1] & blank[1:]
    marks[:-2] |= line[:-2] & line[1:-1] & line[2:]
    filled = lengths > 0
    marks[starts[filled]] |= white[starts[filled]]
    marks[stops[filled] - 1] |= white[stops[filled] - 1]
    light = np.logical_or.reduceat(marks, starts) if n else np.zeros(0, bool)
    return deep > 0, light & (deep == 0)
