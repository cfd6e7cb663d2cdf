"""The technical lexicon of the keyword filter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values, in their order: patterns that any one of which makes a text technical.
TERMS = [
    r"\bpython\b", r"\bjavascript\b", r"\btypescript\b", r"\bjava\b", r"\bc\+\+\b", r"\brust\b", r"\bgo\b", r"\bruby\b", r"\bswift\b", r"\bkotlin\b",
    r"\bsql\b", r"\bhtml\b", r"\bcss\b", r"\bbash\b", r"\bshell\b", r"\bphp\b", r"\bscala\b", r"\br\b(?=\s+(?:script|code|package))",
    r"\bgit\b", r"\bdocker\b", r"\bkubernetes\b", r"\blinux\b", r"\bapi\b", r"\brest\b", r"\bgraphql\b", r"\bhttp\b", r"\bdatabase\b", r"\bpostgres\b",
    r"\bmysql\b", r"\bmongodb\b", r"\bredis\b", r"\baws\b", r"\bazure\b", r"\bgcp\b", r"\bcloud\b", r"\bci/cd\b", r"\bterraform\b", r"\bansible\b",
    r"\bmachine\s+learning\b", r"\bdeep\s+learning\b", r"\bneural\s+net", r"\btransformer\b", r"\bpytorch\b", r"\btensorflow\b", r"\bnpm\b", r"\bpip\b",
    r"\bcargo\b", r"\byarn\b",
    r"```", r"\bdef\s+\w+\s*\(", r"\bfunction\s+\w+\s*\(", r"\bclass\s+\w+", r"\bimport\s+\w+", r"\berror\b.*\b(?:at|in|on)\b", r"(?:Error|Exception|Traceback)\b",
    r"\bstack\s*(?:trace|overflow)\b", r"\bdebug\b", r"\bcompile\b", r"\brun(?:time|ning)?\b", r"\bcommand\s+(?:line|not\s+found)\b",
]
ANY = "|".join(TERMS)
#: The same without look-ahead, for engines that lack it.
ANY_CONSUMING = ANY.replace("(?=", "(?:")


def _grouped() -> str:
    """The same alternatives with the common word boundary in front, and plain words by their first letter, which is quicker to match."""
    bounded = [t.removeprefix(r"\b") for t in TERMS if t.startswith(r"\b")]
    rest = [t for t in TERMS if not t.startswith(r"\b")]
    by_letter: dict[str, list[str]] = {}
    for t in bounded:
        by_letter.setdefault(t[0], []).append(t[1:])
    inside = "|".join(f"{first}(?:{'|'.join(ends)})" for first, ends in by_letter.items() if first.isalpha())
    other = [first + end for first, ends in by_letter.items() if not first.isalpha() for end in ends]
    return rf"\b(?:{'|'.join([inside, *other])})|" + "|".join(rest)


def is_technical(c: Column) -> Column:
    return c.rlike("(?iU)" + _grouped())
