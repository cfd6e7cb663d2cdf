"""Conversation repair: the cheapest edits that give each conversation the order (system) (user assistant)+.

A conversation's turns are edited by macro edits: a run of inserts and then what becomes of the turn (kept, given another
role, deleted).  Written out, no macro edit begins another, so that sequences of them compare like their codes, layer by
layer.  The dynamic programme walks the turns with four states (nothing yet, after the system turn, after a user, after an
assistant) and keeps, for each, the cost and the rank that its audit has among the states' audits, in place of the audit;
a pointer to the macro edit and the state before lets the audit be read back afterwards.

Rows are range-partitioned by conversation and turn and sorted, so a conversation may lie across tasks and none has to hold
it.  Runs of a bounded number of turns are segments.  A conversation that is one segment is solved where it is.  Of one in
several segments, each segment gives a table of costs and ranks for each state before and state behind; these small tables are folded in order,
which settles the states between segments, and then each segment writes its own edits.  What is left in order by contract,
the digest of the repaired text, reads the segments' texts as one sorted stream.

Defined results: null roles and texts are one blank, null conversations are one conversation, null turns come first; rows of equal turn
stay in the order in which they are read; repeated rows are rows of their own (the second is a duplicate); turns of any length and
number are read whole; two texts are the same if their SHA-256 is; other columns, whatever their names, are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, give_back, maybe_broadcast, numbered

#: Turns, and characters of text, of a segment at most (one turn may be longer).
SEGMENT_TURNS, SEGMENT_CHARS = 4096, 1 << 17
#: States: nothing yet, after the system turn, after a user's, after an assistant's.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: What each initial leads to from each state.
FOLLOW = {(EMPTY, "s"): SYSTEM, **{(k, "u"): USER for k in (EMPTY, SYSTEM, ASSISTANT)}, (USER, "a"): ASSISTANT}
NEXT = {EMPTY: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
ROLE = {"u": "user", "a": "assistant"}
FAULTS = ("blank", "duplicate", "truncated")
NEVER = 1 << 60
BLANKS, STOPS = r"[^\x20\x09-\x0D]", ".!?"


def inserts(state: int, n: int) -> int:
    for _ in range(n):
        state = FOLLOW[state, NEXT[state]]
    return state


#: Macro edits' codes in order; a run of over two inserts comes back to a state it had.
CODES = sorted("I" * n + what for n in range(3) for what in "DKR")


@functools.cache
def moves(initial: str, fault: str | None) -> tuple[tuple[int, int, int, int], ...]:
    """(state before, state behind, cost, place of the code) of each macro edit that a turn allows."""
    out = []
    for state, n in itertools.product(range(4), range(3)):
        at, late = inserts(state, n), int(fault == "truncated")
        out.append((state, at, 2 * n + 3, CODES.index("I" * n + "D")))
        if fault not in ("blank", "duplicate"):
            if (at, initial) in FOLLOW:
                out.append((state, FOLLOW[at, initial], 2 * n + late, CODES.index("I" * n + "K")))
            out.append((state, FOLLOW[at, NEXT[at]], 2 * n + 2 + late, CODES.index("I" * n + "R")))
    return tuple(out)


#: Inserts that bring each state to an end.
ENDING = {EMPTY: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
#: A state's tables: the cost of each state, and the rank of its audit among the others'.
Layer = tuple[list[int], list[int]]


def ranked(costs: list[int], keys: list[tuple]) -> Layer:
    """Keys in order become ranks."""
    place = {k: i for i, k in enumerate(sorted({k for k, c in zip(keys, costs) if c < NEVER}))}
    return costs, [place.get(k, 0) for k in keys]


def start(state: int) -> Layer:
    return [0 if k == state else NEVER for k in range(4)], [0] * 4


def step(layer: Layer, allowed: tuple, pointers: list | None = None) -> Layer:
    """One layer on: of each state's ways the cheapest, of these the one whose audit is least."""
    costs, ranks = layer
    best: list[tuple] = [(NEVER, 0, 0, 0)] * 4
    for before, behind, cost, code in allowed:
        if costs[before] < NEVER and (way := (costs[before] + cost, ranks[before], code, before)) < best[behind]:
            best[behind] = way
    if pointers is not None:
        pointers.append([(code, before) for _, _, code, before in best])
    return ranked([b[0] for b in best], [b[1:3] for b in best])


def folded(layer: Layer, tables: list[Layer], pointers: list) -> Layer:
    """A whole segment on: tables[k] are its costs and ranks from state k."""
    best: list[tuple] = [(NEVER, 0, 0, 0)] * 4
    for before, behind in itertools.product(range(4), range(4)):
        cost = layer[0][before] + tables[before][0][behind]
        if cost < NEVER and (way := (cost, layer[1][before], tables[before][1][behind], before)) < best[behind]:
            best[behind] = way
    pointers.append([b[3] for b in best])
    return ranked([b[0] for b in best], [b[1:3] for b in best])


def ending(layer: Layer) -> tuple[int, int]:
    """(state, cost) of the cheapest end, ties by the audit with its last inserts, which end before any other code goes on."""
    cost, _, _, state = min((layer[0][k] + 2 * n, layer[1][k], n, k) for k, n in ENDING.items())
    return state, cost


@dataclass
class Segment:
    """A run of a conversation's turns: roles, texts and each one's first fault."""

    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    faults: list[str | None] = field(default_factory=list)

    def allowed(self):
        return (moves(r[:1], f) for r, f in zip(self.roles, self.faults))

    def tables(self, states=range(4)) -> list[Layer]:
        out = []
        for state in states:
            layer = start(state)
            for allowed in self.allowed():
                layer = step(layer, allowed)
            out.append(layer)
        return out

    def edits(self, first: int, last: int | None) -> tuple[str, list[str], int]:
        """The audit, the repaired lines and the cost from a state before to a state behind; without one, to the best end."""
        pointers: list[list[tuple[int, int]]] = []
        layer = start(first)
        for allowed in self.allowed():
            layer = step(layer, allowed, pointers)
        state, cost = ending(layer) if last is None else (last, layer[0][last])
        end, codes = state, []
        for row in reversed(pointers):
            code, state = row[state]
            codes.append((CODES[code], state))
        audit, lines = [], []
        for (code, state), role, text in zip(reversed(codes), self.roles, self.texts):
            state = self.insert(lines, state, len(code) - 1)
            audit.append(code)
            if code[-1] != "D":
                lines.append(f"{role if code[-1] == 'K' else ROLE[NEXT[state]]}:{text}")
        if last is None:
            self.insert(lines, end, ENDING[end])
            audit.append("I" * ENDING[end])
        return "".join(audit), lines, cost

    @staticmethod
    def insert(lines: list[str], state: int, n: int) -> int:
        for _ in range(n):
            lines.append(f"{ROLE[NEXT[state]]}:")
            state = FOLLOW[state, NEXT[state]]
        return state


def digest(lines: list[str]) -> str:
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and order columns of the rows after damage: every twentieth row by its key's CRC-32 goes, and so on."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    what = F.crc32(key) % 20
    hurt = F.when(what == 1, "").when(what == 2, F.translate("text", STOPS, "")).otherwise(F.col("text"))
    plain = turns.withColumns({"role": F.coalesce("role", blank), "text": F.coalesce("text", blank), "_what": what}).where("_what <> 0")
    changed = plain.withColumns({"role": F.when(F.col("_what") == 4, "user").otherwise(F.col("role")), "text": hurt})
    return changed.withColumn("copy", F.explode(F.when(F.col("_what") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("_what")


def marked(rows: DataFrame, keys: list[str], order: Column, scratch: Scratch) -> DataFrame:
    """Adds ``fault``: the first of blank, duplicate and truncated that a row has, or null.

    A row is a duplicate if its conversation has its role and text earlier; only those that occur twice are joined back.
    """
    ends = F.when(~F.rlike("text", F.lit(BLANKS)), "blank").when(~F.rlike("text", F.lit(r"[.!?][\x20\x09-\x0D]*\z")), "truncated")
    keyed = rows.withColumns({"fault": ends, "_h": F.unhex(F.sha2("text", 256)), "_at": order})
    said = keyed.where("fault is null or fault <> 'blank'").groupBy(*keys, "role", "_h").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    twice = scratch.save(said.where("_n > 1").drop("_n"), "twice")
    joined = keyed.join(maybe_broadcast(twice), [*keys, "role", "_h"], "left")
    again = F.col("_at") > F.col("_first")
    return joined.withColumn("fault", F.when((F.col("fault") == "blank"), "blank").when(again, "duplicate").otherwise(F.col("fault"))).drop("_h", "_at", "_first")


_STATS = "n long, low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, head string, tail string"
_SOLVED = "cost long, audit string, repaired_sha256 string"
_PART = "roles array<string>, texts array<string>, faults array<string>, tables array<long>"
_SCHEMA = f"lost boolean, conv long, part int, seq long, {_STATS}, whole boolean, {_SOLVED}, {_PART}"


def segments(rows: DataFrame) -> DataFrame:
    """Of sorted rows (lost, conv, turn, role, text, fault) a row for each segment, solved where it is a whole conversation.

    A partition's first and last conversations may go on in others, so their segments aren't taken as whole.
    """

    def run(iterator):
        from pyspark import TaskContext

        give_back()
        part, seq = TaskContext.get().partitionId(), 0
        now, segment, stats, chars, opened = None, None, None, 0, False
        names = [c.split()[0] for c in _SCHEMA.split(", ")]
        kinds = {"boolean": pa.bool_(), "long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64())}

        def close(whole: bool) -> tuple:
            solved, payload = (None,) * 3, (None,) * 4
            if whole:
                audit, lines, cost = segment.edits(EMPTY, None)
                solved = (cost, audit, digest(lines))
            else:
                payload = (segment.roles, segment.texts, segment.faults, [x for costs, ranks in segment.tables() for x in (*costs, *ranks)])
            return (*now, part, seq, *stats.values(), whole, *solved, *payload)

        def rows_of(made: list[tuple]) -> pa.RecordBatch:
            columns = [*zip(*made)]
            return pa.RecordBatch.from_arrays([pa.array(c, kinds[k.split()[1]]) for c, k in zip(columns, _SCHEMA.split(", "))], names=names)

        for batch in iterator:
            made = []
            for lost, conv, turn, role, text, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if (lost, conv) != now:
                    if segment:
                        made.append(close(whole=not opened))
                    opened = now is None  # the partition's first conversation may have begun in another
                    now, segment = (lost, conv), None
                elif len(segment.roles) >= SEGMENT_TURNS or chars + len(text) > SEGMENT_CHARS:
                    opened = True
                    made.append(close(whole=False))
                    segment = None
                if segment is None:
                    segment, chars, seq, last = Segment(), 0, seq + 1, None
                    stats = {"n": 0, "low": None, "high": None, "turns": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "head": role[:1], "tail": ""}
                elif stats["tail"] + role[:1] not in ("su", "ua", "au"):
                    stats["illegal"] += 1
                stats["n"] += 1
                stats["tail"] = role[:1]
                if turn is not None:
                    stats["turns"] += turn != last
                    stats["low"] = turn if stats["low"] is None else stats["low"]
                    stats["high"] = last = turn
                if fault:
                    stats[fault] += 1
                segment.roles.append(role)
                segment.texts.append(text)
                segment.faults.append(fault)
                chars += len(text)
            if made:
                yield rows_of(made)
        if segment:
            yield rows_of([close(whole=False)])
        give_back()

    return rows.select("lost", "conv", "turn", "role", "text", "fault").mapInArrow(run, _SCHEMA)


def _settle(parts: DataFrame) -> DataFrame:
    """From the segments of divided conversations, sorted: each one's states before and behind, and the conversation's sums with its last.

    Holds four costs, ranks and pointers a segment of one conversation at a time, no text.
    """
    schema = "lost boolean, conv long, part int, seq long, first int, last int, closing boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"

    def run(iterator):
        now, made = None, []
        names = ["lost", "conv", "part", "seq", *[c.split()[0] for c in _STATS.split(", ")], "tables"]
        rows = (r for batch in iterator for r in zip(*(batch.column(c).to_pylist() for c in names)))
        for now, group in itertools.groupby(rows, key=lambda r: r[:2]):
            layer, pointers, places, sums = start(EMPTY), [], [], dict.fromkeys(("turns", *FAULTS, "illegal"), 0)
            low, high, tail = None, None, None
            for _, _, part, seq, _, lo, hi, turns, blank, duplicate, truncated, illegal, head, end, flat in group:
                tables = [(flat[8 * k : 8 * k + 4], flat[8 * k + 4 : 8 * k + 8]) for k in range(4)]
                layer = folded(layer, tables, pointers)
                places.append((part, seq))
                for name, x in zip(sums, (turns, blank, duplicate, truncated, illegal)):
                    sums[name] += x
                sums["illegal"] += tail is not None and tail + head not in ("su", "ua", "au")
                sums["turns"] -= lo is not None and lo == high  # a turn on either side of the cut
                low, high, tail = lo if low is None else low, high if hi is None else hi, end
            last, cost = ending(layer)
            gaps = 0 if low is None else high - low + 1 - sums["turns"]
            state, out = last, []
            for k in range(len(places) - 1, -1, -1):
                before = pointers[k][state]
                closing = k == len(places) - 1
                out.append((*now, *places[k], before, state, closing, *((gaps, *(sums[f] for f in (*FAULTS, "illegal")), cost) if closing else (None,) * 6)))
                state = before
            for a in range(0, len(out), 1000):
                yield pa.RecordBatch.from_pylist([dict(zip(target.names, r)) for r in out[a : a + 1000]], schema=target)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema))
    return parts.mapInArrow(run, schema)


def _written(settled: DataFrame) -> DataFrame:
    """Each segment's audit and repaired lines between its states."""

    def run(iterator):
        for batch in iterator:
            rows = batch.to_pydict()
            audits, lines = [], []
            for roles, texts, faults, first, last, closing in zip(*(rows[c] for c in ("roles", "texts", "faults", "first", "last", "closing"))):
                segment = Segment(roles, texts, faults)
                audit, own, _ = segment.edits(first, last)
                if closing:
                    segment.insert(own, last, ENDING[last])
                    audit += "I" * ENDING[last]
                audits.append(audit)
                lines.append("\n".join(own) if own else None)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("lost", "conv", "part", "seq")), pa.array(audits, pa.string()), pa.array(lines, pa.string())], names=["lost", "conv", "part", "seq", "audit", "lines"])

    return settled.mapInArrow(run, "lost boolean, conv long, part int, seq long, audit string, lines string")


def _hashed(written: DataFrame) -> DataFrame:
    """lost, conv, audit, repaired_sha256 from segments in order, one of them in memory at a time."""

    def run(iterator):
        rows = (r for batch in iterator for r in zip(*(batch.column(c).to_pylist() for c in ("lost", "conv", "audit", "lines"))))
        for (lost, conv), group in itertools.groupby(rows, key=lambda r: r[:2]):
            h, audits, begun = hashlib.sha256(), [], False
            for _, _, audit, lines in group:
                audits.append(audit)
                if lines is not None:
                    h.update(b"\n" * begun + lines.encode())
                    begun = True
            yield pa.RecordBatch.from_arrays([pa.array([lost]), pa.array([conv], pa.int64()), pa.array(["".join(audits)]), pa.array([h.hexdigest()])], names=["lost", "conv", "audit", "repaired_sha256"])

    return written.mapInArrow(run, "lost boolean, conv long, audit string, repaired_sha256 string")


_COUNTS = ["gaps", *FAULTS, "illegal", "cost"]


def repair(turns: DataFrame, hurt=None) -> DataFrame:
    """Per conversation of turns (conv_id, turn, role, text): gaps, the faults, cost, audit and repaired_sha256.

    ``hurt`` may change the rows first; it gets and returns conv_id, turn, role, text and a column that tells rows apart,
    and may add ``copy``, which orders the copies of a row.
    """
    scratch = Scratch(turns.sparkSession)
    plain = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    given, row = numbered(plain, scratch)
    given = given.withColumnRenamed(row, "place")
    blank = F.lit(" ")
    rows = hurt(given) if hurt else given
    rows = rows if "copy" in rows.columns else rows.withColumn("copy", F.lit(0))
    lost, conv = F.col("conv_id").isNull().alias("lost"), F.coalesce("conv_id", F.lit(0).cast("long")).alias("conv")
    rows = rows.select(lost, conv, "turn", "place", "copy", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"))
    faulty = marked(rows, ["lost", "conv"], F.struct("turn", "place", "copy"), scratch)
    order = ["lost", "conv", "turn", "place", "copy"]
    ranged = faulty.repartitionByRange(*order).sortWithinPartitions(*order)  # Spark puts nulls first
    cut = scratch.save(segments(ranged), "segments")
    solved = cut.where("whole").withColumn("gaps", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)))
    divided = cut.where("not whole")
    place = ["lost", "conv", "part", "seq"]
    tables = divided.drop("roles", "texts", "faults").repartition("lost", "conv").sortWithinPartitions(*place)
    settled = scratch.save(_settle(tables), "settled")
    written = scratch.save(_written(divided.select(*place, "roles", "texts", "faults").join(maybe_broadcast(settled.select(*place, "first", "last", "closing")), place)), "written")
    digests = _hashed(written.repartition("lost", "conv").sortWithinPartitions(*place))
    joined = settled.where("closing").join(digests, ["lost", "conv"])
    columns = ["lost", "conv", *_COUNTS, "audit", "repaired_sha256"]
    done = solved.select(columns).unionByName(joined.select(columns))
    every = given.select(lost, conv).distinct()
    out = every.join(done, ["lost", "conv"], "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in _COUNTS]
    nothing = F.lit(digest([]))
    return out.select(F.when(~F.col("lost"), F.col("conv")).alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
