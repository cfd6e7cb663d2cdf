"""Toxicity by a weighted finite-state pattern grammar.

Five small weighted transducers read a clause's tokens: *insult* and *threat* (what is hit, and how hard), *target* (a person
within four tokens on either side), *negation* (a scope of three tokens) and *reported speech* (to the end of the clause).
``compose`` builds the product of a hit's machine with the three others: an arc's weight is the product of theirs, so what
is scored is a hit on a path through its clause.  A directed insult has its full weight and a bare one a part of it; a
threat without a target has no accepting path.  A target may come after the hit, so the target machine also reads the clause
backwards and the composed arcs depend on both readings (a bimachine).  Clauses are read whole, whatever their length.

The insult lexicon is a seed list plus forms (whole words or word beginnings, so that inflected forms match) whose document
frequencies among labelled rows speak for the label; a form's log odds scale its arc.  A document's evidence is the sum
over its clauses, and the score is a logistic curve of it, fitted on the same labelled rows.  Fitting uses at most ``bound``
labelled rows, picked by a hash of their id; the lexicon and the fitted pairs are no larger than these rows' texts.

Defined results: null and empty texts have evidence 0 and so the lowest score; texts of any length are read whole; repeated
rows are scored alike; null ids are scored and never held out or fitted; an empty table gives an empty result, and without
labelled rows the seeds and a fixed curve remain; other columns of the input, whatever their names, are ignored.  Labels,
lang, source and doc_id are never inputs of a score.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches

#: Seed words of each class, in four languages.
INSULTS = "idiot idiots moron morons stupid scum trash loser losers pathetic worthless disgusting imbecile dumb vermin idiota imbécil estúpido idiote imbécile dummkopf abschaum trottel".split()
VIOLENCE = "kill murder shoot stab burn destroy hang beat strangle töten umbringen erschießen tuer égorger matar degollar".split()
TARGETS = "you your yours he him she her they them du dich dir euch ihr sie tu toi vous te ti usted ustedes vosotros".split()
NEGATIONS = "not no never nor isn't aren't wasn't don't nicht kein keine nie pas jamais nunca jamás tampoco".split()
REPORTS = "said says say called quoted wrote claimed alleged sagte schrieb nannte dit écrit appelé dijo escribió llamó".split()
FUTURES = "will gonna shall going werde wirst wird vais va vamos voy".split()

WORD, INSULT, VIOLENT, TARGET, NEGATION, REPORT, FUTURE = range(7)
KINDS = 7
CLAUSE_END = ".!?;\n"
STOP = re.compile("[.!?;\n]")
TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*")

#: Weights of arcs: of a hit without a target, with one, under negation, in reported speech, and of violence to come.
BARE, DIRECTED, NEGATED, REPORTED, ANNOUNCED = 0.6, 1.25, 0.4, 0.6, 2.0
#: What a violent word weighs; a learned form weighs its log odds.
VIOLENT_WEIGHT = 1.5
#: How many tokens a negation holds, how far off a target may be, and how far behind "will" a violent word.
NEGATION_SCOPE, TARGET_SCOPE, FUTURE_SCOPE = 3, 4, 3


@dataclass(frozen=True)
class Machine:
    """A weighted transducer over token classes: (state, class) -> (state, weight); class None stands for all others."""

    name: str
    arcs: dict = field(hash=False)

    def step(self, state: int, symbol: int) -> tuple[int, float]:
        return self.arcs.get((state, symbol)) or self.arcs[(state, None)]


def scope(name: str, opener: int, width: int, inside: float, outside: float = 1.0) -> Machine:
    """Weighs ``inside`` for the ``width`` tokens after an opener (0: to the clause's end) and ``outside`` elsewhere."""
    if not width:
        return Machine(name, {(0, None): (0, outside), (0, opener): (1, outside), (1, None): (1, inside)})
    arcs = {(0, None): (0, outside)}
    for left in range(width + 1):
        arcs[(left, opener)] = (width, inside if left else outside)
        if left:
            arcs[(left, None)] = (left - 1, inside)
    return Machine(name, arcs)


def hit(name: str, symbol: int) -> Machine:
    """Weighs 1 on the symbol and nothing on any other token, so only arcs that read the symbol are on a path that counts."""
    return Machine(name, {(0, None): (0, 0.0), (0, symbol): (0, 1.0)})


def threat() -> Machine:
    """A violent word weighs 1, and more if it was announced in the tokens before."""
    arcs = {(0, None): (0, 0.0), (0, VIOLENT): (0, 1.0), (0, FUTURE): (FUTURE_SCOPE, 0.0)}
    for left in range(1, FUTURE_SCOPE + 1):
        arcs |= {(left, None): (left - 1, 0.0), (left, VIOLENT): (left - 1, ANNOUNCED), (left, FUTURE): (FUTURE_SCOPE, 0.0)}
    return Machine(name="threat", arcs=arcs)


def compose(*machines: Machine) -> list[list[tuple[int, float]]]:
    """The product as a table: state -> class -> (state, product of all weights), with its start at 0."""
    start = (0,) * len(machines)
    number, table, todo = {start: 0}, [], [start]
    while todo:
        state = todo.pop(0)
        row = []
        for symbol in range(KINDS):
            steps = [m.step(s, symbol) for m, s in zip(machines, state)]
            target = tuple(s for s, _ in steps)
            if target not in number:
                number[target] = len(number)
                todo.append(target)
            row.append((number[target], math.prod(w for _, w in steps)))
        table.append(row)
    return table


_NEGATION, _REPORTED = scope("negation", NEGATION, NEGATION_SCOPE, NEGATED), scope("report", REPORT, 0, REPORTED)
#: Where a target is seen behind, from ahead of the hit or from after it: 1, else 0.
_AHEAD = compose(scope("target", TARGET, TARGET_SCOPE, 1.0, 0.0))
#: By kind of hit, the composed machine if a target is near and if none is.
GRAMMAR = {
    INSULT: [compose(hit("insult", INSULT), scope("target", TARGET, 0, w, w), _NEGATION, _REPORTED) for w in (BARE, DIRECTED)],
    VIOLENT: [compose(threat(), scope("target", TARGET, 0, w, w), _NEGATION, _REPORTED) for w in (0.0, 1.0)],
}


@dataclass
class Lexicon:
    """Word and beginning-of-word arcs of the insult transducer with their weights, and the curve of the score."""

    words: dict[str, float]
    beginnings: dict[str, float]
    #: The score is logistic(slope * evidence - offset).
    offset: float = 4.0
    slope: float = 1.6

    def __post_init__(self):
        self.classes = {w: c for c, ws in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (FUTURE, FUTURES), (VIOLENT, VIOLENCE)) for w in ws}
        self.longest = max(map(len, self.beginnings), default=0)
        self.shortest = min(map(len, self.beginnings), default=1)

    def read(self, token: str) -> tuple[int, float]:
        if token in self.words:
            return INSULT, self.words[token]
        for n in range(min(self.longest, len(token)), self.shortest - 1, -1):
            if token[:n] in self.beginnings:
                return INSULT, self.beginnings[token[:n]]
        return self.classes.get(token, WORD), VIOLENT_WEIGHT

    def scanner(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for form in {*self.words, *self.beginnings, *VIOLENCE}:
            found.add_word(form, len(form))
        found.make_automaton()
        return found

    def probability(self, evidence: float) -> float:
        return 1 / (1 + math.exp(min(700.0, max(-700.0, self.offset - self.slope * evidence))))


def near_targets(kinds: list[int]) -> list[bool]:
    """Whether a target is within reach of each token, by the target machine read in both directions."""
    near = []
    for order in (range(len(kinds)), range(len(kinds) - 1, -1, -1)):
        state, seen = 0, [False] * len(kinds)
        for i in order:
            state, weight = _AHEAD[state][kinds[i]]
            seen[i] = weight > 0
        near.append(seen)
    return [a or b for a, b in zip(*near)]


def clause_weight(tokens: list[str], lexicon: Lexicon) -> float:
    """The evidence of one clause: what its insults and threats weigh on their paths."""
    read = [lexicon.read(t) for t in tokens]
    kinds = [k for k, _ in read]
    near, total = near_targets(kinds), 0.0
    for machines in GRAMMAR.values():  # the two differ in weights alone, so their states are the same
        state = 0
        for i, (kind, weight) in enumerate(read):
            after, arc = machines[near[i]][state][kind]
            total += arc * weight
            state = after
    return total


def evidence(text: str, lexicon: Lexicon, found: ahocorasick.Automaton) -> float:
    """The sum over clauses with an insult or violence; the automaton only finds where such clauses are."""
    low = text.lower()
    total, done = 0.0, 0
    for end, length in found.iter(low):
        start = end - length + 1
        if start < done or start and (low[start - 1].isalpha() or low[start - 1] == "'"):
            continue
        begin = max(max(low.rfind(c, done, start) for c in CLAUSE_END) + 1, done)
        stop = m.start() if (m := STOP.search(low, end + 1)) else len(low)
        total += clause_weight(TOKEN.findall(low[begin:stop]), lexicon)
        done = stop
    return total


#: Word beginnings are tried from this length on; in the first pass so many lengths, then, while any is frequent, as many more.
LEAST_BEGINNING, LENGTHS = 4, 13


def fit(docs: DataFrame, labels: DataFrame, bound: int = 20_000, least_documents: int = 5, least_odds: float = 4.0) -> Lexicon:
    """Learn the insult forms and the curve from at most ``bound`` rows of labels (doc_id, toxic), picked by a hash of their id.

    A word is kept if it occurs in ``least_documents`` toxic documents and its log odds reach ``least_odds``; a beginning
    needs 3 documents and 0.8 more, and 3 words that begin so.  Texts that repeat among the rows count once.
    """
    picked = (
        labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    )
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(picked), "doc_id").where("text is not null")  # at most ``bound`` rows of ids
    rows = rows.groupBy(F.xxhash64("text").alias("same")).agg(F.max("toxic").alias("toxic"), F.first("text").alias("text"))
    seen = rows.select("toxic", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+(?:'\p{L}+)*"), F.lit(0)))).alias("form"))
    words = seen.groupBy("form").agg(F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg"))
    sizes = rows.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    toxic = sizes[0] or 0
    clean = (sizes[1] or 0) - toxic
    odds = F.log((F.col("pos") + 0.5) / (toxic + 1)) - F.log((F.col("neg") + 0.5) / (clean + 1))
    best = words.withColumn("odds", odds).where((F.col("pos") >= least_documents) & (F.col("odds") >= least_odds) | F.col("form").isin(INSULTS) & (F.col("pos") + F.col("neg") >= 2 * least_documents))
    lexicon = {w: 3.0 for w in INSULTS}
    for r in best.collect():
        weight = max(0.0, min(6.0, r["odds"])) if r["form"] in INSULTS else min(9.0, r["odds"])
        lexicon[r["form"]] = weight

    beginnings: dict[str, float] = {}
    first, among = LEAST_BEGINNING, words.where(f"length(form) >= {LEAST_BEGINNING} and pos + neg > 0")
    while True:
        last = first + LENGTHS - 1
        each = among.select(F.explode(F.sequence(F.lit(first), F.least(F.lit(last), F.length("form")))).alias("n"), "form", "pos", "neg")
        starts = each.groupBy(F.expr("substring(form, 1, n)").alias("form")).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.count(F.lit(1)).alias("kinds"))
        starts = starts.withColumn("odds", odds).where((F.col("pos") >= least_documents + 3) & (F.col("kinds") >= 3) & ((F.col("odds") >= least_odds + 0.8) | (F.length("form") == last)))
        longest = []
        for r in sorted(starts.collect(), key=lambda r: len(r["form"])):
            if any(r["form"][:n] in beginnings for n in range(LEAST_BEGINNING, len(r["form"]))):
                continue
            if r["odds"] >= least_odds + 0.8:
                beginnings[r["form"]] = min(9.0, r["odds"])
            else:
                longest.append(r["form"])
        if not longest:  # no longer beginning is frequent
            break
        first = last + 1
        among = among.where(F.substring("form", 1, last).isin(longest) & (F.length("form") >= first))
    return curve(rows, Lexicon(lexicon, beginnings))


def curve(rows: DataFrame, lexicon: Lexicon, rounds: int = 25, pull: float = 2.0) -> Lexicon:
    """The lexicon with offset and slope fitted to rows (toxic, text) by logistic regression, pulled to the fixed ones."""
    pairs = _run(rows.select(F.col("toxic").cast("long").alias("doc_id"), "text"), lexicon).select("doc_id", "evidence").collect()  # the sample's rows
    if not pairs:
        return lexicon
    y, x = (np.array(v, float) for v in zip(*((r[0], r[1]) for r in pairs)))
    design, prior = np.stack([-np.ones(len(x)), np.minimum(x, 200.0)], axis=1), np.array([lexicon.offset, lexicon.slope])
    w = prior.copy()
    for _ in range(rounds):  # Newton's steps
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (y - p) - pull * (w - prior)
        w = w + np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + pull * np.eye(2), gradient)
    offset, slope = max(float(w[0]), 0.5), max(float(w[1]), 0.1)  # no evidence never means toxic, more never means less so
    return Lexicon(lexicon.words, lexicon.beginnings, offset, slope)


def _run(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, evidence, score, predicted (score >= 0.5)."""
    parts = (lexicon.words, lexicon.beginnings, lexicon.offset, lexicon.slope)

    def run(iterator):
        lex = Lexicon(*parts)
        found = lex.scanner()
        for part, texts in batches(iterator):
            weights = [evidence(t, lex, found) if t else 0.0 for t in texts]
            scores = [lex.probability(w) for w in weights]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(weights, pa.float64()), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())],
                names=["doc_id", "evidence", "score", "predicted"],
            )

    return docs.mapInArrow(run, "doc_id long, evidence double, score double, predicted int")


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, evidence (double), score (0 to 1), predicted (score >= 0.5)."""
    return _run(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), lexicon)


def clean_rows(docs: DataFrame, lexicon: Lexicon, least: float = 0.5) -> DataFrame:
    """The rows of docs, all columns, whose score is below ``least``."""
    parts = (lexicon.words, lexicon.beginnings, lexicon.offset, lexicon.slope)
    text_at = docs.columns.index("text")

    def run(iterator):
        lex = Lexicon(*parts)
        found = lex.scanner()
        for part, texts in batches(iterator, text_at=text_at):
            yield part.filter(pa.array([not t or lex.probability(evidence(t, lex, found)) < least for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, bound: int = 20_000) -> DataFrame:
    """Fit on labelled rows outside the held-out fold and score every row: doc_id, held_out, score, predicted, evidence."""
    lexicon = fit(docs, labels.select("doc_id", "toxic").where(~held_out()), bound)
    return score(docs, lexicon).select("doc_id", held_out().alias("held_out"), "score", "predicted", "evidence")
