"""Quality rules: per-document statistics, base rules, and robust multivariate outliers.

Statistic vectors of rows that pass the base rules are transformed and, for each language and source, described by a
minimum-covariance-determinant estimate.  Three starts that depend on the data alone (medians and scaled quartiles, the
classical estimate, and the correlations of squashed values) take two concentration steps each: the share ``core`` of rows
with the least distances gives mean and covariance anew.  Of each group the start with the least determinant goes on until no
determinant falls any more.  Rows whose squared distance exceeds ``cutoff`` are rejected.

A step is two aggregations over all rows, so no group is gathered and a hot source costs no more than its rows.
Transformed values are integers on a grid and distances are counted on one, so sums, order statistics and verdicts are
the same in every run, however rows are dealt out.

Shares are smoothed by a few units that every text is thought to have, so that short texts don't stand out by chance, and
the average sampling variance of a group's documents is added to its covariance: what chance alone does is no outlier, and a
statistic that is constant in the core (no symbols, no repeated lines) has a scale.  A group's estimate is weighted by its
rows against ``weight`` rows of its language's, and that one likewise against the estimate over all; small groups so
lean on larger ones without a switch.

Defined results: a null text has no words and fails the base rules, as do empty ones; texts of any length are read whole;
null lang or source is a value of its own; repeated rows and ties get equal verdicts; null ids are judged as others are;
columns of other names are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, batches

#: Characters counted as symbols; a fixed value.
SYMBOLS = b"#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
WINDOW = 5


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 5-word window which occurs twice or more in the text."""
    n = len(words)
    if n <= WINDOW:
        return 0
    codes: dict[bytes, int] = {}
    c = np.fromiter([codes.setdefault(w, len(codes)) for w in words], np.int64, n)
    if len(codes) == n:
        return 0
    base, limit = len(codes), 1
    key = np.zeros(n - WINDOW + 1, np.int64)
    for i in range(WINDOW):
        if limit > 2**62 // base:  # renumber before the key would overflow
            _, key = np.unique(key, return_inverse=True)
            limit = n
        key = key * base + c[i : i + n - WINDOW + 1]
        limit *= base
    order = np.sort(key)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    hit = np.isin(key, twice)
    covered = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(hit)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + WINDOW, -1)
    return int((np.cumsum(covered)[:n] > 0).sum())


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper, base_failed."""
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper"]

    def run(iterator):
        for part, texts in batches(iterator, text_at=3, binary=True):
            rows = []
            for t in texts:
                words = t.split()  # bytes split at exactly the six blanks
                chars = sum(map(len, words)) - len(t.translate(None, bytes(set(range(256)) - set(range(0x80, 0xC0)))))
                lines = [x for x in t.split(b"\n") if x.strip()]
                rows.append((
                    len(words), chars, len(t) - len(t.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words), len(lines),
                    len(t) - len(t.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
                ))
            columns = [*zip(*rows)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), *(pa.array(c, pa.int64()) for c in columns)], names=["doc_id", "lang", "source", *fields])

    schema = "doc_id long, lang string, source string, " + ", ".join(f"{f} long" for f in fields)
    strings = [F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")]
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *strings).mapInArrow(run, schema)
    return counted.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


#: Transformed values are kept as integers in this many parts of one.
GRID = 512

#: Transformed statistics, and how many independent units a share is of (its sampling variance is a fourth of their inverse);
#: repeats come in runs of about two windows and symbols in runs of three.  Logarithms have fixed least deviations instead.
TRANSFORMS = {
    "log_words": ("log(n_words + 1.0)", 0.05),
    "word_length": ("log((word_chars + 200.0) / (n_words + 40.0))", 0.02),
    "symbols": ("sqrt(n_symbols / (word_chars + 100.0))", "(word_chars + 100.0) / 3"),
    "dup_lines": ("sqrt(n_dup_lines / (n_lines + 10.0))", "n_lines + 10.0"),
    "repeats": ("sqrt(n_repeat_words / (n_words + 50.0))", "(n_words + 50.0) / 10"),
    "upper": ("sqrt(n_upper / (word_chars + 100.0))", "word_chars + 100.0"),
}
_P = len(TRANSFORMS)
_PAIRS = [(i, j) for i in range(_P) for j in range(i, _P)]
_SHARES = [i for i, (_, units) in enumerate(TRANSFORMS.values()) if isinstance(units, str)]
#: Sampling variances are summed as integers in this many parts of one.
_FINE = 1 << 24

#: By how much the covariance of the nearest 0.75 of normal rows in six dimensions is too small (0.75 over the share of
#: chi-squared with 8 degrees of freedom below the 0.75 quantile of that with 6).
CONSISTENCY = 1.362
#: Chi-squared with 6 degrees of freedom, the quantile 1 - 1e-7: a cutoff for rows that are no error.
CUTOFF_6 = 44.0
#: Distances are counted by log(1 + d2) in this many parts of one.
STEPS_OF_ONE = 1024
#: Groups whose estimates (about 1,200 bytes each) are broadcast at most; beyond that rows are joined to them by salted keys.
GROUPS = 20_000
KEYS = ["lv", "g1", "g2"]


def _moments(values: list) -> list:
    """Sums of the values and of their products, as exact integers."""
    return [
        F.count(F.lit(1)).alias("n"), F.array(*(F.sum(v) for v in values)).alias("s"), F.array(*(F.sum(values[i] * values[j]) for i, j in _PAIRS)).alias("p"),
    ]


def _covariance(n, s, p) -> tuple[np.ndarray, np.ndarray]:
    mean = np.asarray(s, float) / n
    cov = np.zeros((_P, _P))
    for (i, j), v in zip(_PAIRS, np.asarray(p, float) / n):
        cov[i, j] = cov[j, i] = v - mean[i] * mean[j]
    return mean, cov


def _estimate(mean, cov, floor) -> tuple:
    cov = cov + np.diag(floor)
    return [*map(float, mean)], np.linalg.inv(cov).ravel().tolist(), float(np.linalg.slogdet(cov)[1])


def _solve(n, s, p, floor):
    import pandas as pd

    rows = [_estimate(*_covariance(*of), np.asarray(f)) for *of, f in zip(n, s, p, floor)]
    return pd.DataFrame(rows, columns=["mean", "inverse", "logdet"])


def _starts(n, s, p, sz, pz, middle, scale, floor):
    import pandas as pd

    out = []
    for n1, s1, p1, s2, p2, m, c, f in zip(n, s, p, sz, pz, middle, scale, floor):
        m, c, f = (np.asarray(v, float) for v in (m, c, f))
        squashed = _covariance(n1, s2, p2)[1] / GRID**2 * np.outer(c, c)
        three = [_estimate(m, np.diag(c**2 - f), f), _estimate(*_covariance(n1, s1, p1), f), _estimate(m, squashed, f)]
        out.append([dict(zip(("mean", "inverse", "logdet"), e)) for e in three])
    return pd.Series(out)


def _blend(n0, s0, p0, f0, n1, s1, p1, f1, n2, s2, p2, f2, weight):
    """Estimates of groups from the sums of all rows' cores, their languages' and their own."""
    import pandas as pd

    out = []
    for *of, w in zip(n0, s0, p0, f0, n1, s1, p1, f1, n2, s2, p2, f2, weight):
        mean = cov = None
        for k in range(0, 12, 4):
            n, m, f = of[k], *(_covariance(of[k], of[k + 1], of[k + 2]), of[k + 3])
            own = m[0], m[1] * CONSISTENCY + np.diag(np.asarray(f, float))
            share = 1.0 if mean is None else n / (n + w)
            mean, cov = own if mean is None else (share * own[0] + (1 - share) * mean, share * own[1] + (1 - share) * cov)
        out.append((mean.tolist(), np.linalg.inv(cov).ravel().tolist()))
    return pd.DataFrame(out, columns=["mean", "inverse"])


def _distance() -> F.Column:
    d = [F.col(f"x{i}") - F.col("mean")[i] for i in range(_P)]
    total = F.lit(0.0)
    for i, j in _PAIRS:
        total = total + d[i] * d[j] * F.col("inverse")[i * _P + j] * F.lit(1.0 if i == j else 2.0)
    return F.greatest(total, F.lit(0.0))


def _at_shares(counts: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Order statistics by keys from counts (keys, value, c): the least value at or below which are the shares.

    A window runs over the values of a grid, of which there are a bounded number, not over rows.
    """
    over = Window.partitionBy(*keys)
    ranked = counts.withColumns({"upto": F.sum("c").over(over.orderBy(value)), "total": F.sum("c").over(over)})
    return ranked.groupBy(*keys).agg(*(F.min(F.when(F.col("upto") >= F.col("total") * F.lit(share), F.col(value))).alias(n) for n, share in shares.items()))


def _beside(rows: DataFrame, estimates: DataFrame, keys: list[str], groups: int, n_rows: int) -> DataFrame:
    """Rows with the estimates of their group, of which there are ``groups``: broadcast if few, else joined by salted keys, as a group may be hot."""
    if groups <= GROUPS:
        return rows.join(F.broadcast(estimates), keys)
    salts = max(32, n_rows // 1_000_000)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*(f"x{i}" for i in range(_P))), F.lit(salts)))
    return salted.join(estimates.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))), [*keys, "salt"]).drop("salt")


def _cores(scratch: Scratch, rows: DataFrame, n_rows: int, core: float) -> DataFrame:
    """Per group of rows (KEYS, x0.., e..): lv, g1, g2, rows_n, floor, and n, s, p of the settled core of least determinant."""
    solve = F.pandas_udf(_solve, "mean array<double>, inverse array<double>, logdet double")
    starts = F.pandas_udf(_starts, "array<struct<mean:array<double>,inverse:array<double>,logdet:double>>")
    xs = [F.col(f"x{i}") for i in range(_P)]
    fixed = [(float(u) * GRID) ** 2 if i not in _SHARES else None for i, (_, u) in enumerate(TRANSFORMS.values())]
    floor = F.array(*(F.lit(f) if f is not None else F.col(f"e{i}") * F.lit(GRID**2 / _FINE) / F.col("n") for i, f in enumerate(fixed)))
    whole = rows.groupBy(*KEYS).agg(*_moments(xs), *(F.sum(f"e{i}").alias(f"e{i}") for i in _SHARES)).withColumn("floor", floor)
    each = rows.select(*KEYS, F.explode(F.array(*(F.struct(F.lit(i).alias("dim"), x.alias("v")) for i, x in enumerate(xs)))).alias("d")).select(*KEYS, "d.dim", "d.v")
    places = _at_shares(each.groupBy(*KEYS, "dim", "v").agg(F.count(F.lit(1)).alias("c")), [*KEYS, "dim"], "v", {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    places = places.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("dim", "q1", "q2", "q3"))).alias("q"))  # six entries
    whole = whole.join(places, KEYS).withColumn("middle", F.transform("q", lambda q: q["q2"].cast("double")))
    whole = whole.withColumn("scale", F.zip_with("q", "floor", lambda q, f: F.greatest((q["q3"] - q["q1"]) / F.lit(1.349), F.sqrt(f)))).drop("q")
    whole = scratch.save(whole, "whole")
    groups, rows = whole.count(), rows.select(*KEYS, *xs)
    beside = lambda table, keys=KEYS: _beside(rows, table, keys, groups, n_rows)

    near = beside(whole.select(*KEYS, "middle", "scale"))
    squashed = [F.round(F.tanh((x - F.col("middle")[i]) / F.col("scale")[i]) * GRID).cast("long") for i, x in enumerate(xs)]
    sums = near.select(*KEYS, *(z.alias(f"z{i}") for i, z in enumerate(squashed))).groupBy(*KEYS).agg(*_moments([F.col(f"z{i}") for i in range(_P)]))
    begun = whole.join(sums.select(*KEYS, F.col("s").alias("sz"), F.col("p").alias("pz")), KEYS)
    begun = begun.select(*KEYS, "floor", F.posexplode(starts("n", "s", "p", "sz", "pz", "middle", "scale", "floor")).alias("start", "e")).select(*KEYS, "floor", "start", "e.*")
    now, turn, last = scratch.save(begun, "now-0"), 0, None
    by = [*KEYS, "start"]
    while True:
        turn += 1
        place = F.floor(F.log1p(_distance()) * STEPS_OF_ONE)
        counts = beside(now.select(*by, "mean", "inverse")).select(*by, place.alias("at")).groupBy(*by, "at").agg(F.count(F.lit(1)).alias("c"))
        cut = now.select(*by, "mean", "inverse").join(_at_shares(counts, by, "at", {"cut": core}), by)
        found = beside(cut).where(place <= F.col("cut")).groupBy(*by).agg(*_moments(xs)).join(now.select(*by, "floor"), by)
        found = found.withColumn("e", solve("n", "s", "p", "floor")).select(*by, "n", "s", "p", "floor", "e.*")
        if turn == 2:  # of each group the best start goes on
            found = found.groupBy(*KEYS).agg(F.min_by(F.struct("start", "n", "s", "p", "floor", "mean", "inverse", "logdet"), F.struct(F.round("logdet", 9), "start")).alias("b")).select(*KEYS, "b.*")
        before, now = now, scratch.save(found, f"now-{turn}")
        if turn < 2:
            continue
        total = now.agg(F.sum(F.round(F.col("logdet") * 1e9).cast("decimal(28,0)"))).first()[0]  # exact, so the same in every run
        if total is None or last is not None and total >= last:
            break
        last = total
    best = before if turn > 2 else now
    return best.join(whole.select(*KEYS, F.col("n").alias("rows_n")), KEYS).select(*KEYS, "rows_n", "n", "s", "p", "floor")


def verdicts(docs: DataFrame, core: float = 0.75, weight: int = 60, cutoff: float = CUTOFF_6) -> DataFrame:
    """Per row: doc_id, the statistics, base_failed, distance (squared; null if base_failed) and kept."""
    scratch = Scratch(docs.sparkSession)
    counted = statistics(docs).select("*", *(F.round(F.expr(e) * GRID).cast("long").alias(f"x{i}") for i, (e, _) in enumerate(TRANSFORMS.values())))
    own = {"g1": F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-")), "g2": F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))}
    counted = scratch.save(counted.withColumns(own), "counted")
    units = [u for _, u in TRANSFORMS.values()]
    passed = counted.where("not base_failed").withColumns({f"e{i}": F.round(F.lit(_FINE / 4) / F.expr(units[i])).cast("long") for i in _SHARES})
    level = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("lv")
    rows = passed.select(level, "g1", "g2", *(f"x{i}" for i in range(_P)), *(f"e{i}" for i in _SHARES))
    rows = rows.withColumns({"g1": F.when(F.col("lv") >= 1, F.col("g1")).otherwise(""), "g2": F.when(F.col("lv") >= 2, F.col("g2")).otherwise("")})
    n_rows = 3 * passed.count()
    cores = scratch.save(_cores(scratch, rows, n_rows, core), "cores")
    at = lambda lv, *keys: cores.where(f"lv = {lv}").select(*keys, *(F.col(c).alias(f"{c}{lv}") for c in ("rows_n", "n", "s", "p", "floor")))
    joined = at(2, "g1", "g2").join(F.broadcast(at(0)), F.lit(True)).join(at(1, "g1"), "g1")  # the row over all, and one a language
    # The weight of an estimate is that of its group's rows; its moments are those of its core.
    blend = F.pandas_udf(_blend, "mean array<double>, inverse array<double>")
    blended = joined.withColumn("e", blend(*(f"{c}{lv}" for lv in range(3) for c in ("n", "s", "p", "floor")), F.lit(weight * core)))
    estimates = scratch.save(blended.select("g1", "g2", "e.mean", "e.inverse"), "estimates")
    out = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    scored = _beside(passed.select(*out, "g1", "g2", *(f"x{i}" for i in range(_P))), estimates, ["g1", "g2"], estimates.count(), n_rows).withColumn("distance", _distance())
    kept = scored.select(*out, "distance", (F.col("distance") <= cutoff).alias("kept"))
    failed = counted.where("base_failed").select(*out, F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept"))
    return kept.unionByName(failed)
