"""Line dedup by a deletion-neighbourhood join, in DataFrame functions only.

The unit of an edit is a word: two lines are near if one word changed, was added or is missing.  A line that isn't blank goes
if an equal line (trimmed of blanks, lower case) comes before it, whatever its length; one of at least ``min_words`` words
also goes if it is the first of its text and the first of a near line comes before it.  Before means by (doc_id, row, line
number), where rows have numbers of their own, written once in the order in which the input is read.

Equal lines are one distinct line, its earliest place, combined before the shuffle; all other places of it go, found by
place and not by text, so that a line in a third of all rows makes no hot key.  All variants with one word deleted are
emitted as hashed keys: lines with equal variants at the same position differ by a changed word, and a variant equal to a
line itself differs by an added one.  Each such group is linked to its earliest line only, which loses nothing, as what is
asked is whether some earlier near line exists.  Every link is verified on the words.

Near lines agree in their first or last half, so only lines that share a half with another one emit variants, and only
those of the other half; this leaves out no pair.  ``min_words`` bounds the near match alone: in a line of a few words
another word is another line.

Defined results: null and empty texts have no lines to drop; a null doc_id comes first; rows that share a doc_id, or have
none, are documents of their own, in the order of their numbers, so of repeated rows the first keeps its lines; lines of any
length are compared whole (equal ones by 96 bits of hash); columns of docs that have the name of a made one are replaced;
an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, maybe_broadcast, numbered

NORMAL = "trim(lower(line))"


#: A document's line numbers are kept as a map from number div 64 to bits, so that asking for one of many costs little.
BIT, AT_MASK = "shiftleft(1L, int(line_no % 64))", "try_element_at(masks, int(line_no div 64))"


def masks(lines: DataFrame, **flags: str) -> DataFrame:
    """(row, masks) of lines (row, line_no): by number div 64, a mask for each flag of the lines for which it holds."""
    words = lines.groupBy("row", F.expr("int(line_no div 64)").alias("w")).agg(*(F.bit_or(F.expr(f"if({e}, {BIT}, 0L)")).alias(n) for n, e in flags.items()))
    return words.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("w", F.struct(*flags)))).alias("masks"))


def lines_of(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, row, line_no (from 0), norm, m (words) of docs (doc_id, row, text), and more of its columns."""
    rows = docs.select("doc_id", "row", *more, F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("line_no", "line"))
    return rows.select("doc_id", "row", *more, "line_no", F.expr(NORMAL).alias("norm")).withColumn("m", F.expr("if(norm = '', 0, length(norm) - length(replace(norm, ' ', '')) + 1)"))


def halves(side: str) -> F.Column:
    """Keys of the halves that a near line must share, of m and of m - 1 words: first halves (p) or last ones (s)."""
    if side == "p":
        return F.expr("array_distinct(array(xxhash64(1, m div 2, substring_index(norm, ' ', int(m div 2))), xxhash64(1, (m - 1) div 2, substring_index(norm, ' ', int((m - 1) div 2)))))")
    return F.expr("array_distinct(array(xxhash64(2, m - m div 2, substring_index(norm, ' ', -int(m - m div 2))), xxhash64(2, (m - 1) - (m - 1) div 2, substring_index(norm, ' ', -int((m - 1) - (m - 1) div 2)))))")


WITHOUT = "array_join(concat(slice({w}, 1, {i}), slice({w}, {i} + 2, size({w}))), ' ')"


def drops(docs: DataFrame, min_words: int = 6) -> DataFrame:
    """Lines that go, of docs (doc_id, row, text) with written row numbers: row, line_no, near (false: an equal line is earlier)."""
    scratch = Scratch(docs.sparkSession)
    keyed = lines_of(docs).where("m > 0")
    sided = [F.when(F.col("m") >= min_words, halves(side)).alias(side) for side in "ps"]  # null, so without keys, for lines too short to be near
    keyed = scratch.save(keyed.select("doc_id", "row", "line_no", F.xxhash64("norm").alias("h"), F.crc32("norm").alias("c"), *sided), "keyed")
    distinct = keyed.groupBy("h", "c").agg(F.min(F.struct("doc_id", "row", "line_no", "p", "s")).alias("at"))
    distinct = scratch.save(distinct.select("at.*"), "distinct")
    equal = keyed.select("row", "line_no").join(distinct.select("row", "line_no"), ["row", "line_no"], "left_anti").withColumn("near", F.lit(False))

    place = ["doc_id", "row", "line_no"]
    sides = [distinct.select(*place, F.lit(side).alias("half"), F.explode(side).alias("key")) for side in "ps"]
    halved = sides[0].unionByName(sides[1])
    shared = halved.groupBy("key").agg(F.count(F.lit(1)).alias("lines")).where("lines > 1").select("key")
    ends = halved.join(shared, "key").groupBy("row", "line_no").agg(F.max(F.expr("half = 'p'")).alias("p"), F.max(F.expr("half = 's'")).alias("s"))
    wanted = scratch.save(masks(ends, p="p", s="s"), "wanted")
    found = lines_of(docs.join(maybe_broadcast(wanted), "row"), "masks").withColumn("at", F.expr(AT_MASK))
    found = found.where(f"((at.p | at.s) & {BIT}) <> 0").select(*place, F.expr(f"(at.p & {BIT}) <> 0").alias("p"), F.expr(f"(at.s & {BIT}) <> 0").alias("s"), "norm")
    found = scratch.save(found, "found")
    split = found.withColumn("words", F.split("norm", " ", -1)).withColumn("m", F.size("words"))
    span = split.withColumn("positions", F.expr("sequence(int(if(s, 0, (m - 1) div 2)), int(if(p, m - 1, m div 2 - 1)))"))
    # Exploded before the strings are cut, so that this stays in generated code.
    each = span.select(*place, "norm", "m", F.explode(F.array_append("positions", F.lit(-1))).alias("i"))
    less = "case when i < 0 then norm when i = 0 then substring_index(norm, ' ', 1 - m) when i = m - 1 then substring_index(norm, ' ', m - 1) else concat(substring_index(norm, ' ', i), ' ', substring_index(norm, ' ', i + 1 - m)) end"
    variants = scratch.save(each.select(*place, "i", F.expr(f"xxhash64({less})").alias("key")), "variants")
    twice = variants.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("key")
    met = scratch.save(variants.join(twice, "key"), "met")
    scratch.drop("variants")

    at = F.struct(*place)
    changed_first = met.where("i >= 0").groupBy("key", "i").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1").drop("rows")
    changed = met.where("i >= 0").join(changed_first, ["key", "i"]).select(at.alias("late"), F.col("first").alias("early"), F.col("i").alias("late_i"), F.col("i").alias("early_i")).where("late <> early")
    own = met.where("i = -1").groupBy("key").agg(F.min(at).alias("own"))
    added = met.where("i >= 0").join(own, "key").select(at.alias("at"), "own", "i").where("at <> own").withColumn("later", F.expr("at > own"))
    first_longer = added.where("not later").groupBy("own").agg(F.min(F.struct("at", "i")).alias("f"))
    added = added.where("later").select(F.col("at").alias("late"), F.col("own").alias("early"), F.col("i").alias("late_i"), F.lit(-1).alias("early_i")).unionByName(
        first_longer.select(F.col("own").alias("late"), F.col("f.at").alias("early"), F.lit(-1).alias("late_i"), F.col("f.i").alias("early_i"))
    )
    links = changed.unionByName(added).selectExpr("late.row as late_row", "late.line_no as late_no", "early.row as early_row", "early.line_no as early_no", "late_i", "early_i").distinct()
    text = lambda end: found.select(F.col("row").alias(f"{end}_row"), F.col("line_no").alias(f"{end}_no"), F.split("norm", " ", -1).alias(f"{end}_words"))
    cut = lambda end: f"if({end}_i < 0, array_join({end}_words, ' '), {WITHOUT.format(w=f'{end}_words', i=f'{end}_i')})"
    checked = links.join(text("late"), ["late_row", "late_no"]).join(text("early"), ["early_row", "early_no"]).where(f"{cut('late')} = {cut('early')}")
    near = checked.select(F.col("late_row").alias("row"), F.col("late_no").alias("line_no"), F.lit(True).alias("near")).distinct()
    out = scratch.save(equal.unionByName(near), "drops")  # a near line is the first of its text, an equal one isn't
    for name in ("keyed", "distinct", "wanted", "found", "met"):
        scratch.drop(name)
    return out


def dedup_lines(docs: DataFrame, min_words: int = 6) -> DataFrame:
    """All columns of docs with the text less its dropped lines, and n_lines, n_equal, n_near (dropped)."""
    scratch = Scratch(docs.sparkSession)
    rows, row = numbered(docs, scratch)
    lines = drops(rows.select("doc_id", F.col(row).alias("row"), F.col("text").cast("string").alias("text")), min_words)
    counts = lines.groupBy("row").agg(F.count_if(~F.col("near")).cast("int").alias("equal"), F.count_if("near").cast("int").alias("near"))
    gone = scratch.save(masks(lines, gone="true").join(counts, "row"), "gone")
    joined = rows.alias("d").join(maybe_broadcast(gone).alias("g"), F.col(f"d.`{row}`") == F.col("g.row"), "left")
    stays = "(coalesce(try_element_at(g.masks, int(i div 64)).gone, 0L) & shiftleft(1L, int(i % 64))) = 0"
    kept = f"if(g.masks is null, d.text, array_join(filter(split(d.text, '\\n', -1), (x, i) -> {stays}), '\\n'))"
    made = {
        "text": F.expr(kept), "n_lines": F.size(F.split(F.coalesce("d.text", F.lit("")), "\n", -1)),
        "n_equal": F.expr("coalesce(g.equal, 0)"), "n_near": F.expr("coalesce(g.near, 0)"),
    }
    rest = [F.col(f"d.`{c}`") if c != "text" else made["text"].alias("text") for c in docs.columns if c == "text" or c not in made]
    return joined.select(*rest, *(made[c].alias(c) for c in ("n_lines", "n_equal", "n_near")))


#: The same rule over whole strings, for DuckDB.
ORACLE = r"""
with l as (
    select doc_id, unnest(range(len(string_split(text, chr(10))))) as line_no, unnest(string_split(text, chr(10))) as line from documents),
n as (select doc_id, line_no, trim(lower(line), ' ') as norm from l),
w as (select doc_id, line_no, norm, string_split(norm, ' ') as ws from n where norm <> ''),
u as (select *, row_number() over (order by doc_id, line_no) as p, row_number() over (partition by norm order by doc_id, line_no) as k from w),
d as (select * from u where k = 1 and len(ws) >= 6),
v as (select p, i, array_to_string(ws[:i] || ws[i + 2:], ' ') as t from (select p, ws, unnest(range(len(ws))) as i from d)),
near as (
    select distinct p from (
        select greatest(a.p, b.p) as p from v a join v b on a.i = b.i and a.t = b.t and a.p < b.p
        union all select greatest(a.p, d.p) as p from v a join d on a.t = d.norm and a.p <> d.p)),
g as (
    select doc_id, line_no, false as near from u where k > 1
    union all select doc_id, line_no, true as near from d where p in (select p from near)),
c as (
    select l.doc_id, string_agg(l.line, chr(10) order by l.line_no) as kept_text
    from l left join g on g.doc_id = l.doc_id and g.line_no = l.line_no where g.doc_id is null group by l.doc_id)
select documents.doc_id, len(string_split(text, chr(10)))::int as n_lines,
    (select count(*) from g where g.doc_id = documents.doc_id and not near)::int as n_equal,
    (select count(*) from g where g.doc_id = documents.doc_id and near)::int as n_near,
    coalesce(c.kept_text, '') as kept_text
from documents left join c on c.doc_id = documents.doc_id
"""
