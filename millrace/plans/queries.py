"""The registered queries of the engine's own operators, each over whole tables, and the DuckDB SQL of each.

Tables without judgements, votes or logs are stood in for by views derived with integer arithmetic, which both engines
compute alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import chat as ch
from ..functions import text as tx
from ..functions.lexicon import ANY_CONSUMING, is_technical
from ..operators import curation as cu
from ..operators import evaluation as ev
from ..operators import judging as jd
from ..operators import near_dup as nd
from ..operators import records as rc
from ..operators import registry as rg
from ..operators import telemetry as te
from ..operators import vectors as ve
from ..schemas import preference_error, sft_error
from ..sources import loaders as ld
from ..sources import log_folder as lf
from ..streaming import token_streams as ts
from .scratch import shared_folder, writer

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# Derived views.


def v_turns(spark, d) -> DataFrame:
    """User turns with the assistant turn right behind them: conv_id, turn, prompt, answer."""
    c = _t(spark, d, "conversations")
    u = c.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("prompt"))
    a = c.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return u.join(a, ["conv_id", "turn"])


V_TURNS = "select u.conv_id, u.turn, u.text as prompt, a.text as answer from conversations u join conversations a on a.conv_id = u.conv_id and a.turn = u.turn + 1 where u.role = 'user' and a.role = 'assistant'"


def v_pref(spark, d) -> DataFrame:
    """Triplets: the rejected text is the conversation's first assistant text; equal ones occur and must be caught."""
    first = _t(spark, d, "conversations").where("role = 'assistant'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("rejected"))
    return v_turns(spark, d).join(first, "conv_id").select("conv_id", "turn", "prompt", F.col("answer").alias("chosen"), "rejected", F.lit("conversations").alias("source"))


V_PREF = f"select t.conv_id, t.turn, t.prompt, t.answer as chosen, f.rejected, 'conversations' as source from ({V_TURNS}) t join (select conv_id, arg_min(text, turn) as rejected from conversations where role = 'assistant' group by conv_id) f using (conv_id)"


def v_judge(spark, d) -> DataFrame:
    """Two verdicts of a judge for each order; one in ten is missing."""
    verdict = lambda n: f"case when {n} < 4 then 'A' when {n} < 7 then 'B' when {n} < 9 then 'tie' end"
    return _t(spark, d, "orders").selectExpr(
        "o_orderkey as case_id", "o_orderpriority as suite", "o_custkey % 3 as pair", f"{verdict('(o_orderkey * 7 + 3) % 10')} as verdict_ab", f"{verdict('(o_orderkey * 13 + o_custkey) % 10')} as verdict_ba",
        "case o_custkey % 3 when 0 then 'base' when 1 then 'base' else 'sft' end as model_a", "case o_custkey % 3 when 0 then 'sft' else 'dpo' end as model_b",
    )


_V = "case when {n} < 4 then 'A' when {n} < 7 then 'B' when {n} < 9 then 'tie' end"
V_JUDGE = f"""select o_orderkey as case_id, o_orderpriority as suite, o_custkey % 3 as pair, {_V.format(n='((o_orderkey * 7 + 3) % 10)')} as verdict_ab, {_V.format(n='((o_orderkey * 13 + o_custkey) % 10)')} as verdict_ba,
    case o_custkey % 3 when 0 then 'base' when 1 then 'base' else 'sft' end as model_a, case o_custkey % 3 when 0 then 'sft' else 'dpo' end as model_b from orders"""
V_BACK = f"select *, case verdict_ba when 'A' then 'B' when 'B' then 'A' else coalesce(verdict_ba, 'tie') end as back from ({V_JUDGE})"
V_FINAL = f"""select *, case when verdict_ab is null then 'failed' when verdict_ab = back and back = 'A' then 'model_a' when verdict_ab = back and back = 'B' then 'model_b' else 'tie' end as final_verdict,
    case when verdict_ab is null then false else verdict_ab <> back end as position_bias_observed from ({V_BACK})"""
_COUNTS = """count(*) filter (where final_verdict = 'model_a') as wins, count(*) filter (where final_verdict = 'model_b') as losses,
    count(*) filter (where final_verdict = 'tie') as ties, count(*) filter (where final_verdict = 'failed') as failed"""


def v_final(spark, d) -> DataFrame:
    return ev.debias(v_judge(spark, d))


def v_kl(spark, d) -> DataFrame:
    """A training log: run = user, step by time."""
    e = _t(spark, d, "events")
    step = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("long")
    return e.select(F.col("user_id").alias("run"), step.alias("step"), (F.col("value") / 100).alias("r_chosen"), (-F.col("value") / 200).alias("r_rejected"))


V_KL = "select user_id as run, row_number() over (partition by user_id order by ts, event_id) as step, value / 100 as r_chosen, -value / 200 as r_rejected from events"
V_KLS = f"select *, (abs(r_chosen) + abs(r_rejected)) / (2 * 0.1) as kl from ({V_KL}) where r_chosen is not null and r_rejected is not null"


def v_labels(spark, d) -> DataFrame:
    return _t(spark, d, "labels").join(_t(spark, d, "documents").select("doc_id"), "doc_id").selectExpr("doc_id", "(doc_id * 37 % 100) / 100.0D as score", "quality as label")


def v_votes(spark, d) -> DataFrame:
    return v_pref(spark, d).selectExpr(
        "concat(conv_id, '-', turn) as vote_id", "prompt", "chosen as response_a", "rejected as response_b", "'base' as model_a", "case when conv_id % 5 = 0 then 'base' else 'dpo' end as model_b",
        "case conv_id % 3 when 0 then 'a' when 1 then 'b' else 'tie' end as winner",
    )


V_VOTES = f"select concat(conv_id, '-', turn) as vote_id, prompt, chosen as response_a, rejected as response_b, 'base' as model_a, case when conv_id % 5 = 0 then 'base' else 'dpo' end as model_b, case conv_id % 3 when 0 then 'a' when 1 then 'b' else 'tie' end as winner from ({V_PREF})"

# Curation.

_TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"
_GRAMS = """case when len(t) >= 13 then list_distinct(list_transform(range(1, len(t) - 11), lambda i: array_to_string(t[i:i + 12], ' '))) when len(t) > 0 then [array_to_string(t, ' ')] else [] end"""
_HITS = f"""with x as (select distinct unnest({_GRAMS}) as gram from (select {_TOKENS} as t from benchmark)),
g as (select doc_id, unnest({_GRAMS}) as gram from (select doc_id, {_TOKENS} as t from documents)),
h as (select doc_id, count(*) as overlap from g where gram in (select gram from x) group by doc_id)"""


def _index(spark, d):
    return cu.gram_index(_t(spark, d, "benchmark"), "text")


@query(_HITS + " select doc_id, overlap from h")
def decontam_hits(spark, d):
    return cu.contaminated(_t(spark, d, "documents"), "doc_id", "text", _index(spark, d))


@query(_HITS + " select source, count(*) filter (where doc_id not in (select doc_id from h)) as kept, count(*) filter (where doc_id in (select doc_id from h)) as dropped from documents group by source")
def decontam_keep_by_source(spark, d):
    judged = cu.with_overlap(_t(spark, d, "documents").select("source", "text"), "text", _index(spark, d))
    return judged.groupBy("source").agg(F.count_if(F.col("overlap") == 0).alias("kept"), F.count_if(F.col("overlap") > 0).alias("dropped"))


@query(_HITS + " select doc_id from h where overlap >= 2")
def decontam_min_overlap2(spark, d):
    return cu.contaminated(_t(spark, d, "documents"), "doc_id", "text", _index(spark, d), min_overlap=2).select("doc_id")


@query("select min(doc_id) as doc_id, sha256(text) as text_sha256 from documents group by text")
def exact_dedup_first_wins(spark, d):
    docs = _t(spark, d, "documents")
    return cu.exact_dedup(docs, F.col("text"), ["doc_id"]).select("doc_id", F.sha2("text", 256).alias("text_sha256"))


@query("select count(*) as n_rows, count(distinct text) as n_kept, count(*) - count(distinct text) as exact_removed from documents")
def dedup_stats(spark, d):
    return cu.dedup_stats(cu.exact_dedup(_t(spark, d, "documents").select("doc_id", "text"), F.col("text"), ["doc_id"], "copies"))


@query(f"""with p as ({V_PREF}), e as (select case when length(prompt) < 5 then 'prompt: too short' when trim(prompt) = '' then 'prompt: blank' when length(chosen) < 5 then 'chosen: too short' when trim(chosen) = '' then 'chosen: blank'
when length(rejected) < 5 then 'rejected: too short' when trim(rejected) = '' then 'rejected: blank' when trim(chosen) = trim(rejected) then 'chosen and rejected are identical' else 'valid' end as verdict from p)
select 'preference' as kind, verdict, count(*) as n from e group by verdict
union all select 'sft', verdict, count(*) from (select case when length(prompt) < 5 then 'instruction: too short' when trim(prompt) = '' then 'instruction: blank' when length(answer) < 5 then 'response: too short' when trim(answer) = '' then 'response: blank' else 'valid' end as verdict from ({V_TURNS})) group by verdict""")
def validity_quarantine_counts(spark, d):
    pref = v_pref(spark, d).select(F.lit("preference").alias("kind"), F.coalesce(preference_error(), F.lit("valid")).alias("verdict"))
    turns = v_turns(spark, d).select(F.col("prompt").alias("instruction"), F.lit("").alias("input"), F.col("answer").alias("response"))
    sft = turns.select(F.lit("sft").alias("kind"), F.coalesce(sft_error(), F.lit("valid")).alias("verdict"))
    return pref.unionByName(sft).groupBy("kind", "verdict").agg(F.count(F.lit(1)).alias("n"))


@query("select 'documents' as tab, doc_id as id from documents where regexp_matches(text, '" + ANY_CONSUMING.replace("'", "''") + "', 'i') union all select 'pages', page_id from pages where regexp_matches(url, '" + ANY_CONSUMING.replace("'", "''") + "', 'i')")
def keyword_filter_docs(spark, d):
    docs = cu.keyword_filter(_t(spark, d, "documents"), "text").select(F.lit("documents").alias("tab"), F.col("doc_id").alias("id"))
    return docs.unionByName(_t(spark, d, "pages").where(is_technical(F.col("url"))).select(F.lit("pages").alias("tab"), F.col("page_id").alias("id")))


@query(r"select page_id, sha256(regexp_replace(regexp_replace(html, '[\t\v\f\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g')) as clean_sha256 from pages")
def whitespace_collapse(spark, d):
    return _t(spark, d, "pages").select("page_id", F.sha2(tx.collapse_whitespace(F.col("html")), 256).alias("clean_sha256"))


@query("select page_id, replace(replace(replace(replace(replace(html, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&') as clean from pages")
def html_unescape_basic(spark, d):
    return _t(spark, d, "pages").select("page_id", tx.unescape_basic(F.col("html")).alias("clean"))


@query(r"select doc_id, trim(regexp_replace(nfc_normalize(text), '[ \t]+', ' ', 'g'), ' ' || chr(10) || chr(9)) as clean from documents")
def normalise_exact(spark, d):
    return _t(spark, d, "documents").select("doc_id", tx.normalise("text").alias("clean"))


def _place(q):
    return f"list_sort(list(n_chars))[floor(count(*) * {q})::bigint + 1]"


@query(f"select lang, {_place(0.5)} as p50, {_place(0.9)} as p90, {_place(0.95)} as p95, {_place(0.99)} as p99, max(n_chars) as max, count(*) as n from documents group by lang")
def length_percentiles_by_lang(spark, d):
    return ev.length_percentiles(_t(spark, d, "documents"), "n_chars", "lang")


@query(r"select doc_id, n_tokens from (select doc_id, len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))::bigint as n_tokens from documents) where n_tokens <= 512")
def token_length_filter(spark, d):
    return _t(spark, d, "documents").select("doc_id", tx.whitespace_tokens(F.col("text")).cast("long").alias("n_tokens")).where("n_tokens <= 512")


@query("select doc_id, case when row_number() over (order by sha256(concat('42:', doc_id)), doc_id) <= greatest(1, floor((select count(*) from documents) * 0.1)) then 'val' else 'train' end as split from documents")
def train_val_split(spark, d):
    return cu.split(_t(spark, d, "documents").select("doc_id"), "doc_id", 0.1)


def _enc(c):
    return f"case when {c} is null then '-' else concat('+', length({c}::varchar), ':', {c}) end"


_LANES = f"""with r as (select sha256(concat_ws(',', {_enc('text')}, {_enc('source')}, {_enc('lang')})) as h from (select text, source, nullif(lang, 'fr') as lang from documents)),
l as (select count(*) as n, {', '.join(f"(coalesce(sum(('0x' || substr(h, {16 * i + 1}, 16))::ubigint), 0) % 18446744073709551616)::varchar as lane{i}" for i in range(4))} from r)"""


def _hashed_docs(spark, d):
    return _t(spark, d, "documents").selectExpr("doc_id", "text", "source", "nullif(lang, 'fr') as lang")


@query(_LANES + " select n, lane0, lane1, lane2, lane3 from l")
def content_lanes(spark, d):
    return cu.content_lanes(_hashed_docs(spark, d), ["text", "source", "lang"])


@query(_LANES + " select substr(sha256(concat_ws(',', n, lane0, lane1, lane2, lane3)), 1, 12) as content_hash from l")
def canonical_content_hash(spark, d):
    return cu.content_hash(_hashed_docs(spark, d), ["text", "source", "lang"])


@query(_HITS + """, s as (select doc_id, text, length(text) >= 5 and trim(text) <> '' as valid, row_number() over (partition by text order by doc_id) = 1 as first, doc_id in (select doc_id from h) as hit from documents)
select 0::bigint as stage_ord, 'loaded' as stage, count(*) as rows from s union all select 1, 'validated', count(*) from s where valid union all select 2, 'quarantined', count(*) from s where not valid
union all select 3, 'after_dedup', count(*) from s where valid and first union all select 4, 'after_decontamination', count(*) from s where valid and first and not hit""")
def curation_funnel(spark, d):
    """Stages of the documents; rows of one text are alike in all but their place, so a text's first row stands for its copies."""
    ok = F.coalesce((F.length("text") >= 5) & (tx.strip(F.col("text")) != ""), F.lit(False))
    firsts = cu.exact_dedup(_t(spark, d, "documents").select("doc_id", "text"), F.col("text"), ["doc_id"], "n")
    rows = cu.with_overlap(firsts.withColumn("v", ok), "text", _index(spark, d))
    n, v, clean = F.col("n"), F.col("v"), F.col("overlap") == 0
    return cu.funnel(rows, [("loaded", n), ("validated", F.when(v, n)), ("quarantined", F.when(~v, n)), ("after_dedup", v), ("after_decontamination", v & clean)])


@query("select exact_removed + near_removed = total_removed as adds_up, exact_removed from (select count(*) - count(distinct text) as exact_removed, 0 as near_removed, count(*) - count(distinct text) as total_removed from documents)")
def dedup_removed(spark, d):
    """How many rows exact and then near dedup take out; SQL knows the first number and that they add up."""
    _, stats = nd.deduplicate(_t(spark, d, "documents").select("doc_id", "text"), "doc_id", "text", writer(spark))
    return stats.select(F.expr("exact_removed + near_removed = total_removed and near_removed >= 0").alias("adds_up"), "exact_removed")


@query()
def near_dup_first_wins(spark, d):
    docs = _t(spark, d, "documents")
    return nd.near_dedup(docs.select("doc_id", "text"), "doc_id", "text", writer(spark)).select("doc_id")


@query()
def near_dup_verified(spark, d):
    """The same with the true similarity of character 5-shingles, at least 0.85."""
    docs = _t(spark, d, "documents")
    return nd.near_dedup(docs.select("doc_id", "text"), "doc_id", "text", writer(spark), verify=0.85).select("doc_id")


@query("select a.item_id as a, b.item_id as b from (select item_id, list_distinct(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) as w from benchmark) a join (select item_id, list_distinct(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) as w from benchmark) b on a.item_id < b.item_id where 10 * len(list_intersect(a.w, b.w)) >= 1 * (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w)))")
def jaccard_pairs(spark, d):
    """Pairs of evaluation items whose word sets overlap by 0.1: joined on words, counted, no cross join."""
    w = _t(spark, d, "benchmark").select("item_id", F.array_distinct(tx.word_tokens(F.col("text"))).alias("w"))
    each = w.select("item_id", F.size("w").alias("n"), F.explode("w").alias("word"))
    a, b = each.alias("a"), each.alias("b")
    both = a.join(b, F.expr("a.word = b.word and a.item_id < b.item_id")).groupBy(F.col("a.item_id").alias("a"), F.col("b.item_id").alias("b")).agg(F.count(F.lit(1)).alias("i"), F.first("a.n").alias("na"), F.first("b.n").alias("nb"))
    return both.where("10 * i >= 1 * (na + nb - i)").select("a", "b")


@query("select label, threshold, tp, fp, fn, case when 2 * tp + fp + fn > 0 then 2.0::double * tp / (2 * tp + fp + fn) else 0 end as f1 from (select 'quality' as label, t as threshold, count(*) filter (where score >= t and label = 1) as tp, count(*) filter (where score >= t and label = 0) as fp, count(*) filter (where score < t and label = 1) as fn from (select doc_id, (doc_id * 37 % 100) / 100.0::double as score, quality as label from labels join documents using (doc_id)) cross join (select unnest([0.3::double, 0.35, 0.4, 0.45, 0.5, 0.55, 0.6]) as t) group by t)")
def threshold_f1(spark, d):
    return cu.threshold_scores(v_labels(spark, d), "score", "label", [0.3, 0.35, 0.4, 0.45, 0.5, 0.55, 0.6]).select(F.lit("quality").alias("label"), "threshold", "tp", "fp", "fn", "f1")


@query("""with u as (select vec_id, label, list_transform(embedding, lambda x: x::double / greatest(sqrt(list_sum(list_transform(embedding, lambda y: y::double * y::double))), 1e-8)) as v from embeddings),
m as (select label, i, avg(v[i]) as x from u, (select unnest(range(1, 65)) as i) group by label, i), n as (select label, sqrt(sum(x * x)) as norm from m group by label),
c as (select label, list(x / greatest(norm, 1e-8) order by i) as c from m join n using (label) group by label)
select vec_id, round(max(list_sum(list_transform(range(1, 65), lambda i: u.v[i] * c.c[i]))), 6) as score from u, c group by vec_id having max(list_sum(list_transform(range(1, 65), lambda i: u.v[i] * c.c[i]))) >= 0.45""")
def embed_centroid_filter(spark, d):
    e = _t(spark, d, "embeddings")
    kept = ve.domain_filter(e.select("vec_id", "embedding"), vector="embedding", centroids=cu.group_centroids(e, "label", "embedding"))
    return kept.select("vec_id", F.round("s", 6).alias("score"))


@query()
def domain_filter_fitted(spark, d):
    """Vectors near the k-means centroids of those with label 0 to 2, by the threshold that tells these from the others best."""
    e = _t(spark, d, "embeddings").withColumn("wanted", (F.col("label") < 3).cast("int"))
    found = ve.kmeans_centroids(e.where("wanted = 1"), "embedding", k=5)
    centroids = spark.createDataFrame([(c.tolist(),) for c in found], "centroid array<double>")
    scored = ve.with_similarity(e, "embedding", centroids)
    threshold = ve.fitted_threshold(scored, "s", "wanted", [t / 100 for t in range(5, 100, 5)])
    return ve.domain_filter(e, vector="embedding", centroids=centroids, threshold=threshold).select("vec_id", F.round("s", 6).alias("score"))


# Chat data.


@query(f"select conv_id, turn, prompt, chosen, rejected, source from ({V_PREF}) where length(prompt) >= 5 and length(chosen) >= 5 and length(rejected) >= 5 and trim(prompt) <> '' and trim(chosen) <> '' and trim(rejected) <> '' and trim(chosen) <> trim(rejected)")
def pref_triplets(spark, d):
    good, _ = ld.route(v_pref(spark, d).withColumn("error", preference_error()))
    return good


@query("select conv_id, arg_max(text, turn) as answer from conversations where role = 'assistant' group by conv_id")
def last_assistant_message(spark, d):
    c = _t(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("m"))
    return c.select("conv_id", ld.last_assistant(F.col("m")).alias("answer")).where("answer is not null")


@query(f"select conv_id, turn, concat('<|im_start|>user', chr(10), prompt, '<|im_end|>', chr(10), '<|im_start|>assistant', chr(10), answer, '<|im_end|>', chr(10)) as text from ({V_TURNS})")
def chat_render(spark, d):
    return v_turns(spark, d).select("conv_id", "turn", tx.chatml(F.col("prompt"), F.col("answer")).alias("text"))


@query(f"select t.conv_id, trim(prompt) as prompt, trim(answer) as answer from ({V_TURNS}) t join (select conv_id, max(turn) as turn from ({V_TURNS}) group by conv_id) l on l.conv_id = t.conv_id and l.turn = t.turn")
def hh_parse(spark, d):
    """Dialogues as one transcript each, read back by the transcript parser."""
    said = v_turns(spark, d).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "prompt", "answer"))).alias("m"))
    text = F.array_join(F.transform("m", lambda m: F.concat(F.lit("\n\nHuman: "), m["prompt"], F.lit("\n\nAssistant: "), m["answer"])), "")
    prompt, answer = ld.parse_transcript(text)
    return said.select("conv_id", prompt.alias("prompt"), answer.alias("answer"))


# Evaluation.


@query("select a.n_name as model_a, b.n_name as model_b from nation a join nation b on a.n_nationkey < b.n_nationkey")
def pair_enumeration(spark, d):
    return ev.model_pairs(_t(spark, d, "nation"), "n_nationkey", "n_name")


@query(f"select case_id, final_verdict, position_bias_observed from ({V_FINAL})")
def debiased_verdicts(spark, d):
    return v_final(spark, d).select("case_id", "final_verdict", "position_bias_observed")


_RATE = "case when wins + losses + ties > 0 then (wins + 0.5::double * ties) / (wins + losses + ties) else 0.5 end as win_rate"


@query(f"select pair, wins, losses, ties, failed, {_RATE} from (select pair, {_COUNTS} from ({V_FINAL}) group by pair)")
def win_rate(spark, d):
    return ev.win_rate(v_final(spark, d), "pair")


@query(f"select pair, suite, wins, losses, ties, failed, {_RATE} from (select pair, suite, {_COUNTS} from ({V_FINAL}) group by pair, suite)")
def win_rate_per_suite(spark, d):
    return ev.win_rate(v_final(spark, d), "pair", "suite")


@query(f"select pair, avg(position_bias_observed::int) as bias_rate from ({V_FINAL}) group by pair")
def bias_rate(spark, d):
    return ev.bias_rate(v_final(spark, d), "pair")


_SIDES = "select l_orderkey, sum(l_quantity) filter (where l_linenumber % 2 = 1) as ta, sum(l_quantity) filter (where l_linenumber % 2 = 0) as tb from lineitem group by l_orderkey"


def _sides(spark, d):
    q = F.col("l_quantity")
    odd = F.col("l_linenumber") % 2 == 1
    return _t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum(F.when(odd, q)).alias("ta"), F.sum(F.when(~odd, q)).alias("tb"))


_GONE = "(ta is null or tb is null or coalesce(final_verdict = 'model_a' and ta > 1.2 * tb, false) or coalesce(final_verdict = 'model_b' and tb > 1.2 * ta, false))"


@query(f"select pair, n_discarded, n_total, 100.0::double * n_discarded / n_total as pct_discarded, wins, losses, ties, failed, {_RATE} from (select pair, count(*) filter (where gone) as n_discarded, count(*) as n_total, {_COUNTS.replace('where final', 'where not gone and final')} from (select *, {_GONE} as gone from ({V_FINAL}) v left join ({_SIDES}) s on s.l_orderkey = v.case_id) group by pair)")
def length_controlled(spark, d):
    rows = v_final(spark, d).join(_sides(spark, d), F.col("case_id") == F.col("l_orderkey"), "left")
    return ev.length_controlled(rows, "ta", "tb", "pair")


@query(f"""with v as (select pair, row_number() over (partition by pair order by case_id) - 1 as i, count(*) over (partition by pair) as n, case final_verdict when 'model_a' then 2 when 'tie' then 1 else 0 end as w
    from ({V_FINAL}) where final_verdict <> 'failed'),
m as (select pair, i, w, n from v), b as (select d.pair, r, sum(x.w) / (2.0::double * max(d.n)) as rate from m d cross join (select unnest(range(50)) as r) join m x on x.pair = d.pair and x.i = ((r * 2654435761 + d.i * 40503 + 12345) % 4294967296) % d.n group by d.pair, r)
select pair, list_sort(list(rate))[2] as ci_low, list_sort(list(rate))[49] as ci_high from b group by pair""")
def bootstrap_ci_sql(spark, d):
    """The interval with 50 resamples drawn by an integer hash, as SQL can repeat them; bootstrap_ci_fast is the one for large groups."""
    return ev.bootstrap_hashed(v_final(spark, d), ["pair"], "case_id")


@query()
def bootstrap_ci_fast(spark, d):
    return ev.bootstrap(v_final(spark, d), ["pair"])


_FIT = f"""with recursive f as (select {{key}} as suite, * exclude (suite) from ({V_FINAL}) where final_verdict <> 'failed'),
m as (select suite, model, other, sum(points) as points from (select suite, model_a as model, model_b as other, case final_verdict when 'model_a' then 1.0::double when 'tie' then 0.5 else 0 end as points from f
    union all select suite, model_b, model_a, case final_verdict when 'model_b' then 1.0::double when 'tie' then 0.5 else 0 end from f) group by all),
k as (select suite, model, row_number() over (partition by suite order by model) as i from (select distinct suite, model from m)),
w as (select x.suite, x.i, list(coalesce(p.points, 0.0) order by y.i) as won, list(coalesce(p.points, 0.0) + coalesce(q.points, 0.0) order by y.i) as games from k x join k y on x.suite = y.suite
    left join m p on p.suite = x.suite and p.model = x.model and p.other = y.model left join m q on q.suite = x.suite and q.model = y.model and q.other = x.model group by x.suite, x.i),
g as (select suite, list(list_sum(won) order by i) as won, list(games order by i) as games, list_transform(range(count(*)), lambda x: 0.0::double) as zero, range(1, count(*) + 1) as ix from w group by suite),
r as (select suite, 0 as step, zero as a, zero as b from g union all select r.suite, step + 1,
    list_transform(ix, lambda i: case when list_sum(list_transform(ix, lambda j: games[i][j] / (exp(a[i]) + exp(a[j])))) * exp(a[i]) > 0 then case when won[i] > 0 then ln(won[i] / (list_sum(list_transform(ix, lambda j: games[i][j] / (exp(a[i]) + exp(a[j])))) * exp(a[i]))) else -10.0 end else a[i] end),
    list_transform(list_transform(ix, lambda i: case when list_sum(list_transform(ix, lambda j: games[i][j] / (exp(b[i]) + exp(b[j])))) > 0 then case when won[i] > 0 then ln(won[i] / list_sum(list_transform(ix, lambda j: games[i][j] / (exp(b[i]) + exp(b[j]))))) else -10.0 end else b[i] end),
        lambda x: greatest(x - list_avg(list_transform(ix, lambda i: case when list_sum(list_transform(ix, lambda j: games[i][j] / (exp(b[i]) + exp(b[j])))) > 0 then case when won[i] > 0 then ln(won[i] / list_sum(list_transform(ix, lambda j: games[i][j] / (exp(b[i]) + exp(b[j]))))) else -10.0 end else b[i] end)), -10.0))
    from r join g using (suite) where step < 200)
select {{out}} model, round(1000 + 173.7 * (a[i] - list_avg(a)), 1) as elo_reference, round(1000 + 173.7 * (b[i] - list_avg(b)), 1) as elo_mle from r join k using (suite) where step = 200"""


@query(_FIT.format(key="'all'", out=""))
def bradley_terry(spark, d):
    judged = v_final(spark, d)
    a = ev.ratings_frame(judged, "reference").withColumnRenamed("elo", "elo_reference")
    return a.join(ev.ratings_frame(judged, "mle").withColumnRenamed("elo", "elo_mle"), "model")


@query(_FIT.format(key="suite", out="suite,"))
def bradley_terry_by_suite(spark, d):
    judged = v_final(spark, d)
    a = ev.ratings_by(judged, "suite").withColumnRenamed("elo", "elo_reference")
    return a.join(ev.ratings_by(judged, "suite", mode="mle").withColumnRenamed("elo", "elo_mle"), ["suite", "model"])


@query(f"""select *, case when abs(delta) < 0.03 then 'no measurable change' when delta < 0 then 'worse than parity' else 'better than parity' end as reading from
(select win_rate, wins + losses + ties as n, win_rate - 0.5 as delta from (select *, {_RATE} from (select {_COUNTS} from ({V_FINAL}))))""")
def deployment_delta(spark, d):
    return ev.deployment_delta(v_final(spark, d)).select("win_rate", "n", "delta", "reading")


@query()
def bootstrap_replay(spark, d):
    """Intervals of each pair and suite by the draws of a seeded generator, one after another."""
    return ev.replay_by(v_final(spark, d), ["pair", "suite"], "case_id", resamples=200)


_PAIRS = f"select *, {_RATE}, wins + losses + ties as n from (select {{keys}}, {_COUNTS} from ({V_FINAL}) group by all)"


@query(f"""with p as ({_PAIRS.format(keys="model_a, model_b, null::varchar as suite, 'pairwise' as section")} union all by name {_PAIRS.format(keys="model_a, model_b, suite, 'per_suite' as section")})
select section, suite, model_a, model_b, name, value from (select section, suite, model_a, model_b, unnest([{{{{'name': 'wins', 'value': wins::double}}}}, {{{{'name': 'losses', 'value': losses::double}}}}, {{{{'name': 'ties', 'value': ties::double}}}}, {{{{'name': 'failed', 'value': failed::double}}}}, {{{{'name': 'n', 'value': n::double}}}}, {{{{'name': 'win_rate', 'value': round(win_rate, 4)}}}}], recursive := true) from p)
union all select 'position_bias_rate', null, model_a, model_b, 'bias_rate', round(avg(position_bias_observed::int), 4) from ({V_FINAL}) group by model_a, model_b""".replace("{{", "{").replace("}}", "}"))
def metrics_table(spark, d):
    return ev.metrics_table(v_final(spark, d), resamples=0).where("section <> 'elo'")


@query(f"""with f as (select * from ({V_FINAL}) where final_verdict <> 'failed'), m as (
    select model_a as model, model_b as other, case final_verdict when 'model_a' then 1.0::double when 'tie' then 0.5 else 0 end as points from f
    union all select model_b, model_a, case final_verdict when 'model_b' then 1.0::double when 'tie' then 0.5 else 0 end from f) select model, other, sum(points) as points from m group by model, other""")
def pairwise_matrix(spark, d):
    return ev.pairwise_matrix(v_final(spark, d))


@query("""with e as (select doc_id, source, true as verifiable, concat(' The | ', substr(text, 1, 6), 'zzz|der') as expected, text as response from documents),
h as (select source, len(list_filter(string_split(lower(trim(expected)), '|'), lambda p: contains(lower(response), trim(p)))) > 0 as ok from e where verifiable and expected <> '' and response is not null)
select source, count(*) filter (where ok) as n_correct, count(*) as n_verifiable, count(*) filter (where ok) / count(*)::double as score from h group by source""")
def exact_match(spark, d):
    e = _t(spark, d, "documents").selectExpr("source", "true as verifiable", "concat(' The | ', substr(text, 1, 6), 'zzz|der') as expected", "text as response")
    return ev.exact_match(e, "expected", "response", "source")


@query(f"""select a.case_id, a.suite, coalesce(c.c_mktsegment, 'No intent recorded.') as intent from ({V_JUDGE}) a join (select distinct l_orderkey from lineitem where l_linenumber % 2 = 1) x on x.l_orderkey = a.case_id
join (select distinct l_orderkey from lineitem where l_linenumber % 2 = 0) y on y.l_orderkey = a.case_id left join (select o_orderkey, c_mktsegment from orders join customer on c_custkey = o_custkey where o_orderkey % 4 <> 0) c on c.o_orderkey = a.case_id""")
def response_alignment(spark, d):
    """Cases that both models answered, with the case's intent or the default."""
    li = _t(spark, d, "lineitem").selectExpr("l_orderkey as case_id", "case when l_linenumber % 2 = 1 then 'a' else 'b' end as model_id").distinct()
    suite = _t(spark, d, "orders").selectExpr("o_orderkey as case_id", "o_orderpriority as suite")
    responses = li.join(suite, "case_id").selectExpr("suite", "case_id", "model_id", "'' as response", "'' as prompt", "cast(null as string) as error")
    cases = _t(spark, d, "orders").where("o_orderkey % 4 <> 0").join(_t(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey")).selectExpr("o_orderpriority as suite", "o_orderkey as id", "'' as prompt", "c_mktsegment as intent")
    return ev.align(responses, cases, "a", "b").select("case_id", "suite", "intent")


_ANSWER = "concat(o_orderpriority, '-', cast(o_totalprice * 100 as bigint), '-{}')"


def _cut(c: str, n: int = 8) -> str:
    return f"case when length({c}) > {n} then concat(substr({c}, 1, {n}), '...') else {c} end"


@query(f"""with lost as (select *, concat('since ', case_id) as rationale from ({V_FINAL}) where case_id % 11 <> 0 and ((model_a = 'base' and model_b = 'sft' and final_verdict = 'model_a') or (model_a = 'sft' and model_b = 'base' and final_verdict = 'model_b')) order by case_id limit 10)
select case_id, suite, o_orderdate::varchar as prompt, o_orderstatus as intent, {_cut(_ANSWER.format('base'))} as winner_response, case when case_id % 7 <> 0 then {_cut(_ANSWER.format('sft'))} end as loser_response, rationale from lost join orders on o_orderkey = case_id""")
def regression_gallery(spark, d):
    """A report's first ten lost cases with a rationale, responses cut for display; some responses are missing."""
    orders = _t(spark, d, "orders")
    judged = v_final(spark, d).withColumn("rationale_ab", F.expr("case when case_id % 11 <> 0 then concat('since ', case_id) else '' end"))
    cases = orders.selectExpr("o_orderpriority as suite", "o_orderkey as case_id", "cast(o_orderdate as string) as prompt", "o_orderstatus as intent")
    said = orders.select(F.col("o_orderpriority").alias("suite"), F.col("o_orderkey").alias("case_id"), F.explode(F.array(*(F.struct(F.lit(m).alias("model_id"), F.expr(_ANSWER.format(m)).alias("response")) for m in ("base", "sft")))).alias("r")).select("suite", "case_id", "r.*")
    return ev.regression_gallery(judged, cases, said.where("model_id = 'base' or case_id % 7 <> 0"), "base", "sft", ["case_id"], 10, 8)


@query("""with raw as (select event_id, case event_id % 4 when 0 then '{"verdict": "A"}' when 1 then '```json' || chr(10) || '{"verdict": "tie"}' || chr(10) || '```' when 2 then '{"verdict": "C"}' else '{"verdict": "A"} trailing' end as raw from events)
select event_id, case event_id % 4 when 0 then 'A' when 1 then 'tie' end as verdict from raw""")
def strict_judge_parse(spark, d):
    raw = F.expr("""case event_id % 4 when 0 then '{"verdict": "A"}' when 1 then concat('```json\n', '{"verdict": "tie"}', '\n```') when 2 then '{"verdict": "C"}' else '{"verdict": "A"} trailing' end""")
    return _t(spark, d, "events").select("event_id", raw.alias("raw")).select("event_id", tx.strict_verdict("raw").alias("verdict"))


# Telemetry, votes, registry.


@query(f"select run, min(step) as stop_step from (select run, step, avg(kl) over w as m, count(kl) over w as k from ({V_KLS}) window w as (partition by run order by step rows between 19 preceding and current row)) where k = 20 and m > 3 group by run")
def kl_guard(spark, d):
    return te.divergence(te.implicit_kl(v_kl(spark, d)), 20, 3.0)


@query(f"select run, round(avg(kl), 9) as mean_kl from ({V_KLS}) group by run")
def mean_kl(spark, d):
    return te.mean_kl(te.implicit_kl(v_kl(spark, d))).select("run", F.round("mean_kl", 9).alias("mean_kl"))


@query(f"select run, step from (select run, step, row_number() over (partition by run order by step) as rn, count(*) over (partition by run) as n from ({V_KLS})) where (rn - 1) % greatest(1, n // 8) = 0 or rn = n")
def kl_subsample(spark, d):
    return te.subsample(te.implicit_kl(v_kl(spark, d))).select("run", "step")


@query("select event_id, json_extract_string(props, '$.k') as k from events where event_type = 'click' and json_extract_string(props, '$.k') is not null")
def log_event_filter(spark, d):
    """Events written as log lines, with bad lines among them, read back by the log query."""
    lines = _t(spark, d, "events").select(F.to_json(F.struct(F.col("event_type").alias("event"), F.col("event_id").cast("string").alias("id"), F.get_json_object("props", "$.k").alias("k"))).alias("value"))
    bad = _t(spark, d, "region").select(F.lit("click {not json").alias("value"))
    return ld.log_records(lines.unionByName(bad), event="click", key="k").select(F.col("r")["id"].cast("long").alias("event_id"), F.col("r")["k"].alias("k"))


@query("select event_id, 'click' as event, user_id::varchar as run_id from events where event_type = 'click' and user_id % 10 = 3")
def log_folder_scan(spark, d):
    """The events written as log files of a run each tenth user, read back by the source; tests on event and run come to it."""
    folder = shared_folder(spark, "log")
    lines = _t(spark, d, "events").where("user_id % 10 = 3").select(F.to_json(F.struct(F.col("event_type").alias("event"), F.col("user_id").cast("string").alias("run_id"), F.col("event_id").alias("id"))).alias("value"))
    lines.write.text(folder)
    read = lf.read_log(spark, folder, suffix=".txt", block=65536).where("event = 'click'")
    return read.select(F.get_json_object("value", "$.id").cast("long").alias("event_id"), "event", "run_id")


@query("""select stream_id, count(*) as n_tokens, string_agg(content, '' order by seq) as said from (select user_id::varchar as stream_id, event_id as seq, concat(event_type, ' ') as content,
    min(case when event_id % 7 = 0 then event_id end) over (partition by user_id) as stop from events) where stop is null or seq < stop group by stream_id""")
def stream_texts(spark, d):
    """Each user's events as one stream of frames, ended by its own sentinel or error, put together again."""
    value = F.expr("case when event_id % 7 = 0 and event_id % 2 = 0 then 'data: [DONE]' else concat('data: ', to_json(named_struct('choices', array(named_struct('delta', named_struct('content', concat(event_type, ' '))))))) end")
    lines = _t(spark, d, "events").select(F.col("user_id").cast("string").alias("stream_id"), F.col("event_id").alias("seq"), value.alias("value"), F.expr("case when event_id % 7 = 0 and event_id % 2 = 1 then 'lost' end").alias("error"))
    tokens = ts.batch_events(lines).where("kind = 'token'")
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "content"))), lambda t: t["content"]), "")
    return tokens.groupBy("stream_id").agg(F.count(F.lit(1)).alias("n_tokens"), said.alias("said"))


@query("select user_id, max(value) as value, min(event_id) filter (where value = m) as event_id from (select *, max(value) over (partition by user_id) as m from events) group by user_id")
def peak_per_run(spark, d):
    return te.peak(_t(spark, d, "events"), "user_id", "value", "event_id")


@query("select event_type, arg_max(event_id, struct_pack(ts := ts, event_id := event_id)) as event_id from events group by event_type")
def last_probe(spark, d):
    return te.last_by(_t(spark, d, "events"), "event_type", "event_id", "ts", "event_id")


@query("select user_id, arg_max(event_type, event_id) as event_type, arg_max(value, event_id) as value from events group by user_id")
def latest_upsert(spark, d):
    return te.upsert_view(_t(spark, d, "events").select("user_id", "event_id", "event_type", "value"), "user_id", "event_id").select("user_id", "event_type", "value")


@query("select o_orderkey, o_orderdate from orders where o_orderstatus = 'F' order by o_orderdate desc, o_orderkey limit 20")
def newest_runs_topk(spark, d):
    return te.newest(_t(spark, d, "orders"), 20, F.desc("o_orderdate"), "o_orderkey", where="o_orderstatus = 'F'").select("o_orderkey", "o_orderdate")


@query(f"select vote_id, prompt, case winner when 'a' then response_a else response_b end as chosen, case winner when 'a' then response_b else response_a end as rejected, 'votes' as source from ({V_VOTES}) where winner <> 'tie' and model_a <> model_b and length(prompt) >= 5 and length(response_a) >= 5 and length(response_b) >= 5 and trim(prompt) <> '' and trim(response_a) <> '' and trim(response_b) <> '' and trim(response_a) <> trim(response_b)")
def votes_to_pref(spark, d):
    return te.votes_to_preferences(v_votes(spark, d))


@query("select vote_id, winner, other from (select conv_id::varchar as vote_id, case conv_id % 4 when 0 then 'base' when 1 then 'sft' when 2 then 'dpo' end as winner, unnest(['base', 'sft', 'dpo']) as other from (select distinct conv_id from conversations)) where winner is not null and winner <> other")
def best_of_three_pairs(spark, d):
    clicks = _t(spark, d, "conversations").select("conv_id").distinct().selectExpr("cast(conv_id as string) as vote_id", "case conv_id % 4 when 0 then 'base' when 1 then 'sft' when 2 then 'dpo' end as winner", "array('base', 'sft', 'dpo') as columns")
    return te.best_of_to_pairs(clicks)


@query("select suite, wanted, coalesce(found, 0) as found from (select unnest(['src1', 'src2', 'none']) as suite, unnest([1::bigint, 1000000, 5]) as wanted) left join (select source as suite, count(*) as found from documents group by source) using (suite) where coalesce(found, 0) < wanted")
def suite_completeness(spark, d):
    return ld.incomplete_suites(_t(spark, d, "documents").select(F.col("source").alias("suite")), {"src1": 1, "src2": 1_000_000, "none": 5})


@query("select doc_id from (select doc_id, (doc_id * 37 % 100) / 100.0::double as score from labels join documents using (doc_id)) where score >= 0.25 and not score >= 0.45")
def newly_admitted(spark, d):
    return cu.newly_admitted(v_labels(spark, d), "score", 0.25, 0.45).select("doc_id")


@query("select doc_id from (select doc_id, (doc_id * 37 % 100) / 100.0::double as score from labels join documents using (doc_id)) where score >= 0.25 and not score >= 0.45 order by sha256(concat('0:', doc_id)), doc_id limit 15")
def admitted_sample(spark, d):
    return cu.admitted_sample(v_labels(spark, d), "doc_id", "score", 0.25, 0.45).select("doc_id")


@query("select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'R')")
def resume_antijoin(spark, d):
    cases = _t(spark, d, "orders").selectExpr("'all' as suite", "o_orderkey as case_id")
    done = _t(spark, d, "lineitem").where("l_returnflag = 'R'").selectExpr("'all' as suite", "l_orderkey as case_id")
    return rc.unjudged(cases, done).select(F.col("case_id").alias("o_orderkey"))


def _longer(prompts):
    """A judge that prefers the longer response."""
    out = []
    for p in prompts:
        a, b = p.split("\n\n## Response A\n\n", 1)[1].rsplit("\n\n## Task", 1)[0].split("\n\n## Response B\n\n", 1)
        out.append('{"verdict": "%s"}' % ("A" if len(a) > len(b) else "B" if len(a) < len(b) else "tie"))
    return out


@query(f"""select concat(conv_id, '-', turn) as case_id, case when length(chosen) > length(rejected) then 'model_a' when length(chosen) < length(rejected) then 'model_b' else 'tie' end as final_verdict, false as position_bias_observed from ({V_PREF})""")
def judging_run(spark, d):
    """Two models' answers to the conversations' turns, judged once each and read from the sink; a first run stops at its limit."""
    turns = v_pref(spark, d).selectExpr("'chat' as suite", "concat(conv_id, '-', turn) as case_id", "prompt", "chosen", "rejected")
    side = lambda m, c: turns.select("suite", "case_id", F.lit(m).alias("model_id"), "prompt", F.col(c).alias("response"), F.lit(None).cast("string").alias("error"))
    responses = side("base", "chosen").unionByName(side("sft", "rejected"))
    cases = turns.selectExpr("suite", "case_id as id", "prompt", "'which is better' as intent")
    folder = shared_folder(spark, "judging")
    calls = jd.Calls(spark, f"{folder}/calls")
    for limit in (100, None):
        jd.run_judging(responses, cases, ["base", "sft"], "longer", _longer, calls, f"{folder}/judgements", limit)
    return jd.KeyedSink(f"{folder}/judgements", jd.JUDGED).rows(spark).select("case_id", "final_verdict", "position_bias_observed")


@query("select user_id as stream_id, count(*) as n_tokens, case when epoch(max(ts)) - epoch(min(ts)) >= 0.1 then round(count(*) / (epoch(max(ts)) - epoch(min(ts))), 1) end as tokens_per_s from events group by user_id")
def stream_rates(spark, d):
    seconds = lambda c: F.unix_micros(c) / 1e6
    e = _t(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    per = e.groupBy(F.col("user_id").alias("stream_id")).agg(F.count(F.lit(1)).alias("n_tokens"), (seconds(F.max("ts")) - seconds(F.min("ts"))).alias("s"))
    return per.select("stream_id", "n_tokens", tx.tokens_per_second(F.col("n_tokens"), F.col("s")).alias("tokens_per_s"))


@query("select doc_id from documents order by sha256(concat('7:', doc_id)), doc_id limit 15")
def seeded_sample(spark, d):
    return cu.sample(_t(spark, d, "documents").select("doc_id"), "doc_id", 15, 7)


# Records, suites, registry, and the whole build.


def _built(spark, d):
    from .build import build_dataset

    rows = v_turns(spark, d).select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("prompt").alias("instruction"), F.lit("").alias("input"), F.col("answer").alias("response"), F.lit("chat").alias("source"))
    return build_dataset(rows, "sft", "id", writer(spark), _t(spark, d, "benchmark").select(F.col("text").alias("prompt")), technical_only=True)


_CLEAN = r"trim(regexp_replace(nfc_normalize({c}), '[ \t]+', ' ', 'g'), ' ' || chr(10) || chr(9))"
_BUILD = f"""with r as (select conv_id * 1000 + turn as id, prompt as instruction, answer as response from ({V_TURNS})),
v as (select id, {_CLEAN.format(c='instruction')} as instruction, {_CLEAN.format(c='response')} as response from r where length(instruction) >= 5 and length(response) >= 5 and trim(instruction) <> '' and trim(response) <> ''),
k as (select * from v where length(instruction) >= 5 and length(response) >= 5 and regexp_matches(instruction, '{ANY_CONSUMING.replace("'", "''")}', 'i')),
u as (select min(id) as id, instruction, response from k group by instruction, response),
x as (select distinct unnest({_GRAMS}) as gram from (select {_TOKENS} as t from benchmark)),
g as (select id, unnest({_GRAMS}) as gram from (select id, {_TOKENS.replace('text', 'instruction')} as t from u)),
f as (select * from u where id not in (select id from g where gram in (select gram from x)))"""


@query(_BUILD + " select id, instruction, '' as input, response, 'chat' as source from f")
def dataset_build(spark, d):
    return _built(spark, d).rows


@query(_BUILD + """ select 0::bigint as stage_ord, 'loaded' as stage, count(*) as rows from r union all select 1, 'validated', count(*) from v union all select 2, 'quarantined', (select count(*) from r) - (select count(*) from v where length(instruction) >= 5 and length(response) >= 5)
union all select 3, 'after_keyword', count(*) from k union all select 4, 'after_dedup', count(*) from u union all select 5, 'after_decontamination', count(*) from f union all select 6, 'final', count(*) from f""")
def dataset_build_funnel(spark, d):
    return _built(spark, d).funnel


_ENC = "concat('+', length({c}), ':', {c})"
_KEYED = f"""{_BUILD}, d as (select instruction, '' as input, response, 'alpaca_cleaned' as source from f),
e as (select *, sha256(concat_ws(',', {', '.join(_ENC.format(c=c) for c in ('instruction', 'input', 'response', 'source'))})) as k from d)"""


@query(_KEYED + " select instruction, input, response, source, case when row_number() over (order by sha256(concat('42:', k)), k) <= greatest(1, floor((select count(*) from e) * 0.1)) then 'val' else 'train' end as split from e")
def dataset_artifact(spark, d):
    """The conversations' turns written as a source, built from there to a written dataset, resolved by its hash and read back."""
    from .build import build_from_sources

    folder = shared_folder(spark, "artifact")
    turns = v_turns(spark, d).select(F.col("prompt").alias("instruction"), F.lit("").alias("input"), F.col("answer").alias("output"))
    turns.write.json(f"{folder}/source.json")
    prompts = _t(spark, d, "benchmark").select(F.col("text").alias("prompt"))
    digest, _ = build_from_sources(spark, {"alpaca_cleaned": f"{folder}/source.json"}, "sft", f"{folder}/out", "turns", technical_only=True, eval_prompts=prompts)
    path = ld.resolve_dataset(spark, f"{folder}/out", digest)
    train, val = (spark.read.parquet(f"{path}/{p}").withColumn("split", F.lit(p)) for p in ("train", "val"))
    return train.unionByName(val)


_RESPONSES = "select l_orderkey as case_id, case l_linenumber % 2 when 1 then 'a' else 'b' end as model_id, l_linenumber::bigint * 100000000 + l_partkey * 100 + l_quantity::bigint as ord, l_quantity as n_tokens, case when l_partkey % 5 = 0 then '' when l_partkey % 7 = 0 then 'timeout' end as error from lineitem"


def _responses(spark, d):
    return _t(spark, d, "lineitem").selectExpr("l_orderkey as case_id", "case l_linenumber % 2 when 1 then 'a' else 'b' end as model_id", "cast(l_linenumber as long) * 100000000 + l_partkey * 100 + cast(l_quantity as long) as ord", "l_quantity as n_tokens", "case when l_partkey % 5 = 0 then '' when l_partkey % 7 = 0 then 'timeout' end as error")


@query(f"select case_id, model_id, arg_max(n_tokens, ord) as n_tokens, max(ord) as ord from ({_RESPONSES}) where error is null group by case_id, model_id")
def response_scan(spark, d):
    return rc.responses(_responses(spark, d), ["case_id", "model_id"], "ord").drop("error")


@query(f"select case_id, model_id, arg_max(n_tokens, ord) as n_tokens, max(ord) as ord from ({_RESPONSES}) where coalesce(error, '') = '' group by case_id, model_id")
def response_scan_report(spark, d):
    return rc.responses(_responses(spark, d), ["case_id", "model_id"], "ord", "coalesce(error, '') <> ''").drop("error")


@query(f"select model_id, count(*) filter (where error is null) as completed, count(*) filter (where error is not null) as failed from ({_RESPONSES}) group by model_id")
def generation_summary(spark, d):
    return rc.summary(_responses(spark, d), "model_id")


@query(f"select case_id, suite, final_verdict from ({V_FINAL}) where verdict_ab is not null")
def judgement_scan(spark, d):
    """Judgements written as JSON lines, with blank and bad lines among them, and read back."""
    lines = rc.judgement_json(v_final(spark, d).where("verdict_ab is not null"))
    bad = _t(spark, d, "region").selectExpr("case when r_regionkey % 2 = 0 then '  ' else '{\"case_id\": 1, \"suite\"' end as value")
    return rc.judgements(lines.unionByName(bad), "case_id long, suite string, final_verdict string")


@query(f"select suite, case_id from (select suite, case_id, row_number() over (partition by suite order by case_id) as n from ({V_JUDGE})) where n <= 50 and case_id % 3 <> 0")
def judging_todo(spark, d):
    cases = v_judge(spark, d).select("suite", "case_id")
    return rc.unjudged(cases, cases.where("case_id % 3 = 0"), 50)


@query(f"select conv_id, turn, concat('<|im_start|>user', chr(10), prompt, '<|im_end|>', chr(10), '<|im_start|>assistant', chr(10)) as prompt, concat('<|im_start|>user', chr(10), prompt, '<|im_end|>', chr(10), '<|im_start|>assistant', chr(10), chosen, '<|im_end|>', chr(10)) as chosen, concat('<|im_start|>user', chr(10), prompt, '<|im_end|>', chr(10), '<|im_start|>assistant', chr(10), rejected, '<|im_end|>', chr(10)) as rejected, source from ({V_PREF})")
def preference_render(spark, d):
    return ch.preference_render(v_pref(spark, d))


@query("select format('ae_{:03d}', n - 1) as id, text as prompt from (select text, row_number() over (order by sha256(concat('42:', item_id)), item_id) as n from benchmark) where n <= 60 and length(text) >= 10")
def suite_subset(spark, d):
    return rc.suite_subset(_t(spark, d, "benchmark"), "item_id", "text", 60, 10, "ae_%03d")


@query("select source as suite, count(*) as n_cases, count(*) filter (where n_chars % 2 = 0) as n_verifiable, count(*) filter (where lang = 'fr') as n_errors from documents group by source")
def suite_stats(spark, d):
    return rc.suite_stats(_t(spark, d, "documents").selectExpr("source as suite", "n_chars % 2 = 0 as verifiable", "case when lang = 'fr' then 'x' end as error"))


@query("select count(*) filter (where quality = 1) as positives, count(*) filter (where quality = 0) as negatives from labels")
def label_counts(spark, d):
    return rc.label_counts(_t(spark, d, "labels"), "quality")


@query("select doc_id, substr(text, 1, 500) as text from documents order by sha256(concat('42:', doc_id)), doc_id limit 25")
def label_sample(spark, d):
    return rc.label_sample(_t(spark, d, "documents"), "doc_id", "text", 25)


@query("select user_id as run, concat('runs/checkpoint-', max(event_id)) as path, max(event_id) as step from events where event_type <> 'click' group by user_id")
def latest_checkpoint(spark, d):
    files = _t(spark, d, "events").selectExpr("user_id as run", "concat('runs/checkpoint-', event_id) as path", "event_type <> 'click' as whole")
    return rc.latest_checkpoint(files.unionByName(files.selectExpr("run", "'runs/last' as path", "true as whole")))


@query("select o_orderkey as eval_id, o_custkey, c_name from orders left join (select c_custkey, c_name from customer where c_custkey % 2 = 0) on c_custkey = o_custkey order by o_orderkey desc limit 20")
def eval_listing(spark, d):
    reports = _t(spark, d, "orders").selectExpr("o_orderkey as eval_id", "o_custkey")
    metrics = reports.join(_t(spark, d, "customer").where("c_custkey % 2 = 0").selectExpr("c_custkey as o_custkey", "c_name"), "o_custkey").select("eval_id", "c_name")
    return rc.eval_listing(reports, metrics)


@query("select l_orderkey as run_id, l_linenumber as artifact_id, o_orderpriority as run_kind, o_orderstatus as status from lineitem join orders on o_orderkey = l_orderkey")
def artifact_join(spark, d):
    artifacts = _t(spark, d, "lineitem").selectExpr("l_orderkey as run_id", "l_linenumber as artifact_id", "l_shipdate as created_at")
    runs = _t(spark, d, "orders").selectExpr("o_orderkey as run_id", "o_orderpriority as kind", "o_orderstatus as status")
    return rc.artifacts_of(artifacts, runs).drop("created_at")


@query("""select o_orderkey as model_id, case when o_orderkey % 2 = 0 then 'ollama' else 'local' end as backend, a.ref from orders left join (select l_orderkey, l_returnflag, arg_min(concat('p/', l_partkey), struct_pack(t := l_shipdate, n := l_linenumber)) as ref from lineitem group by l_orderkey, l_returnflag) a
on a.l_orderkey = o_orderkey and a.l_returnflag = case when o_orderkey % 2 = 0 then 'R' else 'N' end""")
def publish_refs(spark, d):
    models = _t(spark, d, "orders").selectExpr("o_orderkey as model_id", "o_orderkey as run_id", "case when o_orderkey % 2 = 0 then 'ollama' else 'local' end as backend")
    # Lines of an order aren't told apart by their number: of those alike in date and number the first in the files is taken.
    place = "struct(l_linenumber is null as lost, l_linenumber as n, _metadata.file_path as file, _metadata.row_index as row) as artifact_id"
    artifacts = _t(spark, d, "lineitem").selectExpr("l_orderkey as run_id", "l_returnflag as kind", "concat('p/', coalesce(cast(l_partkey as string), '')) as path", "l_shipdate as created_at", place)
    return rc.publish_refs(models, artifacts, spark.createDataFrame([("ollama", "R"), ("local", "N")], "backend string, kind string"))


@query("select user_id as model_id, arg_max(event_type, event_id) as backend from events group by user_id having arg_max(event_id % 3, event_id) <> 0")
def served_models(spark, d):
    log = _t(spark, d, "events").selectExpr("user_id as model_id", "event_id as version", "int(event_id % 3 <> 0) as enabled", "event_type as backend", "user_id % 7 as sort_order")
    return rc.served(log).select("model_id", "backend")


@query("select c_custkey as model_id, case when c_custkey % 4 = 0 then null when c_custkey % 4 = 1 then 'echo' else c_mktsegment end as engine, c_custkey % 4 <> 0 as known from customer")
def engine_routing(spark, d):
    c = _t(spark, d, "customer")
    models = c.where("c_custkey % 4 <> 0").selectExpr("c_custkey as model_id", "case when c_custkey % 4 <> 1 then c_mktsegment end as backend")
    return rc.route(c.selectExpr("c_custkey as model_id"), models)


@query("select conv_id as session_id, list_transform(list_sort([struct_pack(h := sha256(concat('42:base:', conv_id)), c := 'base'), struct_pack(h := sha256(concat('42:sft:', conv_id)), c := 'sft'), struct_pack(h := sha256(concat('42:dpo:', conv_id)), c := 'dpo')]), lambda s: s.c)[1] as first from (select distinct conv_id from conversations)")
def blind_order(spark, d):
    sessions = _t(spark, d, "conversations").selectExpr("conv_id as session_id").distinct()
    return rc.blind_order(sessions, ["base", "sft", "dpo"]).select("session_id", F.col("columns")[0].alias("first"))


@query("""with e as (select doc_id, source, concat(' The | ', substr(text, 1, 6), 'zzz|der') as expected, text as response from documents where lang <> 'fr')
select source, doc_id, expected, substr(response, 1, 100) as got_preview from e where response is not null and expected <> '' and len(list_filter(string_split(lower(trim(expected)), '|'), lambda p: contains(lower(response), trim(p)))) = 0""")
def exact_match_failures(spark, d):
    e = _t(spark, d, "documents").selectExpr("source", "doc_id", "true as verifiable", "concat(' The | ', substr(text, 1, 6), 'zzz|der') as expected", "text as response", "case when lang = 'fr' then 'failed' end as error")
    return ev.exact_match_failures(e, "expected", "response", "source", "doc_id")


@query("select o_orderkey::varchar as run_id, o_orderpriority as kind, case when o_orderkey % 3 = 0 then 'failed' when o_orderkey % 3 = 1 then 'completed' else 'running' end as status, case when o_orderkey % 3 = 0 then concat('note ', o_custkey, ' | lost') else concat('note ', o_custkey) end as notes, case when o_orderkey % 5 = 0 then 'abc' end as git_sha from orders")
def registry_state(spark, d):
    """Runs that are started, completed, failed and changed in part, each in one write, and their state."""
    runs = _t(spark, d, "orders").selectExpr("cast(o_orderkey as string) as run_id", "o_orderkey as n", "o_orderpriority as kind", "concat('note ', o_custkey) as notes")
    registry = rg.Registry(spark, shared_folder(spark, "registry"))
    registry.start_runs(runs.select("run_id", "kind", "notes"))
    registry.put("runs", runs.where("n % 5 = 0").selectExpr("run_id", "'abc' as git_sha"))
    registry.complete_runs(runs.where("n % 3 = 1").selectExpr("run_id", "'now' as finished_at"))
    registry.fail(runs.where("n % 3 = 0").selectExpr("run_id", "'now' as finished_at", "'lost' as error"))
    return registry.table("runs").select("run_id", "kind", "status", "notes", "git_sha")


@query("""select 'sft-' || user_id as run_id, bool_or(event_type = 'click') as complete, max(event_id) filter (where event_type = 'view') as latest_step, max(ts) as modified from events where user_id % 2 = 0 group by user_id""")
def run_folders(spark, d):
    """Runs of a kind from a listing of their files."""
    e = _t(spark, d, "events")
    name = "case event_type when 'click' then 'adapter/adapter_config.json' when 'view' then concat('checkpoints/checkpoint-', event_id, '/trainer_state.json') else concat('checkpoints/checkpoint-', event_id, '/weights.bin') end"
    return rg.run_folders(e.selectExpr(f"concat(case when user_id % 2 = 0 then 'sft-' else 'dpo-' end, user_id, '/', {name}) as path", "ts as modified"), "sft")
