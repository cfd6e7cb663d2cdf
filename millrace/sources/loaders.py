"""Sources: declarative specs that become a select list, validation with quarantine, suites, logs, parsers of streams."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..schemas import EVAL_CASE, preference_error, sft_error
from ..functions.text import strip


@dataclass(frozen=True)
class SourceSpec:
    """An adapter: our column <- theirs; optional kept categories; whether chosen and rejected are message lists, and rows are turns of threads."""

    name: str
    kind: str
    field_map: dict = field(default_factory=dict)
    categories_keep: tuple = ()
    message_lists: bool = False
    transcript: bool = False
    threads: bool = False
    revision: str = "main"
    split: str = "train"


#: The sources' names, field names, splits and kept categories.
_SFT = {"instruction": "instruction", "input": "input", "response": "output"}
_PREF = {c: c for c in ("prompt", "chosen", "rejected")}
CATALOG = {
    s.name: s
    for s in (
        SourceSpec("alpaca_cleaned", "sft", _SFT),
        SourceSpec("code_alpaca", "sft", _SFT),
        SourceSpec("dolly_15k", "sft", {"instruction": "instruction", "input": "context", "response": "response"}, ("closed_qa", "information_extraction", "general_qa", "classification", "summarization")),
        SourceSpec("oasst1", "sft", {"instruction": "parent_text", "response": "text"}, threads=True),
        SourceSpec("ultrafeedback", "preference", _PREF, message_lists=True, split="train_prefs"),
        SourceSpec("py_dpo", "preference", _PREF, message_lists=True),
        SourceSpec("anthropic_hh", "preference", _PREF, transcript=True),
    )
}


def with_order(df: DataFrame, *by: str) -> DataFrame:
    """_ord: the position by the given columns; list order has to be carried, a DataFrame has none."""
    return df.withColumn("_ord", F.struct(*by))


def last_assistant(messages: Column) -> Column:
    """The last assistant message, null without one (such rows are quarantined)."""
    said = F.filter(messages, lambda m: m["role"] == "assistant")
    return F.when(F.size(said) > 0, F.element_at(said, -1)["content"])


def parse_transcript(text: Column) -> tuple[Column, Column]:
    """(prompt, answer) of a dialogue's last human turn; null where there's no answer."""
    last = F.element_at(F.split(text, "\n\nHuman: ", -1), -1)
    parts = F.split(last, "\n\nAssistant: ", 2)
    whole = F.size(parts) == 2
    return F.when(whole, strip(F.element_at(parts, 1))), F.when(whole, strip(F.element_at(parts, 2)))


def oasst_rows(df: DataFrame) -> DataFrame:
    """English assistant answers of rank 0 or none, with their parent's text."""
    kept = df.where("lang = 'en' and role = 'assistant' and (rank is null or rank = 0) and coalesce(parent_id, '') <> ''")
    return kept.join(df.select(F.col("message_id").alias("parent_id"), F.col("text").alias("parent_text")), "parent_id", "left")


def adapt(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """The spec's columns, a missing column as empty text, and ``error`` (null if valid)."""
    if spec.categories_keep:
        df = df.where(F.col("category").isin(*spec.categories_keep))
    if spec.transcript:
        prompt, chosen = parse_transcript(F.col("chosen"))
        _, rejected = parse_transcript(F.col("rejected"))
        df = df.withColumns({"prompt": prompt, "chosen": chosen, "rejected": rejected})
    ours = ("instruction", "input", "response") if spec.kind == "sft" else ("prompt", "chosen", "rejected")
    columns = []
    for c in ours:
        theirs = spec.field_map.get(c)
        value = F.col(theirs) if theirs in df.columns else F.lit("")
        listed = theirs in df.columns and isinstance(df.schema[theirs].dataType, ArrayType)  # plain texts are taken as they are
        columns.append((last_assistant(value) if spec.message_lists and listed else value).cast("string").alias(c))
    kept = [c for c in ("_ord",) if c in df.columns]
    out = df.select(*kept, *columns, F.lit(spec.name).alias("source"))
    return out.withColumn("error", sft_error() if spec.kind == "sft" else preference_error())


def route(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantine records)."""
    fields = [c for c in df.columns if c not in ("error", "_ord")]
    bad = df.where("error is not null").select(F.to_json(F.struct(*fields)).alias("raw"), "source", "error", F.lit("validation").alias("stage"))
    return df.where("error is null").drop("error"), bad


def source_path(path: str, spec: SourceSpec) -> str:
    """Where a source's rows are: the path with its revision and split put in where it names them."""
    return path.replace("{revision}", spec.revision).replace("{split}", spec.split)


def load_source(spark: SparkSession, path: str, spec: SourceSpec, limit: int | None = None) -> DataFrame:
    """The source's rows by its spec; a limit takes the first rows of its files, in their order, before any is left out."""
    path = source_path(path, spec)
    df = spark.read.json(path) if path.endswith((".json", ".jsonl")) else spark.read.parquet(path)
    if limit is not None:
        # a block's rows have growing numbers, whichever task reads it
        place = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()]
        at = df.select("*", *(c.alias(f"_at{i}") for i, c in enumerate(place)))
        df = at.orderBy("_at0", "_at1", "_at2").limit(limit).drop("_at0", "_at1", "_at2")
    return adapt(oasst_rows(df) if spec.threads else df, spec)


def load_all(spark: SparkSession, paths: dict[str, str], limit: int | None = None, catalog: dict[str, SourceSpec] = CATALOG) -> DataFrame:
    """Sources of either kind in order, the limit for each; ``kind`` tells which columns a row has, the other kind's are null.

    Unknown names are skipped, and no known one raises ValueError.  ``of_kind`` gives one kind's rows with its own columns.
    """
    known = [(name, path) for name, path in paths.items() if name in catalog]
    if not known:
        raise ValueError(f"no known source among {sorted(paths)}")
    parts = [load_source(spark, path, catalog[name], limit).withColumns({"kind": F.lit(catalog[name].kind), "source_ord": F.lit(k)}) for k, (name, path) in enumerate(known)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def of_kind(df: DataFrame, kind: str) -> DataFrame:
    """The rows of a kind, without the other kind's columns."""
    other = ("prompt", "chosen", "rejected") if kind == "sft" else ("instruction", "input", "response")
    return df.where(F.col("kind") == kind).drop("kind", *other)


#: The least numbers of cases of the suites.
SUITE_MINIMUMS = {"domain_v1": 20, "mtbench_sub": 20, "alpacaeval_sub": 30}


def load_suite(spark: SparkSession, name: str, folder: str, limit: int | None = None) -> DataFrame:
    """Valid cases of a JSONL suite; blank and bad lines are dropped and the limit counts valid ones; no file, no rows."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.jsonl")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], EVAL_CASE)
    rows = spark.read.text(f"{folder}/{name}.jsonl").where(strip(F.col("value")) != "")
    case = rows.select(F.monotonically_increasing_id().alias("_ord"), F.from_json("value", EVAL_CASE).alias("c")).select("_ord", "c.*")
    case = case.withColumns({"suite": F.lit(name), "difficulty": F.coalesce("difficulty", F.lit(2)), "verifiable": F.coalesce("verifiable", F.lit(False)), "category": F.coalesce("category", F.lit(""))})
    good = case.where("id is not null and intent is not null and length(prompt) >= 5 and difficulty between 1 and 3").orderBy("_ord")
    return (good.limit(limit) if limit else good).drop("_ord")


def load_suites(spark: SparkSession, names: list[str], folder: str, limit: int | None = None) -> DataFrame:
    """The cases of several suites, the limit for each; no names, no rows."""
    return reduce(DataFrame.unionByName, [load_suite(spark, n, folder, limit) for n in names], spark.createDataFrame([], EVAL_CASE))


def incomplete_suites(cases: DataFrame, minimums: dict[str, int] = SUITE_MINIMUMS) -> DataFrame:
    """Suites with fewer cases than wanted: suite, wanted, found."""
    wanted = cases.sparkSession.createDataFrame([*minimums.items()], "suite string, wanted long")
    found = wanted.join(cases.groupBy("suite").agg(F.count(F.lit(1)).alias("found")), "suite", "left").withColumn("found", F.coalesce("found", F.lit(0)))
    return found.where("found < wanted")


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key; order must be total for a repeatable result."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")).select(*keys, "_last.*")


def log_records(lines: DataFrame, event: str | None = None, key: str | None = None, run_id: str | None = None) -> DataFrame:
    """JSON log lines (value) as maps; cheap substring tests come before the parse, bad lines are skipped.  Batch or stream."""
    for text in (event, key, run_id):
        if text:
            lines = lines.where(F.col("value").contains(text))
    rows = lines.select(F.from_json("value", "map<string,string>").alias("r")).where("r is not null and size(r) > 0")
    if event:
        rows = rows.where(F.col("r")["event"] == event)
    if key:
        rows = rows.where(F.map_contains_key("r", key))
    if run_id:
        rows = rows.where(F.col("r")["run_id"] == run_id)
    return rows


def sse_content(lines: DataFrame, *streams: str) -> DataFrame:
    """Deltas of server-sent event frames (value) by position _ord, up to [DONE]; with stream columns each stream's up to its own."""
    data = lines.where(F.col("value").startswith("data: ")).withColumn("value", F.expr("substring(value, 7)"))
    end = data.where(F.trim("value") == "[DONE]").groupBy(*streams).agg(F.min("_ord").alias("_end"))  # a row a stream
    body = data.join(end, [*streams], "left") if streams else data.crossJoin(F.broadcast(end))
    body = body.where("(_end is null or _ord < _end)")
    return body.select(*streams, "_ord", F.get_json_object("value", "$.choices[0].delta.content").alias("content")).where("content is not null")


def ndjson_content(lines: DataFrame, *streams: str) -> DataFrame:
    """Texts of JSON lines and whether each says that its stream is done; unreadable lines say nothing."""
    read = F.get_json_object
    return lines.select(*streams, "_ord", read("value", "$.message.content").alias("content"), F.coalesce(read("value", "$.done").cast("boolean"), F.lit(False)).alias("done")).where("content is not null or done")


def manifests(spark: SparkSession, folder: str) -> DataFrame:
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "manifest.json").load(folder)
    return found.select("path", F.col("modificationTime").alias("modified"), F.get_json_object(F.col("content").cast("string"), "$.content_hash").alias("content_hash"))


def new_manifests(now: DataFrame, before: DataFrame) -> DataFrame:
    return now.join(before, ["path", "modified"], "left_anti")


def resolve_dataset(spark: SparkSession, folder: str, wanted: str, registry: DataFrame | None = None) -> str:
    """The folder of the dataset with a content hash: the registry's (content_hash, path) if it has one, else by the manifests.

    The rows that are there are hashed again; raises LookupError if no dataset has the hash, ValueError if its rows don't.
    """
    from ..operators.curation import content_hash

    row = registry.where(F.col("content_hash") == wanted).orderBy("path").select("path").first() if registry is not None else None
    if row is None:
        found = manifests(spark, folder).where(F.col("content_hash") == wanted).orderBy("path").first()
        if found is None:
            raise LookupError(f"no dataset {wanted}")
        row = {"path": found["path"].rsplit("/", 1)[0]}
    manifest = spark.read.format("binaryFile").load(f"{row['path']}/manifest.json").select(F.from_json(F.col("content").cast("string"), "key string, columns array<string>, n_train long, n_val long").alias("m")).first()["m"]
    parts = [spark.read.parquet(f"{row['path']}/{p}").withColumn("split", F.lit(p)) for p in ("train", "val") if manifest[f"n_{p}"]]
    there = content_hash(reduce(DataFrame.unionByName, parts), [c for c in manifest["columns"] if c != manifest["key"]] + ["split"]).first()["content_hash"] if parts else wanted
    if there != wanted:
        raise ValueError(f"{row['path']} should hold {wanted} but holds {there}")
    return row["path"]


def last_hash_token(text: Column) -> Column:
    """The last hexadecimal token of 8 to 64 digits, null without one."""
    return F.try_element_at(F.regexp_extract_all(text, F.lit(r"\b[0-9a-f]{8,64}\b"), F.lit(0)), F.lit(-1))
