"""The extraction queue as functions from table to table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewrack.functions.text import not_blank
from tidewrack.operators import store, validate
from tidewrack.session import cut
from tidewrack.sources import paths

PLATFORMS = ("bluesky", "hackernews")


def _changed(posts: DataFrame, which: Column, status: str) -> tuple[DataFrame, DataFrame]:
    which = F.coalesce(which, F.lit(False))
    return posts.withColumn("extraction_status", F.when(which, status).otherwise(F.col("extraction_status"))), posts.agg(F.count_if(which).alias("changed"))


def skip_unextractable(posts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pending posts without text become skipped; also one row (changed)."""
    return _changed(posts, (F.col("extraction_status") == "pending") & ~not_blank(F.col("text")), "skipped")


def reopen(posts: DataFrame, insights: DataFrame, version: str, platforms: tuple[str, ...] = PLATFORMS) -> tuple[DataFrame, DataFrame]:
    """Done posts of the platforms whose insight is of the version become pending; also one row (changed)."""
    of = insights.filter(F.col("extractor_version") == version).select(F.col("post_id").alias("id"), F.lit(True).alias("_of")).distinct()
    new, count = _changed(posts.join(of, "id", "left"), F.col("_of") & (F.col("extraction_status") == "done") & F.col("platform").isin(*platforms), "pending")
    return new.select(*posts.columns), count


def pick(posts: DataFrame, n: int, platforms: tuple[str, ...] = PLATFORMS, only: DataFrame | None = None) -> DataFrame:
    """The next n pending posts with text, latest collected first; only: (id) limits to these. The limit is the batch's size."""
    rows = posts.filter((F.col("extraction_status") == "pending") & F.col("platform").isin(*platforms) & not_blank(F.col("text")))
    rows = rows if only is None else rows.join(only.select("id"), "id", "left_semi")
    return rows.orderBy(F.desc_nulls_last("collected_at"), "id").limit(n)


def mark(posts: DataFrame, ids: DataFrame, status: str) -> DataFrame:
    """posts with the status of the given ids set."""
    return posts.join(ids.select("id", F.lit(True).alias("_in")).distinct(), "id", "left").withColumn("extraction_status", F.when(F.col("_in"), status).otherwise(F.col("extraction_status"))).select(*posts.columns)


def batch_lines(batch: DataFrame) -> DataFrame:
    """(value): the JSON lines of a batch file."""
    at = F.date_format("posted_at", "yyyy-MM-dd'T'HH:mm:ss")
    return batch.select(F.to_json(F.struct("id", "platform", "text", at.alias("posted_at"), "matched_keywords"), {"ignoreNullFields": "false"}).alias("value"))


def batch_id(taken: set[str], now: datetime) -> str:
    """The first unused second from now on, as the batch's name."""
    while (name := f"{now:%Y%m%dT%H%M%S}") in taken:
        now += timedelta(seconds=1)
    return name


def instructions(template: str, values: dict[str, str]) -> str:
    """A template with its {names} filled in."""
    for k, v in values.items():
        template = template.replace("{" + k + "}", v)
    return template


def ledger_add(ledger: DataFrame, name: str, now: datetime, count: int, version: str) -> DataFrame:
    row = ledger.sparkSession.createDataFrame([(name, now, count, version, None, None)], ledger.schema)
    return ledger.unionByName(row)


def ledger_loaded(ledger: DataFrame, name: str, now: datetime, count: int) -> DataFrame:
    this = F.col("batch_id") == name
    return ledger.withColumns({"loaded_at": F.when(this, F.lit(now).cast("timestamp_ntz")).otherwise(F.col("loaded_at")), "loaded_count": F.when(this, F.lit(count)).otherwise(F.col("loaded_count"))})


def post_status(posts: DataFrame) -> DataFrame:
    return posts.groupBy("extraction_status").agg(F.count("*").alias("count"))


def open_batches(ledger: DataFrame) -> DataFrame:
    return ledger.filter("loaded_at IS NULL").select("batch_id", "post_count", "extractor_version").orderBy("batch_id")


def insight_domains(insights: DataFrame) -> DataFrame:
    return insights.groupBy(F.coalesce("domain", F.lit("(none)")).alias("domain")).agg(F.count("*").alias("count"))


def embeddable(insights: DataFrame, n: int) -> DataFrame:
    """The next n insights that need a vector, by post_id."""
    return insights.filter(F.col("embedding").isNull() & not_blank(F.col("summary"))).orderBy("post_id").limit(n)


@dataclass(frozen=True)
class Prepared:
    """What prepare() made; the tables are the new states, to be stored together."""

    batch_id: str
    posts: DataFrame
    ledger: DataFrame
    batch_path: str
    instruction_path: str
    result_path: str


def domain_guide(domains: list[dict]) -> str:
    """A vocabulary (id, label, boundary) as a list for people."""
    return "\n".join(f"- `{d['id']}` ({d.get('label') or d['id']})" + (f": {d['boundary']}" if d.get("boundary") else "") for d in domains)


def prepare(posts: DataFrame, insights: DataFrame, ledger: DataFrame, folder: str, n: int, version: str, template: str, domains: list[dict], now: datetime, platforms: tuple[str, ...] = PLATFORMS, reextract: str | None = None) -> Prepared | None:
    """Writes the next n posts as a batch with its instructions and moves them on: skip posts without text, reopen those of the version
    reextract (then only they count), pick, write both files, mark as batched, add to the ledger. None if nothing is pending; then nothing
    is reopened either. Files come first, so that no post is batched without one; a batch file that is in no ledger is harmless."""
    if not platforms:
        raise ValueError("no platforms")
    spark = posts.sparkSession
    state = skip_unextractable(posts)[0]
    only = None
    if reextract:
        state = reopen(state, insights, reextract, platforms)[0]
        only = insights.filter(F.col("extractor_version") == reextract).select(F.col("post_id").alias("id")).distinct()
    batch = cut(pick(state, n, platforms, only))
    count = batch.count()
    if not count:
        return None
    name = batch_id({r["batch_id"] for r in ledger.select("batch_id").collect()}, now)  # a row per batch ever made
    base = f"{folder.rstrip('/')}/{name}"
    at = (f"{base}.jsonl", f"{base}.md", f"{base}.result.jsonl")
    batch_lines(batch).write.mode("overwrite").text(at[0])
    paths.write_text(spark, at[1], instructions(template, {"batch_jsonl": at[0], "result_jsonl": at[2], "domain_ids": " | ".join(d["id"] for d in domains), "domain_guide": domain_guide(domains)}))
    return Prepared(name, mark(state, batch, "batched"), ledger_add(ledger, name, now, count, version), *at)


@dataclass(frozen=True)
class Loaded:
    """What load() made; the tables are the new states, to be stored together."""

    posts: DataFrame
    insights: DataFrame
    ledger: DataFrame
    accepted: int
    rejected: int
    cleared: int
    errors_path: str | None


def result_lines(spark, path: str) -> DataFrame:
    """(line_no, line) of a result file, from 1, blank lines counted."""
    rows = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("m"))
    # a batch's answers are one file of at most a batch's lines
    return rows.select(F.row_number().over(Window.partitionBy("f").orderBy("at", "m")).alias("line_no"), "line")


def load(posts: DataFrame, insights: DataFrame, ledger: DataFrame, folder: str, name: str, domains: list[str], now: datetime) -> Loaded:
    """Takes a batch's results in: valid lines become insights, their posts are done, the ledger has time and number, the rest goes into the
    errors file (if there is any). A missing file or a batch that isn't in the ledger raises before anything is written."""
    spark = posts.sparkSession
    base = f"{folder.rstrip('/')}/{name}"
    for p in (f"{base}.jsonl", f"{base}.result.jsonl"):
        if not paths.exists(spark, p):
            raise FileNotFoundError(p)
    entry = ledger.filter(F.col("batch_id") == name).first()
    if entry is None:
        raise ValueError(f"unknown batch: {name}")
    ids = spark.read.schema("id string").json(f"{base}.jsonl").filter("id IS NOT NULL").distinct()
    good, bad = validate.load(result_lines(spark, f"{base}.result.jsonl"), ids, domains)
    good, bad = cut(good), cut(bad)
    new = good.drop("line_no").withColumns({"confidence": F.col("confidence").cast("float"), "extractor_version": F.lit(entry["extractor_version"]), "extracted_at": F.lit(now).cast("timestamp_ntz")})
    errors, errors_path = bad.count(), None
    if errors:
        errors_path = f"{base}.errors.jsonl"
        validate.error_lines(bad).write.mode("overwrite").text(errors_path)
    accepted = good.count()
    cleared = store.cleared_embeddings(insights, new).first()["cleared"]
    return Loaded(mark(posts, good.select(F.col("post_id").alias("id")), "done"), store.upsert_insights(insights, new), ledger_loaded(ledger, name, now, accepted), accepted, errors, cleared, errors_path)
