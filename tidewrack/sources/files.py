"""Text files: logs, reports, documents, gates, and configurations given as Python values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def whole(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(file, text) of whole files; a missing folder gives no rows."""
    try:
        rows = spark.read.option("wholetext", "true").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "file string, text string")
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


def logs(spark: SparkSession, path: str) -> DataFrame:
    return whole(spark, path, "*.log")


def event_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value) of a JSON-lines file; a missing file gives no rows. Bytes that aren't UTF-8 become replacement characters."""
    try:
        return spark.read.text(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "value string")


def reports(spark: SparkSession, path: str) -> DataFrame:
    """(path, title, modified, size) of Markdown files, last names first, without reading them."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.md").option("recursiveFileLookup", "true").load(path).select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))
    return rows.withColumn("title", F.regexp_replace(F.regexp_extract("path", r"([^/]*)$", 1), r"\.md$", "")).select("path", "title", "modified", "size").orderBy(F.desc("path"))


def batch_ids(spark: SparkSession, path: str) -> DataFrame:
    """(id) of a batch file."""
    return spark.read.schema("id string").json(path).filter("id IS NOT NULL").distinct()


def numbered_lines(files: DataFrame) -> DataFrame:
    """(file, line_no, line) from 1, blank lines counted, of whole files."""
    return files.select("file", F.posexplode(F.split("text", r"\r\n|\n|\r")).alias("p", "line")).select("file", (F.col("p") + 1).alias("line_no"), "line")


def gates(files: DataFrame) -> DataFrame:
    """(name, command, stage, interactive) of hook files (file, text): a heading opens a stage, a list item a job; what follows belongs to it.
    Jobs without a command are left out; one without a name takes its command."""
    lines = numbered_lines(files)
    heading, item = r"^([a-z][a-z0-9-]*):\s*$", r"^\s*-\s*(name|run):\s*(.+?)\s*$"
    w = Window.partitionBy("file").orderBy("line_no")
    rows = lines.withColumns({"h": F.nullif(F.regexp_extract("line", heading, 1), F.lit("")), "starts": F.col("line").rlike(heading) | F.col("line").rlike(item)})
    rows = rows.withColumns({"stage": F.last("h", ignorenulls=True).over(w), "job": F.sum(F.when(F.col("starts"), 1).otherwise(0)).over(w)})
    value = lambda k: F.nullif(F.regexp_extract("line", rf"^(?:\s*-\s*|\s+){k}:\s*(.+?)\s*$", 1), F.lit(""))
    first = lambda k: F.min_by(value(k), F.when(value(k).isNotNull(), F.col("line_no")))
    jobs = rows.groupBy("file", "stage", "job").agg(first("name").alias("name"), first("run").alias("command"), F.bool_or(F.col("line").rlike(r"^\s*-?\s*interactive:\s*true\s*$")).alias("interactive"))
    return jobs.filter("stage IS NOT NULL AND command IS NOT NULL").select(F.coalesce("name", "command").alias("name"), "command", "stage", "interactive")


def steps(files: DataFrame, contains: str = "scripts/") -> DataFrame:
    """The same of a pipeline's file: steps whose command contains the text, at stage CI."""
    pattern = r"(?m)^\s+-\s*name:\s*(.+?)\s*\n\s+run:\s*(.+?)\s*$"
    both = F.zip_with(F.regexp_extract_all("text", F.lit(pattern), 1), F.regexp_extract_all("text", F.lit(pattern), 2), lambda n, c: F.struct(n.alias("name"), c.alias("command")))
    return files.select(F.explode(both).alias("s")).select("s.name", "s.command", F.lit("CI").alias("stage"), F.lit(False).alias("interactive")).filter(F.col("command").contains(contains))


def documents(files: DataFrame, order: list[tuple[str, str]]) -> DataFrame:
    """(slug, title, text) of the files whose path ends as listed (ending, title), in that order; missing ones are left out."""
    spark = files.sparkSession
    wanted = spark.createDataFrame([(i, e, t) for i, (e, t) in enumerate(order)], "n int, slug string, title string")
    return files.join(F.broadcast(wanted), files["file"].endswith(wanted["slug"])).orderBy("n").select("slug", "title", "text")


def option(values: dict, key: str, default, kind: type = str):
    """A typed value of a configuration: missing or empty gives the default, whole numbers must be at least 1."""
    v = values.get(key)
    if v is None or v == "" or v == []:
        return default
    if kind is int and (isinstance(v, bool) or not isinstance(v, int) or v < 1):
        raise ValueError(f"{key} must be a whole number from 1 on: {v!r}")
    if kind is list and not (isinstance(v, list) and all(isinstance(x, str) for x in v)):
        raise ValueError(f"{key} must be a list of texts: {v!r}")
    return str(v) if kind is str else v


def vocabulary(spark: SparkSession, entries: list[dict]) -> DataFrame:
    """(id, label, boundary) of a domain vocabulary; a missing or repeated id raises."""
    ids = [e.get("id") for e in entries]
    if not all(ids) or len(set(ids)) < len(ids):
        raise ValueError("ids of a vocabulary must be there and differ")
    return spark.createDataFrame([(e["id"], e.get("label") or e["id"], e.get("boundary")) for e in entries], "id string, label string, boundary string")


@dataclass(frozen=True)
class Collector:
    """A collector's settings: keywords, and its options with their values."""

    name: str
    keywords: list[str]
    options: dict


# The options of each collector with their defaults, and the settings that must come from the environment.
COLLECTORS = {
    "bluesky": {"sort": "latest", "limit_per_keyword": 50},
    "youtube": {"order": "relevance", "max_results_per_keyword": 25, "region_code": "JP", "relevance_language": "ja"},
    "hackernews": {"tags": "(story,comment)", "hits_per_page": 50},
    "hnjobs": {"thread_kinds": ["hiring", "freelancer"], "thread_limit": 3, "hits_per_page": 50},
    "github": {"qualifiers": "is:issue", "per_page": 50},
    "reddit": {"sort": "new", "time_filter": "month", "limit_per_keyword": 50},
}
REQUIRED = {"youtube": ("YOUTUBE_API_KEY",), "reddit": ("REDDIT_CLIENT_ID", "REDDIT_CLIENT_SECRET", "REDDIT_USER_AGENT")}


def collector(values: dict, name: str, environment: dict[str, str] | None = None) -> Collector:
    """A collector's settings out of a configuration given as Python values (name: {keywords, options}). Without keywords, with an option of
    the wrong kind or without a required setting of the environment it raises. The environment's values aren't kept."""
    missing = [k for k in REQUIRED.get(name, ()) if not (environment or {}).get(k)]
    if missing:
        raise ValueError(f"{name} needs {', '.join(missing)}")
    own = values.get(name) or {}
    if not own.get("keywords"):
        raise ValueError(f"{name} has no keywords")
    return Collector(name, list(own["keywords"]), {k: option(own, k, d, type(d)) for k, d in COLLECTORS[name].items()})
