"""The landing zone: <root>/<platform>/<date>.jsonl, append only. An entry is a file, or a folder of part files as this engine writes it."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack.operators import normalize, store
from tidewrack.sources import paths

LINE_SCHEMA = "value string"
ORIGIN = "line string, file string, file_date date, seq struct<date:string,name:string,at:bigint,m:bigint>"


def entries(spark: SparkSession, root: str, platform: str, since: date | None = None) -> tuple[list[str], int]:
    """(paths, unreadable): a platform's entries in order of name, and how many of them may not be read and are left out. Entries dated before
    since are left out by their name, without being opened; those whose name is no date stay. A missing folder has none."""
    found = [p for p in paths.listed(spark, f"{root.rstrip('/')}/{platform}") if p.endswith(".jsonl")]

    def wanted(path: str) -> bool:
        try:
            return since is None or date.fromisoformat(path.rsplit("/", 1)[-1].removesuffix(".jsonl")) >= since
        except ValueError:
            return True

    found = [p for p in found if wanted(p)]
    fine = [p for p in found if paths.readable(spark, p)]
    return fine, len(found) - len(fine)


def with_origin(lines: DataFrame) -> DataFrame:
    """Lines read from files with file (the entry), file_date (null if the name has none) and seq, which orders them by date, name and place in
    the file (a file may be read in parts)."""
    rows = lines.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), (F.monotonically_increasing_id() % (1 << 33)).alias("m"))
    date_ = F.regexp_extract("path", r"(\d{4}-\d{2}-\d{2})\.jsonl(?:/[^/]*)?$", 1)
    name = F.regexp_extract("path", r"([^/]*\.jsonl(?:/[^/]*)?)$", 1)
    return rows.withColumns({"file": F.regexp_replace("path", r"(\.jsonl)/[^/]*$", "$1"), "file_date": date_.try_cast("date"), "seq": F.struct(date_.alias("date"), name.alias("name"), "at", "m")}).select("line", "file", "file_date", "seq")


def read(spark: SparkSession, root: str, platform: str, since: date | None = None) -> DataFrame:
    """(line, file, file_date, seq) of a platform's entries (see entries()). Of a file that stops being UTF-8 the lines before that place count."""
    found, _ = entries(spark, root, platform, since)
    return _valid(_lines(spark, found))


def _lines(spark: SparkSession, found: list[str]) -> DataFrame:
    return with_origin(spark.read.option("ignoreCorruptFiles", "true").text(found)) if found else spark.createDataFrame([], ORIGIN)


def broken(rows: DataFrame) -> DataFrame:
    """(file, stop): entries with bytes that aren't UTF-8, and the first place of such."""
    return rows.filter(~F.is_valid_utf8("line")).groupBy("file").agg(F.min("seq").alias("stop"))


def _valid(rows: DataFrame) -> DataFrame:
    return rows.join(broken(rows), "file", "left").filter("stop IS NULL OR seq < stop").select("line", "file", "file_date", "seq")


def load_all(spark: SparkSession, root: str, posts: DataFrame, since: date | None = None, platforms: tuple[str, ...] = tuple(normalize.PLATFORMS)) -> tuple[DataFrame, DataFrame]:
    """(posts after the load, one row per platform: platform, files, inserted, updated, skipped). All platforms go through one upsert, as
    their ids differ. Skipped are lines that can't be mapped and entries that can't be read, or not to their end."""
    good, bad, files = [], [], []
    for p in platforms:
        found, unreadable = entries(spark, root, p, since)
        rows = _lines(spark, found)
        new, rejects = normalize.normalize(_valid(rows), p)
        good.append(new)
        bad.append(rejects.select(F.lit(p).alias("platform")).unionAll(broken(rows).select(F.lit(p).alias("platform"))))
        files.append((p, len(found) + unreadable, unreadable))
    new = reduce(DataFrame.unionByName, good)
    known = posts.select("id", F.lit(True).alias("known"))
    per = new.groupBy("platform", "id").agg(F.count("*").alias("n")).join(known, "id", "left").groupBy("platform").agg(F.count_if(F.col("known").isNull()).alias("inserted"), F.sum("n").alias("n"))
    skipped = reduce(DataFrame.unionAll, bad).groupBy("platform").agg(F.count("*").alias("s"))
    counts = spark.createDataFrame(files, "platform string, files int, unreadable int").join(per, "platform", "left").join(skipped, "platform", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    inserted = zero(F.col("inserted"))
    return store.upsert_posts(posts, new, "seq"), counts.select("platform", "files", inserted.alias("inserted"), (zero(F.col("n")) - inserted).alias("updated"), (zero(F.col("s")) + F.col("unreadable")).alias("skipped"))


def load_platform(spark: SparkSession, root: str, platform: str, posts: DataFrame, since: date | None = None) -> tuple[DataFrame, DataFrame]:
    """load_all() of one platform."""
    return load_all(spark, root, posts, since, (platform,))


def to_lines(records: DataFrame) -> DataFrame:
    """(value): records as JSON lines."""
    return records.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def append(records: DataFrame, root: str, platform: str, today: date) -> str:
    """Adds records to the platform's lines of the day, as part files in the folder <date>.jsonl, and gives its path. Where the day's entry is a
    file already, it moves into that folder first."""
    path = f"{root.rstrip('/')}/{platform}/{today:%Y-%m-%d}.jsonl"
    paths.as_folder(records.sparkSession, path, "part-0000-before.txt")
    to_lines(records).write.mode("append").text(path)
    return path


def overwrite(records: DataFrame, path: str) -> None:
    """Writes records as JSON lines in place of what is at the path."""
    to_lines(records).write.mode("overwrite").text(path)
