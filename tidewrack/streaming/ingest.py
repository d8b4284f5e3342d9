"""Landing files as a stream into the posts table; each run takes what is new and stops.

The result equals one batch load of all files: rows are ordered by file date, file and place in the file, not by arrival, and the upsert is
idempotent, so a batch that is replayed after a failure changes nothing. History has no end: known rows are in the table, not in the
stream's state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack.operators import normalize, store
from tidewrack.sources import paths

ORDERED = "id string, platform string, native_id string, author_id string, author_handle string, text string, url string, lang string, posted_at timestamp_ntz, collected_at timestamp_ntz, matched_keywords array<string>, metrics string, raw string, extraction_status string, seq string"


class Table:
    """A table as numbered Parquet versions; the greatest one that is complete counts (Spark's mark is written last). A new version is written
    beside the old ones, of which the last stays for readers that are under way."""

    def __init__(self, spark: SparkSession, path: str, schema: str) -> None:
        self.spark, self.path, self.schema = spark, path, schema

    def versions(self) -> list[int]:
        names = [p.rsplit("/", 1)[-1] for p in paths.listed(self.spark, self.path)]
        return sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit() and paths.exists(self.spark, f"{self.path}/{n}/_SUCCESS"))

    def read(self) -> DataFrame:
        v = self.versions()
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/v{v[-1]}") if v else self.spark.createDataFrame([], self.schema)

    def write(self, df: DataFrame) -> None:
        v = self.versions()
        df.write.mode("overwrite").parquet(f"{self.path}/v{v[-1] + 1 if v else 0}")
        for old in v[:-1]:
            paths.delete(self.spark, f"{self.path}/v{old}")


def merged(posts: DataFrame, incoming: DataFrame) -> DataFrame:
    """posts and incoming rows by id, with seq texts that order all rows ever seen: the greatest gives the normalised columns, stored rows
    the status, all the keywords."""
    rows = posts.withColumn("stored", F.lit(True)).unionByName(incoming.withColumn("stored", F.lit(False)))
    status = F.max_by("extraction_status", F.struct("stored", F.col("seq")))
    words = rows.select("id", F.explode("matched_keywords").alias("k")).groupBy("id").agg(F.array_sort(F.collect_set("k")).alias("w"))
    last = F.max_by(F.struct("platform", "native_id", *store.POST_COLUMNS), F.struct("seq"))
    one = rows.groupBy("id").agg(last.alias("l"), status.alias("extraction_status"), F.max("seq").alias("seq")).join(words, "id", "left")
    return one.select("id", "l.*", "extraction_status", "seq", F.coalesce("w", F.array().cast("array<string>")).alias("matched_keywords")).select(*posts.columns)


def incoming(lines: DataFrame, platform: str) -> tuple[DataFrame, DataFrame]:
    """(posts with seq, rejects) of lines (line, file, m)."""
    rows = lines.filter(F.col("file").rlike(rf"/{platform}/[^/]*\.jsonl(/[^/]*)?$")).withColumn("name", F.regexp_extract("file", r"([^/]*\.jsonl(?:/[^/]*)?)$", 1))
    good, bad = normalize.normalize(rows, platform)
    order = F.concat_ws("|", "name", F.lpad(F.col("m").cast("string"), 20, "0"))
    return good.withColumn("seq", order).drop("file", "m", "name"), bad


def run(spark: SparkSession, root: str, table: Table, checkpoint: str, rejects: str | None = None, platforms: tuple[str, ...] = tuple(normalize.PLATFORMS)) -> None:
    """Takes all new files under root into the table and returns."""
    lines = spark.readStream.schema("value string").option("recursiveFileLookup", "true").text(root)
    lines = lines.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))

    def each(batch: DataFrame, number: int) -> None:
        batch = batch.withColumn("m", F.monotonically_increasing_id() % (1 << 33)).persist()
        all_new, all_bad = None, None
        for p in platforms:
            new, bad = incoming(batch, p)
            bad = bad.select(F.lit(p).alias("platform"), "file", "line")
            all_new, all_bad = (new, bad) if all_new is None else (all_new.unionByName(new), all_bad.unionByName(bad))
        table.write(merged(table.read(), all_new.select(*table.read().columns)))
        if rejects:
            all_bad.write.mode("overwrite").json(f"{rejects}/{number}")
        batch.unpersist()

    lines.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(each).start().awaitTermination()
