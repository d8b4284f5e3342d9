"""Queries of the general training-data problems 1 and 4 over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack.operators import drift, timestamps
from tidewrack.session import spread, table
from tidewrack.sources import jsonlines


def p1_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every time text of the four sources with its instant, null where the text names none."""
    zones = timestamps.known_zones(spark)
    parts = [spread(table(spark, sf_dir, t).select(F.lit(t).alias("source"), F.col(k).cast("string").alias("record_key"), F.col(c).alias("value"), "writer_tz")) for t, k, c in (("posts", "row_id", "posted_at"), ("reddit_post", "row_no", "created_at"), ("hackernews_item", "row_no", "created_at"))]
    lines = table(spark, sf_dir, "bluesky_lines").withColumn("record_key", F.concat_ws("#", "file_name", "line_no"))
    lines = jsonlines.field_texts(lines, "line", "created_at", ["record_key", "writer_tz"])
    parts.append(lines.select(F.lit("bluesky_lines").alias("source"), "record_key", "value", "writer_tz"))
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    # coalesce() to as many partitions as there are changes nothing but keeps Catalyst from copying the expressions into each branch
    rows = rows.coalesce(rows.rdd.getNumPartitions())
    return timestamps.with_epoch_us(rows, "value", "writer_tz", "epoch_us", zones).select("source", "record_key", F.col("value").alias("time_text"), "epoch_us")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose time text names exactly one instant."""
    return p1_times(spark, sf_dir).filter("epoch_us IS NOT NULL").select("source", "record_key", "epoch_us")


#: Columns of the landing record and how each value is made to fit.
BLUESKY_COLUMNS = {
    "post_id": "string", "keyword": "string", "text": "string", "author_handle": "string", "author_display_name": "string", "author_did": "did",
    "lang": "strings", "like_count": "long", "repost_count": "long", "reply_count": "long", "created_at": "string", "indexed_at": "string",
    "url": "string", "collected_at": "string", "raw": "json",
}


def p4_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each change of a field at each file, with how alike the two fields of a rename are."""
    return drift.changes(drift.profiles(table(spark, sf_dir, "bluesky_lines"), "file_name", "line"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each change of a field at each file."""
    return p4_changes(spark, sf_dir).drop("likeness")


def p4_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All landing lines as one table under the known names, whatever a file called or typed its fields."""
    renames = p4_changes(spark, sf_dir).filter("change = 'renamed'").select("field", "new_field").distinct()
    names = drift.name_groups([(r.field, r.new_field) for r in renames.collect()], list(BLUESKY_COLUMNS))
    return drift.unified(table(spark, sf_dir, "bluesky_lines"), "file_name", "line", ["file_name", "line_no"], names, BLUESKY_COLUMNS)


def queries() -> dict:
    return {"p1_found": p1_found, "p1_times": p1_times, "p4_found": p4_found, "p4_changes": p4_changes, "p4_table": p4_table}
