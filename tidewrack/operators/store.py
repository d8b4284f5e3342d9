"""State of the store: upserts without a table format, as full rewrites of the touched table.

Every upsert takes the stored rows and the incoming rows with a sequence column that orders the incoming ones (file date, file, line), so
the result doesn't depend on arrival and a replayed batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

POST_COLUMNS = ("author_id", "author_handle", "text", "url", "lang", "posted_at", "collected_at", "metrics", "raw")
_KEPT = ("platform", "native_id", "extraction_status")


def upsert_posts(existing: DataFrame | None, incoming: DataFrame, seq: str) -> DataFrame:
    """Posts by id: the last incoming row gives the normalised columns, the first known row the platform, the identifier and the status,
    and keywords are the union of all. Null ids are left out. incoming: the columns of posts and seq (any type that sorts, not null).

    One aggregation by id. Each column is an aggregate of its own, so a query on the result reads only the columns it asks for; keywords are
    collected as distinct lists, so repeats of a hot id are combined before the shuffle.
    """
    columns = ["id", *POST_COLUMNS, *_KEPT, "matched_keywords"]
    rows = incoming.select(*columns, F.col(seq).alias("_seq"))
    order = F.col("_seq")
    if existing is not None:
        rows = existing.select(*columns, F.lit(None).cast(incoming.schema[seq].dataType).alias("_seq")).unionByName(rows)
        # a stored row has no sequence: it comes before all others
        order = F.struct(F.col("_seq").isNotNull(), "_seq")
    words = F.array_sort(F.array_distinct(F.array_compact(F.flatten(F.collect_set("matched_keywords")))))
    one = rows.filter(F.col("id").isNotNull()).groupBy("id").agg(*[F.min_by(c, order).alias(c) for c in _KEPT], *[F.max_by(c, order).alias(c) for c in POST_COLUMNS], words.alias("matched_keywords"))
    return one.select("id", "platform", "native_id", *POST_COLUMNS, "matched_keywords", "extraction_status")


def load_counts(existing_ids: DataFrame, incoming: DataFrame) -> DataFrame:
    """One row (inserted, updated): ids not known before, and rows that hit a known one, repeats within the batch included."""
    new = incoming.select("id").distinct().join(existing_ids.select("id"), "id", "left_anti").agg(F.count("*").alias("inserted"))
    return new.crossJoin(incoming.agg(F.count("*").alias("n"))).select("inserted", (F.col("n") - F.col("inserted")).alias("updated"))


def known_ids(posts: DataFrame, platform: str) -> DataFrame:
    """The identifiers seen on a platform, over all history."""
    return posts.filter(F.col("platform") == platform).select("native_id").distinct()


def keyword_rows(posts: DataFrame, platform: str) -> DataFrame:
    """(matched_keywords, text) of a platform."""
    return posts.filter(F.col("platform") == platform).select("matched_keywords", "text")


def record_keyword_hits(posts: DataFrame, hits: DataFrame) -> DataFrame:
    """posts with the keywords of hits (platform, native_id, keyword) added to those rows' sets."""
    words = hits.groupBy("platform", "native_id").agg(F.collect_set("keyword").alias("_hits"))
    both = F.array_sort(F.array_distinct(F.array_compact(F.concat(F.coalesce("matched_keywords", F.array().cast("array<string>")), "_hits"))))
    return posts.join(words, ["platform", "native_id"], "left").withColumn("matched_keywords", F.when(F.col("_hits").isNull(), F.col("matched_keywords")).otherwise(both)).drop("_hits").select(*posts.columns)


def upsert_insights(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Insights by post_id, incoming rows first; the embedding is dropped unless the summary is the same. incoming has unique post_ids and no
    embedding columns."""
    plain = [c for c in existing.columns if c not in ("post_id", "embedding", "embedding_model")]
    new = incoming.select("post_id", *(F.col(c).alias(f"n_{c}") for c in plain), F.lit(True).alias("n_row"))
    both = existing.join(new, "post_id", "full_outer")
    keep = F.col("n_row").isNull() | F.col("summary").eqNullSafe(F.col("n_summary"))
    return both.select("post_id", *(F.when(F.col("n_row"), F.col(f"n_{c}")).otherwise(F.col(c)).alias(c) for c in plain), *(F.when(keep, F.col(c)).alias(c) for c in ("embedding", "embedding_model"))).select(*existing.columns)


def cleared_embeddings(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """One row (cleared): stored embeddings that upsert_insights drops."""
    both = existing.filter(F.col("embedding").isNotNull()).join(incoming.select("post_id", F.col("summary").alias("n_summary")), "post_id")
    return both.agg(F.count_if(~F.col("summary").eqNullSafe(F.col("n_summary"))).alias("cleared"))


def collect_dedup(items: DataFrame, known: DataFrame) -> DataFrame:
    """items with ``outcome``. items: (task_no, item_no, native_id, ...) as tasks return them, known: (native_id).

    new: first sighting of an identifier not known; hit: known before the run, or first seen in an earlier task, whose keyword still counts;
    skip: repeat within the task that saw it first.
    """
    order = Window.partitionBy("native_id").orderBy("task_no", "item_no")
    first_task = F.first("task_no").over(order)
    flagged = items.join(known.select("native_id", F.lit(True).alias("_known")), "native_id", "left")
    outcome = F.when(F.col("_known").isNotNull(), "hit").when(F.row_number().over(order) == 1, "new").when(F.col("task_no") > first_task, "hit").otherwise("skip")
    return flagged.withColumn("outcome", outcome).drop("_known").select(*items.columns, "outcome")


def collect_run(tasks: DataFrame, items: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(new items, keyword hits, one row per task) of a run of searches, each failure kept apart from the rest.

    tasks: (task_no, label, keyword, failed), failed: the search gave no answer. items: (task_no, item_no, native_id, state, ...) with state
    ok, excluded (read, but not wanted) or malformed; those of failed tasks don't count. known: (native_id). Each task's row has fetched,
    added, skipped, excluded, malformed and failed, tasks without items too; hits are (native_id, keyword), repeats once.
    """
    rows = items.join(tasks.filter(~F.col("failed")).select("task_no", "keyword"), "task_no")
    judged = collect_dedup(rows.filter("state = 'ok' AND native_id IS NOT NULL"), known)
    n = lambda c, name: F.coalesce(F.count_if(c), F.lit(0)).alias(name)
    plain = rows.groupBy("task_no").agg(F.count("*").alias("fetched"), n(F.col("state") == "excluded", "excluded"), n((F.col("state") == "malformed") | (F.col("state") == "ok") & F.col("native_id").isNull(), "malformed"))
    done = judged.groupBy("task_no").agg(n(F.col("outcome") == "new", "added"), n(F.col("outcome") != "new", "skipped"))
    counts = ["fetched", "added", "skipped", "excluded", "malformed"]
    summary = tasks.select("task_no", "label", "failed").join(plain, "task_no", "left").join(done, "task_no", "left").select("task_no", "label", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts], "failed")
    new = judged.filter("outcome = 'new'").drop("outcome", "state", "keyword")
    return new, judged.filter("outcome = 'hit'").select("native_id", "keyword").distinct(), summary


def run_line(label: Column, fetched: Column, added: Column, skipped: Column, excluded: Column, malformed: Column, context: Column | None = None) -> Column:
    """The log's line of a task (fixed format, read again by telemetry.log_lines); counts of 0 behind the third are left out."""
    more = lambda name, c: F.when(c > 0, F.format_string(f" / {name}: %d件", c)).otherwise("")
    end = F.lit("") if context is None else F.coalesce(F.concat(F.lit(" ("), F.nullif(context, F.lit("")), F.lit(")")), F.lit(""))
    return F.concat(F.format_string("[%s] 取得: %d件 / 新規: %d件 / スキップ: %d件", label, fetched, added, skipped), more("対象外", excluded), more("不正", malformed), end)


def insert_records(existing: DataFrame, lines: DataFrame, platform: str, seq: str) -> tuple[DataFrame, DataFrame]:
    """(posts after it, one row inserted, failed) of a collected batch of landing lines (line, seq): what can't be mapped has failed."""
    from tidewrack.operators import normalize

    good, bad = normalize.normalize(lines, platform)
    counts = good.agg(F.count("*").alias("inserted")).crossJoin(bad.agg(F.count("*").alias("failed")))
    return upsert_posts(existing, good, seq), counts


def collect_summary(outcomes: DataFrame) -> DataFrame:
    """Per task: fetched, added, skipped."""
    return outcomes.groupBy("task_no").agg(F.count("*").alias("fetched"), F.count_if(F.col("outcome") == "new").alias("added"), F.count_if(F.col("outcome") != "new").alias("skipped"))


def reset_vectors(insights: DataFrame) -> tuple[DataFrame, DataFrame]:
    """insights without embeddings, and one row (cleared) with how many there were."""
    none = insights.withColumns({"embedding": F.lit(None).cast("array<float>"), "embedding_model": F.lit(None).cast("string")})
    return none, insights.agg(F.count_if(F.col("embedding").isNotNull()).alias("cleared"))
