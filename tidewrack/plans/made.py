"""Queries over inputs that are made of the test tables: lines, answers of services and files in the forms in which they arrive. Each runs over
its whole table and has the SQL that gives the same rows straight from the table."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack import schemas
from tidewrack.functions.text import markdown_cell
from tidewrack.functions.time import iso_utc
from tidewrack.operators import graph, normalize, queue, report, search, store, telemetry, textscan, validate
from tidewrack.plans import reference as ref
from tidewrack.session import cut, shared_dir, table
from tidewrack.sources import landing, paths
from tidewrack.streaming import ingest

_QUERIES: dict = {}
_SQL: dict[str, str] = {}


def _query(name: str, sql: str):
    def add(f):
        _QUERIES[name], _SQL[name] = f, sql
        return f

    return add


def _folder(spark) -> str:
    return f"{shared_dir(spark).rstrip('/')}/made-{uuid.uuid4().hex}"


# validation of raw lines: each insight gives a line with one fault, by its number

_FINE = {"insight_type": "'need'", "domain": "'other'", "summary": "'s'", "pain_level": "1", "monetizable": "true", "competitors": "array(' A ', ' ')", "confidence": "0.5D"}
#: Fault number, field, its value, reason.
_FAULTS = (
    (2, "pain_level", "true", "pain_level"), (3, "pain_level", "2.0D", "pain_level"), (4, "monetizable", "1", "monetizable"), (5, "competitors", "'A'", "competitors"),
    (6, "confidence", "'1'", "confidence"), (7, "confidence", "1.5D", "confidence"), (8, "summary", "repeat('x', 401)", "summary"), (9, "domain", "'none of these'", "domain"),
    (10, "insight_type", "'Need'", "insight_type"), (11, "pain_level", "4", "pain_level"), (12, "competitors", "array(1)", "competitors"), (13, "confidence", "true", "confidence"),
)
_KINDS = 17


def _lines(i: DataFrame) -> DataFrame:
    def json(**over) -> str:
        return f"to_json(named_struct('post_id', post_id, {', '.join(f"'{k}', {v}" for k, v in (_FINE | over).items())}))"

    plain = [(0, "'{'"), (1, "'[1]'"), (14, "' '"), (15, "concat(to_json(named_struct('post_id', post_id)), ' x')"), (16, "to_json(named_struct('post_id', ' '))")]
    cases = [*plain, *((k, json(**{f: v})) for k, f, v, _ in _FAULTS)]
    return i.withColumn("line", F.expr(f"CASE insight_no % {_KINDS + 3} " + " ".join(f"WHEN {k} THEN {v}" for k, v in cases) + f" ELSE {json()} END"))


_REASON = f"CASE insight_no % {_KINDS + 3} WHEN 0 THEN 'json' WHEN 1 THEN 'object' WHEN 15 THEN 'json' WHEN 16 THEN 'post_id' " + " ".join(f"WHEN {k} THEN '{r}'" for k, _, _, r in _FAULTS) + " END"


@_query("validate_raw_lines", f"SELECT insight_no AS line_no, {_REASON} AS reason, insight_no % {_KINDS + 3} > {_KINDS - 1} AS valid FROM insights WHERE insight_no % {_KINDS + 3} <> 14")
def validate_raw_lines(spark, sf):
    """Broken lines, values that are no object, fields of the wrong JSON type and bounds, each with its first reason; blank lines are left out."""
    got = validate.judged(_lines(ref.insights_of(spark, sf)).select(F.col("insight_no").alias("line_no"), "line"), ref.DOMAINS)
    return got.select("line_no", "reason", F.col("reason").isNull().alias("valid"))


@_query("validate_batch", f"WITH l AS (SELECT insight_no * 2 + k AS line_no, post_id, {_REASON} AS r, insight_no % 3 > 0 AS b, insight_no % {_KINDS + 3} AS m FROM insights, (VALUES (0), (1)) v(k)) SELECT line_no, coalesce(r, CASE WHEN NOT b THEN 'batch' WHEN line_no % 2 = 1 THEN 'duplicate' END) AS reason FROM l WHERE m <> 14")
def validate_batch(spark, sf):
    """Every line twice, with two thirds of the posts in the batch: others are rejected, as is the second valid line of a post."""
    i = ref.insights_of(spark, sf)
    twice = _lines(i).select("line", F.explode(F.array(F.col("insight_no") * 2, F.col("insight_no") * 2 + 1)).alias("line_no"))
    good, bad = validate.load(twice, i.filter("insight_no % 3 > 0").select(F.col("post_id").alias("id")), ref.DOMAINS)
    return good.select("line_no", F.lit(None).cast("string").alias("reason")).unionByName(bad.select("line_no", "reason"))


# answers of six services


def _answers(df: DataFrame, platform: str, item: str, *more: str) -> DataFrame:
    rows = df.select(F.expr(f"to_json(named_struct({item}))").alias("item"), F.lit("k").alias("keyword"), F.lit("2026-08-01T00:00:00+00:00").alias("collected_at"), *[F.expr(x) for x in more])
    return normalize.flatten(rows, platform)


_OF = lambda p: f"SELECT * FROM posts WHERE platform = '{p}' AND native_id IS NOT NULL"


def _posts(spark, sf, platform):
    return table(spark, sf, "posts").filter((F.col("platform") == platform) & F.col("native_id").isNotNull())


@_query("flatten_bluesky", f"SELECT native_id AS post_id, coalesce(text, '') AS text, coalesce(author_handle, '') AS author_handle, coalesce(author_id, '') AS author_did, CAST(row_id % 50 AS BIGINT) AS like_count, CAST(0 AS BIGINT) AS repost_count, coalesce(posted_at, '') AS created_at, 'https://bsky.app/profile/' || coalesce(author_handle, '') || '/post/' || list_extract(string_split(native_id, '/'), -1) AS url, coalesce(lang, '') AS first_lang FROM ({_OF('bluesky')})")
def flatten_bluesky(spark, sf):
    item = "'uri', native_id, 'author', named_struct('handle', author_handle, 'did', author_id), 'record', named_struct('text', text, 'createdAt', posted_at, 'langs', CASE WHEN lang IS NOT NULL THEN array(lang) END), 'likeCount', row_id % 50"
    got = _answers(_posts(spark, sf, "bluesky"), "bluesky", item)
    return got.select("post_id", "text", "author_handle", "author_did", "like_count", "repost_count", "created_at", "url", F.coalesce(F.try_element_at("lang", F.lit(1)), F.lit("")).alias("first_lang"))


@_query("flatten_youtube", f"SELECT native_id AS video_id, coalesce(author_handle, '') AS title, coalesce(text, '') AS description, coalesce(author_id, '') AS channel_id, coalesce(posted_at, '') AS published_at, 'https://www.youtube.com/watch?v=' || native_id AS url FROM ({_OF('youtube')})")
def flatten_youtube(spark, sf):
    item = "'id', named_struct('videoId', native_id), 'snippet', named_struct('title', author_handle, 'description', text, 'channelId', author_id, 'publishedAt', posted_at)"
    return _answers(_posts(spark, sf, "youtube"), "youtube", item).select("video_id", "title", "description", "channel_id", "published_at", "url")


_LINES_OF = lambda *c: f"concat_ws(chr(10), {', '.join(f'nullif({x}, {chr(39) * 2})' for x in c)})"
_HTML = "'<p>' || keyword || ' &amp; more<br/></p>'"
_PLAIN = "keyword || ' & more'"


@_query("flatten_hackernews", f"SELECT item_id, {_LINES_OF('title', _PLAIN)} AS text, CASE WHEN row_no % 3 = 0 THEN 'comment' ELSE 'story' END AS item_type, coalesce(author, '') AS author, coalesce(points, 0) AS points, coalesce(created_at, '') AS created_at, CASE WHEN row_no % 3 = 0 OR coalesce(url, '') = '' THEN 'https://news.ycombinator.com/item?id=' || item_id ELSE url END AS url FROM hackernews_item WHERE item_id IS NOT NULL")
def flatten_hackernews(spark, sf):
    """Stories and comments with HTML in their texts; a comment's topic is its story's."""
    item = f"'objectID', item_id, '_tags', array(CASE WHEN row_no % 3 = 0 THEN 'comment' ELSE 'story' END), 'title', CASE WHEN row_no % 3 > 0 THEN title END, 'story_title', CASE WHEN row_no % 3 = 0 THEN title END, 'story_text', CASE WHEN row_no % 3 > 0 THEN {_HTML} END, 'comment_text', CASE WHEN row_no % 3 = 0 THEN {_HTML} END, 'author', author, 'points', points, 'num_comments', num_comments, 'created_at', created_at, 'url', url"
    rows = table(spark, sf, "hackernews_item").filter("item_id IS NOT NULL")
    return _answers(rows, "hackernews", item).select("item_id", "text", "item_type", "author", "points", "created_at", "url")


_SEEK = "CASE row_id % 4 WHEN 0 THEN 'Seeking Work | remote' WHEN 1 THEN 'seeking freelancer, Berlin' WHEN 2 THEN repeat('x', 120) || 'SEEKING WORK' ELSE 'Acme Ltd' END"


@_query("flatten_hnjobs", f"SELECT native_id AS item_id, 'T' || chr(10) || {_SEEK} AS text, CASE row_id % 4 WHEN 0 THEN 'work' WHEN 1 THEN 'freelancer' END AS seeking, coalesce(author_handle, '') AS author FROM ({_OF('hnjobs')}) WHERE row_id % 5 > 0")
def flatten_hnjobs(spark, sf):
    """Entries directly under their thread, and the side they take; answers to entries are left out."""
    item = f"'objectID', native_id, 'parent_id', row_id % 5, 'story_id', CASE WHEN row_id % 5 > 0 THEN row_id % 5 ELSE 9 END, 'comment_text', {_SEEK}, 'author', author_handle"
    return _answers(_posts(spark, sf, "hnjobs"), "hnjobs", item, "'1' AS thread_id", "'T' AS thread_title", "'hiring' AS thread_kind").select("item_id", "text", "seeking", "author")


@_query("flatten_github", f"SELECT native_id AS issue_id, {_LINES_OF(chr(39) + 'T' + chr(39), 'text')} AS text, CASE WHEN row_id % 2 = 0 THEN 'o/n' ELSE '' END AS repo_full_name, coalesce(author_id, '') AS author_id, CAST(row_id % 7 AS BIGINT) AS reactions, 'bug,plain' AS labels FROM ({_OF('github')})")
def flatten_github(spark, sf):
    item = "'id', native_id, 'title', 'T', 'body', text, 'repository_url', CASE WHEN row_id % 2 = 0 THEN 'https://h.example/repos/o/n/' ELSE 'n' END, 'user', named_struct('id', author_id), 'reactions', named_struct('total_count', row_id % 7), 'labels', from_json('[{\"name\":\"bug\"},\"plain\",3]', 'array<variant>')"
    return _answers(_posts(spark, sf, "github"), "github", item).select("issue_id", "text", "repo_full_name", "author_id", "reactions", F.array_join("labels", ",").alias("labels"))


@_query("flatten_reddit", f"SELECT post_id, {_LINES_OF('title', 'text')} AS text, coalesce(nullif(author, ''), '[deleted]') AS author, nullif(author_id, '') AS author_id, coalesce(score, 0) AS score, strftime(make_timestamp(row_no * 100003 * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS created_at, 'https://www.reddit.com/r/' || row_no AS url FROM reddit_post WHERE post_id IS NOT NULL")
def flatten_reddit(spark, sf):
    item = "'name', post_id, 'title', title, 'selftext', text, 'author', author, 'author_fullname', author_id, 'score', score, 'created_utc', CAST(row_no * 100003 AS DOUBLE), 'permalink', concat('/r/', row_no)"
    rows = table(spark, sf, "reddit_post").filter("post_id IS NOT NULL")
    return _answers(rows, "reddit", item).select("post_id", "text", "author", "author_id", "score", "created_at", "url")


# threads


def _threads(spark, sf):
    title = F.when(F.col("event_type") == "view", "Ask HN: Who is hiring? (x)").when(F.col("event_type") == "click", "Ask HN: Freelancer? Seeking freelancer? (x)").when(F.col("event_type") == "error", "Ask HN: WHO WANTS TO BE HIRED (x)").otherwise("other")
    rows = table(spark, sf, "events").select(F.col("event_id").cast("string").alias("thread_id"), title.alias("title"), F.date_format("ts", "yyyy-MM-dd").alias("created_at"), F.lit(0).alias("author_no"), F.col("event_id").alias("position"))
    return normalize.select_threads(rows, ["hiring", "hired", "freelancer"], 3)


_THREADS = "t AS (SELECT CAST(event_id AS VARCHAR) AS thread_id, CASE event_type WHEN 'view' THEN 'hiring' WHEN 'click' THEN 'freelancer' WHEN 'error' THEN 'hired' END AS kind, ts, event_id FROM events), s AS (SELECT thread_id, kind FROM t WHERE kind IS NOT NULL QUALIFY row_number() OVER (PARTITION BY kind ORDER BY strftime(ts, '%Y-%m-%d') DESC, event_id) <= 3)"


@_query("thread_tasks", f"WITH {_THREADS}, k AS (SELECT DISTINCT keyword FROM hackernews_item WHERE keyword IS NOT NULL) SELECT thread_id, keyword FROM s, k")
def thread_tasks(spark, sf):
    """Every chosen thread with every keyword."""
    words = table(spark, sf, "hackernews_item").select("keyword").filter("keyword IS NOT NULL").distinct()
    return normalize.tasks(_threads(spark, sf), words).select("thread_id", "keyword")


@_query("thread_counts", f"WITH {_THREADS}, k AS (SELECT unnest(['hiring', 'hired', 'freelancer', 'other']) AS kind) SELECT k.kind, count(s.kind) AS threads FROM k LEFT JOIN s USING (kind) GROUP BY 1")
def thread_counts(spark, sf):
    return normalize.threads_per_kind(_threads(spark, sf), ["hiring", "hired", "freelancer", "other"])


# landing files

_REDDIT = f"SELECT 'reddit:' || post_id AS id, coalesce(text, '') AS text, {ref.iso_sql('created_at')} AS posted_at FROM reddit_post WHERE post_id IS NOT NULL AND post_id <> '' QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY row_no % 2 DESC, row_no DESC) = 1"


def _land(spark, sf, root: str) -> None:
    """Two days of landing files, of even and odd rows, with the row's number inside so that lines of a file have an order that SQL can give."""
    r = table(spark, sf, "reddit_post").drop("writer_tz", "raw")
    for k in (0, 1):
        landing.append(r.filter(F.col("row_no") % 2 == k).coalesce(1).sortWithinPartitions("row_no"), root, "reddit", date(2026, 8, 1 + k))


@_query("landing_load", _REDDIT)
def landing_load(spark, sf):
    """Rows appended to landing files, read back and loaded: the last line of an identifier counts."""
    root = _folder(spark)
    try:
        _land(spark, sf, root)
        return cut(landing.load_all(spark, root, spark.createDataFrame([], ref.table(spark, sf, "posts").withColumn("posted_at", iso_utc(F.col("posted_at"))).select(*schemas.POSTS.fieldNames()).schema))[0].select("id", "text", "posted_at"))
    finally:
        paths.delete(spark, root)


@_query("landing_counts", "SELECT 'reddit' AS platform, 1 AS files, count(DISTINCT post_id) FILTER (ok) AS inserted, count(*) FILTER (ok) - count(DISTINCT post_id) FILTER (ok) AS updated, count(*) FILTER (NOT ok) AS skipped FROM (SELECT post_id, post_id IS NOT NULL AND post_id <> '' AS ok FROM reddit_post WHERE row_no % 2 = 1)")
def landing_counts(spark, sf):
    """Counts of a load from the second day on: files of other days aren't opened."""
    root = _folder(spark)
    try:
        _land(spark, sf, root)
        none = spark.createDataFrame([], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.POSTS.fields))
        return cut(landing.load_platform(spark, root, "reddit", none, since=date(2026, 8, 2))[1])
    finally:
        paths.delete(spark, root)


@_query("landing_stream", _REDDIT)
def landing_stream(spark, sf):
    """The same as a stream into the versioned table."""
    root = _folder(spark)
    try:
        _land(spark, sf, f"{root}/in")
        posts = ingest.Table(spark, f"{root}/posts", ingest.ORDERED)
        ingest.run(spark, f"{root}/in", posts, f"{root}/state", platforms=("reddit",))
        return cut(posts.read().select("id", "text", "posted_at"))
    finally:
        paths.delete(spark, root)


@_query("insert_outcome", "SELECT count(*) FILTER (ok) AS inserted, count(*) FILTER (NOT ok) AS failed FROM (SELECT row_no % 9 > 0 AND post_id IS NOT NULL AND post_id <> '' AS ok FROM reddit_post)")
def insert_outcome(spark, sf):
    """A collected batch in which every ninth record has no identifier."""
    r = table(spark, sf, "reddit_post").withColumn("post_id", F.expr("CASE WHEN row_no % 9 > 0 THEN post_id END"))
    lines = r.select(F.to_json(F.struct("post_id", "text", "created_at", "collected_at")).alias("line"), F.col("row_no").alias("seq"))
    none = spark.createDataFrame([], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.POSTS.fields))
    return store.insert_records(none, lines, "reddit", "seq")[1]


_RUN = "WITH i AS (SELECT CAST(row_no % 7 AS INT) AS task_no, row_no AS item_no, trim(item_id) AS native_id, CASE WHEN row_no % 11 = 0 THEN 'malformed' WHEN row_no % 13 = 0 THEN 'excluded' ELSE 'ok' END AS state FROM hackernews_item WHERE row_no % 7 <> 3), k AS (SELECT DISTINCT native_id FROM posts WHERE platform = 'hackernews' AND load_batch < 3), o AS (SELECT i.*, CASE WHEN k.native_id IS NOT NULL THEN 'hit' WHEN row_number() OVER w = 1 THEN 'new' WHEN task_no > first_value(task_no) OVER w THEN 'hit' ELSE 'skip' END AS outcome FROM (SELECT * FROM i WHERE state = 'ok' AND native_id IS NOT NULL) i LEFT JOIN k USING (native_id) WINDOW w AS (PARTITION BY native_id ORDER BY task_no, item_no)) "


@_query("collect_run", _RUN + "SELECT t.task_no, (SELECT count(*) FROM i WHERE i.task_no = t.task_no) AS fetched, (SELECT count(*) FROM o WHERE o.task_no = t.task_no AND outcome = 'new') AS added, (SELECT count(*) FROM o WHERE o.task_no = t.task_no AND outcome <> 'new') AS skipped, (SELECT count(*) FROM i WHERE i.task_no = t.task_no AND state = 'excluded') AS excluded, (SELECT count(*) FROM i WHERE i.task_no = t.task_no AND (state = 'malformed' OR state = 'ok' AND native_id IS NULL)) AS malformed, t.task_no = 3 AS failed FROM (SELECT CAST(unnest(range(7)) AS INT) AS task_no) t")
def collect_run(spark, sf):
    """A run of seven searches, of which one fails and some give items that can't be read or aren't wanted."""
    rows = table(spark, sf, "hackernews_item")
    state = F.expr("CASE WHEN row_no % 11 = 0 THEN 'malformed' WHEN row_no % 13 = 0 THEN 'excluded' ELSE 'ok' END")
    items = rows.select((F.col("row_no") % 7).cast("int").alias("task_no"), F.col("row_no").alias("item_no"), F.trim("item_id").alias("native_id"), state.alias("state"))
    tasks = spark.createDataFrame([(k, f"t{k}", f"k{k}", k == 3) for k in range(7)], "task_no int, label string, keyword string, failed boolean")
    return store.collect_run(tasks, items, table(spark, sf, "posts").filter("platform = 'hackernews' AND load_batch < 3").select("native_id").distinct())[2].drop("label")


# queue

_PICKED = f"pk AS (SELECT id FROM p WHERE extraction_status = 'pending' AND platform IN ('bluesky', 'hackernews') AND length({ref._TRIM('text')}) > 0 ORDER BY collected_at DESC NULLS LAST, id LIMIT 20)"
_NOW = datetime(2026, 8, 12)


def _prepared(spark, sf, folder):
    ledger = spark.createDataFrame([], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.BATCHES.fields))
    vocabulary = [{"id": d} for d in ref.DOMAINS]
    return queue.prepare(ref.posts_of(spark, sf), ref.insights_of(spark, sf), ledger, folder, 20, "x9", "{batch_jsonl} {domain_ids}", vocabulary, _NOW)


@_query("queue_prepare", ref._P + f", {_PICKED} SELECT CASE WHEN id IN (SELECT id FROM pk) THEN 'batched' WHEN extraction_status = 'pending' AND (text IS NULL OR length({ref._TRIM('text')}) = 0) THEN 'skipped' ELSE extraction_status END AS extraction_status, count(*) AS count FROM p GROUP BY 1")
def queue_prepare(spark, sf):
    """States of all posts after a batch was made of them."""
    folder = _folder(spark)
    try:
        return cut(queue.post_status(_prepared(spark, sf, folder).posts))
    finally:
        paths.delete(spark, folder)


@_query("queue_batch_file", ref._P + f", {_PICKED} SELECT id, platform, text, strftime(posted_at, '%Y-%m-%dT%H:%M:%S') AS posted_at, array_to_string(matched_keywords, '|') AS keywords FROM p WHERE id IN (SELECT id FROM pk)")
def queue_batch_file(spark, sf):
    """What the batch's file holds."""
    folder = _folder(spark)
    try:
        made = _prepared(spark, sf, folder)
        rows = spark.read.schema("id string, platform string, text string, posted_at string, matched_keywords array<string>").json(made.batch_path)
        return cut(rows.select("id", "platform", "text", "posted_at", F.array_join("matched_keywords", "|").alias("keywords")))
    finally:
        paths.delete(spark, folder)


@_query("queue_load", ref._P + f", {_PICKED}, n AS (SELECT id, row_number() OVER (ORDER BY id) AS k FROM pk) SELECT count(*) FILTER (k % 4 > 0) AS accepted, count(*) FILTER (k % 4 = 0) AS rejected, count(*) FILTER (k % 4 > 0) AS done, count(*) FILTER (k % 4 > 0) AS loaded FROM n")
def queue_load(spark, sf):
    """A batch made, answered (every fourth answer out of bounds) and taken in."""
    folder = _folder(spark)
    try:
        made = _prepared(spark, sf, folder)
        ids = [r["id"] for r in spark.read.schema("id string").json(made.batch_path).orderBy("id").collect()]  # a batch of 20
        line = lambda k, i: f'{{"post_id": "{i}", "insight_type": "need", "domain": "other", "summary": "s", "pain_level": {9 if k % 4 == 0 else 1}, "monetizable": false, "confidence": 1}}\n'
        paths.write_text(spark, made.result_path, "".join(line(k, i) for k, i in enumerate(ids, 1)))
        insights = ref.insights_of(spark, sf).drop("insight_no")
        got = queue.load(made.posts, insights, made.ledger, folder, made.batch_id, ref.DOMAINS, _NOW)
        batch = spark.createDataFrame([(i,) for i in ids], "id string")
        done = got.posts.join(batch, "id", "left_semi").agg(F.count_if(F.col("extraction_status") == "done").alias("done"))
        one = done.crossJoin(got.ledger.agg(F.sum("loaded_count").cast("bigint").alias("loaded")))
        return cut(one.select(F.lit(got.accepted).cast("bigint").alias("accepted"), F.lit(got.rejected).cast("bigint").alias("rejected"), "done", "loaded"))
    finally:
        paths.delete(spark, folder)


@_query("ledger_states", "SELECT 'b' || load_batch AS batch_id, count(*) AS post_count, CASE WHEN load_batch = 2 THEN 7 END AS loaded_count FROM posts GROUP BY load_batch")
def ledger_states(spark, sf):
    """A ledger of all load batches, of which one is marked as loaded."""
    counts = table(spark, sf, "posts").groupBy("load_batch").agg(F.count("*").alias("n"))
    ledger = counts.select(F.concat(F.lit("b"), "load_batch").alias("batch_id"), F.lit(_NOW).alias("created_at"), F.col("n").cast("int").alias("post_count"), F.lit("v").alias("extractor_version"), F.lit(None).cast("timestamp_ntz").alias("loaded_at"), F.lit(None).cast("int").alias("loaded_count"))
    return queue.ledger_loaded(ledger, "b2", _NOW, 7).select("batch_id", F.col("post_count").cast("bigint").alias("post_count"), "loaded_count")


@_query("open_batches", "SELECT 'b' || load_batch AS batch_id, count(*) AS post_count FROM posts WHERE load_batch <> 2 GROUP BY load_batch")
def open_batches(spark, sf):
    rows = ledger_states(spark, sf).withColumns({"extractor_version": F.lit("v"), "loaded_at": F.when(F.col("loaded_count").isNotNull(), F.lit(_NOW))})
    return queue.open_batches(rows).select("batch_id", "post_count")


@_query("batch_names", "SELECT strftime(TIMESTAMP '2026-08-12' + to_seconds(CAST(count(DISTINCT load_batch) AS INT)), '%Y%m%dT%H%M%S') AS name FROM posts")
def batch_names(spark, sf):
    """The first second that is no batch's name yet, where as many are taken as there are load batches."""
    n = table(spark, sf, "posts").agg(F.count_distinct("load_batch")).first()[0]
    taken = {(_NOW + timedelta(seconds=k)).strftime("%Y%m%dT%H%M%S") for k in range(n)}
    return spark.createDataFrame([(queue.batch_id(taken, _NOW),)], "name string")


# report


@_query("report_sections", ref._P + f", {ref._PAIRS}, {ref._MENTIONS}, x AS (SELECT * FROM b WHERE {ref._IN('extracted_at', ref.EXTRACTED)}), "
        f"d AS (SELECT domain, count(*) FILTER (extracted_at >= TIMESTAMP '2026-08-07') AS n, count(*) FILTER (extracted_at < TIMESTAMP '2026-08-07') AS o, {ref._EXAMPLE('url').replace('url IS NOT NULL AND', 'url IS NOT NULL AND extracted_at >= TIMESTAMP ' + chr(39) + '2026-08-07' + chr(39) + ' AND')} AS u FROM b WHERE domain IS NOT NULL AND extracted_at >= TIMESTAMP '2026-08-04' AND extracted_at < TIMESTAMP '2026-08-10' GROUP BY 1) "
        f"SELECT 'daily_counts' AS section, '| ' || collected_at::DATE || ' | ' || platform || ' | ' || count(*) || ' |' AS line FROM p WHERE {ref._IN('collected_at', ref.EXTRACTED)} GROUP BY platform, collected_at::DATE "
        f"UNION ALL SELECT 'type_counts', '| ' || insight_type || ' | ' || count(*) || ' | ' || coalesce({ref._EXAMPLE('url')}, '-') || ' |' FROM x GROUP BY insight_type "
        "UNION ALL SELECT 'domain_counts', '| ' || domain || ' | ' || n || ' | ' || o || ' | ' || CASE WHEN n >= o THEN '+' ELSE '' END || (n - o) || ' | ' || coalesce(u, '-') || ' |' FROM d WHERE n > 0 "
        "UNION ALL SELECT 'top_signals', '- [' || platform || '/' || coalesce(domain, '-') || '] ' || CASE WHEN coalesce(summary, '') = '' THEN post_id ELSE translate(replace(summary, '|', '\\|'), chr(13) || chr(10), '  ') END || CASE WHEN coalesce(url, '') = '' THEN '' ELSE chr(10) || '  ' || url END FROM x WHERE pain_level = 3 AND monetizable "
        f"UNION ALL SELECT 'new_competitors', '| ' || replace(product, '|', '\\|') || ' | ' || strftime(min(extracted_at), '%Y-%m-%d') || ' | ' || coalesce({ref._EXAMPLE('url')}, '-') || ' |' FROM m GROUP BY product HAVING {ref._IN('min(extracted_at)', ref.EXTRACTED)}")  # fmt: skip
def report_sections(spark, sf):
    """The lines of a report's sections; those of the two top lists are queries of their own."""
    parts = report.build(ref.posts_of(spark, sf), ref.insights_of(spark, sf), *ref.EXTRACTED)
    out = None
    for name in ("daily_counts", "type_counts", "domain_counts", "top_signals", "new_competitors"):
        one = report.section_lines(name, parts[name]).select(F.lit(name).alias("section"), "line")
        out = one if out is None else out.unionByName(one)
    return out


@_query("markdown_cells", "SELECT row_id, CASE WHEN row_id % 3 = 0 THEN '-' ELSE 'a' || repeat('\\|', CAST(row_id % 4 AS INT)) || '  ' || translate(replace(coalesce(lang, ''), '|', '\\|'), chr(13) || chr(10), '  ') END AS cell FROM posts")
def markdown_cells(spark, sf):
    value = F.expr("CASE WHEN row_id % 3 = 0 THEN CASE WHEN row_id % 2 = 0 THEN '' END ELSE concat('a', repeat('|', CAST(row_id % 4 AS INT)), '\\r\\n', coalesce(lang, '')) END")
    return table(spark, sf, "posts").select("row_id", markdown_cell(value).alias("cell"))


# search and vectors


@_query("search_guarded", ref._P + f", {ref._VEC} SELECT b.post_id, round(list_cosine_similarity(v.e, {ref._QUERY_VECTOR}), 4) AS score FROM b JOIN v USING (post_id) WHERE platform = 'bluesky' ORDER BY list_cosine_similarity(v.e, {ref._QUERY_VECTOR}) DESC, b.post_id LIMIT 20")
def search_guarded(spark, sf):
    """Search with its checks: the model follows from the stored vectors, whose dimension must be the query's."""
    got = search.search(ref.vectors_of(spark, sf), ref.posts_of(spark, sf), ref._query_vector(spark, sf), 20, platform="bluesky")
    return got.select("post_id", F.round("score", 4).alias("score"))


@_query("model_guards", f"SELECT 'one model' AS corpus, '{ref.MODEL}' AS resolved UNION ALL SELECT 'all', NULL UNION ALL SELECT 'none', 'multilingual-e5-large' UNION ALL SELECT 'dimension', NULL")
def model_guards(spark, sf):
    """Which model a corpus of one model, of several, and without vectors resolves to; null where it is refused, as is a wrong dimension."""
    all_, one = ref.insights_of(spark, sf), ref.vectors_of(spark, sf)

    def tried(f):
        try:
            return f()
        except ValueError:
            return None

    rows = [("one model", tried(lambda: search.resolve_model(one))), ("all", tried(lambda: search.resolve_model(all_))), ("none", tried(lambda: search.resolve_model(one.limit(0)))), ("dimension", tried(lambda: search.ensure_matches(one, ref.MODEL, 63) or "fine"))]
    return spark.createDataFrame(rows, "corpus string, resolved string")


@_query("embed_step", f"WITH e AS (SELECT post_id, summary FROM insights WHERE embedding IS NULL AND length({ref._TRIM('summary')}) > 0 ORDER BY post_id LIMIT 100) SELECT post_id, CAST(length('passage: ' || summary) AS DOUBLE) AS first, '{ref.MODEL}' AS embedding_model FROM e")
def embed_step(spark, sf):
    """The first hundred insights without vector get one, by an embedder that measures the text. The limit is the step's size."""
    i = ref.insights_of(spark, sf)
    rows = i.filter(F.col("embedding").isNull()).withColumn("embedding_model", F.lit(None).cast("string")).unionByName(ref.vectors_of(spark, sf))
    got = search.embed(rows, lambda texts: [[float(len(t))] * 64 for t in texts], ref.MODEL, 100)
    ids = i.filter(F.col("embedding").isNull()).select("post_id")
    return got.filter(F.col("embedding").isNotNull()).join(ids, "post_id", "left_semi").select("post_id", F.col("embedding")[0].cast("double").alias("first"), "embedding_model")


@_query("neighbour_floor", f"WITH {ref._VEC} SELECT count(*) AS pairs FROM v a JOIN v b ON a.post_id < b.post_id WHERE list_cosine_similarity(a.e, b.e) >= 0.95")
def neighbour_floor(spark, sf):
    """How many pairs of stored vectors pass a higher threshold, by the block products."""
    return graph.vector_pairs(ref.vectors_of(spark, sf), 0.95, limit=None).agg(F.count("*").alias("pairs"))


# telemetry and scans


@_query("event_scan", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, event_type AS \"check\", CAST(event_id % 3 AS INT) AS exit_code, CAST(0 AS BIGINT) AS violations, 'unknown' AS context, ts::DATE AS day FROM events WHERE event_id % 5 < 2")
def event_scan(spark, sf):
    """Event lines, of which some are broken, lack a field, or have a time that is none; days are those of the event's own offset."""
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    line = F.to_json(F.struct(F.when(F.col("event_id") % 5 == 2, F.lit("soon")).otherwise(F.concat(at, F.when(F.col("event_id") % 2 == 0, F.lit("Z")).otherwise(F.lit("+00:00")))).alias("ts"), F.when(F.col("event_id") % 5 != 3, F.col("event_type")).alias("check"), (F.col("event_id") % 3).alias("exit_code"), F.col("event_id").alias("duration_ms")))
    lines = table(spark, sf, "events").select(F.when(F.col("event_id") % 5 == 4, F.substring(line, 1, 20)).otherwise(line).alias("value"))
    got = telemetry.in_order(telemetry.parse_events(lines))
    return got.select(F.col("duration_ms").alias("event_id"), F.date_format("ts_instant", "yyyy-MM-dd HH:mm:ss").alias("at"), "check", "exit_code", "violations", "context", F.col("ts_day").alias("day"))


@_query("unrecorded_gates", f"WITH {ref._EVENTS}, c AS (SELECT DISTINCT \"check\" FROM e) SELECT \"check\" AS name FROM (SELECT \"check\" FROM c UNION ALL SELECT \"check\" || '-never' FROM c) WHERE \"check\" NOT IN (SELECT \"check\" FROM c) AND \"check\" NOT LIKE 'view%'")
def unrecorded_gates(spark, sf):
    """Gates of which no event is known; interactive ones (those of one kind) leave none."""
    stats = telemetry.check_stats(ref.events_of(spark, sf))
    names = stats.select(F.explode(F.array(F.col("check"), F.concat("check", F.lit("-never")))).alias("name"))
    gates = names.select("name", F.lit("pre-commit").alias("stage"), F.lit(True).alias("is_check"), F.col("name").startswith("view").alias("interactive"))
    return telemetry.unrecorded(gates, stats).select("name")


_STATUS = "CASE doc_id % 5 WHEN 0 THEN '採用' WHEN 1 THEN '提案中' WHEN 2 THEN '置換済み（ADR-0001）' WHEN 3 THEN '保留' END"
_SLUG = "lpad(CAST(doc_id % 10000 AS VARCHAR), 4, '0') || '-d'"


def _records(spark, sf):
    text = f"concat('# ADR-', lpad(CAST(doc_id % 10000 AS STRING), 4, '0'), ': ', coalesce(regexp_replace(title, '[\\\\r\\\\n]', ' '), 'x'), '\\n\\n', coalesce(concat('- ステータス: ', {_STATUS}, '\\n'), ''), '- 日付: 2026-08-01\\n')"
    docs = table(spark, sf, "documents").select(F.expr("concat('d/', lpad(CAST(doc_id % 10000 AS STRING), 4, '0'), '-d.md')").alias("name"), F.expr(text).alias("text"))
    return textscan.records(docs, "name", "text")


@_query("decision_records", f"SELECT {_SLUG} AS slug, lpad(CAST(doc_id % 10000 AS VARCHAR), 4, '0') AS number, CASE doc_id % 5 WHEN 2 THEN '置換済み' WHEN 4 THEN '不明' ELSE {_STATUS} END AS status, CASE WHEN doc_id % 5 = 2 THEN 'ADR-0001' END AS superseded_by, '2026-08-01' AS date FROM documents")
def decision_records(spark, sf):
    return _records(spark, sf).select("slug", "number", "status", "superseded_by", "date")


@_query("records_by_status", "SELECT CAST(CASE doc_id % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 6 WHEN 3 THEN 7 ELSE 5 END AS BIGINT) AS rank, count(*) AS records FROM documents GROUP BY 1")
def records_by_status(spark, sf):
    """Statuses in their order, replaced ones behind, unknown ones at the end."""
    return textscan.by_status(_records(spark, sf)).select(F.col("rank").cast("bigint").alias("rank"), F.size("slugs").cast("bigint").alias("records"))


@_query("active_records", f"WITH {ref._EVENTS} SELECT (SELECT count(*) FROM posts) AS collected, count(*) AS runs_total, count(*) FILTER (exit_code <> 0) AS blocks_total, (SELECT count(*) FROM documents WHERE doc_id % 5 = 0) AS records_active FROM e")
def active_records(spark, sf):
    return telemetry.overview(table(spark, sf, "posts"), ref.events_of(spark, sf), _records(spark, sf))


@_query("layer_pairs", "SELECT DISTINCT src_type AS layer, dst_type AS imports FROM edges WHERE (src_type, dst_type) NOT IN (('author', 'product'), ('post', 'post'))")
def layer_pairs(spark, sf):
    """Pairs that a table of allowed ones lacks."""
    allowed = spark.createDataFrame([("author", "product"), ("post", "post")], "layer string, imports string")
    return textscan.not_allowed(table(spark, sf, "edges").select(F.col("src_type").alias("layer"), F.col("dst_type").alias("imports")).distinct(), allowed)


@_query("schema_versions", "SELECT * FROM (VALUES (1, 'posts, insights, edges, extraction_batches'), (2, 'insights.embedding_model')) v(version, note)")
def schema_versions(spark, sf):
    """A store brought up from nothing has a row for each step."""
    none = spark.createDataFrame([], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.SCHEMA_VERSION.fields))
    return schemas.upgrade({"insights": ref.insights_of(spark, sf).drop("embedding_model")}, none, _NOW)[1].select("version", "note")


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
