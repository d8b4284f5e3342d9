"""Landing records of six platforms to the common form of posts, and captured search answers to landing records.

A platform is an entry of PLATFORMS: its schema, the field with the identifier, and expressions for the common columns. Missing fields are
null (older records lack some); a record without identifier is a reject, never an error.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewrack.functions.json import parsed
from tidewrack.functions.text import or_null
from tidewrack.functions.time import epoch_iso, iso_utc


@dataclass(frozen=True)
class Platform:
    """How a platform's records map to posts. metrics: name in the result, field, default of a missing field (None: null)."""

    key: str
    fields: str
    author_id: str | None
    author_handle: str | None
    posted_at: str = "created_at"
    text: tuple[str, ...] = ("text",)
    metrics: tuple[tuple[str, object], ...] = ()
    lang: bool = False
    extra: dict = field(default_factory=dict)


_COMMON = "keyword string, url string, collected_at string"
PLATFORMS = {
    "bluesky": Platform("post_id", "post_id string, text string, author_handle string, author_did string, like_count bigint, repost_count bigint, reply_count bigint, created_at string", "author_did", "author_handle", metrics=(("like_count", 0), ("repost_count", 0), ("reply_count", 0)), lang=True),
    "youtube": Platform("video_id", "video_id string, title string, description string, channel_id string, channel_title string, published_at string", "channel_id", "channel_title", "published_at", ("title", "description")),
    "hackernews": Platform("item_id", "item_id string, text string, item_type string, author string, points bigint, num_comments bigint, story_id string, created_at string", "author", "author", metrics=(("points", 0), ("num_comments", 0), ("item_type", None), ("story_id", None))),
    "hnjobs": Platform("item_id", "item_id string, text string, thread_id string, thread_title string, thread_kind string, seeking string, author string, created_at string", "author", "author", metrics=(("thread_id", None), ("thread_title", None), ("thread_kind", None), ("seeking", None))),
    "github": Platform("issue_id", "issue_id string, text string, repo_full_name string, number bigint, state string, author string, author_id string, comments bigint, reactions bigint, labels array<string>, created_at string", "author_id", "author", metrics=(("comments", 0), ("reactions", 0), ("state", None), ("repo_full_name", None), ("number", None), ("labels", ()))),
    "reddit": Platform("post_id", "post_id string, text string, subreddit string, author string, author_id string, score bigint, num_comments bigint, upvote_ratio double, created_at string, link_url string", "author_id", "author", metrics=(("score", 0), ("num_comments", 0), ("upvote_ratio", None), ("subreddit", None), ("link_url", None))),
}


def first_lang(v: Column) -> Column:
    """The first of an array of languages, or the text itself, of a variant."""
    kind = F.schema_of_variant(v)
    return F.when(kind == "STRING", or_null(F.try_variant_get(v, "$", "string"))).when(kind.startswith("ARRAY"), F.try_variant_get(v, "$[0]", "string"))


def normalize(lines: DataFrame, platform: str, line: str = "line") -> tuple[DataFrame, DataFrame]:
    """(posts, rejects) of JSON lines; other columns (file, line number) go along. Blank lines are in neither; lines that aren't an object or
    lack the identifier are rejects."""
    p = PLATFORMS[platform]
    rest = [c for c in lines.columns if c != line]
    v = parsed(F.col(line))
    rows = lines.filter(F.length(F.regexp_replace(line, r"\s", "")) > 0).withColumns({"_v": v, "_r": F.from_json(line, f"{p.fields}, {_COMMON}", {"mode": "PERMISSIVE"})})
    object_ = F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False))
    key_ok = object_ & F.coalesce((F.schema_of_variant(F.try_variant_get("_v", f"$.{p.key}", "variant")) == "STRING") & (F.col(f"_r.{p.key}") != ""), F.lit(False))
    rows = rows.withColumn("_ok", key_ok)
    rejects = rows.filter(~F.col("_ok")).select(*rest, line)
    r = lambda c: F.col(f"_r.{c}")
    default = lambda c, d: r(c) if d is None else F.coalesce(r(c), F.array().cast("array<string>") if d == () else F.lit(d))
    metrics = F.to_json(F.struct(*[default(c, d).alias(c) for c, d in p.metrics]), {"ignoreNullFields": "false"}) if p.metrics else F.lit("{}")
    raw = F.try_variant_get("_v", "$.raw", "variant")
    has_raw = F.coalesce(~F.schema_of_variant(raw).isin("VOID", "OBJECT<>"), F.lit(False)) & ~F.coalesce(F.to_json(raw).isin('""', "0", "false", "[]", "{}"), F.lit(False))
    text = F.coalesce(r("text"), F.lit("")) if p.text == ("text",) else F.concat_ws("\n", *[or_null(r(c)) for c in p.text])
    keyword = or_null(r("keyword"))
    posts = rows.filter("_ok").select(
        *rest,
        F.concat(F.lit(f"{platform}:"), r(p.key)).alias("id"),
        F.lit(platform).alias("platform"),
        r(p.key).alias("native_id"),
        or_null(r(p.author_id)).alias("author_id"),
        or_null(r(p.author_handle)).alias("author_handle"),
        text.alias("text"),
        or_null(r("url")).alias("url"),
        (first_lang(F.try_variant_get("_v", "$.lang", "variant")) if p.lang else F.lit(None).cast("string")).alias("lang"),
        iso_utc(r(p.posted_at)).alias("posted_at"),
        iso_utc(r("collected_at")).alias("collected_at"),
        F.when(keyword.isNotNull(), F.array(keyword)).otherwise(F.array().cast("array<string>")).alias("matched_keywords"),
        metrics.alias("metrics"),
        F.when(has_raw, F.to_json(raw)).otherwise(F.to_json("_v")).alias("raw"),
        F.lit("pending").alias("extraction_status"),
    )
    return posts, rejects


# Captured answers: one JSON object of the service per row in column v (variant).


def _at(path: str, kind: str = "string") -> Column:
    return F.try_variant_get("v", f"$.{path}", kind)


def _lines(*parts: Column) -> Column:
    return F.concat_ws("\n", *[or_null(p) for p in parts])


def flatten_bluesky() -> dict[str, Column]:
    uri, handle = _at("uri"), F.coalesce(_at("author.handle"), F.lit(""))
    return {"post_id": uri, "text": F.coalesce(_at("record.text"), F.lit("")), "author_handle": handle, "author_display_name": F.coalesce(_at("author.displayName"), F.lit("")), "author_did": F.coalesce(_at("author.did"), F.lit("")), "lang": F.coalesce(_at("record.langs", "array<string>"), F.array().cast("array<string>")), **{n: F.coalesce(_at(c, "bigint"), F.lit(0)) for n, c in (("like_count", "likeCount"), ("repost_count", "repostCount"), ("reply_count", "replyCount"))}, "created_at": F.coalesce(_at("record.createdAt"), F.lit("")), "indexed_at": F.coalesce(_at("indexedAt"), F.lit("")), "url": F.concat(F.lit("https://bsky.app/profile/"), handle, F.lit("/post/"), F.element_at(F.split(uri, "/"), -1))}


def flatten_youtube() -> dict[str, Column]:
    text = lambda c: F.coalesce(_at(f"snippet.{c}"), F.lit(""))
    key = _at("id.videoId")
    return {"video_id": key, "title": text("title"), "description": text("description"), "channel_id": text("channelId"), "channel_title": text("channelTitle"), "published_at": text("publishedAt"), "url": F.concat(F.lit("https://www.youtube.com/watch?v="), key)}


def flatten_hackernews() -> dict[str, Column]:
    """story_text and comment_text are expected without HTML: see functions.text.clean_html."""
    key, title = _at("objectID"), or_null(_at("title"))
    kind = F.when(F.array_contains(F.coalesce(_at("_tags", "array<string>"), F.array().cast("array<string>")), "comment"), "comment").otherwise("story")
    own = F.concat(F.lit("https://news.ycombinator.com/item?id="), key)
    text = _lines(F.coalesce(title, or_null(_at("story_title"))), F.coalesce(F.col("story_text"), F.col("comment_text")))
    return {"item_id": key, "text": text, "title": title, "item_type": kind, "author": F.coalesce(_at("author"), F.lit("")), "points": F.coalesce(_at("points", "bigint"), F.lit(0)), "num_comments": F.coalesce(_at("num_comments", "bigint"), F.lit(0)), "story_id": _at("story_id"), "created_at": F.coalesce(_at("created_at"), F.lit("")), "url": F.when(kind == "comment", own).otherwise(F.coalesce(or_null(_at("url")), own))}


# Marks of thread titles and of the side a posting takes.
THREAD_KINDS = (("hiring", "Who is hiring"), ("freelancer", "Freelancer? Seeking freelancer"), ("hired", "Who wants to be hired"))
#: The accounts that open each kind of thread.
THREAD_AUTHORS = {"hiring": ("whoishiring",), "freelancer": ("whoishiring", "jon_north"), "hired": ("whoishiring",)}
SEEKING, SEEKING_CHARS = (("freelancer", "SEEKING FREELANCER"), ("work", "SEEKING WORK")), 120


def thread_kind(title: Column) -> Column:
    """The kind of a monthly thread, null for other titles."""
    return F.coalesce(*[F.when(F.lower(title).contains(mark.lower()), kind) for kind, mark in THREAD_KINDS])


def seeking_role(body: Column) -> Column:
    """The side that a posting's first characters name, null if none."""
    head = F.upper(F.substring(body, 1, SEEKING_CHARS))
    return F.coalesce(*[F.when(head.contains(mark), role) for role, mark in SEEKING])


def is_job_entry() -> Column:
    """Whether a comment stands directly under its thread."""
    return F.coalesce(_at("parent_id").isNotNull() & (_at("parent_id") == _at("story_id")), F.lit(False))


def flatten_hnjobs() -> dict[str, Column]:
    """Needs thread_id, thread_title, thread_kind beside v, and comment_text without HTML."""
    key, body = _at("objectID"), F.coalesce(F.col("comment_text"), F.lit(""))
    return {"item_id": key, "text": _lines(F.col("thread_title"), body), "thread_id": F.col("thread_id"), "thread_title": F.col("thread_title"), "thread_kind": F.col("thread_kind"), "seeking": seeking_role(body), "author": F.coalesce(_at("author"), F.lit("")), "created_at": F.coalesce(_at("created_at"), F.lit("")), "url": F.concat(F.lit("https://news.ycombinator.com/item?id="), key)}


def repo_full_name(url: Column) -> Column:
    """The last two parts of an address, '' if there are fewer."""
    parts = F.split(F.regexp_replace(url, "/+$", ""), "/")
    return F.when(F.size(parts) >= 2, F.concat_ws("/", F.slice(parts, -2, 2))).otherwise("")


def label_names(labels: Column) -> Column:
    """Names of labels that are texts or objects with a name; others are left out."""
    each = F.transform(F.coalesce(labels.cast("array<variant>"), F.array().cast("array<variant>")), lambda x: F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string")).when(F.schema_of_variant(x).startswith("OBJECT"), F.coalesce(F.try_variant_get(x, "$.name", "string"), F.lit(""))))
    return F.array_compact(each)


def flatten_github() -> dict[str, Column]:
    title, body = F.coalesce(_at("title"), F.lit("")), or_null(_at("body"))
    text = lambda c: F.coalesce(_at(c), F.lit(""))
    return {"issue_id": _at("id"), "text": _lines(title, body), "title": title, "body": body, "repo_full_name": F.coalesce(repo_full_name(_at("repository_url")), F.lit("")), "number": F.coalesce(_at("number", "bigint"), F.lit(0)), "state": text("state"), "author": text("user.login"), "author_id": text("user.id"), "comments": F.coalesce(_at("comments", "bigint"), F.lit(0)), "reactions": F.coalesce(_at("reactions.total_count", "bigint"), F.lit(0)), "labels": label_names(_at("labels", "array<variant>")), "created_at": text("created_at"), "updated_at": text("updated_at"), "url": text("html_url")}


def flatten_reddit() -> dict[str, Column]:
    title, body, link = F.coalesce(_at("title"), F.lit("")), or_null(_at("selftext")), or_null(_at("permalink"))
    return {"post_id": _at("name"), "text": _lines(title, body), "title": title, "selftext": body, "subreddit": F.coalesce(_at("subreddit"), F.lit("")), "author": F.coalesce(or_null(_at("author")), F.lit("[deleted]")), "author_id": or_null(_at("author_fullname")), "score": F.coalesce(_at("score", "bigint"), F.lit(0)), "num_comments": F.coalesce(_at("num_comments", "bigint"), F.lit(0)), "upvote_ratio": _at("upvote_ratio", "double"), "created_at": epoch_iso(_at("created_utc", "double")), "url": F.coalesce(F.concat(F.lit("https://www.reddit.com"), link), F.lit("")), "link_url": or_null(_at("url"))}


FLATTENERS = {"bluesky": flatten_bluesky, "youtube": flatten_youtube, "hackernews": flatten_hackernews, "hnjobs": flatten_hnjobs, "github": flatten_github, "reddit": flatten_reddit}


def flatten(items: DataFrame, platform: str, item: str = "item") -> DataFrame:
    """Landing records of a service's items: items (item: JSON text, keyword, collected_at, and thread columns for hnjobs). Items without an
    identifier, and comments of hnjobs that aren't entries, are left out."""
    from tidewrack.functions.text import clean_html

    rows = items.withColumn("v", F.try_parse_json(item)).filter("v IS NOT NULL")
    if platform in ("hackernews", "hnjobs"):
        rows = rows.withColumns({"story_text": _at("story_text"), "comment_text": _at("comment_text"), "v": F.to_json("v")})
        rows = clean_html(clean_html(rows, "story_text"), "comment_text").withColumn("v", F.try_parse_json("v"))
    if platform == "hnjobs":
        rows = rows.filter(is_job_entry())
    made = FLATTENERS[platform]()
    return rows.select(*[c.alias(n) for n, c in made.items()], "keyword", "collected_at", F.to_json("v").alias("raw")).filter(F.col(PLATFORMS[platform].key).isNotNull())


def select_threads(threads: DataFrame, kinds: list[str], n: int) -> DataFrame:
    """The newest n threads per kind: threads (thread_id, title, created_at, author_no, position) with ``kind``; ties keep the order in which
    authors and their threads came."""
    from pyspark.sql import Window

    rows = threads.withColumn("kind", thread_kind(F.col("title"))).filter(F.col("kind").isin(*kinds) & F.col("thread_id").isNotNull())
    order = Window.partitionBy("kind").orderBy(F.desc(F.coalesce("created_at", F.lit(""))), "author_no", "position")
    return rows.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= n).drop("rn")


def authors_of(kinds: list[str]) -> list[str]:
    """The accounts to list threads of, each once, in order of the kinds. Unknown kinds and an empty list raise."""
    unknown = [k for k in kinds if k not in THREAD_AUTHORS]
    if unknown or not kinds:
        raise ValueError(f"unknown kinds of threads: {unknown}" if unknown else "no kinds of threads")
    return list(dict.fromkeys(a for k in kinds for a in THREAD_AUTHORS[k]))


def threads_per_kind(selected: DataFrame, kinds: list[str]) -> DataFrame:
    """(kind, threads) for every wanted kind, 0 where there is none."""
    wanted = selected.sparkSession.createDataFrame([(k,) for k in kinds], "kind string")
    return wanted.join(selected.groupBy("kind").agg(F.count("*").alias("threads")), "kind", "left").select("kind", F.coalesce("threads", F.lit(0)).alias("threads"))


def missing_kinds(selected: DataFrame, kinds: list[str]) -> DataFrame:
    """(kind): wanted kinds of which there is no thread."""
    return selected.sparkSession.createDataFrame([(k,) for k in kinds], "kind string").join(selected.select("kind").distinct(), "kind", "left_anti")


def tasks(threads: DataFrame, keywords: DataFrame) -> DataFrame:
    """Every thread with every keyword: the searches to run. Both are short lists of a configuration, so their product is one, too."""
    return threads.crossJoin(F.broadcast(keywords))
