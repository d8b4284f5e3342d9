"""Queries of the problems on text corpora over the test tables, and the SQL that gives the same where SQL can."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack.llm import dedup, gram, language, leaks, neighbours, packing, sketch, truncation
from tidewrack.session import cut, shared_dir, table

#: Problem 2: least rows with both keywords, least share of all rows, least ratio to chance.
P2_COUNT, P2_SHARE, P2_LIFT = 5, 1 / 1000, 3.0


def p2_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of keywords that occur together often enough, with counts and ratio to chance."""
    pairs = gram.cooccurrence(table(spark, sf_dir, "posts"), "matched_keywords", P2_COUNT, P2_SHARE)
    return pairs.select(F.col("item_a").alias("keyword_a"), F.col("item_b").alias("keyword_b"), "n_a", "n_b", "n_ab", "n", F.round("lift", 6).alias("lift"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of keywords that occur together at least three times as often as by chance."""
    return p2_pairs(spark, sf_dir).filter(F.col("n_ab") * F.col("n") >= F.lit(3) * F.col("n_a") * F.col("n_b")).select("keyword_a", "keyword_b")


#: Problems 3 and 6: least similarity of the sets of 4-character substrings, least characters of a normalised text.
P6_SIMILARITY, P6_CHARS = 0.6, 60


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = table(spark, sf_dir, "posts").select(F.lit("posts").alias("space"), "text", F.col("row_id").alias("key"))
    return posts.unionByName(table(spark, sf_dir, "insights").select(F.lit("insights").alias("space"), F.col("summary").alias("text"), F.col("insight_no").alias("key")))


#: Problem 3: load batches are put into the history in so many runs of consecutive ones, as a backlog is.
P3_LOADS = 3


def _arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = table(spark, sf_dir, "posts")
    return posts.select("load_batch", "row_id", dedup.item_of(F.col("platform"), F.col("native_id"), F.col("id")).alias("item"), "text")


def _history_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/p3-{uuid.uuid4().hex}"


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of posts that repeat an item or a text of an earlier row, each with the first row of its set: load batches go into a history."""
    df = _arrivals(spark, sf_dir)
    low, high = df.agg(F.min("load_batch"), F.max("load_batch")).first()
    ends = sorted({low + (high - low + 1) * k // P3_LOADS for k in range(P3_LOADS + 1)}) if low is not None else []
    loads = [(a, b - 1) for a, b in zip(ends, ends[1:], strict=False)]
    return dedup.repeats(df, _history_path(spark), loads, "load_batch", P6_SIMILARITY, P6_CHARS)


def p3_last_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refused rows of the last load batch against a history of all earlier ones."""
    df = _arrivals(spark, sf_dir)
    last = df.agg(F.max("load_batch")).first()[0]
    history = dedup.History(spark, _history_path(spark), P6_SIMILARITY, P6_CHARS)
    try:
        history.check(df.filter(F.col("load_batch") < last))
        return cut(history.check(df.filter(F.col("load_batch") == last)))
    finally:
        history.drop()


#: Problem 5: neighbours per vector and least cosine.
P5_K, P5_COSINE = 10, 0.85


def p5_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of posts of which at least one is a neighbour of the other, as similar_to edges hold them."""
    found = neighbours.nearest(table(spark, sf_dir, "insights"), "post_id", "embedding", "embedding_model", P5_K, P5_COSINE)
    return neighbours.pairs(found).select(F.col("a").alias("post_id_a"), F.col("b").alias("post_id_b"), "cosine")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of posts of which at least one is a neighbour of the other."""
    return p5_pairs(spark, sf_dir).drop("cosine")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of rows of posts, and of insights, with nearly equal text."""
    df = _texts(spark, sf_dir)
    pairs = cut(sketch.similar(df, P6_SIMILARITY, P6_CHARS))
    return sketch.row_pairs(df, pairs, P6_CHARS).select(F.col("space").alias("source"), "key_a", "key_b")


def p6_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row's class of equal texts and the number of other classes with nearly the same text."""
    df = _texts(spark, sf_dir)
    pairs = cut(sketch.similar(df, P6_SIMILARITY, P6_CHARS))
    links = pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))).groupBy("id").agg(F.count("*").alias("links"))
    return sketch.members(df, ["space", "key"], P6_CHARS).join(links, "id", "left").select(F.col("space").alias("source"), "key", F.col("id").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"))


def p7_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each post's languages, with the number of sentences and the confidence of each."""
    model = language.model_of(table(spark, sf_dir, "lang_samples"), "lang", "sample_text")
    return language.languages(table(spark, sf_dir, "posts"), "row_id", "text", model).withColumnRenamed("key", "row_id")


def p7_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each whole sentence of each post with its language and confidence."""
    model = language.model_of(table(spark, sf_dir, "lang_samples"), "lang", "sample_text")
    return language.segments(table(spark, sf_dir, "posts"), "row_id", "text", model).withColumnRenamed("key", "row_id")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of posts that their label doesn't name."""
    model = language.model_of(table(spark, sf_dir, "lang_samples"), "lang", "sample_text")
    posts = table(spark, sf_dir, "posts")
    label = F.lower(F.regexp_extract("lang", r"^[\s\p{Z}]*([A-Za-z]{2})(?:[-_][A-Za-z0-9_-]*)?[\s\p{Z}]*$", 1))
    df = posts.select(F.struct("row_id", F.coalesce(label, F.lit("")).alias("label")).alias("key"), "text")
    return language.languages(df, "key", "text", model).filter(F.col("lang") != F.col("key.label")).select("key.row_id", "lang")


#: Problem 8: the capacity where none is asked for.
P8_CAPACITY = 2048


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's pieces (one, unless it exceeds the capacity) and their containers."""
    got = packing.pack(table(spark, sf_dir, "documents"), "doc_id", "text", P8_CAPACITY)
    return got.select(F.col("key").alias("doc_id"), "piece", "tokens", F.col("container").alias("container_id"))


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per kind of container how many are used, the tokens in them and the share of their room that is filled."""
    sized = cut(packing.measured(table(spark, sf_dir, "documents"), "doc_id", "text"))
    kinds = table(spark, sf_dir, "container_spec").collect()  # a few rows of a fixed table
    out = None
    for k in sorted(kinds, key=lambda r: r["capacity_tokens"]):
        capacity = k["capacity_tokens"]
        one = packing.packed(sized, capacity).agg(F.count_distinct("container").alias("containers"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"))
        one = one.select(F.lit(k["container_kind"]).alias("container_kind"), F.lit(capacity).alias("capacity_tokens"), "containers", "tokens", F.try_divide(F.col("tokens"), F.col("containers") * capacity).alias("filled"))
        out = one if out is None else out.unionByName(one)
    return out


#: Problem 9: largest edit distance at which a whole item counts as present in p9_near.
P9_EDITS = 40


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the evaluation items they share a passage with."""
    got = leaks.leaks(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_items"), "item_id", "item_text")
    return got.filter(F.col("shared") >= leaks.MIN_COMMON).select("doc_id", "item_id")


def p9_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a whole item with few edits, with the edit distance."""
    got = leaks.leaks(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_items"), "item_id", "item_text", P9_EDITS)
    return got.filter("edits IS NOT NULL").select("doc_id", "item_id", "edits")


#: Problem 10: a document counts as cut from this score on.
P10_SCORE = 0.5


def p10_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the probability that its text was cut."""
    return truncation.scores(table(spark, sf_dir, "documents"), "doc_id", "source", "text").select(F.col("key").alias("doc_id"), "source", "cut_score")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose text was cut."""
    return p10_scores(spark, sf_dir).filter(F.col("cut_score") >= P10_SCORE).select("doc_id")


def p10_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents of each source are cut, and their share."""
    cut_n = F.count_if(F.col("cut_score") >= P10_SCORE)
    return p10_scores(spark, sf_dir).groupBy("source").agg(F.count("*").alias("documents"), cut_n.alias("cut"), (cut_n / F.count("*")).alias("share"))


_P2_SQL = r"""
WITH r AS (SELECT row_id, lower(regexp_replace(k, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) AS k FROM (SELECT row_id, unnest(matched_keywords) AS k FROM posts)),
k AS (SELECT DISTINCT row_id, k FROM r WHERE k IS NOT NULL AND k <> ''),
n AS (SELECT count(DISTINCT row_id) AS n FROM k),
c AS (SELECT k, count(*) AS c FROM k GROUP BY k),
p AS (SELECT a.k AS keyword_a, b.k AS keyword_b, count(*) AS n_ab FROM k a JOIN k b ON a.row_id = b.row_id AND a.k < b.k GROUP BY 1, 2),
f AS (SELECT keyword_a, keyword_b, x.c AS n_a, y.c AS n_b, n_ab, n.n AS n, round(n_ab * n.n::DOUBLE / (x.c * y.c), 6) AS lift
      FROM p JOIN c x ON x.k = keyword_a JOIN c y ON y.k = keyword_b, n WHERE n_ab >= 5 AND n_ab * 1000 >= n.n)
"""


def queries() -> dict:
    return {"p2_found": p2_found, "p2_pairs": p2_pairs, "p3_found": p3_found, "p3_last_batch": p3_last_batch, "p5_found": p5_found, "p5_pairs": p5_pairs, "p6_found": p6_found, "p6_links": p6_links, "p7_found": p7_found, "p7_languages": p7_languages, "p7_segments": p7_segments, "p8_containers": p8_containers, "p8_fill": p8_fill, "p9_found": p9_found, "p9_near": p9_near, "p10_found": p10_found, "p10_scores": p10_scores, "p10_sources": p10_sources}


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": _P2_SQL + "SELECT keyword_a, keyword_b FROM f WHERE n_ab * n >= 3 * n_a * n_b",
        "p2_pairs": _P2_SQL + "SELECT * FROM f",
    }
