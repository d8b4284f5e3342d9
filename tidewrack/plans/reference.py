"""The engine's own queries over the test tables, each with the SQL that gives the same rows.

The table posts holds rows as they arrive; the store's posts are what upserting them in order gives. Times of the report are fixed, as the
tables are."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack.functions.text import PAIN_WORDS, pain, space_trim
from tidewrack.functions.time import ISO, epoch_iso, iso_utc
from tidewrack.functions.vectors import cosine
from tidewrack.operators import graph, normalize, queue, report, search, store, telemetry, textscan, validate
from tidewrack.session import table

COLLECTED = (datetime(2026, 8, 2), datetime(2026, 8, 4))
EXTRACTED = (datetime(2026, 8, 7), datetime(2026, 8, 10))
DOMAINS = ["model_quality", "edge_compute", "fab_rigs", "coast_ops", "fleet_admin", "other"]
MODEL, TOP, SIMILAR = "sigvec-64", 10, 0.85


def raw_posts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "posts").withColumn("posted_at", iso_utc(F.col("posted_at")))


def posts_of(spark: SparkSession, sf: str) -> DataFrame:
    # times are read after the upsert: once per post, and only where they are asked for
    return store.upsert_posts(None, table(spark, sf, "posts"), "row_id").withColumn("posted_at", iso_utc(F.col("posted_at")))


def insights_of(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "insights")


def both_of(spark: SparkSession, sf: str) -> DataFrame:
    return report.joined(insights_of(spark, sf), posts_of(spark, sf))


def vectors_of(spark: SparkSession, sf: str) -> DataFrame:
    """Insights with the usable vectors of one model."""
    return insights_of(spark, sf).filter((F.col("embedding_model") == MODEL) & (F.size("embedding") == 64))


def events_of(spark: SparkSession, sf: str) -> DataFrame:
    """The stream table as check events."""
    e = table(spark, sf, "events")
    rule = F.concat(F.lit("r"), F.get_json_object("props", "$.k").cast("int") % 5)
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return e.select(F.concat_ws("-", "event_type", F.get_json_object("props", "$.k").cast("int") % 20).alias("check"), F.when(F.col("value") > 250, 1).otherwise(0).alias("exit_code"), F.floor(F.col("value") * 10).cast("bigint").alias("duration_ms"), F.lit(1).cast("bigint").alias("violations"), F.array(rule).alias("rules"), at.alias("ts"), F.col("ts").alias("ts_instant"), F.to_date("ts").alias("ts_day"))


_G = lambda c, i, d="": f"coalesce(nullif(regexp_extract({c}, '{ISO}', {i}), ''), '{d}')"


def iso_sql(c: str) -> str:
    g = lambda i, d="": _G(c, i, d)
    wall = f"{g(1)}||'-'||{g(2)}||'-'||{g(3)}||' '||{g(4, '00')}||':'||{g(5, '00')}||':'||{g(6, '00')}||'.'||rpad(substr({g(7, '0')}, 1, 6), 6, '0')"
    digits = f"rpad(replace(substr({g(8)}, 2), ':', ''), 4, '0')"
    minutes = f"CASE WHEN {g(8)} IN ('', 'Z') THEN 0 ELSE (CASE WHEN {g(8)} LIKE '-%' THEN -1 ELSE 1 END) * (CAST(substr({digits}, 1, 2) AS INT) * 60 + CAST(substr({digits}, 3, 2) AS INT)) END"
    return f"CASE WHEN regexp_matches({c}, '{ISO}') THEN TRY_CAST({wall} AS TIMESTAMP) - to_minutes({minutes}) END"


_RAW = f"raw AS (SELECT row_id, id, platform, native_id, author_id, author_handle, text, url, lang, {iso_sql('posted_at')} AS posted_at, collected_at, matched_keywords, metrics, raw, extraction_status FROM posts)"
_P = f"""WITH {_RAW},
lst AS (SELECT * FROM raw WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY row_id DESC) = 1),
fst AS (SELECT id, platform, native_id, extraction_status FROM raw WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY row_id) = 1),
wrd AS (SELECT id, list_sort(list(DISTINCT k)) AS w FROM (SELECT id, unnest(matched_keywords) AS k FROM posts) WHERE k IS NOT NULL GROUP BY id),
p AS (SELECT id, f.platform, f.native_id, author_id, author_handle, text, url, lang, posted_at, collected_at, coalesce(w, []) AS matched_keywords, metrics, raw, f.extraction_status
      FROM lst JOIN fst f USING (id) LEFT JOIN wrd USING (id)),
b AS (SELECT i.*, p.* EXCLUDE (id) FROM insights i JOIN p ON p.id = i.post_id)
"""
_T = lambda t: f"TIMESTAMP '{t}'"
_IN = lambda c, s: f"{c} >= {_T(s[0])} AND {c} < {_T(s[1])}"
_TRIM = lambda c: f"regexp_replace({c}, '^\\p{{Zs}}+|\\p{{Zs}}+$', '', 'g')"
_EXAMPLE = lambda u: f"arg_max({u}, row(posted_at, post_id)) FILTER (WHERE {u} IS NOT NULL AND posted_at IS NOT NULL)"
_PAIRS = "kw AS (SELECT DISTINCT id, posted_at, collected_at, k FROM (SELECT id, posted_at, collected_at, unnest(matched_keywords) AS k FROM p) WHERE k IS NOT NULL), pr AS (SELECT a.id, a.posted_at, a.collected_at, a.k AS a, b.k AS b FROM kw a JOIN kw b ON a.id = b.id AND a.k < b.k)"
_MENTIONS = f"m AS (SELECT * FROM (SELECT b.*, {_TRIM('c')} AS product FROM (SELECT *, unnest(competitors) AS c FROM b) b) WHERE length(product) > 0)"
_EDGE = lambda st, s, dt, d, k, w, o, src: f"SELECT '{st}' AS src_type, {s} AS src_id, '{dt}' AS dst_type, {d} AS dst_id, '{k}' AS edge_type, CAST({w} AS FLOAT) AS weight, {o} AS observed_at FROM {src} GROUP BY {s}, {d}"
_VEC = f"v AS (SELECT post_id, embedding::DOUBLE[] AS e FROM insights WHERE embedding_model = '{MODEL}' AND len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))) AND list_bool_or(list_transform(embedding, lambda x: x <> 0)))"
_EVENTS = "e AS (SELECT event_type || '-' || (CAST(json_extract_string(props, '$.k') AS INT) % 20) AS \"check\", CASE WHEN value > 250 THEN 1 ELSE 0 END AS exit_code, CAST(floor(value * 10) AS BIGINT) AS duration_ms, 1 AS violations, 'r' || (CAST(json_extract_string(props, '$.k') AS INT) % 5) AS rule, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, ts AS ts_instant, ts::DATE AS day FROM events)"

_QUERIES: dict = {}
_SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(f):
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return add


# store


@_query("posts_upsert", _P + "SELECT * EXCLUDE (raw, metrics) FROM p")
def posts_upsert(spark, sf):
    return posts_of(spark, sf).drop("raw", "metrics")


@_query("posts_upsert_batches", _P + "SELECT * EXCLUDE (raw, metrics) FROM p")
def posts_upsert_batches(spark, sf):
    """The same from a stored half and the batches after it."""
    raw = raw_posts(spark, sf)
    old = store.upsert_posts(None, raw.filter("load_batch < 6"), "row_id")
    return store.upsert_posts(old, raw.filter("load_batch >= 6"), "row_id").drop("raw", "metrics")


@_query("load_counts", "WITH o AS (SELECT DISTINCT id FROM posts WHERE load_batch < 6), n AS (SELECT id FROM posts WHERE load_batch >= 6) SELECT (SELECT count(DISTINCT id) FROM n WHERE id NOT IN (SELECT id FROM o)) AS inserted, (SELECT count(*) FROM n) - (SELECT count(DISTINCT id) FROM n WHERE id NOT IN (SELECT id FROM o)) AS updated")
def load_counts(spark, sf):
    raw = table(spark, sf, "posts")
    return store.load_counts(raw.filter("load_batch < 6"), raw.filter("load_batch >= 6"))


@_query("known_ids", "SELECT DISTINCT native_id FROM posts WHERE platform = 'reddit'")
def known_ids(spark, sf):
    return store.known_ids(table(spark, sf, "posts"), "reddit")


@_query("keyword_rows", "SELECT array_to_string(matched_keywords, '|') AS keywords, text FROM posts WHERE platform = 'github'")
def keyword_rows(spark, sf):
    return store.keyword_rows(table(spark, sf, "posts"), "github").select(F.array_join("matched_keywords", "|").alias("keywords"), "text")


@_query("keyword_hits", _P + ", h AS (SELECT 'reddit' AS platform, post_id AS native_id, list(DISTINCT keyword) AS hits FROM reddit_post WHERE keyword IS NOT NULL GROUP BY post_id) SELECT id, CASE WHEN hits IS NULL THEN matched_keywords ELSE list_sort(list_distinct(matched_keywords || hits)) END AS matched_keywords FROM p LEFT JOIN h USING (platform, native_id)")
def keyword_hits(spark, sf):
    hits = table(spark, sf, "reddit_post").select(F.lit("reddit").alias("platform"), F.col("post_id").alias("native_id"), "keyword").filter("keyword IS NOT NULL")
    return store.record_keyword_hits(posts_of(spark, sf), hits).select("id", "matched_keywords")


@_query("insights_upsert", "WITH n AS (SELECT * REPLACE (CASE WHEN insight_no % 2 = 0 THEN summary || ' (2)' ELSE summary END AS summary, 'x9' AS extractor_version) FROM insights WHERE insight_no % 3 = 0) SELECT post_id, coalesce(n.extractor_version, o.extractor_version) AS extractor_version, CASE WHEN n.post_id IS NOT NULL THEN n.summary ELSE o.summary END AS summary, CASE WHEN n.post_id IS NULL OR o.summary IS NOT DISTINCT FROM n.summary THEN o.embedding_model END AS embedding_model FROM insights o LEFT JOIN n USING (post_id)")
def insights_upsert(spark, sf):
    """A new version of every third insight, of which half have another summary: the input of an upsert, made of the whole table."""
    old = insights_of(spark, sf)
    return store.upsert_insights(old.drop("insight_no"), _new_insights(old)).select("post_id", "extractor_version", "summary", "embedding_model")


def _new_insights(old: DataFrame) -> DataFrame:
    changed = F.when(F.col("insight_no") % 2 == 0, F.concat("summary", F.lit(" (2)"))).otherwise(F.col("summary"))
    return old.filter("insight_no % 3 = 0").withColumns({"summary": changed, "extractor_version": F.lit("x9")}).drop("embedding", "embedding_model", "insight_no")


@_query("cleared_embeddings", "SELECT count(*) AS cleared FROM insights WHERE insight_no % 6 = 0 AND embedding IS NOT NULL AND summary IS NOT NULL")
def cleared_embeddings(spark, sf):
    old = insights_of(spark, sf)
    return store.cleared_embeddings(old, _new_insights(old))


@_query("reset_vectors", "SELECT count(*) AS cleared FROM insights WHERE embedding IS NOT NULL")
def reset_vectors(spark, sf):
    return store.reset_vectors(insights_of(spark, sf))[1]


def _tasks(spark, sf):
    rows = table(spark, sf, "hackernews_item")
    return rows.select((F.col("row_no") % 7).cast("int").alias("task_no"), F.col("row_no").alias("item_no"), F.trim("item_id").alias("native_id"))


_COLLECT = "WITH i AS (SELECT CAST(row_no % 7 AS INT) AS task_no, row_no AS item_no, trim(item_id) AS native_id FROM hackernews_item), k AS (SELECT DISTINCT native_id FROM posts WHERE platform = 'hackernews' AND load_batch < 3), o AS (SELECT i.*, CASE WHEN k.native_id IS NOT NULL THEN 'hit' WHEN row_number() OVER w = 1 THEN 'new' WHEN task_no > first_value(task_no) OVER w THEN 'hit' ELSE 'skip' END AS outcome FROM i LEFT JOIN k USING (native_id) WINDOW w AS (PARTITION BY native_id ORDER BY task_no, item_no)) "


@_query("collect_dedup", _COLLECT + "SELECT * FROM o")
def collect_dedup(spark, sf):
    return store.collect_dedup(_tasks(spark, sf), table(spark, sf, "posts").filter("platform = 'hackernews' AND load_batch < 3").select("native_id").distinct())


@_query("collect_summary", _COLLECT + "SELECT task_no, count(*) AS fetched, count(*) FILTER (outcome = 'new') AS added, count(*) FILTER (outcome <> 'new') AS skipped FROM o GROUP BY 1")
def collect_summary(spark, sf):
    return store.collect_summary(collect_dedup(spark, sf))


# report


@_query("daily_counts", _P + f"SELECT platform, collected_at::DATE AS day, count(*) AS count FROM p WHERE {_IN('collected_at', COLLECTED)} GROUP BY 1, 2")
def daily_counts(spark, sf):
    return report.daily_counts(posts_of(spark, sf), *COLLECTED)


@_query("type_counts", _P + f"SELECT insight_type, count(*) AS count, {_EXAMPLE('url')} AS example_url FROM b WHERE {_IN('extracted_at', EXTRACTED)} GROUP BY 1")
def type_counts(spark, sf):
    return report.type_counts(both_of(spark, sf), *EXTRACTED)


@_query("domain_counts", _P + f", c AS (SELECT domain, count(*) AS count, {_EXAMPLE('url')} AS example_url FROM b WHERE {_IN('extracted_at', EXTRACTED)} AND domain IS NOT NULL GROUP BY 1), o AS (SELECT domain, count(*) AS n FROM b WHERE extracted_at >= TIMESTAMP '2026-08-04' AND extracted_at < TIMESTAMP '2026-08-07' AND domain IS NOT NULL GROUP BY 1) SELECT domain, count, coalesce(n, 0) AS previous_count, example_url FROM c LEFT JOIN o USING (domain)")
def domain_counts(spark, sf):
    return report.domain_counts(both_of(spark, sf), *EXTRACTED)


@_query("top_signals", _P + f"SELECT post_id, platform, url, summary, domain FROM b WHERE {_IN('extracted_at', EXTRACTED)} AND pain_level = 3 AND monetizable")
def top_signals(spark, sf):
    return report.top_signals(both_of(spark, sf), *EXTRACTED)


@_query("top_keywords", _P + f"SELECT k AS keyword, count(*) AS count FROM (SELECT unnest(matched_keywords) AS k FROM p WHERE {_IN('collected_at', COLLECTED)}) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {TOP}")
def top_keywords(spark, sf):
    return report.top_keywords(posts_of(spark, sf), *COLLECTED, TOP)


@_query("keyword_pairs", _P + f", {_PAIRS} SELECT a AS keyword_a, b AS keyword_b, count(*) AS count FROM pr WHERE {_IN('collected_at', COLLECTED)} GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT {TOP}")
def keyword_pairs(spark, sf):
    return report.top_keyword_pairs(posts_of(spark, sf), *COLLECTED, TOP)


@_query("new_competitors", _P + f", {_MENTIONS} SELECT product, min(extracted_at) AS first_seen, {_EXAMPLE('url')} AS example_url FROM m GROUP BY 1 HAVING {_IN('min(extracted_at)', EXTRACTED)}")
def new_competitors(spark, sf):
    return report.new_competitors(both_of(spark, sf), *EXTRACTED)


@_query("opportunity", _P + f"SELECT post_id, insight_type, domain, summary, pain_level, monetizable, url FROM b WHERE {_IN('extracted_at', EXTRACTED)} AND insight_type <> 'none'")
def opportunity(spark, sf):
    return report.opportunities(both_of(spark, sf), *EXTRACTED).drop("competitors")


@_query("report_lines", _P + f"SELECT '| ' || insight_type || ' | ' || count(*) || ' | ' || coalesce({_EXAMPLE('url')}, '-') || ' |' AS line FROM b WHERE {_IN('extracted_at', EXTRACTED)} GROUP BY insight_type")
def report_lines(spark, sf):
    return report.section_lines("type_counts", report.type_counts(both_of(spark, sf), *EXTRACTED))


# graph


@_query("edges_mentions", _P + f", {_MENTIONS} " + _EDGE("author", "author_id", "product", "product", "mentions", "count(*)", "max(posted_at)", "(SELECT * FROM m WHERE author_id IS NOT NULL)"))
def edges_mentions(spark, sf):
    return graph.mentions(both_of(spark, sf))


@_query("edges_cooccurs", _P + f", {_PAIRS} " + _EDGE("keyword", "a", "keyword", "b", "cooccurs", "count(*)", "max(posted_at)", "pr"))
def edges_cooccurs(spark, sf):
    return graph.cooccurs(posts_of(spark, sf))


@_query("edges_belongs_to", _P + ", k AS (SELECT DISTINCT post_id, domain, posted_at, k FROM (SELECT post_id, domain, posted_at, unnest(matched_keywords) AS k FROM b WHERE domain IS NOT NULL) WHERE k IS NOT NULL) " + _EDGE("keyword", "k", "domain", "domain", "belongs_to", "count(*)", "max(posted_at)", "k"))
def edges_belongs_to(spark, sf):
    return graph.belongs_to(both_of(spark, sf))


_SIM = f"{_VEC}, s AS (SELECT a.post_id AS a, b.post_id AS b, list_cosine_similarity(a.e, b.e) AS sim FROM v a JOIN v b ON a.post_id < b.post_id WHERE list_cosine_similarity(a.e, b.e) >= {SIMILAR}), mi AS (SELECT a AS src, b AS dst, sim FROM s UNION ALL SELECT b, a, sim FROM s), t AS (SELECT * FROM mi QUALIFY row_number() OVER (PARTITION BY src ORDER BY round(sim, 12) DESC, dst) <= {TOP}), c AS (SELECT least(src, dst) AS a, greatest(src, dst) AS b, max(sim) AS sim FROM t GROUP BY 1, 2)"


@_query("similar_to", _P + f", {_SIM} SELECT c.a AS src_id, c.b AS dst_id, round(c.sim, 4) AS weight, greatest(x.posted_at, y.posted_at) AS observed_at FROM c JOIN p x ON x.id = c.a JOIN p y ON y.id = c.b")
def similar_to(spark, sf):
    rows = graph.nearest_pairs(vectors_of(spark, sf), posts_of(spark, sf), SIMILAR, TOP, limit=None)
    return rows.select(F.col("a").alias("src_id"), F.col("b").alias("dst_id"), F.round("sim", 4).alias("weight"), "observed_at")


@_query("edges_rebuild", _P + f", {_PAIRS} SELECT edge_type, count(*) AS n FROM (" + _EDGE("keyword", "a", "keyword", "b", "cooccurs", "count(*)", "max(posted_at)", "pr") + " UNION ALL SELECT * FROM edges WHERE edge_type <> 'cooccurs') GROUP BY 1")
def edges_rebuild(spark, sf):
    return graph.rebuild(table(spark, sf, "edges"), posts_of(spark, sf), insights_of(spark, sf), ("cooccurs",)).groupBy("edge_type").agg(F.count("*").alias("n"))


@_query("graph_top_cooccur", "SELECT src_id, dst_id, weight FROM edges WHERE edge_type = 'cooccurs' ORDER BY weight DESC, src_id, dst_id LIMIT 20")
def graph_top_cooccur(spark, sf):
    return graph.top_cooccurring(table(spark, sf, "edges"))


_PRODUCT = "(SELECT dst_id FROM edges WHERE edge_type = 'mentions' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


@_query("graph_product_accounts", f"SELECT src_id AS author_id, weight FROM edges WHERE edge_type = 'mentions' AND dst_id = {_PRODUCT}")
def graph_product_accounts(spark, sf):
    edges = table(spark, sf, "edges")
    top = edges.filter("edge_type = 'mentions'").groupBy("dst_id").count().orderBy(F.desc("count"), "dst_id").first()
    return graph.accounts_of(edges, top["dst_id"] if top else "")


@_query("graph_neighbors", "WITH s AS (SELECT * FROM edges WHERE edge_type = 'similar_to'), q AS (SELECT min(dst_id) AS q FROM s) SELECT CASE WHEN src_id = q THEN dst_id ELSE src_id END AS neighbour_id, max(weight) AS weight FROM s, q WHERE src_id = q OR dst_id = q GROUP BY 1")
def graph_neighbors(spark, sf):
    edges = table(spark, sf, "edges")
    q = edges.filter("edge_type = 'similar_to'").agg(F.min("dst_id").alias("q")).first()["q"]
    return graph.neighbours_of(edges, q or "")


@_query("pair_endpoints", _P + "SELECT src_id, dst_id, x.platform AS src_platform, y.platform AS dst_platform FROM edges e JOIN p x ON x.id = e.src_id JOIN p y ON y.id = e.dst_id WHERE e.edge_type = 'similar_to'")
def pair_endpoints(spark, sf):
    """Both ends of each stored pair looked up in posts."""
    side = lambda k: posts_of(spark, sf).select(F.col("id").alias(f"{k}_id"), F.col("platform").alias(f"{k}_platform"))
    return table(spark, sf, "edges").filter("edge_type = 'similar_to'").select("src_id", "dst_id").join(side("src"), "src_id").join(side("dst"), "dst_id")


# search

_QUERY_VECTOR = f"(SELECT embedding::DOUBLE[] FROM insights WHERE embedding_model = '{MODEL}' AND len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda x: isfinite(x))) AND list_bool_or(list_transform(embedding, lambda x: x <> 0)) ORDER BY post_id LIMIT 1)"


def _query_vector(spark, sf):
    fine = F.forall("embedding", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    return vectors_of(spark, sf).filter(fine).orderBy("post_id").first()["embedding"]


@_query("semantic_search", _P + f", {_VEC} SELECT b.post_id, round(list_cosine_similarity(v.e, {_QUERY_VECTOR}), 4) AS score, platform, domain FROM b JOIN v USING (post_id) ORDER BY list_cosine_similarity(v.e, {_QUERY_VECTOR}) DESC, b.post_id LIMIT 20")
def semantic_search(spark, sf):
    got = search.ranked(vectors_of(spark, sf), posts_of(spark, sf), _query_vector(spark, sf))
    return got.select("post_id", F.round("score", 4).alias("score"), "platform", "domain")


@_query("filtered_search", _P + f", {_VEC} SELECT b.post_id, round(list_cosine_similarity(v.e, {_QUERY_VECTOR}), 4) AS score FROM b JOIN v USING (post_id) WHERE insight_type = 'complaint' AND pain_level = 2 AND NOT monetizable AND posted_at >= TIMESTAMP '2024-06-01' AND text ILIKE '%e%' ORDER BY list_cosine_similarity(v.e, {_QUERY_VECTOR}) DESC, b.post_id LIMIT 20")
def filtered_search(spark, sf):
    got = search.ranked(vectors_of(spark, sf), posts_of(spark, sf), _query_vector(spark, sf), 20, insight_type="complaint", pain_level=2, monetizable=False, since=datetime(2024, 6, 1), text="e")
    return got.select("post_id", F.round("score", 4).alias("score"))


@_query("text_filter", _P + "SELECT id FROM p WHERE text ILIKE '%spool%' AND platform = 'bluesky'")
def text_filter(spark, sf):
    return posts_of(spark, sf).filter(search.filters(platform="bluesky", text="spool")).select("id")


@_query("corpus_models", "SELECT DISTINCT embedding_model FROM insights WHERE embedding IS NOT NULL")
def corpus_models(spark, sf):
    return graph.models(insights_of(spark, sf))


@_query("corpus_dims", "SELECT DISTINCT CAST(len(embedding) AS INT) AS dimension FROM insights WHERE embedding IS NOT NULL")
def corpus_dims(spark, sf):
    return graph.dimensions(insights_of(spark, sf))


@_query("pairwise_cosine", "WITH q AS (SELECT embedding::DOUBLE[] AS q FROM embeddings ORDER BY vec_id LIMIT 1) SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], q), 6) AS score FROM embeddings, q")
def pairwise_cosine(spark, sf):
    """One vector against all."""
    e = table(spark, sf, "embeddings")
    q = e.orderBy("vec_id").first()["embedding"]
    return e.select("vec_id", F.round(cosine(F.col("embedding"), F.array(*[F.lit(float(x)) for x in q])), 6).alias("score"))


@_query("vector_pairs", "SELECT CAST(a.vec_id AS VARCHAR) AS a, CAST(b.vec_id AS VARCHAR) AS b, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 4) AS sim FROM embeddings a JOIN embeddings b ON CAST(a.vec_id AS VARCHAR) < CAST(b.vec_id AS VARCHAR) WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.4")
def vector_pairs(spark, sf):
    """All pairs above a similarity, by products of blocks."""
    e = table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("post_id"), "embedding")
    return graph.vector_pairs(e, 0.4).withColumn("sim", F.round("sim", 4))


# queue


@_query("queue_pick", _P + f"SELECT id, platform, collected_at FROM p WHERE extraction_status = 'pending' AND platform IN ('bluesky', 'hackernews') AND length({_TRIM('text')}) > 0 ORDER BY collected_at DESC NULLS LAST, id LIMIT 20")
def queue_pick(spark, sf):
    return queue.pick(posts_of(spark, sf), 20).select("id", "platform", "collected_at")


@_query("queue_skip", _P + f"SELECT count(*) AS changed FROM p WHERE extraction_status = 'pending' AND (text IS NULL OR length({_TRIM('text')}) = 0)")
def queue_skip(spark, sf):
    return queue.skip_unextractable(posts_of(spark, sf))[1]


@_query("queue_skipped", _P + f"SELECT CASE WHEN extraction_status = 'pending' AND (text IS NULL OR length({_TRIM('text')}) = 0) THEN 'skipped' ELSE extraction_status END AS extraction_status, count(*) AS count FROM p GROUP BY 1")
def queue_skipped(spark, sf):
    return queue.post_status(queue.skip_unextractable(posts_of(spark, sf))[0])


@_query("queue_reopen", _P + "SELECT id FROM p WHERE extraction_status = 'pending' OR (extraction_status = 'done' AND platform IN ('bluesky', 'hackernews') AND id IN (SELECT post_id FROM insights WHERE extractor_version = 'x1'))")
def queue_reopen(spark, sf):
    return queue.reopen(posts_of(spark, sf), insights_of(spark, sf), "x1")[0].filter("extraction_status = 'pending'").select("id")


@_query("extract_status", _P + "SELECT extraction_status, count(*) AS count FROM p GROUP BY 1")
def extract_status(spark, sf):
    return queue.post_status(posts_of(spark, sf))


@_query("insight_domains", "SELECT coalesce(domain, '(none)') AS domain, count(*) AS count FROM insights GROUP BY 1")
def insight_domains(spark, sf):
    return queue.insight_domains(insights_of(spark, sf))


@_query("embeddable", f"SELECT post_id, summary FROM insights WHERE embedding IS NULL AND length({_TRIM('summary')}) > 0 ORDER BY post_id LIMIT 500")
def embeddable(spark, sf):
    return queue.embeddable(insights_of(spark, sf), 500).select("post_id", "summary")


# validation


@_query("validate_results", f"SELECT insight_no AS line_no, CASE WHEN insight_type NOT IN ('need', 'complaint', 'advantage', 'workaround', 'none') OR insight_type IS NULL OR trim(insight_type) = '' THEN 'insight_type' WHEN insight_type <> 'none' AND (domain IS NULL OR domain NOT IN ({', '.join(repr(d) for d in DOMAINS)})) THEN 'domain' WHEN insight_type <> 'none' AND (summary IS NULL OR length(regexp_replace(summary, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')) NOT BETWEEN 1 AND 400) THEN 'summary' WHEN pain_level IS NULL OR pain_level NOT BETWEEN 0 AND 3 OR (insight_type = 'none' AND pain_level <> 0) THEN 'pain_level' WHEN monetizable IS NULL THEN 'monetizable' WHEN competitors IS NOT NULL AND len(list_filter(competitors, lambda x: x IS NULL)) > 0 THEN 'competitors' WHEN confidence IS NULL OR confidence NOT BETWEEN 0 AND 1 OR isnan(confidence) THEN 'confidence' END AS reason FROM insights")
def validate_results(spark, sf):
    """The insights written as result lines and judged."""
    i = insights_of(spark, sf)
    line = F.to_json(F.struct("post_id", "insight_type", "domain", "summary", F.col("pain_level").cast("int").alias("pain_level"), "monetizable", "competitors", F.col("confidence").cast("double").alias("confidence")))
    return validate.judged(i.select(F.col("insight_no").alias("line_no"), line.alias("line")), DOMAINS).select("line_no", "reason")


# normalisation and scans


@_query("iso_times", f"SELECT row_id, {iso_sql('posted_at')} AS posted_at FROM posts")
def iso_times(spark, sf):
    return raw_posts(spark, sf).select("row_id", "posted_at")


@_query("clean_keywords", f"SELECT row_id, {_TRIM('k')} AS keyword FROM (SELECT row_id, unnest(matched_keywords) AS k FROM posts) WHERE k IS NOT NULL AND length({_TRIM('k')}) > 0")
def clean_keywords(spark, sf):
    rows = table(spark, sf, "posts").select("row_id", F.explode("matched_keywords").alias("k")).select("row_id", space_trim(F.col("k")).alias("keyword"))
    return rows.filter(F.length("keyword") > 0)


@_query("normalize_reddit", f"SELECT 'reddit:' || post_id AS id, nullif(author_id, '') AS author_id, nullif(author, '') AS author_handle, coalesce(text, '') AS text, nullif(url, '') AS url, {iso_sql('created_at')} AS posted_at, coalesce(score, 0) AS score, subreddit FROM reddit_post WHERE post_id IS NOT NULL AND post_id <> ''")
def normalize_reddit(spark, sf):
    r = table(spark, sf, "reddit_post")
    lines = r.select(F.to_json(F.struct(*[c for c in r.columns if c not in ("row_no", "writer_tz", "raw")])).alias("line"))
    posts, _ = normalize.normalize(lines, "reddit")
    return posts.select("id", "author_id", "author_handle", "text", "url", "posted_at", F.get_json_object("metrics", "$.score").cast("bigint").alias("score"), F.get_json_object("metrics", "$.subreddit").alias("subreddit"))


@_query("normalize_hackernews", f"SELECT 'hackernews:' || item_id AS id, nullif(author, '') AS author_id, coalesce(text, '') AS text, nullif(url, '') AS url, {iso_sql('created_at')} AS posted_at, coalesce(points, 0) AS points, item_type FROM hackernews_item WHERE item_id IS NOT NULL AND item_id <> ''")
def normalize_hackernews(spark, sf):
    r = table(spark, sf, "hackernews_item")
    lines = r.select(F.to_json(F.struct(*[c for c in r.columns if c not in ("row_no", "writer_tz", "raw")])).alias("line"))
    posts, _ = normalize.normalize(lines, "hackernews")
    return posts.select("id", "author_id", "text", "url", "posted_at", F.get_json_object("metrics", "$.points").cast("bigint").alias("points"), F.get_json_object("metrics", "$.item_type").alias("item_type"))


_J = lambda f: f"json_extract_string(line, '$.{f}')"


@_query("normalize_bluesky", f"SELECT file_name, line_no, 'bluesky:' || {_J('post_id')} AS id, 'bluesky' AS platform, {_J('post_id')} AS native_id, nullif({_J('author_did')}, '') AS author_id, nullif({_J('author_handle')}, '') AS author_handle, coalesce({_J('text')}, '') AS text, nullif({_J('url')}, '') AS url, nullif(CASE json_type(line, '$.lang') WHEN 'VARCHAR' THEN {_J('lang')} WHEN 'ARRAY' THEN {_J('lang[0]')} END, '') AS lang, {iso_sql(_J('created_at'))} AS posted_at, {iso_sql(_J('collected_at'))} AS collected_at, CASE WHEN coalesce({_J('keyword')}, '') = '' THEN [] ELSE [{_J('keyword')}] END AS matched_keywords, 'pending' AS extraction_status FROM (SELECT * FROM bluesky_lines WHERE json_valid(line)) WHERE json_type(line) = 'OBJECT' AND json_type(line, '$.post_id') = 'VARCHAR' AND {_J('post_id')} <> ''")
def normalize_bluesky(spark, sf):
    """Landing lines as posts."""
    posts, _ = normalize.normalize(table(spark, sf, "bluesky_lines").select("file_name", "line_no", "line"), "bluesky")
    return posts.drop("raw", "metrics")


@_query("epoch_to_iso", "SELECT event_id, strftime(make_timestamp(event_id * 1000003 * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS iso FROM events")
def epoch_to_iso(spark, sf):
    return table(spark, sf, "events").select("event_id", epoch_iso(F.col("event_id") * 1000003).alias("iso"))


#: No post of the tables voices trouble: of every fifth the text gets a sentence that does.
_TROUBLE_SQL = "CASE WHEN row_id % 5 = 0 THEN text || ' Any advice?' ELSE text END"


def troubled(spark, sf):
    return table(spark, sf, "posts").withColumn("text", F.expr(_TROUBLE_SQL))


@_query("keyword_quality", f"WITH k AS (SELECT unnest(matched_keywords) AS keyword, regexp_matches(coalesce({_TROUBLE_SQL}, ''), '(?i)\\b({'|'.join(PAIN_WORDS)})\\b') AS p FROM posts WHERE platform = 'bluesky') SELECT keyword, count(*) AS count, count(*) FILTER (p) AS pain_count, count(*) FILTER (p)::DOUBLE / count(*) AS pain_rate FROM k GROUP BY 1")
def keyword_quality(spark, sf):
    return telemetry.keyword_quality(store.keyword_rows(troubled(spark, sf), "bluesky"))


@_query("pain_texts", f"SELECT row_id FROM (SELECT row_id, {_TROUBLE_SQL} AS text FROM posts) WHERE regexp_matches(text, '(?i)\\b({'|'.join(PAIN_WORDS)})\\b')")
def pain_texts(spark, sf):
    return troubled(spark, sf).filter(pain(F.col("text"))).select("row_id")


@_query("check_stats", f"WITH {_EVENTS} SELECT \"check\", count(*) AS runs, count(*) FILTER (exit_code <> 0) AS blocks, CAST(sum(violations) AS BIGINT) AS violations, CAST(sum(duration_ms) AS BIGINT) AS total_ms, count(*) FILTER (exit_code <> 0)::DOUBLE / count(*) AS block_rate, CAST(round_even(sum(duration_ms)::DOUBLE / count(*), 0) AS BIGINT) AS avg_ms FROM e GROUP BY 1")
def check_stats(spark, sf):
    return telemetry.check_stats(events_of(spark, sf))


@_query("silent_checks", f"WITH {_EVENTS} SELECT \"check\", count(*) AS runs FROM e GROUP BY 1 HAVING count(*) FILTER (exit_code <> 0) = 0")
def silent_checks(spark, sf):
    return telemetry.silent_checks(telemetry.check_stats(events_of(spark, sf))).select("check", "runs")


@_query("rule_stats", f"WITH {_EVENTS} SELECT rule, count(*) AS hits, arg_max(ts, row(ts_instant, ts)) AS last_seen FROM e GROUP BY 1")
def rule_stats(spark, sf):
    return telemetry.rule_stats(events_of(spark, sf))


@_query("daily_runs", f"WITH {_EVENTS}, d AS (SELECT CAST(unnest(generate_series(max(day) - 29, max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM e) SELECT d.day, count(e.day) AS runs, count(*) FILTER (exit_code <> 0) AS blocks FROM d LEFT JOIN e ON e.day = d.day GROUP BY 1")
def daily_runs(spark, sf):
    return telemetry.daily_runs(events_of(spark, sf))


@_query("peak_shares", f"WITH {_EVENTS}, r AS (SELECT rule, count(*) AS hits FROM e GROUP BY 1) SELECT rule, round(hits * 100.0 / max(hits) OVER (), 6) AS share FROM r")
def peak_shares(spark, sf):
    return telemetry.rule_stats(events_of(spark, sf)).select("rule", F.round(telemetry.share_of_peak(F.col("hits")), 6).alias("share"))


@_query("top_rules", f"WITH {_EVENTS} SELECT rule, count(*) AS hits FROM e GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def top_rules(spark, sf):
    return telemetry.rule_stats(events_of(spark, sf)).select("rule", "hits").limit(5)


@_query("overview", f"WITH {_EVENTS} SELECT (SELECT count(*) FROM posts) AS collected, count(*) AS runs_total, count(*) FILTER (exit_code <> 0) AS blocks_total FROM e")
def overview(spark, sf):
    return telemetry.overview(table(spark, sf, "posts"), events_of(spark, sf))


# collector logs, written from the posts: a run per batch and platform, finished unless the batch is the fourth


def logs_of(spark, sf):
    words = table(spark, sf, "posts").filter("platform IS NOT NULL").select("platform", "load_batch", "row_id", F.explode(F.array_distinct(F.array_compact("matched_keywords"))).alias("k"))
    words = words.filter(~F.col("k").rlike(r"[\]\s]$|^\s*$|^\s"))
    counts = words.groupBy("platform", "load_batch", "k").agg(F.count("*").alias("n"), F.count_if(F.col("row_id") % 3 == 0).alias("a"))
    result = F.format_string("[%s:%s] 取得: %d件 / 新規: %d件 / スキップ: %d件", "platform", "k", "n", "a", F.col("n") - F.col("a"))
    runs = counts.groupBy("platform", "load_batch").agg(F.array_sort(F.collect_list(result)).alias("r"))
    stamp = F.format_string("[2026-08-03 %02d:00:00] ", "load_batch")
    body = F.concat_ws("\n", F.concat(stamp, F.lit("start: "), "platform"), F.array_join("r", "\n"), F.lit("saved"), F.lit(""), F.when(F.col("load_batch") != 3, F.concat(stamp, F.lit("done: "), "platform")))
    files = runs.groupBy("platform").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("load_batch", body.alias("t")))), lambda x: x["t"]), "\n").alias("text"))
    return files.select(F.concat(F.lit("/logs/"), "platform", F.lit(".log")).alias("file"), "text")


_LOG = "WITH w AS (SELECT DISTINCT platform, load_batch, row_id, k FROM (SELECT platform, load_batch, row_id, unnest(matched_keywords) AS k FROM posts WHERE platform IS NOT NULL) WHERE NOT regexp_matches(k, '[\\]\\s]$|^\\s*$|^\\s')), c AS (SELECT platform, load_batch, k, count(*) AS n, count(*) FILTER (row_id % 3 = 0) AS a FROM w GROUP BY 1, 2, 3), "
_RUNS = "r AS (SELECT '/logs/' || platform || '.log' AS file, CAST(row_number() OVER (PARTITION BY platform ORDER BY load_batch) AS BIGINT) AS run_no, CAST(sum(n) AS BIGINT) AS fetched, CAST(sum(a) AS BIGINT) AS added, load_batch <> 3 AS finished FROM c GROUP BY platform, load_batch) "


@_query("log_runs", _LOG + _RUNS + "SELECT * FROM r")
def log_runs(spark, sf):
    runs = telemetry.log_runs(telemetry.log_lines(logs_of(spark, sf)))
    return runs.select("file", "run_no", "fetched", "added", "finished")


@_query("log_totals", _LOG + _RUNS + "SELECT file, count(*) AS runs, CAST(sum(fetched) AS BIGINT) AS total_fetched, CAST(sum(added) AS BIGINT) AS total_added, count(*) FILTER (NOT finished) AS unfinished FROM r GROUP BY 1")
def log_totals(spark, sf):
    return telemetry.log_totals(telemetry.log_runs(telemetry.log_lines(logs_of(spark, sf))))


@_query("log_display", _LOG + _RUNS + "SELECT file, run_no, true AS truncated FROM r QUALIFY row_number() OVER (PARTITION BY file ORDER BY run_no DESC) <= 5")
def log_display(spark, sf):
    return telemetry.display_runs(telemetry.log_runs(telemetry.log_lines(logs_of(spark, sf))), 5).select("file", "run_no", "truncated")


@_query("keyword_summary", _LOG + "SELECT platform FROM c LIMIT 0")
def keyword_summary(spark, sf):
    return telemetry.keyword_summary(telemetry.log_results(telemetry.log_lines(logs_of(spark, sf))))


_SQL["keyword_summary"] = _LOG[: _LOG.rindex(", ")] + " SELECT platform, k AS keyword, CAST(sum(n) AS BIGINT) AS fetched, CAST(sum(a) AS BIGINT) AS added, count(*) AS runs FROM c GROUP BY 1, 2"


@_query("thread_topn", "WITH t AS (SELECT event_id, event_type, CASE event_type WHEN 'view' THEN 'hiring' WHEN 'click' THEN 'freelancer' WHEN 'error' THEN 'hired' END AS kind, ts FROM events) SELECT CAST(event_id AS VARCHAR) AS thread_id, kind FROM t WHERE kind IN ('hiring', 'freelancer') QUALIFY row_number() OVER (PARTITION BY kind ORDER BY strftime(ts, '%Y-%m-%d') DESC, event_id) <= 3")
def thread_topn(spark, sf):
    """The newest three threads per kind, with events as threads."""
    title = F.when(F.col("event_type") == "view", "Ask HN: Who is hiring? (x)").when(F.col("event_type") == "click", "Ask HN: Freelancer? Seeking freelancer? (x)").when(F.col("event_type") == "error", "Ask HN: Who wants to be hired? (x)").otherwise("other")
    threads = table(spark, sf, "events").select(F.col("event_id").cast("string").alias("thread_id"), title.alias("title"), F.date_format("ts", "yyyy-MM-dd").alias("created_at"), F.lit(0).alias("author_no"), F.col("event_id").alias("position"))
    return normalize.select_threads(threads, ["hiring", "freelancer"], 3).select("thread_id", "kind")


_LINE_KEY = "regexp_replace(regexp_replace(regexp_replace(line, '^\\s*[-*>#]+\\s*', ''), '[`*_、。，．,.:：]', '', 'g'), '\\s', '', 'g')"
_LINES = "l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents WHERE text IS NOT NULL)"


@_query("dup_lines", f"WITH {_LINES}, f AS (SELECT *, regexp_matches(line, '^\\s*```') AS fence, sum(CASE WHEN regexp_matches(line, '^\\s*```') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) % 2 = 1 AS inside FROM l), k AS (SELECT doc_id, line_no, {_LINE_KEY} AS line_key FROM f WHERE NOT fence AND NOT inside AND NOT regexp_matches(line, '^\\s*\\|') AND NOT contains(line, 'dup-ok')) SELECT line_key, count(DISTINCT doc_id) AS documents, min(doc_id) AS first_key FROM k WHERE length(line_key) >= 30 GROUP BY 1 HAVING count(DISTINCT doc_id) > 1")
def dup_lines(spark, sf):
    return textscan.repeated_lines(table(spark, sf, "documents"), "doc_id", "text").select("line_key", "documents", "first_key")


#: No document of the tables holds a secret: some get one, by their number.
_KEYS = "CASE doc_id % 6 WHEN 0 THEN 'sk-ant-' || repeat('a', 24) WHEN 1 THEN 'AIza' || repeat('b', 35) WHEN 2 THEN 'ghp_' || repeat('c', 36) WHEN 3 THEN '-----BEGIN RSA PRIVATE KEY-----' WHEN 4 THEN 'x=abcd-ef01-ghij-23kl;' ELSE '123e4567-e89b-12d3-a456-426614174000' END"


@_query("secret_scan", f"WITH {_LINES.replace('FROM documents', f'FROM (SELECT doc_id, text || chr(10) || {_KEYS} AS text FROM documents)')} SELECT doc_id AS \"key\", CAST(line_no AS INT) AS line_no, label FROM l, (VALUES {', '.join(f'({chr(39)}{n}{chr(39)}, {chr(39)}{p}{chr(39)})' for n, p in textscan.SECRETS)}) s(label, pattern) WHERE regexp_matches(line, pattern)")
def secret_scan(spark, sf):
    return textscan.secrets(table(spark, sf, "documents").withColumn("text", F.expr(f"text || chr(10) || {_KEYS}")), "doc_id", "text")


@_query("path_kinds", "SELECT file_name AS path, CASE WHEN regexp_matches(file_name, '(^|.*/)[^/]*-collector/(data|state|reports)/') THEN 'collected' WHEN regexp_matches(file_name, '(^|/)\\.env\\.(example|sample)$') THEN NULL WHEN regexp_matches(file_name, '(^|/)\\.env(\\.[^/]*)?$') THEN 'environment' END AS kind FROM (SELECT DISTINCT file_name FROM bluesky_lines)")
def path_kinds(spark, sf):
    files = table(spark, sf, "bluesky_lines").select("file_name").distinct()
    return files.select(F.col("file_name").alias("path"), textscan.path_kind(F.col("file_name")).alias("kind"))


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
