from datetime import datetime

from pyspark.sql import functions as F

from tidewrack import schemas
from tidewrack.operators import report, store


def posts(spark, *rows):
    base = dict.fromkeys(schemas.POSTS.fieldNames())
    return spark.createDataFrame([tuple((base | {"platform": r["id"].split(":")[0] if r["id"] else "x", "native_id": (r["id"] or "x:").split(":")[1], "matched_keywords": [], "extraction_status": "pending", "text": ""} | r)[c] for c in base) for r in rows], _ddl())


def _ddl():
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.POSTS.fields)


def seq(df):
    return df.withColumn("seq", F.monotonically_increasing_id())


def as_dict(df):
    return {r["id"]: r.asDict() for r in df.collect()}


def test_upsert_twice_changes_nothing(spark):
    new = seq(posts(spark, {"id": "reddit:1", "matched_keywords": ["a"], "text": "t"}))
    once = store.upsert_posts(None, new, "seq")
    twice = store.upsert_posts(once, new, "seq")
    assert as_dict(once) == as_dict(twice) and len(as_dict(once)) == 1
    counts = store.load_counts(posts(spark).select("id"), new).first()
    assert tuple(counts) == (1, 0) and tuple(store.load_counts(once, new).first()) == (0, 1)


def test_keywords_union_and_status_survives(spark):
    old = posts(spark, {"id": "reddit:1", "matched_keywords": ["a"], "extraction_status": "done", "text": "old"})
    got = as_dict(store.upsert_posts(old, seq(posts(spark, {"id": "reddit:1", "matched_keywords": ["b", None], "text": "new"}, {"id": "reddit:1", "matched_keywords": None, "text": None})), "seq"))
    assert got["reddit:1"]["matched_keywords"] == ["a", "b"] and got["reddit:1"]["extraction_status"] == "done" and got["reddit:1"]["text"] is None


def test_upsert_of_nothing_and_null_ids(spark):
    assert store.upsert_posts(None, seq(posts(spark)), "seq").count() == 0
    assert store.upsert_posts(None, seq(posts(spark, {"id": None})), "seq").count() == 0


def test_keyword_hits(spark):
    p = posts(spark, {"id": "reddit:1", "matched_keywords": ["a"]}, {"id": "reddit:2", "matched_keywords": None})
    hits = spark.createDataFrame([("reddit", "1", "a"), ("reddit", "1", "b"), ("reddit", "2", "c")], "platform string, native_id string, keyword string")
    got = as_dict(store.record_keyword_hits(p, hits))
    assert got["reddit:1"]["matched_keywords"] == ["a", "b"] and got["reddit:2"]["matched_keywords"] == ["c"]


def test_collect(spark):
    items = spark.createDataFrame([(1, 1, "k"), (1, 2, "n"), (1, 3, "n"), (2, 1, "n"), (2, 2, "m")], "task_no int, item_no int, native_id string")
    known = spark.createDataFrame([("k",)], "native_id string")
    got = {(r["task_no"], r["item_no"]): r["outcome"] for r in store.collect_dedup(items, known).collect()}
    assert got == {(1, 1): "hit", (1, 2): "new", (1, 3): "skip", (2, 1): "hit", (2, 2): "new"}


def test_insight_upsert_drops_stale_vectors(spark):
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.INSIGHTS.fields)
    row = lambda k, s, e: (k, "need", "d", s, 1, False, [], 0.5, "v1", datetime(2026, 8, 1), e, "m" if e else None)
    old = spark.createDataFrame([row("a", "same", [1.0]), row("b", "old", [1.0]), row("c", "kept", [2.0])], ddl)
    new = spark.createDataFrame([row("a", "same", None), row("b", "new", None), row("d", "new", None)], ddl).drop("embedding", "embedding_model")
    got = {r["post_id"]: (r["summary"], r["embedding"]) for r in store.upsert_insights(old, new).collect()}
    assert got == {"a": ("same", [1.0]), "b": ("new", None), "c": ("kept", [2.0]), "d": ("new", None)}
    assert store.cleared_embeddings(old, new).first()["cleared"] == 1


def test_report_golden(spark, tmp_path):
    at = datetime(2026, 8, 3)
    p = posts(spark, {"id": "bluesky:1", "collected_at": at, "matched_keywords": ["a", "b"]}, {"id": "bluesky:2", "collected_at": at, "matched_keywords": ["a"]}, {"id": "hackernews:1", "collected_at": datetime(2026, 8, 4), "matched_keywords": ["c"]}, {"id": "bluesky:3", "collected_at": datetime(2026, 8, 8)})
    since, until = datetime(2026, 8, 1), datetime(2026, 8, 8)
    assert [(str(r["day"]), r["platform"], r["count"]) for r in report.daily_counts(p, since, until).collect()] == [("2026-08-03", "bluesky", 2), ("2026-08-04", "hackernews", 1)]
    assert [tuple(r) for r in report.top_keywords(p, since, until, 2).collect()] == [("a", 2), ("b", 1)]
    assert [tuple(r) for r in report.top_keyword_pairs(p, since, until, 5).collect()] == [("a", "b", 1)]
    nothing = spark.createDataFrame([], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.INSIGHTS.fields))
    for _ in range(2):  # a second run of the same days takes the file's place
        path = report.write(report.build(p, nothing, since, until), f"file://{tmp_path}", since, until)
    text = open(path.removeprefix("file://"), encoding="utf-8").read()
    assert path.endswith("/report-2026-08-01_2026-08-08.md") and sorted(f.name for f in tmp_path.iterdir() if not f.name.startswith(".")) == ["report-2026-08-01_2026-08-08.md"]
    assert text.startswith("# 定期レポート 2026-08-01 〜 2026-08-08\n\n") and text.endswith("## 新規に観測された競合製品\n\n該当なし\n\n")
    assert "| 日付 | platform | 件数 |\n|---|---|---|\n| 2026-08-03 | bluesky | 2 |\n| 2026-08-04 | hackernews | 1 |\n\n## insight_type別の分布" in text


def test_report_cells(spark):
    from tidewrack.functions.text import markdown_cell

    rows = spark.createDataFrame([("a|b",), ("c\r\nd",), ("",), (None,), ("|\n|",)], "v string")
    assert [r[0] for r in rows.select(markdown_cell(F.col("v"))).collect()] == ["a\\|b", "c  d", "-", "-", "\\| \\|"]
    signals = spark.createDataFrame([("p1", "x", "u", "s|t", "d"), ("p2", "x", None, None, None)], "post_id string, platform string, url string, summary string, domain string")
    assert [r[0] for r in report.section_lines("top_signals", signals).collect()] == ["- [x/d] s\\|t\n  u", "- [x/-] p2"]


def test_only_the_columns_asked_for_are_read(spark, data):
    from tidewrack.plans import reference

    plan = reference.daily_counts(spark, data)._jdf.queryExecution().executedPlan().toString()
    schema = plan[plan.index("ReadSchema") :].split("\n")[0]
    assert "collected_at" in schema and not any(f"{c}:" in schema for c in ("text", "raw", "metrics", "matched_keywords", "posted_at"))


def test_collect_run(spark):
    tasks = spark.createDataFrame([(1, "a", "k", False), (2, "b", "m", True), (3, "c", "n", False), (4, "d", "o", False)], "task_no int, label string, keyword string, failed boolean")
    items = spark.createDataFrame([(1, 1, "old", "ok"), (1, 2, "x", "ok"), (1, 3, None, "malformed"), (1, 4, None, "excluded"), (2, 1, "y", "ok"), (3, 1, "x", "ok"), (3, 2, "z", "ok"), (3, 3, "z", "ok")], "task_no int, item_no int, native_id string, state string")
    new, hits, summary = store.collect_run(tasks, items, spark.createDataFrame([("old",)], "native_id string"))
    assert {r["native_id"] for r in new.collect()} == {"x", "z"} and {tuple(r) for r in hits.collect()} == {("old", "k"), ("x", "n")}
    assert {r["label"]: tuple(r)[2:] for r in summary.collect()} == {"a": (4, 1, 1, 1, 1, False), "b": (0, 0, 0, 0, 0, True), "c": (3, 1, 2, 0, 0, False), "d": (0, 0, 0, 0, 0, False)}
    line = summary.filter("task_no = 1").select(store.run_line(F.col("label"), *[F.col(c) for c in ("fetched", "added", "skipped", "excluded", "malformed")], F.lit("x"))).first()[0]
    assert line == "[a] 取得: 4件 / 新規: 1件 / スキップ: 1件 / 対象外: 1件 / 不正: 1件 (x)"


def test_versions_are_stamped_once(spark):
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.SCHEMA_VERSION.fields)
    old = spark.createDataFrame([], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.INSIGHTS.fields)).drop("embedding_model")
    tables, versions, applied = schemas.upgrade({"insights": old}, spark.createDataFrame([(1, datetime(2026, 1, 1), "x")], ddl), datetime(2026, 8, 1))
    assert applied == [2] and "embedding_model" in tables["insights"].columns and versions.count() == 2
    assert schemas.upgrade(tables, versions, datetime(2026, 8, 2))[2] == []
