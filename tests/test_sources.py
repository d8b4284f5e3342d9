import json
from datetime import date

import pytest

from tests.test_store import as_dict, posts
from tidewrack.operators import normalize, telemetry, textscan
from tidewrack.sources import captured, files, landing
from tidewrack.streaming import ingest


def record(k, **more):
    return {"post_id": f"t3_{k}", "keyword": "a", "text": f"text {k}", "author": "x", "author_id": "", "created_at": "2026-06-05T11:47:05+09:00", "collected_at": "2026-06-06T00:00:00+00:00", "url": "u", "score": 3, "upvote_ratio": 0.5, "subreddit": "s"} | more


def write(root, platform, name, lines):
    (root / platform).mkdir(parents=True, exist_ok=True)
    (root / platform / name).write_bytes("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines).encode() + b"\n")


def test_load(spark, tmp_path):
    write(tmp_path, "reddit", "2026-07-01.jsonl", [record("1"), "", "{bad", {"text": "no id"}, "[1]"])
    write(tmp_path, "reddit", "2026-08-02.jsonl", [record("1", keyword="b", text="newer"), record("2")])
    table, counts = landing.load_platform(spark, str(tmp_path), "reddit", posts(spark))
    assert tuple(counts.first()) == ("reddit", 2, 2, 1, 3)
    got = as_dict(table)
    assert got["reddit:t3_1"]["text"] == "newer" and got["reddit:t3_1"]["matched_keywords"] == ["a", "b"] and got["reddit:t3_1"]["author_id"] is None
    assert str(got["reddit:t3_1"]["posted_at"]) == "2026-06-05 02:47:05"
    assert json.loads(got["reddit:t3_2"]["metrics"]) == {"score": 3, "num_comments": 0, "upvote_ratio": 0.5, "subreddit": "s", "link_url": None}
    _, late = landing.load_platform(spark, str(tmp_path), "reddit", posts(spark), since=date(2026, 8, 1))
    assert late.first()["files"] == 1
    _, none = landing.load_platform(spark, str(tmp_path), "github", posts(spark))
    assert tuple(none.first()) == ("github", 0, 0, 0, 0)


@pytest.mark.parametrize("platform", list(normalize.PLATFORMS))
def test_every_platform(spark, platform):
    p = normalize.PLATFORMS[platform]
    line = json.dumps({p.key: "1", "title": "T", "description": "D", "text": "T\nD", "keyword": "k", "lang": ["ja"], "raw": {"r": 1}})
    good, bad = normalize.normalize(spark.createDataFrame([(line,), (json.dumps({p.key: ""}),)], "line string"), platform)
    r = good.first()
    assert (r["id"], r["text"], r["lang"], r["matched_keywords"], r["raw"]) == (f"{platform}:1", "T\nD", "ja" if platform == "bluesky" else None, ["k"], '{"r":1}') and bad.count() == 1


def test_flatten(spark):
    one = lambda p, item, **more: normalize.flatten(spark.createDataFrame([(json.dumps(item), "k", "2026-08-01T00:00:00+00:00", *more.values())], "item string, keyword string, collected_at string" + "".join(f", {c} string" for c in more)), p).first()
    r = one("bluesky", {"uri": "at://d/p/rk", "author": {"handle": "h", "did": "d"}, "record": {"text": "t", "langs": ["ja"]}, "likeCount": 2})
    assert (r["post_id"], r["url"], r["lang"], r["like_count"], r["repost_count"]) == ("at://d/p/rk", "https://bsky.app/profile/h/post/rk", ["ja"], 2, 0)
    r = one("hackernews", {"objectID": "7", "_tags": ["comment"], "story_title": "S", "comment_text": "<p>a &amp; b</p>", "url": "z"})
    assert (r["text"], r["item_type"], r["url"]) == ("S\na & b", "comment", "https://news.ycombinator.com/item?id=7")
    r = one("hnjobs", {"objectID": "8", "parent_id": 5, "story_id": 5, "comment_text": "SEEKING WORK | x"}, thread_id="5", thread_title="T", thread_kind="freelancer")
    assert (r["seeking"], r["text"]) == ("work", "T\nSEEKING WORK | x")
    assert one("hnjobs", {"objectID": "8", "parent_id": 6, "story_id": 5}, thread_id="5", thread_title="T", thread_kind="hiring") is None
    r = one("github", {"id": 3, "title": "T", "body": "B", "repository_url": "https://x/repos/o/n/", "labels": [{"name": "bug"}, "x", 3], "user": {"id": 9}, "reactions": {"total_count": 4}})
    assert (r["issue_id"], r["repo_full_name"], r["labels"], r["author_id"], r["reactions"]) == ("3", "o/n", ["bug", "x"], "9", 4)
    r = one("reddit", {"name": "t3_1", "title": "T", "selftext": "S", "created_utc": 0.5, "permalink": "/r/x", "author": ""})
    assert (r["text"], r["created_at"], r["url"], r["author"]) == ("T\nS", "1970-01-01T00:00:00.500000+00:00", "https://www.reddit.com/r/x", "[deleted]")
    r = one("youtube", {"id": {"videoId": "v"}, "snippet": {"title": "T", "channelId": "c"}})
    assert (r["video_id"], r["url"], r["channel_id"], r["description"]) == ("v", "https://www.youtube.com/watch?v=v", "c", "")


def test_captured(spark, tmp_path):
    (tmp_path / "reddit").mkdir()
    (tmp_path / "reddit" / "a.json").write_text(json.dumps({"data": {"children": [{"data": {"name": "t3_1"}}]}}))
    (tmp_path / "reddit" / "broken.json").write_text("{")
    spark.dataSource.register(captured.Captured)
    rows = spark.read.format("captured").option("path", str(tmp_path)).load().collect()
    assert [(r["platform"], r["name"], json.loads(r["item"])) for r in rows] == [("reddit", "a", {"name": "t3_1"})]


def test_stream_equals_batch(spark, tmp_path):
    root = tmp_path / "landing"
    write(root, "reddit", "2026-08-02.jsonl", [record("1", text="newer", keyword="b"), "{bad", record("3")])
    table = ingest.Table(spark, str(tmp_path / "table"), ingest.ORDERED)
    ingest.run(spark, str(root), table, str(tmp_path / "state"), str(tmp_path / "rejects"))
    write(root, "reddit", "2026-07-01.jsonl", [record("1", text="older"), record("2")])  # an older file comes later
    ingest.run(spark, str(root), table, str(tmp_path / "state"))
    ingest.run(spark, str(root), table, str(tmp_path / "state"))
    batch, _ = landing.load_platform(spark, str(root), "reddit", posts(spark))
    stream = as_dict(table.read().drop("seq"))
    assert stream == as_dict(batch) and stream["reddit:t3_1"]["text"] == "newer" and stream["reddit:t3_1"]["matched_keywords"] == ["a", "b"]
    assert spark.read.json(str(tmp_path / "rejects/*")).count() == 1


def test_gates_and_steps(spark):
    text = "pre-commit:\n  jobs:\n    - name: one\n      run: scripts/check-a.sh\n    - run: bare\n      interactive: true\ncommit-msg:\n  jobs:\n    - name: two\n      run: x\n"
    got = {tuple(r) for r in files.gates(spark.createDataFrame([("l", text)], "file string, text string")).collect()}
    assert got == {("one", "scripts/check-a.sh", "pre-commit", False), ("bare", "bare", "pre-commit", True), ("two", "x", "commit-msg", False)}
    ci = "jobs:\n    steps:\n      - name: a\n        run: scripts/x.sh\n      - name: b\n        run: other\n"
    assert [tuple(r) for r in files.steps(spark.createDataFrame([("c", ci)], "file string, text string")).collect()] == [("a", "scripts/x.sh", "CI", False)]


def test_options():
    assert files.option({"a": ""}, "a", "d") == "d" and files.option({"a": 3}, "a", 1, int) == 3
    for bad in (0, True, "x"):
        with pytest.raises(ValueError):
            files.option({"a": bad}, "a", 1, int)


def test_logs(spark):
    text = "before\n[t1] start: p\n[p:k] 取得: 24件 / 新規: 3件 / スキップ: 21件\n\n[p:m] 取得: 4件 / 新規: 0件 / スキップ: 4件 (x)\nnote\n[t2] done: p\n[t3] start: p\n"
    lines = telemetry.log_lines(spark.createDataFrame([("/l/p.log", text)], "file string, text string"))
    runs = {r["run_no"]: r for r in telemetry.log_runs(lines).collect()}
    assert (runs[1]["fetched"], runs[1]["added"], runs[1]["finished"], runs[1]["notes"], runs[0]["notes"], runs[2]["finished"]) == (28, 3, True, 1, 1, False)
    assert tuple(telemetry.log_totals(telemetry.log_runs(lines)).first()) == ("/l/p.log", 3, 28, 3, 1)
    assert [r["keyword"] for r in telemetry.keyword_summary(telemetry.log_results(lines)).collect()] == ["m", "k"]


def test_events(spark):
    lines = ['{"ts":"2026-08-01T23:30:00+09:00","check":"a","exit_code":1,"duration_ms":300,"rules":["r"]}', "", "{bad", '{"ts":"x","check":"a","exit_code":0}', '{"check":"a","exit_code":0}', '{"ts":"2026-08-03T00:00:00","check":"a","exit_code":0,"duration_ms":101}', '{"ts":"2026-08-03T00:00:00Z","check":"b","exit_code":0}']
    e = telemetry.parse_events(spark.createDataFrame([(x,) for x in lines], "value string"))
    stats = {r["check"]: r for r in telemetry.check_stats(e).collect()}
    assert (stats["a"]["runs"], stats["a"]["blocks"], stats["a"]["avg_ms"]) == (2, 1, 200) and [r["check"] for r in telemetry.silent_checks(telemetry.check_stats(e)).collect()] == ["b"]
    assert [(str(r["day"]), r["runs"]) for r in telemetry.daily_runs(e, 3).collect()] == [("2026-08-01", 1), ("2026-08-02", 0), ("2026-08-03", 2)]
    assert json.loads(telemetry.metrics_payload(e).first()["payload"])["rules"][0]["rule"] == "r"
    assert json.loads(telemetry.event_line("c", "x", 1, 5, "NG: [a] q\nNG: [b] r\nNG: [a] s\nNG: []\nNG: [Not an id] x\n NG: [c]", "t"))["rules"] == ["a", "b", "a"]
    assert telemetry.daily_runs(e.limit(0)).count() == 0


def test_keyword_quality(spark):
    rows = spark.createDataFrame([(["k", "m"], "i tried but it doesn't work"), (["k"], "plain"), (["k"], "struggling"), (None, "i tried"), (["m"], None)], "matched_keywords array<string>, text string")
    assert [(r["keyword"], r["count"], r["pain_count"]) for r in telemetry.keyword_quality(rows).collect()] == [("k", 3, 1), ("m", 2, 1)]


def test_text_scans(spark):
    same = "- 同じ説明がここにも書かれているという長い一行であり三十文字をこえている。"
    docs = spark.createDataFrame([(1, f"{same}\n```\n{same}\n```"), (2, f"* {same[2:]}"), (3, f"```\n{same}\n```\n| {same}"), (4, None), (5, "key sk-ant-" + "a" * 20 + "\n123e4567-e89b-12d3-a456-426614174000\nabcd-efgh-ijkl-mnop")], "doc int, text string")
    assert [(r["documents"], r["first_key"], r["first_line_no"]) for r in textscan.repeated_lines(docs, "doc", "text").collect()] == [(2, 1, 1)]
    assert {(r["key"], r["line_no"], r["label"]) for r in textscan.secrets(docs, "doc", "text").collect()} == {(5, 1, "anthropic_key"), (5, 3, "app_password")}
    paths = spark.createDataFrame([(p,) for p in ("a-collector/data/.env.example", ".env.example", "x/.env", "x/.env.local", "src/a.py", "b.tmp")], "p string")
    assert {tuple(r) for r in textscan.private_paths(paths, "p", spark.createDataFrame([("b.tmp",)], "path string")).collect()} == {("a-collector/data/.env.example", "private-file"), ("x/.env", "private-file"), ("x/.env.local", "private-file"), ("b.tmp", "gitignored-file")}
    good = "# ADR-0001: T\n\n- ステータス: 採用\n- 日付: 2026-08-01\n\n## コンテキスト\n## 決定\n```\n## x\n```\n## 結果\n"
    adr = spark.createDataFrame([("d/0001-a.md", good), ("d/0002-b.md", good.replace("採用", "置換済み（ADR-0001）")), ("d/bad.md", "nothing")], "name string, text string")
    got = {r["slug"]: (r["number"], r["status"], r["superseded_by"]) for r in textscan.records(adr, "name", "text").collect()}
    assert got == {"0001-a": ("0001", "採用", None), "0002-b": ("0001", "置換済み", "ADR-0001"), "bad": ("", "不明", None)}
    assert [r["status"] for r in textscan.by_status(textscan.records(adr, "name", "text")).collect()] == ["採用", "不明", "置換済み"]
    assert {(r["name"], r["fault"]) for r in textscan.record_faults(adr, "name", "text").collect()} == {("d/bad.md", f) for f in ("file name", "title", "status", "date", "headings")}


def test_append_is_read_back(spark, tmp_path):
    root, day = f"file://{tmp_path}", date(2026, 8, 2)
    rows = spark.createDataFrame([("t3_1", "a", None), ("t3_2", "b|\n", "k")], "post_id string, text string, keyword string")
    for part in (rows.limit(1), rows.filter("post_id = 't3_2'")):
        landing.append(part, root, "reddit", day)
    assert sorted(json.loads(r["line"])["post_id"] for r in landing.read(spark, root, "reddit").collect()) == ["t3_1", "t3_2"]
    # a file of another writer stays, and days before since are left out by name
    write(tmp_path, "reddit", "2026-08-03.jsonl", [record("9")])
    landing.append(rows.limit(1), root, "reddit", date(2026, 8, 3))
    assert landing.read(spark, root, "reddit", since=date(2026, 8, 3)).count() == 2
    assert {str(r["file_date"]) for r in landing.read(spark, root, "reddit").collect()} == {"2026-08-02", "2026-08-03"}
    table, counts = landing.load_all(spark, root, posts(spark))
    got = {r["platform"]: tuple(r)[1:] for r in counts.collect()}
    assert got["reddit"] == (2, 3, 1, 0) and got["github"] == (0, 0, 0, 0) and len(as_dict(table)) == 3


def test_files_that_stop_being_text(spark, tmp_path):
    write(tmp_path, "reddit", "2026-08-02.jsonl", [record("1")])
    (tmp_path / "reddit" / "2026-08-03.jsonl").write_bytes(json.dumps(record("2")).encode() + b"\n\xff\xfe{\n" + json.dumps(record("3")).encode() + b"\n")
    table, counts = landing.load_platform(spark, str(tmp_path), "reddit", posts(spark))
    assert tuple(counts.first()) == ("reddit", 2, 2, 0, 1) and set(as_dict(table)) == {"reddit:t3_1", "reddit:t3_2"}


def test_collectors():
    got = files.collector({"bluesky": {"keywords": ["a"], "sort": "", "limit_per_keyword": 7}}, "bluesky")
    assert got.keywords == ["a"] and got.options == {"sort": "latest", "limit_per_keyword": 7}
    assert files.collector({"reddit": {"keywords": ["a"]}}, "reddit", dict.fromkeys(files.REQUIRED["reddit"], "x")).options["time_filter"] == "month"
    for values, name in (({}, "bluesky"), ({"bluesky": {"keywords": ["a"], "limit_per_keyword": 0}}, "bluesky"), ({"reddit": {"keywords": ["a"]}}, "reddit"), ({"hnjobs": {"keywords": ["a"], "thread_kinds": "hiring"}}, "hnjobs")):
        with pytest.raises(ValueError):
            files.collector(values, name)
    assert normalize.authors_of(["hiring", "freelancer"]) == ["whoishiring", "jon_north"]
    with pytest.raises(ValueError):
        normalize.authors_of(["x"])


def test_layers(spark):
    allowed = spark.createDataFrame([("domain", "domain"), ("adapter", "adapter"), ("adapter", "domain")], "layer string, imports string")
    rows = [("domain.a", "adapter.db", False), ("adapter.source.x.y", "adapter.source.z", False), ("adapter.source.x.y", "adapter.source.x.q", False), ("adapter.db", "adapter.source.x", False), ("adapter.db", "domain.a", False), ("domain.a", "numpy", True), ("adapter.db", "numpy", True), ("tests", "adapter.db", False)]
    got = {tuple(r) for r in textscan.layer_faults(spark.createDataFrame(rows, "module string, target string, outside boolean"), allowed, "adapter.source", ("adapter",)).collect()}
    assert got == {("domain.a", "adapter.db", "layer"), ("adapter.source.x.y", "adapter.source.z", "horizontal"), ("adapter.db", "adapter.source.x", "horizontal"), ("domain.a", "numpy", "external")}
