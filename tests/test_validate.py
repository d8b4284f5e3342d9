import json

import pytest

from tidewrack.operators import queue, validate

GOOD = {"post_id": "p", "insight_type": "need", "domain": "other", "summary": "s", "pain_level": 2, "monetizable": True, "competitors": [" A ", " "], "confidence": 1}
CASES = [
    ({}, None), ({"insight_type": "none", "pain_level": 0}, None), ({"competitors": []}, None), ({"confidence": 0.5}, None),
    ({"post_id": " "}, "post_id"), ({"post_id": None}, "post_id"), ({"insight_type": "x"}, "insight_type"), ({"domain": "x"}, "domain"), ({"domain": None}, "domain"),
    ({"summary": ""}, "summary"), ({"summary": "x" * 401}, "summary"), ({"pain_level": 4}, "pain_level"), ({"pain_level": True}, "pain_level"), ({"pain_level": 2.0}, "pain_level"),
    ({"insight_type": "none", "pain_level": 1}, "pain_level"), ({"monetizable": 1}, "monetizable"), ({"competitors": "A"}, "competitors"), ({"competitors": [1]}, "competitors"),
    ({"competitors": None}, "competitors"), ({"confidence": True}, "confidence"), ({"confidence": 1.5}, "confidence"), ({"confidence": "1"}, "confidence"),
]


def frame(spark, lines):
    return spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "line_no int, line string")


def test_rules(spark):
    lines = [json.dumps(GOOD | over) for over, _ in CASES] + ["{", "[1]", "3", "", "  "]
    got = {r["line_no"]: r for r in validate.judged(frame(spark, lines), ["other"]).collect()}
    want = [w for _, w in CASES] + ["json", "object", "object"]
    for i, w in enumerate(want):
        if lines[i] == json.dumps(GOOD | {"competitors": None}):
            assert got[i]["reason"] in (None, "competitors")
            continue
        assert got[i]["reason"] == w, lines[i]
    assert len(got) == len(want) and got[0]["competitors"] == ["A"] and got[1]["domain"] is None and got[1]["summary"] is None


def test_only_one_value_on_a_line(spark):
    from pyspark.sql import functions as F

    from tidewrack.functions.json import parsed

    fine = ['{"a": 1}', ' {"a": [1, {}]} ', "[1]", "1", "null", '"x"', "true"]
    bad = ["", " ", '{"a": 1} x', '{"a": 1}]', '{"a": 1}}', '{"a": 1}, 2', '{"a": 1}, "b": 2', "1 2", "{", '{"a": 1}] [1', '{"a": 1}} {', None, "1, 2", "NaN"]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(fine + bad)], "i int, x string")
    assert {r["i"] for r in rows.filter(parsed(F.col("x")).isNotNull()).collect()} == set(range(len(fine)))


def test_batch(spark):
    lines = [json.dumps(GOOD | {"post_id": k} | o) for k, o in (("a", {"pain_level": 9}), ("a", {}), ("a", {}), ("b", {}))]
    accepted, rejected = validate.load(frame(spark, lines), spark.createDataFrame([("a",)], "id string"), ["other"])
    assert [r["line_no"] for r in accepted.collect()] == [1]
    assert {(r["line_no"], r["reason"]) for r in rejected.collect()} == {(0, "pain_level"), (2, "duplicate"), (3, "batch")}
    assert len(validate.error_lines(rejected).collect()) == 3


def test_queue_names():
    from datetime import datetime

    assert queue.batch_id({"20260801T000000"}, datetime(2026, 8, 1)) == "20260801T000001"
    assert queue.instructions("{a} {b}", {"a": "1"}) == "1 {b}"


def test_since():
    from datetime import datetime

    from tidewrack.functions.time import since_of

    assert since_of("7d", datetime(2026, 8, 8)) == datetime(2026, 8, 1)
    with pytest.raises(ValueError):
        since_of("week", datetime(2026, 8, 8))


def test_a_batch_there_and_back(spark, tmp_path):
    from datetime import datetime

    from tests.test_store import as_dict, posts
    from tidewrack import schemas

    ddl = lambda t: ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in t.fields)
    insights, ledger = spark.createDataFrame([], ddl(schemas.INSIGHTS)), spark.createDataFrame([("20260801T000000", datetime(2026, 8, 1), 1, "v0", None, None)], ddl(schemas.BATCHES))
    p = posts(spark, {"id": "bluesky:1", "text": "one", "collected_at": datetime(2026, 8, 2), "posted_at": datetime(2026, 8, 1, 5)}, {"id": "bluesky:2", "text": " "}, {"id": "bluesky:3", "text": "three"}, {"id": "github:4", "text": "other"})
    vocabulary = [{"id": "other", "label": "O", "boundary": "all else"}]
    folder = f"file://{tmp_path}/x"
    made = queue.prepare(p, insights, ledger, folder, 1, "v1", "{batch_jsonl} {result_jsonl} {domain_ids}\n{domain_guide}", vocabulary, datetime(2026, 8, 1))
    assert made.batch_id == "20260801T000001" and {k: r["extraction_status"] for k, r in as_dict(made.posts).items()} == {"bluesky:1": "batched", "bluesky:2": "skipped", "bluesky:3": "pending", "github:4": "pending"}
    assert [json.loads(r[0]) for r in spark.read.text(made.batch_path).collect()] == [{"id": "bluesky:1", "platform": "bluesky", "text": "one", "posted_at": "2026-08-01T05:00:00", "matched_keywords": []}]
    text = open(made.instruction_path.removeprefix("file://"), encoding="utf-8").read()
    assert text == f"{made.batch_path} {made.result_path} other\n- `other` (O): all else"
    with pytest.raises(FileNotFoundError):
        queue.load(made.posts, insights, made.ledger, folder, made.batch_id, ["other"], datetime(2026, 8, 3))
    with open(made.result_path.removeprefix("file://"), "w") as f:
        f.write("\n".join([json.dumps(GOOD | {"post_id": "bluesky:1"}), "", "{", json.dumps(GOOD | {"post_id": "nobody"})]))
    with pytest.raises(ValueError):
        queue.load(made.posts, insights, ledger, folder, made.batch_id, ["other"], datetime(2026, 8, 3))
    done = queue.load(made.posts, insights, made.ledger, folder, made.batch_id, ["other"], datetime(2026, 8, 3))
    assert (done.accepted, done.rejected, done.cleared) == (1, 2, 0) and as_dict(done.posts)["bluesky:1"]["extraction_status"] == "done"
    assert [(json.loads(r[0])["line"], json.loads(r[0])["reason"]) for r in spark.read.text(done.errors_path).collect()] == [(3, "json"), (4, "batch")]
    one = done.insights.collect()[0]
    assert (one["post_id"], one["extractor_version"], one["extracted_at"]) == ("bluesky:1", "v1", datetime(2026, 8, 3))
    assert {r["batch_id"]: r["loaded_count"] for r in done.ledger.collect()} == {"20260801T000000": None, "20260801T000001": 1}
    assert queue.prepare(p.filter("platform = 'github'"), insights, ledger, folder, 1, "v1", "", vocabulary, datetime(2026, 8, 1)) is None
    again = queue.prepare(done.posts, done.insights, done.ledger, folder, 5, "v2", "", vocabulary, datetime(2026, 8, 4), reextract="v1")
    assert spark.read.text(again.batch_path).count() == 1 and as_dict(again.posts)["bluesky:3"]["extraction_status"] == "pending"
