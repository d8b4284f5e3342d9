from datetime import datetime

import numpy as np
import pytest

from tests.test_store import posts
from tidewrack import schemas
from tidewrack.operators import graph, search

DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.INSIGHTS.fields)


def insights(spark, *rows):
    return spark.createDataFrame([(k, "need", "d", "s", 1, False, c, 0.5, "v1", datetime(2026, 8, 1), None if e is None else [float(x) for x in e], m) for k, c, e, m in rows], DDL)


@pytest.fixture
def small(spark):
    p = posts(spark, *[{"id": f"x:{k}", "author_id": "did:a", "posted_at": datetime(2026, 8, 1), "matched_keywords": ["a", "b"]} for k in ("near1", "near2", "far")])
    i = insights(spark, ("x:near1", ["Roboflow"], [1.0, 0, 0], "m"), ("x:near2", [" Roboflow", "Edge", " "], [0.99, 0.1, 0], "m"), ("x:far", None, [0.0, 0, 1], "m"))
    return p, i


def test_edges(small):
    got = {(r["edge_type"], r["src_id"], r["dst_id"]): round(r["weight"], 3) for r in graph.derive(*small).collect()}
    assert got == {("mentions", "did:a", "Roboflow"): 2.0, ("mentions", "did:a", "Edge"): 1.0, ("cooccurs", "a", "b"): 3.0, ("belongs_to", "a", "d"): 3.0, ("belongs_to", "b", "d"): 3.0, ("similar_to", "x:near1", "x:near2"): 0.995}


def test_rebuild(small):
    first = graph.derive(*small)
    assert sorted(map(tuple, graph.rebuild(first, *small).collect())) == sorted(map(tuple, first.collect()))
    assert graph.rebuild(first, *small, kinds=("cooccurs",)).count() == first.count()
    with pytest.raises(ValueError):
        graph.derive(*small, kinds=("nothing",))
    with pytest.raises(ValueError):
        graph.derive(*small, limit=2)
    assert {r["neighbour_id"] for r in graph.neighbours_of(first, "x:near2").collect()} == {"x:near1"}


def test_models_must_agree(spark, small):
    mixed = small[1].unionByName(insights(spark, ("x:o", None, [1.0, 0, 0], "other")))
    with pytest.raises(ValueError):
        graph.derive(small[0], mixed)
    assert graph.derive(small[0], mixed, kinds=("mentions",)).count() == 2
    with pytest.raises(ValueError):
        search.resolve_model(mixed)


def test_vector_pairs_in_blocks(spark):
    x = np.random.default_rng(1).standard_normal((90, 6))
    x[0] = 0
    df = spark.createDataFrame([(f"p{i}", v.tolist()) for i, v in enumerate(x)] + [("bad", [1.0]), ("nan", [float("nan")] * 6), (None, [1.0] * 6), ("null", None)], "post_id string, embedding array<double>")
    n = x[1:] / np.linalg.norm(x[1:], axis=1, keepdims=True)
    s = n @ n.T
    want = {tuple(sorted((f"p{i + 1}", f"p{j + 1}"))) for i in range(89) for j in range(i) if s[i, j] >= 0.7}
    got = graph.vector_pairs(df, 0.7, block=20)
    assert {(r["a"], r["b"]) for r in got.collect()} == want and got.count() == len(want)


def test_vector_pairs_in_parts(spark):
    x = np.random.default_rng(2).standard_normal((150, 6)).astype(np.float32)
    x[100:] = x[:50] * 3  # of the same direction
    df = spark.createDataFrame([(f"p{i}", v.tolist()) for i, v in enumerate(x)] + [("short", [1.0])], "post_id string, embedding array<float>")
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    s = u @ u.T
    want = {tuple(sorted((f"p{i}", f"p{j}"))): round(s[i, j], 9) for i in range(150) for j in range(i) if s[i, j] >= 0.7}
    for sent in (1000, 1 << 25):
        got = graph.vector_pairs(df, 0.7, block=20, limit=None, sent=sent).collect()
        assert {(r["a"], r["b"]): round(r["sim"], 9) for r in got} == want and len(got) == len(want)
    assert graph.vector_pairs(df.limit(0), 0.7, limit=None).count() == 0
    with pytest.raises(ValueError):
        graph.vector_pairs(df, 0.7, limit=150)


def test_near_ties_go_to_the_lesser_id(spark):
    p = posts(spark, *[{"id": k, "posted_at": datetime(2026, 8, 1)} for k in ("x:q", "x:z", "x:a")])
    v = spark.createDataFrame([("x:q", [1.0, 0.0]), ("x:z", [0.9, 0.19**0.5]), ("x:a", [0.9, 0.19**0.5 * (1 + 1e-13)])], "post_id string, embedding array<double>")
    got = graph.similar_to(v, p, 0.85, 1).collect()
    assert {(r["src_id"], r["dst_id"]) for r in got} == {("x:a", "x:q"), ("x:a", "x:z")}


def test_search(small):
    got = search.search(small[1], small[0], [1.0, 0, 0])
    assert [r["post_id"] for r in got.collect()] == ["x:near1", "x:near2", "x:far"]
    assert search.search(small[1], small[0], [1.0, 0, 0], pain_level=2).count() == 0
    assert search.search(small[1], small[0], [1.0, 0, 0], text="_").count() == 0
    with pytest.raises(ValueError):
        search.search(small[1], small[0], [1.0, 0])


def test_embed(spark, small):
    more = small[1].unionByName(insights(spark, ("x:new", None, None, None)))
    got = search.embed(more, lambda t: [[float(len(x)), 0.0, 1.0] for x in t], "m", 10)
    assert got.filter("post_id = 'x:new'").first()["embedding"] == [10.0, 0.0, 1.0] and got.count() == 4
    with pytest.raises(ValueError):
        search.embed(more, lambda t: [[1.0] for _ in t], "m", 10)
    assert search.embed_query("q", lambda t: [[float(len(t[0]))]]) == [8.0]
