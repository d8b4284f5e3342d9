import os
import random

import numpy as np
import pytest

from tidewrack.llm import packing

needs_vocabulary = pytest.mark.skipif(not os.path.exists(packing.VOCABULARY), reason="no vocabulary here")


def test_curve_visits_neighbours():
    for dims, levels in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(2**levels)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
        key = packing.hilbert_key(grid, levels)
        assert sorted(key.tolist()) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def sized(spark, sizes):
    return spark.createDataFrame([(i, n, i % 17) for i, n in enumerate(sizes)], "key int, tokens bigint, place bigint")


@pytest.mark.parametrize("ranges", [4000, 3])
def test_packing(spark, monkeypatch, ranges):
    monkeypatch.setattr(packing, "RANGE_CONTAINERS", ranges)
    rng = random.Random(3)
    sizes = [rng.choice([rng.randrange(1, 60), rng.randrange(1, 101), rng.randrange(100, 420)]) for _ in range(900)] + [0, 0, 100, 200, 101]
    rows = packing.packed(sized(spark, sizes), 100).collect()
    room, whole = {}, {}
    for r in rows:
        room[r["container"]] = room.get(r["container"], 0) + r["tokens"]
        whole.setdefault(r["key"], []).append(r["tokens"])
    assert max(room.values()) <= 100 and sum(room.values()) == sum(sizes)
    for i, n in enumerate(sizes):
        assert sorted(whole[i]) == sorted([100] * (n // 100) + ([n % 100] if n % 100 or not n else []))
    assert len(room) <= 1.02 * sum(sizes) / 100 + (2 if ranges == 4000 else sum(sizes) / 100 / ranges)  # each range may leave one partly filled


def test_hot_place_spreads(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANGE_CONTAINERS", 20)
    df = spark.createDataFrame([(i, 30, 5) for i in range(1500)], "key int, tokens bigint, place bigint")
    from pyspark.sql import functions as F

    per = packing.packed(df, 100).groupBy(F.shiftright("container", 32)).count().collect()
    assert len(per) > 10 and max(r["count"] for r in per) < 300


@needs_vocabulary
def test_texts(spark):
    e = packing.load(packing.VOCABULARY)
    t = ("The nozzle of the board, 改めて、岸壁で。\n\n" * 9000)[:300_000]
    assert packing.count_tokens(e, t) == len(e.encode_ordinary(t))
    rows = packing.pack(spark.createDataFrame([(1, "a b c"), (2, None), (3, ""), (4, t), (5, "🚀 " * 10)], "key int, text string"), "key", "text", 2048).collect()
    assert {r["key"] for r in rows} == {1, 3, 4, 5} and sum(r["tokens"] for r in rows if r["key"] == 4) == packing.count_tokens(e, t)
    assert packing.pack(spark.createDataFrame([], "key int, text string"), "key", "text", 2048).count() == 0


def test_containers_hold_neighbours(spark):
    rng = random.Random(9)
    rows = [(i, rng.randrange(5, 60), i) for i in range(4000)]
    got = packing.packed(spark.createDataFrame(rows, "key bigint, tokens bigint, place bigint"), 200).collect()
    boxes = {}
    for r in got:
        boxes.setdefault(r["container"], []).append(r["key"])
    gaps = sorted(b - a for x in boxes.values() for a, b in zip(sorted(x), sorted(x)[1:], strict=False))
    assert len(got) == 4000 and gaps[len(gaps) // 2] <= 40


def test_same_containers_whatever_the_partitions(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANGE_CONTAINERS", 10)
    rng = random.Random(4)
    df = spark.createDataFrame([(i, rng.randrange(0, 300), rng.randrange(2**32)) for i in range(1200)], "key bigint, tokens bigint, place bigint")
    one, two = ({tuple(r) for r in packing.packed(x, 256).collect()} for x in (df, df.repartition(7)))
    assert one == two and len({r[3] >> 32 for r in one}) > 20
