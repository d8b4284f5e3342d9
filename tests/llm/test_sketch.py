import random

import numpy as np
from pyspark.sql import functions as F

from tidewrack.llm import sketch

WORDS = ["radar", "buoy", "quay", "nozzle", "spool", "fog", "harbour", "camera", "board", "gripper", "stepper", "label", "queue", "driver", "model", "レーダー", "浮標", "岸壁"]


def corpus(seed, n):
    """Texts and copies with edits from tiny to large."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        t = " ".join(f"{rng.choice(WORDS)}{rng.randrange(3000)}" for _ in range(rng.choice([9, 30, 80])))
        out.append(t)
        for k in range(rng.randrange(4)):
            w = t.split()
            for _ in range(int(len(w) * rng.choice([0.02, 0.08, 0.15, 0.25]))):
                w[rng.randrange(len(w))] = rng.choice(WORDS) + str(rng.randrange(3000))
            if rng.random() < 0.3:
                w = w[len(w) // 5 :]
            out.append(" ".join(w).upper() + "  " if k == 1 else " ".join(w))
    return out


def brute(texts, least=0.6, min_chars=60):
    sets = {i: sketch.shingles(sketch.normalise(t)) for i, t in enumerate(texts) if t is not None and len(sketch.normalise(t)) >= min_chars}
    keys = sorted(sets)
    return {(i, j): s for x, i in enumerate(keys) for j in keys[x + 1 :] if (s := sketch.jaccard(sets[i], sets[j])) >= least}


def frame(spark, texts):
    return spark.createDataFrame([("s", t, i, 0) for i, t in enumerate(texts)], "space string, text string, key int, id int")


def test_pairs_against_brute_force(spark):
    texts = corpus(3, 220) + [None, "", "  ", "short", "a" * 90, "a" * 91, "ab" * 60, "ba" * 60, "x" * 30 + "long " * 40_000] + ["the same text again and again, written by many people at many times"] * 40
    want = brute(texts)
    df = frame(spark, texts)
    got = {(r["key_a"], r["key_b"]) for r in sketch.row_pairs(df, sketch.similar(df)).collect()}
    assert got <= set(want)
    sure = {p for p, s in want.items() if s >= 0.75}
    assert len(got & sure) >= 0.995 * len(sure) and len(got) >= 0.97 * len(want), (len(got), len(want))


def _entries(texts, lists=(np.zeros(0, np.uint64), np.zeros(0, np.int64)), old=()):
    values, start = sketch.shingle_sets([sketch.normalise(t) for t in texts])
    doc, key = sketch.list_keys(values, start)
    key &= np.uint64(0xFF)
    row, key = sketch.cells(key, doc.astype(np.int64), lists)
    x = np.zeros(len(row), sketch.ENTRY)
    x["key"], x["id"], x["sig"] = key & np.uint64(0xFFFFFFFF), doc[row], sketch.signatures(values, start)[doc[row]]
    x["small"], x["old"] = sketch.smallness(np.diff(start))[doc[row]], np.isin(doc[row], list(old))
    return x


def test_lists_split_into_cells_and_blocks_lose_nothing(monkeypatch):
    texts = corpus(5, 40)
    whole = sketch.list_pairs(_entries(texts))
    assert len(whole) > 20
    monkeypatch.setattr(sketch, "_PAIRS", 50)
    assert (sketch.list_pairs(_entries(texts)) == whole).all()
    split = _entries(texts, (np.arange(0, 256, 2, dtype=np.uint64), np.arange(128) % 5 + 1))
    assert (sketch.list_pairs(split) == whole).all()


def test_old_entries_meet_new_ones_only():
    texts = corpus(6, 40)
    whole = {tuple(p) for p in sketch.list_pairs(_entries(texts)).tolist()}
    old = set(range(0, len(texts), 3))
    assert {tuple(p) for p in sketch.list_pairs(_entries(texts, old=old)).tolist()} == {p for p in whole if not (p[0] in old and p[1] in old)}


def test_one_list_with_a_third_of_the_texts(spark, monkeypatch):
    """A run of values that many texts share: the sample finds it, its cells are several tasks' work, no pair is lost."""
    monkeypatch.setattr(sketch, "LIST", 40)
    head = "every one of these notes starts with the very same long sentence that nobody ever edits, "
    rng = random.Random(2)
    texts = corpus(4, 60) + [head + "".join(rng.choice("abcdefgh123") for _ in range(rng.randrange(4, 24))) for _ in range(120)]
    df = frame(spark, texts)
    held = sketch.sketches(df, 60).withColumn("old", F.lit(0).cast("byte"))
    keys, parts = sketch.long_lists(held, held.count())
    assert len(keys) and parts.max() >= 3
    want = brute(texts)
    got = {(r["key_a"], r["key_b"]) for r in sketch.row_pairs(df, sketch.similar(df)).collect()}
    assert got <= set(want) and len(got) >= 0.98 * len(want) and len(want) > 5000


def test_exhaustive_finds_every_pair(spark):
    texts = corpus(9, 120) + [None, "", "a" * 90, "a" * 91, "ab" * 60, "ba" * 60]
    for least in (0.6, 0.8):
        df = frame(spark, texts)
        got = {(r["key_a"], r["key_b"]) for r in sketch.row_pairs(df, sketch.similar(df, least, exhaustive=True)).collect()}
        assert got == set(brute(texts, least))


def test_signature_estimates():
    a, b = ["w%d" % i for i in range(400)], ["w%d" % i for i in range(100, 500)]
    va, sa = sketch.shingle_sets([" ".join(a), " ".join(b)])
    j = sketch.jaccard(sketch.shingles(" ".join(a)), sketch.shingles(" ".join(b)))
    s = sketch.signatures(va, sa)
    assert abs(1 - np.bitwise_count(s[0] ^ s[1]).sum() / sketch.BITS - (1 + j) / 2) < 0.13


def test_spaces_are_apart_and_empty(spark):
    t = "one text that stands in both spaces and is long enough to count for both"
    df = spark.createDataFrame([("a", t, 1), ("b", t, 2)], "space string, text string, key int")
    assert sketch.row_pairs(df, sketch.similar(df)).count() == 0
    assert sketch.similar(df.limit(0)).count() == 0
    assert sketch.members(df, ["key"], 60).select(F.count_distinct("id")).first()[0] == 2


def test_recall_by_band(spark):
    rng = random.Random(8)
    rows, band = [], {}
    for i in range(1500):
        n, low = rng.randrange(70, 600), (0.60, 0.62, 0.65)[i % 3]
        t = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
        u = t[: 3 + -int(-(n - 3) * 2 * low // (1 + low))]  # the rest is new
        u += "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n - len(u)))
        s = sketch.jaccard(sketch.shingles(t), sketch.shingles(u))
        if low <= s < low + 0.02:
            band[2 * i, 2 * i + 1] = low
            rows += [("s", t, 2 * i), ("s", u, 2 * i + 1)]
    df = spark.createDataFrame(rows, "space string, text string, key int")
    got = {(r["key_a"], r["key_b"]) for r in sketch.row_pairs(df, sketch.similar(df)).collect()}
    for low, least in ((0.60, 0.985), (0.62, 0.99), (0.65, 0.99)):
        want = [p for p in band if band[p] == low]
        found = sum(p in got for p in want)
        print(f"from {low}: {found} of {len(want)}")
        assert len(want) > 300 and found >= least * len(want), (low, found, len(want))
