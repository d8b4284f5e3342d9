import random
from collections import Counter
from itertools import combinations

import pytest

from tidewrack.llm import gram


def brute(rows, min_count, share):
    sets = [s for r in rows if (s := {x.strip().lower() for x in (r or []) if x and x.strip()})]
    one, two = Counter(x for s in sets for x in s), Counter(p for s in sets for p in combinations(sorted(s), 2))
    return {(*p, one[p[0]], one[p[1]], n, len(sets)) for p, n in two.items() if n >= min_count and n >= len(sets) * share}


@pytest.mark.parametrize("bound", [200_000, 0])
@pytest.mark.parametrize("items", [9, 1500])
def test_against_counting(spark, monkeypatch, bound, items):
    monkeypatch.setattr(gram, "BROADCAST_ITEMS", bound)
    rng = random.Random(items)
    rows = [[f" K{rng.randrange(items)} " if rng.random() < 0.3 else f"k{rng.randrange(items)}" for _ in range(rng.randrange(8))] for _ in range(600)] + [None, [], [None, " ", ""], ["a", "A ", "b"]] + [["hot", "hot2"]] * 300
    df = spark.createDataFrame([(r, "x", 1) for r in rows], "w array<string>, at string, n int")
    got = {(r["item_a"], r["item_b"], r["n_a"], r["n_b"], r["n_ab"], r["n"]) for r in gram.cooccurrence(df, "w", 2, 0.001).collect()}
    assert got == brute(rows, 2, 0.001)


def test_empty(spark):
    assert gram.cooccurrence(spark.createDataFrame([], "w array<string>"), "w", 1, 0.001).count() == 0


def test_blocks_hand_out_what_is_over(monkeypatch):
    """Long records and many items: partial counts leave inside a block, and add up to the same."""
    import numpy as np

    rng = random.Random(5)
    records = [sorted(rng.sample(range(2000), rng.choice([0, 1, 2, 5, 300]))) for _ in range(40)]
    want = Counter(p for r in records for p in combinations(r, 2))
    sizes = [len(r) for r in records]
    for held, products in ((4_000_000, 2_000_000), (500, 1000), (10**9, 7)):
        monkeypatch.setattr(gram, "_HELD", held)
        monkeypatch.setattr(gram, "_PRODUCTS", products)
        g, got = gram._Gram(), Counter()
        out = [*g.add(np.repeat(np.arange(len(records)), sizes), np.array([x for r in records for x in r], np.int64)), g.take()]
        for b in out:
            for i, j, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                got[i, j] += n
        assert got == want and (len(out) > 1) == (held == 500)
        if products == 7:
            break
