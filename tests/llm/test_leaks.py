import random

import numpy as np

from tidewrack.llm import leaks

ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789かなカナ漢字"


def text(rng, n):
    return "".join(rng.choice(ALPHABET) for _ in range(n))


def test_found_is_exact(spark):
    rng = random.Random(4)
    items = [(i, text(rng, rng.randrange(60, 300))) for i in range(30)] + [(98, "too short"), (99, None), (100, "")]
    docs = []
    for k in range(200):
        body = text(rng, rng.randrange(0, 900))
        if k % 2:
            t = items[rng.randrange(30)][1]
            n = rng.choice([20, 45, 49, 50, 51, 60, 300])
            at = rng.randrange(0, max(1, len(t) - n + 1))
            part = t[at : at + n]
            part = " ".join(part[i : i + 7] for i in range(0, len(part), 7)).upper() if k % 3 == 0 else part.replace("a", "a-")
            body = body[:100] + part + body[100:]
        docs.append((k, body))
    docs += [(900, None), (901, ""), (902, "x" * 300_000 + items[0][1])]
    want = set()
    for d, t in docs:
        p = leaks.letters(t or "")
        grams = {p[i : i + 50] for i in range(len(p) - 49)}
        want |= {(d, i) for i, s in items if s and any(leaks.letters(s)[j : j + 50] in grams for j in range(len(leaks.letters(s)) - 49))}
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    it = spark.createDataFrame(items, "item_id bigint, item_text string")
    run = lambda: {(r["doc_id"], r["item_id"]) for r in leaks.leaks(df, "doc_id", "text", it, "item_id", "item_text").filter("shared >= 50").collect()}
    assert run() == want
    leaks.ITEM_CHARS, kept = 900, leaks.ITEM_CHARS
    try:
        assert run() == want
    finally:
        leaks.ITEM_CHARS = kept
    assert leaks.leaks(df.limit(0), "doc_id", "text", it, "item_id", "item_text").count() == 0
    assert leaks.leaks(df, "doc_id", "text", it.limit(0), "item_id", "item_text").count() == 0


def test_edited_items(spark):
    rng = random.Random(5)
    items = [(i, text(rng, 200)) for i in range(20)]
    docs = []
    for i, t in items:
        s = list(t)
        for _ in range(5):
            k = rng.randrange(len(s))
            s[k] = rng.choice(["", "q", s[k] + "w"])
        docs.append((i, text(rng, 77) + "".join(s) + text(rng, 50)))
    df = leaks.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), "doc_id", "text", spark.createDataFrame(items, "item_id bigint, item_text string"), "item_id", "item_text", 30)
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in df.filter("edits IS NOT NULL").collect()}
    assert len(got) >= 18 and all(a == b for a, b in got)


def test_embedding_keeps_small_edits_near():
    rng = np.random.default_rng(1)
    a = rng.integers(97, 123, (400, leaks.WINDOW)).astype(np.uint32)
    b = a.copy()
    b[:, 20] = 64
    same = (leaks.cgk_keys(a, 40, 4) == leaks.cgk_keys(b, 40, 4)).mean()
    other = (leaks.cgk_keys(a, 40, 4) == leaks.cgk_keys(a[::-1], 40, 4)).mean()
    assert same > 0.4 > 0.2 > other and (leaks.cgk_keys(a) == leaks.cgk_keys(a.copy())).all()


def test_edit_distance():
    assert leaks.edit_distance("kitten", "sitting", 5) == 3 and leaks.edit_distance("kitten", "sitting", 2) == 3 and leaks.edit_distance("", "abc", 5) == 3


def test_place_distance():
    rng = random.Random(6)
    for _ in range(40):
        a, b = ("".join(rng.choice("abc") for _ in range(n)) for n in (rng.randrange(1, 12), rng.randrange(0, 14)))
        want = min(leaks.edit_distance(a, b[i:j], 99) for i in range(len(b) + 1) for j in range(i, len(b) + 1))
        assert leaks.place_distance(a, b, 99) == want


def test_items_with_many_spread_edits():
    rng = random.Random(7)
    for n, edits in ((200, 20), (200, 30), (200, 38), (320, 38)):
        items = leaks.Items([(i, text(rng, n)) for i in range(100)])
        docs = []
        for t in items.texts:
            s = list(t)
            for k in rng.sample(range(n), edits):
                s[k] = rng.choice(["", rng.choice(ALPHABET), s[k] + rng.choice(ALPHABET)])
            docs.append(text(rng, 77) + "".join(s) + text(rng, 50))
        got = {d: e for d, i, _, e in leaks._scan(docs, items, 40) if e >= 0 and d == i}
        print(f"{n} characters, {edits} edits: {len(got)} of 100")
        assert len(got) >= 97 and max(got.values()) <= edits
