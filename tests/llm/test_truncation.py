import random

from tidewrack.llm import truncation

STARTS = ["The nozzle of the board", "Our harbour camera", "Die Düse am Gerät", "La boquilla de la placa", "With default settings, the driver"]
ENDS = ["keeps missing small buoys above 155.5 W", "drifts badly, so we went back to NOL-15849", "verwechselt Paletten mit Menschen", "se queda a medias con v2.4-rad9", "labels shadows as boats"]
TAILS = ["", "", "", "\n\n#tag #other", "\nhttps://a.example/x1", "\n\n-- \nLum", " 🙏🙏", "\n```\n$ run --id 3\n```", " Oh well…"]


def whole(rng):
    return " ".join(f"{rng.choice(STARTS)} {rng.randrange(9999)} {rng.choice(ENDS)}{rng.choice('..!')}" for _ in range(rng.randrange(2, 7)))


def test_held_out_accuracy(spark):
    rng = random.Random(2)
    rows = []
    for i in range(2400):
        t = whole(rng)
        cut = rng.random() < 0.15
        if cut:
            at = rng.randrange(30, len(t) - 2)
            while t[at - 1] in ".! " and not (t[at - 1] == "." and t[at].isdigit()):
                at = rng.randrange(30, len(t) - 2)
            t = t[:at] + rng.choice(["", "…", "...", " [more]"])
        else:
            t += rng.choice(TAILS)
        rows.append((i, f"s{i % 5}", t, int(cut)))
    rows += [(9000, None, None, 0), (9001, "s1", "", 0), (9002, "s1", "  \n", 0), (9003, None, "https://a.example #x 🚀", 0), (9004, "s2", whole(rng) * 400, 0)]
    df = spark.createDataFrame(rows, "doc_id int, source string, text string, is_cut int")
    got = {r["key"]: r["cut_score"] for r in truncation.scores(df, "doc_id", "source", "text").collect()}
    assert len(got) == len(rows)
    wrong = [(i, t[-50:], got[i]) for i, _, t, c in rows if t and (got[i] >= 0.5) != bool(c)]
    assert len(wrong) <= 0.01 * len(rows), wrong[:10]
    assert all(got[i] < 0.5 for i in range(9000, 9005))


def test_core():
    for tail in ("\n\n#a #b", "\nhttps://x.example/y", "\n\n-- \nLum", " 🙏🙏", "\n```\ncode\n```", "\n\nFull text: https://x.example/y", "\n```\nopen"):
        assert truncation.core("It stays open." + tail) == "It stays open.", tail
    assert truncation.core("cut in the mid�") == "cut in the mid�"


def test_limits_and_empty(spark):
    df = spark.createDataFrame([("a", "x" * 50)] * 30 + [("a", "y" * k) for k in range(60)] + [("b", "z" * k) for k in range(60)] + [("b", None)], "source string, text string")
    from pyspark.sql import functions as F

    assert [(r["source"], r["at_chars"]) for r in truncation.limits(df, F.col("source"), F.col("text")).collect()] == [("a", [50])]
    assert truncation.scores(spark.createDataFrame([], "k int, s string, t string"), "k", "s", "t").count() == 0
