import pandas as pd
import pytest

from tidewrack.llm import language


@pytest.fixture(scope="module")
def labelled(data):
    d = pd.read_parquet(f"{data}/lang_samples.parquet")
    return list(zip(d["lang"], d["sample_text"], strict=True))


def test_held_out(labelled):
    fit, held = labelled[::2], labelled[1::2]
    m = language.train(fit)
    got, conf = m.predict([language.prepared(s) for _, s in held])
    assert sum(m.languages[g] == want for g, (want, _) in zip(got, held, strict=True) if g >= 0) >= 0.98 * len(held)
    assert (got >= 0).mean() > 0.97 and conf.mean() > 0.9


def test_segments(spark, labelled):
    m = language.train(labelled)
    by = {x: s for x, s in labelled}
    rows = [
        (1, by["en"] + " " + by["ja"] + "\n" + by["de"]), (2, "#tag https://a.example/x 🚀 WIM-34140"), (3, None), (4, ""), (5, "   \n"), (6, "🚀 -> Nolcle 2670"),
        (7, by["fr"][:-1]), (8, "ragment of a sentence that a cut left. " + by["pt"]), (9, (by["es"] + " ") * 3000),
    ]
    df = spark.createDataFrame(rows, "k int, t string")
    got = {(r["key"], r["lang"]) for r in language.languages(df, "k", "t", m).collect()}
    assert got == {(1, "en"), (1, "ja"), (1, "de"), (8, "pt"), (9, "es")}
    parts = language.segments(df, "k", "t", m)
    assert parts.filter("key = 1").count() >= 3 and parts.filter("key IN (2, 3, 4, 5, 6)").count() == 0
    assert language.languages(df.limit(0), "k", "t", m).count() == 0
