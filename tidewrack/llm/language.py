"""The language of each sentence of a text, with a confidence.

Averaged hashed subword embeddings with a linear softmax: each substring of 3, 4 and 5 characters of a sentence (letters only, lower case,
words apart) has an embedding in a table of BUCKETS rows, the sentence has their average, and a linear layer with softmax gives the
languages. Table and layer are trained by stochastic gradient descent on labelled sentences (at most FIT of them). A part is held out to
set the temperature of the confidence and the least confidence: sentences below it have no language. Since averaging and the layer are
linear, both are multiplied into one table of BUCKETS x languages after training, and scoring is a sum of its rows.

Sentences end with an end mark; lines end them too. Links, tags, mentions, bracketed keywords and symbols around them are taken off first.
Only whole sentences count: one without its end mark, or that a cut left without its beginning (in Latin script it then starts with a
small letter in the middle of the text's start), is none. Null and blank texts and texts without any sentence give no rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.session import spread

BUCKETS, DIM, FIT, EPOCHS, GRAMS = 2**16, 16, 20_000, 60, (3, 4, 5)
#: Share of the labelled sentences held out, and the share of held-out sentences that the least confidence may reject.
HELD_OUT, REJECT = 0.2, 0.002
#: Substrings that make full evidence; of fewer the scores count in proportion, so a sentence of a few letters is sure only where they are telling.
EVIDENCE = 80
_CHARS = 1_000_000

_DROP = re.compile(r"https?://\S+|(?<!\w)[@#]\w+|\[[^\]\n]{0,40}\](?=[\s.!?]*$)", re.IGNORECASE)
_SENTENCE = re.compile(r"[^。！？\n]*?(?:[。！？]+|[.!?…]+[\"'”’»)]*(?=\s+\D|\s*$|[぀-ヿ一-鿿]))|[^。！？\n]+")
_ENDS = re.compile(r"(?:[。！？]|[.!?][\"'”’»)]*)$")
_TOKEN = re.compile(r"\S*\d\S*")


def sentences(text: str) -> list[str]:
    """The whole sentences of a text."""
    out = []
    clean = _DROP.sub(" ", text).strip()
    for i, m in enumerate(_SENTENCE.finditer(clean)):
        s = m.group().strip()
        if not _ENDS.search(s):
            continue
        if i == 0 and s[0].islower():
            continue
        out.append(s)
    return out


def prepared(sentence: str) -> str:
    """NFKC, letters in lower case, words with digits left out, words apart and framed by spaces."""
    if not sentence.isascii():
        sentence = unicodedata.normalize("NFKC", sentence)
    s = _TOKEN.sub(lambda m: re.sub(r"[A-Za-z]*[-/.]?[A-Za-z]*\d[A-Za-z0-9_./-]*", " ", m.group()), sentence)
    return " " + " ".join(re.sub(r"[\W\d_]+", " ", s).lower().split()) + " "


def gram_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, start): the hashed substrings of all texts, those of a text together, and where each text's start."""
    c = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    length = np.array([len(t) for t in texts], np.int64)
    end = np.cumsum(length)
    left = np.repeat(end, length) - np.arange(len(c))  # characters from here to the text's end
    h = c * np.uint32(2654435761)
    cols = np.full((len(c), len(GRAMS)), -1, np.int32)
    for n in range(1, max(GRAMS)):
        if len(c) > n:
            h = h[:-1] * np.uint32(0x01000193) ^ c[n:] * np.uint32(2654435761)
        else:
            h = h[:0]
        if n + 1 in GRAMS:
            x = h ^ (h >> np.uint32(15)) ^ np.uint32(n)
            cols[: len(h), GRAMS.index(n + 1)] = np.where(left[: len(h)] > n, x % np.uint32(BUCKETS), np.uint32(0)).astype(np.int32)
            cols[: len(h), GRAMS.index(n + 1)][left[: len(h)] <= n] = -1
    flat = cols.reshape(-1)
    keep = flat >= 0
    counts = np.add.reduceat(keep.astype(np.int64), (end - length) * len(GRAMS)) if len(texts) and len(c) else np.zeros(len(texts), np.int64)
    return flat[keep], np.concatenate([[0], np.cumsum(counts)])


class Model:
    """Languages, their table of scores, temperature and least confidence."""

    def __init__(self, languages: list[str], table: np.ndarray, scale: float, least: float) -> None:
        self.languages, self.table, self.scale, self.least = languages, table, scale, least

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of the language or -1, confidence) of each prepared sentence."""
        if not texts:
            return np.zeros(0, np.int64), np.zeros(0)
        buckets, start = gram_buckets(texts)
        n = np.diff(start)
        z = np.zeros((len(texts), self.table.shape[1]), np.float32)
        some = n > 0
        if some.any():
            z[some] = np.add.reduceat(self.table[buckets], start[:-1][some], axis=0) / n[some, None]
        weight = np.minimum(1.0, n / EVIDENCE)
        p = _softmax(z[:, : len(self.languages)].astype(np.float64) * self.scale * weight[:, None])
        best, conf = p.argmax(axis=1), p.max(axis=1)
        return np.where(some & (conf >= self.least), best, -1), np.where(some, conf, 0.0)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(labelled: list[tuple[str, str]], epochs: int = EPOCHS, seed: int = 3) -> Model:
    """A model from (language, sentence) pairs: a first fit without the held-out part calibrates, a second on all pairs is what scores."""
    first = _fit(labelled, epochs, seed, HELD_OUT)
    whole = _fit(labelled, epochs, seed, 0.0)
    return Model(whole.languages, whole.table, first.scale, first.least) if first.languages == whole.languages else first


def _run_of(text: str, rng: np.random.Generator) -> str:
    """Some words in a row of a prepared sentence, or some characters where its words are long."""
    words = text.split()
    if len(words) < 8:
        at = int(rng.integers(0, max(1, len(text) // 2)))
        return text[at : at + max(8, len(text) // 2)]
    n = int(rng.integers(3, len(words)))
    at = int(rng.integers(0, len(words) - n + 1))
    return " " + " ".join(words[at : at + n]) + " "


def _fit(labelled: list[tuple[str, str]], epochs: int, seed: int, held_out: float) -> Model:
    labelled = sorted(x for x in labelled if x[0] and x[1])
    languages = sorted({x[0] for x in labelled})
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(labelled))
    held, fit = order[: int(len(order) * held_out)], order[int(len(order) * held_out) :]
    texts, y = [prepared(x[1]) for x in labelled], np.array([languages.index(x[0]) for x in labelled])
    e, w = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)), np.zeros((DIM, len(languages)))
    for epoch in range(epochs):
        rate = 0.5 * (1 - epoch / epochs)
        for at in range(0, len(fit), 8):
            k = fit[at : at + 8]
            # half of the time a run of words of the sentence, so that each part of it learns to tell the language
            x, start = gram_buckets([_run_of(texts[i], rng) if rng.random() < 0.5 else texts[i] for i in k])
            n = np.maximum(np.diff(start), 1)
            mean = np.stack([e[x[s:t]].mean(axis=0) if t > s else e[0] for s, t in zip(start, start[1:], strict=False)])
            g = _softmax(mean @ w)
            g[np.arange(len(k)), y[k]] -= 1
            back = g @ w.T
            w -= rate * mean.T @ g
            np.subtract.at(e, x, np.repeat(rate * 8 * back / n[:, None], np.diff(start), axis=0))
        fit = rng.permutation(fit)
    table = np.zeros((BUCKETS, 8 * -(-len(languages) // 8)), np.float32)
    table[:, : len(languages)] = e @ w
    model = Model(languages, table, 1.0, 0.0)
    if len(held):
        parts = [gram_buckets([texts[i]])[0] for i in held]
        z = np.stack([table[x].mean(axis=0)[: len(languages)] if len(x) else np.zeros(len(languages)) for x in parts]).astype(np.float64)
        loss = lambda s: -np.log(np.maximum(_softmax(z * s)[np.arange(len(held)), y[held]], 1e-12)).mean()
        model.scale = float(min((0.25, 0.5, 0.75, 1, 1.5, 2, 3, 5), key=loss))
        own = np.sort(_softmax(z * model.scale)[np.arange(len(held)), y[held]])
        model.least = float(max(0.5, own[int(len(own) * REJECT)] * 0.8))
    return model


def model_of(samples: DataFrame, lang: str, sentence: str) -> Model:
    """A model trained on at most FIT of the labelled sentences, those of least hash; trained once for each set of them in a process."""
    rows = samples.filter(F.col(lang).isNotNull() & F.col(sentence).isNotNull()).select(F.col(lang).alias("l"), F.col(sentence).alias("s")).orderBy(F.xxhash64("s"), "s", "l").limit(FIT).collect()
    return _trained(tuple((r["l"], r["s"]) for r in rows))


@lru_cache(maxsize=4)
def _trained(labelled: tuple[tuple[str, str], ...]) -> Model:
    return train(list(labelled))


def segments(df: DataFrame, key: str, text: str, model: Model) -> DataFrame:
    """(key, n, sentence, lang, confidence): every whole sentence in order, lang null below the least confidence."""
    sent = df.sparkSession.sparkContext.broadcast(model)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            row, n, text_out = [], [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                for k, s in enumerate(sentences(t) if t else []):
                    row.append(i)
                    n.append(k)
                    text_out.append(s)
            best, conf = _predicted(m, text_out)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row, pa.int64())), pa.array(n, pa.int32()), pa.array(text_out, pa.string()), pa.array([m.languages[x] if x >= 0 else None for x in best], pa.string()), pa.array(conf, pa.float64())], ["key", "n", "sentence", "lang", "confidence"])

    return spread(df.select(key, text)).mapInArrow(run, f"key {kind}, n int, sentence string, lang string, confidence double")


def _predicted(m: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    best, conf = [], []
    for at in range(0, len(texts), 8000):
        a, c = m.predict([prepared(s) for s in texts[at : at + 8000]])
        best.append(a)
        conf.append(c)
    return (np.concatenate(best), np.concatenate(conf)) if best else (np.zeros(0, np.int64), np.zeros(0))


def languages(df: DataFrame, key: str, text: str, model: Model) -> DataFrame:
    """(key, lang, sentences, confidence): the languages of each text with the number of their sentences and their mean confidence. Summed in
    the workers: a row per text and language leaves them, no shuffle."""
    sent = df.sparkSession.sparkContext.broadcast(model)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            row, texts = [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                if t:
                    got = sentences(t)
                    texts += got
                    row += [i] * len(got)
            best, conf = _predicted(m, texts)
            of = np.array(row, np.int64) * len(m.languages) + best
            ok = best >= 0
            each, at = np.unique(of[ok], return_inverse=True)
            n, total = np.bincount(at, minlength=len(each)), np.bincount(at, conf[ok], len(each))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(each // len(m.languages), pa.int64())), pa.array([m.languages[x] for x in each % len(m.languages)], pa.string()), pa.array(n, pa.int32()), pa.array(total / np.maximum(n, 1), pa.float64())], ["key", "lang", "sentences", "confidence"])

    return spread(df.select(key, text)).mapInArrow(run, f"key {kind}, lang string, sentences int, confidence double")
