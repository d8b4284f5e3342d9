"""Texts that a source cut: a hashed logistic regression on how texts end.

What a source or writer puts after the last sentence is taken off first: links, tag lines, signatures, symbols, code blocks. A cut mark
(ellipsis, bracketed word, replacement character) stays as a feature and is taken off for the other features. Features: the closing
characters, the shape of the last word, what stands after the last finished sentence, the cut mark, and whether the length in characters or
in bytes is one at which the text's source has a spike (a limit). All are hashed into BITS.

Training needs no labels: of a bounded sample of SAMPLE documents each is taken as it is (class 0, with the few really cut ones among them
as noise) and cut at random places, with and without marks, and behind points inside words (class 1); cuts that happen to fall behind a
finished sentence are left out. A first fit without the features of the limit finds the really cut ones of the sample, which then change
class for the fit that counts. The weights are applied to every document, whole texts.

Spikes are counted over all documents. Null and blank texts are scored 0; texts without any sentence (only links, tags, symbols) too.
An empty table gives no rows. Null sources are a source of their own without limits.
"""

from __future__ import annotations

import random
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewrack.session import cut as written
from tidewrack.session import spread

SAMPLE, CUTS, BITS, EPOCHS = 8_000, 3, 2**15, 6
#: A length is a limit of its source if at least SPIKE of its texts have it, and more than the lengths around it (up to SPIKE_FAR away, without
#: the SPIKE_NEAR nearest, which a limit may spread to) let expect by so many standard deviations.
SPIKE, SPIKE_NEAR, SPIKE_FAR, SPIKE_DEVIATIONS = 4, 3, 14, 6.0
_BROADCAST_ROWS = 100_000
# Marks that sources put behind a cut.
_MARK = re.compile(r"(?:…|\.\.\.|\[(?:more|…|\.\.\.|continued|truncated|read more)\]|\((?:more|continued)\)|�+)$", re.IGNORECASE)
#: A link, with what introduces it on its own line.
_LINK, _TAGS, _SIGNED = re.compile(r"(?:(?:^|\n)[^\n]{0,24}:[ \t]*|(?:^|\s))https?://\S*$"), re.compile(r"(?:(?:^|\s)#\w*)+$"), re.compile(r"\n-- ?(?:\n[^\n]{0,40})?$")
_CLOSERS = "\"'”’»)]）」』"
_END = ".。!?！？"
_FINISHED = re.compile(r"[.!?]+[\"'”’»)\]]*\s+|[。！？]+[」』）]*|\n")


def is_symbol(c: str) -> bool:
    return c not in "`�" and unicodedata.category(c) in ("So", "Sk", "Mn", "Cf")


def core(text: str) -> str:
    """The text without links, tag lines, signatures, symbols and code blocks at its end."""
    while True:
        s = text.rstrip()
        while s and is_symbol(s[-1]):
            s = s[:-1].rstrip()
        for p in (_LINK, _TAGS, _SIGNED):
            s = p.sub("", s)
        if s.count("\n```") % 2 and not s.endswith("```"):  # cut inside a block
            s = s[: s.rfind("\n```")]
        elif s.endswith("```") and (i := s[:-3].rfind("```")) >= 0:
            s = s[:i]
        if s == text:
            return s
        text = s


def shape(s: str) -> str:
    """Letters as a or A, digits as 9, kana and ideographs as K, the rest as it is."""
    return "".join("9" if c.isdigit() else ("K" if "\u3040" <= c <= "\u9fff" else "A" if c.isupper() else "a") if c.isalpha() else c for c in s)


def features(text: str, at_limit: bool | None) -> list[int]:
    """Hashed features of a text, the last that of the limit (left out if that is None); none for a text without sentences."""
    s = core(text)
    mark = _MARK.search(s)
    body = (s[: mark.start()] if mark else s).rstrip()
    m = (mark.group().lower()[:3] if mark else "-") + ("_" if mark and s[: mark.start()] != body else "")
    if not any(c.isalpha() for c in body):
        return []
    bare = body.rstrip(_CLOSERS + " \u00a0\u202f")
    last = re.search(r"[!-~]*$", bare[-200:]).group() or bare[-4:]
    after = _FINISHED.split(s[-400:] + " ")
    rest = next((x.strip() for x in reversed(after) if x and x.strip()), "")
    tail = _FINISHED.split(bare[-400:])[-1].strip()
    end = bare[-1:] if bare[-1:] in _END else "w"
    sh = shape(last[-14:]) if len(last) <= 18 else "long" + last[-1]
    log = "log" if re.match(r"\[\d\d:\d\d\]|\||\$ |- |Re:|#", body[body.rfind("\n") + 1 :]) else "text"
    f = [f"e{end}", f"e{end}{m}", f"m{m}", f"s{sh}", f"c{shape(bare[-3:])}", f"c{shape(bare[-2:])}", f"t{min(len(tail), 60) // 6}{end}", f"k{log}{end}"]
    f += [f"x{bare[-n:]}" for n in (1, 2, 3)]
    if len(rest) <= 14:
        f += [f"r{rest.lower()}"] * 2
    if end == ".":
        f += [f"p{re.sub(r'9+', '9', re.sub(r'[aA]+', 'a', sh))}{len(last) > 18}"] * 2
    if at_limit is not None:
        f.append(f"l{at_limit}{end}")
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) % BITS for x in f]


def training_rows(text: str, at_limit: bool, seed: int) -> Iterator[tuple[int, list[int]]]:
    """(class, features): the text as it is, and cut."""
    own = features(text, at_limit)
    if own:
        yield 0, own
    rng = random.Random(seed)
    s = core(text)
    if len(s) < 40:
        return
    inner = [m.end() for m in re.finditer(r"\w\.(?=\w)", s)]
    places = [rng.randrange(20, len(s)) for _ in range(CUTS)] + ([rng.choice(inner)] if inner else [])
    for at in places:
        cut = s[:at]
        body = cut.rstrip(_CLOSERS + " \n\r\t\u00a0\u202f")
        inside = body.endswith(".") and at < len(s) and body == cut and s[at].isalnum()
        # a cut inside what core() takes off leaves the sentence before it whole
        if not body or core(cut) != cut.rstrip() or body[-1] in _END and not inside:
            continue
        mark = rng.choice(("", "", "", "…", "...", " [more]", "�"))
        f = features(cut + mark, None)
        if f:
            yield 1, f


def fit(labels: np.ndarray, rows: list[list[int]], epochs: int = EPOCHS, rate: float = 0.1, decay: float = 1e-5) -> np.ndarray:
    """Weights of a logistic regression by stochastic gradient descent in small groups."""
    w = np.zeros(BITS + 1)
    if not len(rows):
        return w
    size = np.array([len(r) for r in rows])
    flat, start = np.concatenate([np.array(r, np.int64) for r in rows]), np.concatenate([[0], np.cumsum(size)])
    rng = np.random.default_rng(5)
    for epoch in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 64):
            k = order[at : at + 64]
            idx = np.concatenate([flat[start[i] : start[i + 1]] for i in k])
            own = np.repeat(np.arange(len(k)), size[k])
            z = np.bincount(own, w[idx], len(k)) + w[BITS]
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[k]) * rate / (1 + epoch)
            w *= 1 - decay
            w -= np.bincount(idx, g[own], BITS + 1)
            w[BITS] -= g.sum() / 8
    return w


def fit_twice(labels: np.ndarray, rows: list[list[int]]) -> np.ndarray:
    """Weights from the training rows: first without the features of the limit, then, with them, after the documents that the first
    weights call cut have changed class."""
    w = fit(labels, [r if y else r[:-1] for y, r in zip(labels, rows, strict=True)])
    cut = np.array([bool(y) or w[r[:-1]].sum() + w[BITS] > 0 for y, r in zip(labels, rows, strict=True)])
    return fit(cut.astype(np.int64), rows)


def limits(df: DataFrame, source: Column, text: Column) -> DataFrame:
    """(source, chars, bytes): the lengths at which a source has spikes, arrays."""
    each = df.filter(text.isNotNull()).select(source.alias("source"), F.length(text).alias("chars"), F.octet_length(text).alias("bytes"))
    counts = each.select("source", F.explode(F.array(F.struct(F.lit("c").alias("unit"), F.col("chars").alias("n")), F.struct(F.lit("b").alias("unit"), F.col("bytes").alias("n")))).alias("x")).groupBy("source", "x.unit", "x.n").count()
    by = Window.partitionBy("source", "unit").orderBy("n")
    within = lambda k: F.sum("count").over(by.rangeBetween(-k, k))
    counts = counts.withColumn("usual", (within(SPIKE_FAR) - within(SPIKE_NEAR)) / (2 * (SPIKE_FAR - SPIKE_NEAR)))
    spikes = counts.filter((F.col("count") >= SPIKE) & (F.col("count") >= F.col("usual") + SPIKE_DEVIATIONS * F.sqrt("usual") + SPIKE - 1))
    return spikes.groupBy("source").agg(F.collect_set(F.when(F.col("unit") == "c", F.col("n"))).alias("at_chars"), F.collect_set(F.when(F.col("unit") == "b", F.col("n"))).alias("at_bytes"))


def scores(df: DataFrame, key: str, source: str, text: str) -> DataFrame:
    """(key, source, cut_score): probability that the text was cut, for every row."""
    spikes = written(limits(df, F.col(source), F.col(text)))  # read three times below
    rows = spread(df.select(F.col(key).alias("key"), F.col(source).alias("source"), F.col(text).alias("text")))
    few = spikes.limit(_BROADCAST_ROWS + 1).count() <= _BROADCAST_ROWS
    near = lambda n, a: F.coalesce(F.exists(a, lambda x: (x - n).between(-1, 3)), F.lit(False))
    rows = rows.join(F.broadcast(spikes) if few else spikes, "source", "left").select("key", "source", "text", (F.coalesce(F.array_contains("at_chars", F.length("text")), F.lit(False)) | near(F.octet_length("text"), "at_bytes")).alias("at_limit"))
    n = df.count()
    share = min(1.0, SAMPLE / max(n, 1))
    sample = rows.filter((F.pmod(F.xxhash64("key"), F.lit(1_000_003)) < int(share * 1_000_003) + 1) & F.col("text").isNotNull())

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [x for t, a in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for x in training_rows(t, a, zlib.crc32(t[-200:].encode("utf-8", "surrogatepass")))]
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int32()), pa.array([g[1] for g in got], pa.list_(pa.int32()))], ["label", "f"])

    got = sample.select("text", "at_limit").mapInArrow(train, "label int, f array<int>").toArrow()
    order = sorted(zip(got.column("label").to_pylist(), got.column("f").to_pylist(), strict=True))
    sent = df.sparkSession.sparkContext.broadcast(fit_twice(np.array([x[0] for x in order]), [x[1] for x in order]).astype(np.float32))
    kinds = [rows.schema[c].dataType.simpleString() for c in ("key", "source")]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value
        for b in batches:
            f = [features(t, a) if t else [] for t, a in zip(b.column("text").to_pylist(), b.column("at_limit").to_pylist(), strict=True)]
            z = [float(w[x].sum() + w[BITS]) if x else -30.0 for x in f]
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("source"), pa.array(1 / (1 + np.exp(-np.clip(np.array(z), -30, 30))), pa.float64())], ["key", "source", "cut_score"])

    return rows.mapInArrow(score, f"key {kinds[0]}, source {kinds[1]}, cut_score double")
