"""Texts into containers of a fixed number of tokens, with neighbours in content side by side.

Each text is counted in tokens of a public tokenizer and becomes a vector of hashed words, projected by fixed random signs to DIMS
numbers; those are the coordinates of a cell whose place on a Hilbert curve is the text's key. Rows are range-sorted by key, and each
range is packed along the curve: windows of about WINDOW_CONTAINERS containers' tokens are placed largest first, each piece into the open
container with the least room that still holds it, and containers with room stay open for the next windows. Most pieces of a container are
thus from one window, neighbours on the curve; small pieces also fill room left by earlier windows.

A text of more tokens than the capacity fills whole containers with pieces of exactly the capacity and leaves one shorter piece; no other
text is split. The curve is cut into ranges by the tokens counted in 2 ** BIN_BITS stretches of it (RANGE_CONTAINERS containers a range), and a
stretch of more tokens, as of equal texts, is shared out by a hash, which bounds what one task packs and the share of room lost at the ends
of ranges. The same table always gives the same containers, whatever its partitions.

Null texts are in no container; texts without tokens are placed as pieces of 0 tokens; an empty table gives no containers.
"""

from __future__ import annotations

import base64
import math
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.session import cut, spread

#: The vocabulary file (ranks of byte sequences) is a parameter; this is its usual place. The pattern is the usual one of its kind.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
DIMS, LEVELS, SLOTS = 4, 8, 1024
WINDOW_CONTAINERS, RANGE_CONTAINERS = 16, 4000
#: Leading bits of a place by which the tokens along the curve are counted, to cut it into ranges.
BIN_BITS = 18
#: Characters given to the tokenizer at once: longer texts are counted in parts cut before a space or a line's end.
_PART = 200_000
_WORD = re.compile(r"[^\W\d_]{2,}")


def load(vocabulary: str):
    """The tokenizer of a vocabulary file."""
    import tiktoken

    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(encoding, text: str) -> int:
    """Tokens of a text."""
    n = 0
    while len(text) > _PART:
        # the pattern never joins a letter to a space that follows it
        at = next((m.start() for m in re.finditer(r"(?<=\w)\s(?=\w)", text[_PART // 2 : _PART])), None)
        if at is None:
            break
        n += len(encoding.encode_ordinary(text[: _PART // 2 + at]))
        text = text[_PART // 2 + at :]
    return n + len(encoding.encode_ordinary(text))


def _projection() -> np.ndarray:
    return np.random.default_rng(17).choice([-1.0, 1.0], (SLOTS, DIMS))


def cells(texts: list[str], signs: np.ndarray) -> np.ndarray:
    """(number of texts, DIMS) coordinates, 0 to 2 ** LEVELS - 1. Kana and ideographs count by pairs, other text by words."""
    out = np.zeros((len(texts), DIMS))
    for i, t in enumerate(texts):
        words = _WORD.findall(t.lower())
        slots = [zlib.crc32(w[k : k + 2].encode() if w[0] > "⿿" else w.encode()) % SLOTS for w in words for k in (range(0, len(w) - 1, 2) if w[0] > "⿿" else (0,))]
        if slots:
            v = signs[slots].sum(axis=0)
            out[i] = v / math.sqrt(len(slots))
    # near normal, so its distribution function spreads the cells evenly
    share = 1 / (1 + np.exp(-1.702 * out / 2))
    return np.minimum(share * 2**LEVELS, 2**LEVELS - 1).astype(np.int64)


def hilbert_key(x: np.ndarray, levels: int = LEVELS) -> np.ndarray:
    """Place on the Hilbert curve of each row of coordinates, by the transposed-bits construction over all rows at once."""
    x = x.T.astype(np.int64).copy()
    n = len(x)
    q = 1 << (levels - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            t = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ t)
            if i:
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (levels - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(levels - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def measured(df: DataFrame, key: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, tokens, place) of every text that isn't null."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, signs = load(vocabulary), _projection()
        for b in batches:
            texts = b.column(1).to_pylist()
            n = [count_tokens(encoding, t) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(hilbert_key(cells(texts, signs)), pa.int64())], ["key", "tokens", "place"])

    return spread(df.select(key, text).filter(F.col(text).isNotNull())).mapInArrow(run, f"key {kind}, tokens bigint, place bigint")


class Packer:
    """Open containers by room left."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.count, self.open = capacity, 0, []

    def place(self, sizes: list[int]) -> list[int]:
        """The container of each size; all sizes are at most the capacity."""
        out = [0] * len(sizes)
        for i in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
            n = sizes[i]
            at = bisect_left(self.open, (n, -1))
            if n and at < len(self.open):
                room, box = self.open.pop(at)
            elif not n and self.count:
                out[i] = self.count - 1
                continue
            else:
                room, box = self.capacity, self.count
                self.count += 1
            out[i] = box
            if room > n:
                insort(self.open, (room - n, box))
        return out


def windows(sizes: list[int], capacity: int) -> Iterator[tuple[int, int]]:
    """Bounds of the runs of pieces that are placed together, of at least WINDOW_CONTAINERS containers' tokens each but the last."""
    lo, n = 0, 0
    for i, size in enumerate(sizes):
        n += size
        if n >= WINDOW_CONTAINERS * capacity or i == len(sizes) - 1:
            yield lo, i + 1
            lo, n = i + 1, 0


def ranges_of(weights: list[tuple[int, int]], most: int) -> list[tuple[int, int, int]]:
    """(bin, first range, number of ranges) of each bin with its weight, bins in order: a range takes bins until it holds most; a bin of more
    gets ranges of its own."""
    out, at, held = [], 0, 0
    for b, w in weights:
        if held and held + w > most:
            at, held = at + 1, 0
        n = max(1, -(-w // most))
        out.append((b, at, n))
        at, held = (at + n, 0) if n > 1 else (at, held + w)
    return out


def packed(sized: DataFrame, capacity: int) -> DataFrame:
    """(key, piece, tokens, container): where each piece of each text goes; sized: the result of measured(), best written out before."""
    spark = sized.sparkSession
    pieces = sized.withColumn("n", F.greatest(F.ceil(F.col("tokens") / F.lit(capacity)), F.lit(1))).withColumn("piece", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))))
    pieces = pieces.select("key", F.col("piece").cast("int").alias("piece"), F.least(F.lit(capacity).cast("bigint"), F.col("tokens") - (F.col("piece") - 1) * capacity).alias("tokens"), "place", F.shiftright("place", DIMS * LEVELS - BIN_BITS).alias("bin"))
    # texts of few tokens count for a little more, as a task holds their rows, too
    least = max(1, capacity // 128)
    weights = sorted((r["bin"], r["w"]) for r in pieces.groupBy("bin").agg(F.sum(F.col("tokens") + least).alias("w")).collect())  # at most 2 ** BIN_BITS
    bins = spark.createDataFrame(ranges_of(weights, RANGE_CONTAINERS * capacity), "bin bigint, first bigint, ranges bigint")
    kind = sized.schema["key"].dataType.simpleString()
    rows = pieces.join(F.broadcast(bins), "bin").withColumn("range", F.col("first") + F.pmod(F.xxhash64("key", "piece"), F.col("ranges")))

    def run(key: tuple, t: pa.Table) -> pa.Table:
        t = t.take(pc.sort_indices(t, sort_keys=[(c, "ascending") for c in ("place", "key", "piece")]))
        sizes, pack = t.column("tokens").to_pylist(), Packer(capacity)
        boxes = [x for lo, hi in windows(sizes, capacity) for x in pack.place(sizes[lo:hi])]
        return t.select(["key", "piece", "tokens"]).append_column("container", pa.array([(key[0].as_py() << 32) + x for x in boxes], pa.int64()))

    return rows.select("key", "piece", "tokens", "place", "range").groupBy("range").applyInArrow(run, f"key {kind}, piece int, tokens bigint, container bigint")


def pack(df: DataFrame, key: str, text: str, capacity: int, vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, piece, tokens, container) of all texts."""
    return packed(cut(measured(df, key, text, vocabulary)), capacity)
