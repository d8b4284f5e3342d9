"""Evaluation texts inside training texts, whole or in part.

Texts are compared as letters and digits only, in NFKC and lower case. Each window of WINDOW characters of an item (at every position) and
every window of a document at steps of STRIDE is embedded by the CGK random walk: a pointer goes through the window and a fixed random
bit per step and character says whether it moves on, so windows at a small edit distance give strings at a small Hamming distance, and
equal windows give equal strings. Bit sampling then keys the strings: ROUNDS draws of BITS positions each; equal keys make a candidate.
Any stretch of MIN_COMMON = WINDOW + STRIDE - 1 shared characters holds a whole document window and its equal item window, which meet in
every round, so the recall for exact passages is one; for edited ones the rounds raise it.

Candidates are verified exactly: the shared stretch around the two windows is grown to both sides.

Whole items with up to a number of edits have candidates of their own, as 40 edits spread over 200 letters leave no window of 25 nearly
unchanged: every stretch of SEED letters of a document is looked up among those of the items. SEEDS of them that put the item's start within
that many letters of each other (edits can't move them further apart) make a place; places whose letters hold too few of the item's TRIPLES
are dropped without loss, and the least edit distance of the item to any part of the place, widened by the edits at both ends, counts.

The table of items is sent to all tasks in parts of about ITEM_CHARS characters (one part for usual evaluation sets; documents are scanned
once per part). Documents are read whole, without a shuffle of their texts. Null and blank texts hold nothing; items shorter than a
window can't be found; equal items are reported each.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.session import spread

MIN_COMMON, WINDOW = 50, 25
STRIDE = MIN_COMMON - WINDOW + 1
ROUNDS, BITS = 2, 32
#: Letters of a seed, seeds of a place, letters of the pieces that places are checked by.
SEED, SEEDS, TRIPLES = 8, 2, 3
_TRIPLE_SLOTS = 4096
ITEM_CHARS = 4_000_000
#: Characters scanned at once; for seeds, of which there are more.
_CHARS, _SEED_CHARS = 2_000_000, 200_000


def letters(text: str) -> str:
    """NFKC, lower case, only letters and digits."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return "".join(filter(str.isalnum, text.lower()))


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _coin(step: int, c: np.ndarray) -> np.ndarray:
    """The fixed random bit of a step and a character."""
    x = (c.astype(np.uint32) + np.uint32(1)) * np.uint32(2654435761) + np.uint32((step * 0x9E3779B1 + 0x7F4A7C15) & 0xFFFFFFFF)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x2C1B3C6D)
    return (x >> np.uint32(17)) & np.uint32(1)


def cgk_keys(windows: np.ndarray, rounds: int = ROUNDS, bits: int = BITS) -> np.ndarray:
    """(number of windows, rounds) keys: samples of the CGK embedding of each row of windows, hashed to 64 bits."""
    n, w = windows.shape
    steps = 3 * w
    rng = np.random.default_rng(20_240_101)
    wanted = [set(rng.choice(steps, bits, replace=False).tolist()) for _ in range(rounds)]
    at, rows = np.zeros(n, np.int64), np.arange(n) * w
    flat = np.ascontiguousarray(windows).reshape(-1)
    keys = np.full((rounds, n), 1469598103934665603, np.uint64)
    for step in range(steps):
        inside = at < w
        c = np.where(inside, flat[rows + np.minimum(at, w - 1)], np.uint32(0))
        for r in range(rounds):
            if step in wanted[r]:
                keys[r] = (keys[r] ^ c.astype(np.uint64)) * np.uint64(1099511628211)
                keys[r] ^= keys[r] >> np.uint64(29)
        at += _coin(step, c) & inside
    return keys.T


def windows_of(c: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, windows) of a text's code points."""
    if len(c) < WINDOW:
        return np.zeros(0, np.int64), np.zeros((0, WINDOW), np.uint32)
    starts = np.arange(0, len(c) - WINDOW + 1, step)
    return starts, np.lib.stride_tricks.sliding_window_view(c, WINDOW)[starts]


def edit_distance(a: str, b: str, most: int) -> int:
    """Edit distance, or most + 1 if it is larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        if min(row) > most:
            return most + 1
    return min(row[-1], most + 1)


def place_distance(item: str, text: str, most: int) -> int:
    """Least edit distance of the item to any part of the text, or most + 1 if it is larger; columns of the table as bits."""
    full, top = (1 << len(item)) - 1, 1 << (len(item) - 1)
    at: dict[str, int] = {}
    for i, c in enumerate(item):
        at[c] = at.get(c, 0) | 1 << i
    up, down, now, best = full, 0, len(item), len(item)
    for c in text:
        eq = at.get(c, 0)
        x = eq | down
        h = (((eq & up) + up) ^ up) | eq
        ph, mh = down | (full & ~(h | up)), up & h
        if ph & top:
            now += 1
        elif mh & top:
            now -= 1
            best = min(best, now)
        ph, mh = (ph << 1) & full, (mh << 1) & full
        up, down = mh | (full & ~(x | ph)), ph & x
    return min(best, most + 1)


def seeds_of(c: np.ndarray) -> np.ndarray:
    """The hash of each stretch of SEED code points."""
    n = max(len(c) - SEED + 1, 0)
    h = np.full(n, 1469598103934665603, np.uint64)
    for k in range(SEED):
        h = (h ^ c[k : n + k].astype(np.uint64)) * np.uint64(1099511628211)
    return h ^ (h >> np.uint64(29))


def triples_of(c: np.ndarray) -> np.ndarray:
    """The slot of each stretch of TRIPLES code points."""
    n = max(len(c) - TRIPLES + 1, 0)
    h = np.zeros(n, np.uint32)
    for k in range(TRIPLES):
        h = (h ^ c[k : n + k]) * np.uint32(2654435761)
        h ^= h >> np.uint32(15)
    return (h % np.uint32(_TRIPLE_SLOTS)).astype(np.int64)


class Items:
    """The windows of all items by key, for looking up document windows."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.ids, self.texts, owner, start, wins = [], [], [], [], []
        for k, t in items:
            s = letters(t or "")
            a, w = windows_of(codes(s), 1)
            if len(a):
                owner.append(np.full(len(a), len(self.ids)))
                start.append(a)
                wins.append(w)
                self.ids.append(k)
                self.texts.append(s)
        self.owner, self.start = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (owner, start))
        keys = cgk_keys(np.concatenate(wins)) if wins else np.zeros((0, ROUNDS), np.uint64)
        self.order = [np.argsort(keys[:, r], kind="stable") for r in range(ROUNDS)]
        self.keys = [keys[o, r] for r, o in enumerate(self.order)]

        # by seed, only used for edited items
        each = [seeds_of(codes(t)) for t in self.texts]
        seed = np.concatenate(each) if each else np.zeros(0, np.uint64)
        order = np.argsort(seed, kind="stable")
        self.seed, first = np.unique(seed[order], return_index=True)
        self.seed_at = np.append(first, len(seed))
        self.seed_owner = np.repeat(np.arange(len(each)), [len(x) for x in each])[order]
        self.seed_start = np.concatenate([np.arange(len(x)) for x in each])[order] if each else np.zeros(0, np.int64)
        self.maybe = np.zeros(2**20, bool)
        self.maybe[(self.seed & np.uint64(2**20 - 1)).astype(np.int64)] = True
        self.triples = [np.unique(triples_of(codes(t)), return_counts=True) for t in self.texts]

    def places(self, plain: list[str], edits: int) -> Iterator[tuple[int, int, int, int]]:
        """(text number, item, least and largest start of the item): places with SEEDS seeds of an item."""
        size = np.array([len(t) for t in plain], np.int64)
        begin = np.cumsum(size) - size
        h = seeds_of(codes("".join(plain)))
        at = np.flatnonzero(self.maybe[(h & np.uint64(2**20 - 1)).astype(np.int64)]) if len(self.seed) else np.zeros(0, np.int64)
        k = np.minimum(np.searchsorted(self.seed, h[at]), max(len(self.seed) - 1, 0))
        same = self.seed[k] == h[at]
        at, k = at[same], k[same]
        doc = np.searchsorted(begin, at, side="right") - 1
        inside = at - begin[doc] + SEED <= size[doc]  # not over the end of a text
        at, k, doc = at[inside], k[inside], doc[inside]
        n = self.seed_at[k + 1] - self.seed_at[k]
        of = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.seed_at[k], n)
        doc, pos = np.repeat(doc, n), np.repeat(at - begin[doc], n)
        pair, start = doc * len(self.ids) + self.seed_owner[of], pos - self.seed_start[of]
        order = np.lexsort((start, pair))
        pair, start = pair[order], start[order]
        if not len(pair):
            return
        new = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (start[1:] - start[:-1] > edits)]))
        end = np.append(new[1:], len(pair))
        ok = end - new >= SEEDS
        p, lo, hi = pair[new[ok]], start[new[ok]], start[end[ok] - 1]
        yield from zip((p // len(self.ids)).tolist(), (p % len(self.ids)).tolist(), lo.tolist(), hi.tolist(), strict=True)

    def distance(self, item: int, text: str, triples: np.ndarray, edits: int) -> int:
        """place_distance(), without computing it where the triples of the text rule it out: an edit changes TRIPLES of them at most.
        Triples of equal hash only let more pass."""
        b, (have, n) = self.texts[item], self.triples[item]
        if np.minimum(np.bincount(triples, minlength=_TRIPLE_SLOTS)[have], n).sum() < len(b) - TRIPLES + 1 - TRIPLES * edits:
            return edits + 1
        return place_distance(b, text, edits)

    def hits(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document window, item window) pairs with an equal key in some round, without repeats."""
        out = []
        for r in range(ROUNDS):
            lo, hi = (np.searchsorted(self.keys[r], keys[:, r], side=s) for s in ("left", "right"))
            n = hi - lo
            doc = np.repeat(np.arange(len(keys)), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
            out.append(np.stack([doc, self.order[r][at]], axis=1))
        p = np.unique(np.concatenate(out), axis=0)
        return p[:, 0], p[:, 1]


def stretch(a: str, i: int, b: str, j: int) -> int:
    """Length of the common stretch of a and b around the equal windows at i and j."""
    lo = 0
    while i - lo > 0 and j - lo > 0 and a[i - lo - 1] == b[j - lo - 1]:
        lo += 1
    hi = WINDOW
    while i + hi < len(a) and j + hi < len(b) and a[i + hi] == b[j + hi]:
        hi += 1
    return lo + hi


def _seed_parts(plain: list[str], at: int, end: int) -> Iterator[range]:
    """Runs of the texts from at to end of about _SEED_CHARS characters."""
    n = 0
    for k in range(at, end):
        n += len(plain[k])
        if n >= _SEED_CHARS or k == end - 1:
            yield range(at, k + 1)
            at, n = k + 1, 0


def _scan(texts: list[str | None], items: Items, edits: int | None) -> Iterator[tuple[int, int, int, int]]:
    """(text number, item id, longest shared stretch, edit distance of the best candidate or -1)."""
    plain = [letters(t or "") for t in texts]
    at = 0
    while at < len(plain):
        end, n = at, 0
        while end < len(plain) and (end == at or n + len(plain[end]) <= _CHARS):
            n += len(plain[end])
            end += 1
        parts = [windows_of(codes(t), STRIDE) for t in plain[at:end]]
        size = [len(p[0]) for p in parts]
        best: dict[tuple[int, int], list[int]] = {}
        if sum(size):
            start, owner = np.concatenate([p[0] for p in parts]), np.repeat(np.arange(at, end), size)
            d, w = items.hits(cgk_keys(np.concatenate([p[1] for p in parts])))
            done: dict[tuple[int, int, int], int] = defaultdict(lambda: -1)
            for doc, i, it, j in zip(owner[d].tolist(), start[d].tolist(), items.owner[w].tolist(), items.start[w].tolist(), strict=True):
                a, b = plain[doc], items.texts[it]
                x = best.setdefault((doc, it), [0, -1])
                if a[i : i + WINDOW] == b[j : j + WINDOW]:
                    if done[doc, it, i - j] > i:  # within a stretch already measured
                        continue
                    n = stretch(a, i, b, j)
                    done[doc, it, i - j] = i + n
                    x[0], x[1] = max(x[0], n), 0 if n == len(b) else x[1]
        for part in () if edits is None else _seed_parts(plain, at, end):
            last, triples = -1, np.zeros(0, np.int64)
            for doc, it, lo, hi in items.places(plain[part.start : part.stop], edits):
                doc += part.start
                if doc != last:  # places come text by text
                    last, triples = doc, triples_of(codes(plain[doc]))
                x = best.get((doc, it), [0, -1])
                if x[1] == 0:
                    continue
                first, stop = max(0, lo - edits), hi + len(items.texts[it]) + edits
                e = items.distance(it, plain[doc][first:stop], triples[first : max(first, stop - TRIPLES + 1)], edits)
                if e <= edits and (x[1] < 0 or e < x[1]):
                    best[doc, it] = [x[0], e]
        for (doc, it), (n, e) in best.items():
            yield doc, items.ids[it], n, e
        at = end


def leaks(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, edits: int | None = None) -> DataFrame:
    """(doc_id, item_id, shared, edits): documents and the items they share a key of a window with; shared: characters of the longest
    shared stretch seen (exact from MIN_COMMON on), edits: edit distance of the whole item to the place in the document, null over the
    parameter edits or if that is None."""
    chars = items.agg(F.sum(F.length(item_text))).first()[0] or 0
    parts = max(1, -(-chars // ITEM_CHARS))
    each = [_part(docs, doc_id, text, items.filter(F.pmod(F.xxhash64(item_id), F.lit(parts)) == p), item_id, item_text, edits) for p in range(parts)]
    return reduce(DataFrame.unionByName, each)


def _part(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, edits: int | None) -> DataFrame:
    rows = [(r["k"], r["t"]) for r in items.select(F.col(item_id).alias("k"), F.col(item_text).alias("t")).collect()]
    sent = docs.sparkSession.sparkContext.broadcast(rows)
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Items(sent.value)
        for b in batches:
            got = list(_scan(b.column(1).to_pylist(), table, edits))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([g[0] for g in got], pa.int64())), pa.array([g[1] for g in got], pa.int64()), pa.array([g[2] for g in got], pa.int32()), pa.array([None if g[3] < 0 else g[3] for g in got], pa.int32())], ["doc_id", "item_id", "shared", "edits"])

    return spread(docs.select(doc_id, text)).mapInArrow(run, f"doc_id {kind}, item_id bigint, shared int, edits int")
