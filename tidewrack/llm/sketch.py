"""Near copies of texts: bottom-k sketches under one hash function, inverted lists, a sketch filter and exact verification.

1. A text's 4-character substrings are hashed by one function; its sketch is the k smallest hashes in order.
2. Inverted lists: the values of RUN neighbours in a sketch make one list key. Two texts of similarity J share each run of the joint order
   with probability J ** RUN. About KEYS runs are kept per text, chosen by the key's own hash, so both texts of a pair choose alike. Single
   values would make lists that grow with every common phrase; runs keep lists short. Sets of up to SMALL values list every value as well.
3. Filter: a signature of SLOTS x ORDERS bits goes with each entry of a list. Each range of the hash gives, in ORDERS orders, one bit of its
   least value (a sketch of the union's minima), so bits agree with probability (1 + J) / 2. A list is ordered by the size of the sets, and
   only sizes within reach of the similarity are compared. What passes leaves the list.
4. The exact Jaccard similarity of the sets decides.

Steps 2 and 3 find a pair of similarity LEAST or more with a probability near one (README); ``exhaustive`` asks for all of them for certain:
lists of the single values that any similar pair must share one of (the first of each set in order of the hash, as many as the similarity
leaves room for), and no filter but the sizes.

Equal texts are one class throughout (a 64-bit digest), so copies cost nothing after the first step; each task drops repeats before the
shuffle. Sketches are written once; their entries are packed by bucket of key into few rows and compared in WAVES parts of the keys one after
the other, so that only a part of the entries is on disk at a time; up to AT_ONCE entries are one part. No list is capped: one that a bounded sample of the texts shows to be
longer than LIST entries is split into cells, each a pair of parts of the list, over as many tasks.

Null texts and normalised texts under min_chars are left out; an empty table gives no pairs; texts are read whole, however long; extra
columns are ignored.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.session import cut, spread

SHINGLE, K, RUN, KEYS, SMALL = 4, 128, 4, 48, 40
#: Bits of a signature: ranges of the hash and orders in each.
SLOTS, ORDERS = 16, 16
BITS = SLOTS * ORDERS
#: The least similarity that lists and filter are made for; the filter passes what is within so many standard deviations of it.
LEAST, DEVIATIONS = 0.6, 3.5
#: Steps of the size of a set in an entry to a factor of e.
_SIZE_STEPS = 16
#: Parts in which the keys are compared, entries up to which they are one part (100 MB); entries of a list from which on it is split, if a sample
#: of SAMPLE texts shows it.
WAVES, AT_ONCE, LIST, SAMPLE = 3, 2_000_000, 16_384, 20_000
#: Texts hashed at once, entries of a bucket, pairs compared at once, and rows up to which the set of wanted texts is broadcast.
_BATCH_CHARS, _BUCKET_ENTRIES, _PAIRS, _BROADCAST_ROWS = 2_000_000, 250_000, 2_000_000, 400_000
_EMPTY = np.uint64(2**63)
_KEY_BYTES = 6
_GOLDEN, _M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Odd factors, one for each order of the hash.
_ORDER = np.random.default_rng(5).integers(1, 2**63, ORDERS).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def normalise(text: str) -> str:
    """NFKC, lower case, runs of white space as one space, trimmed."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return " ".join(text.lower().split())


def mix(x: np.ndarray) -> np.ndarray:
    """The final mixing of a 64-bit pseudo-random generator; the one hash function of the sketches."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def digest(text: str, space: str = "") -> int:
    """A signed 64-bit identity of a text in a space of texts that are compared with each other."""
    return xxhash.xxh3_64_intdigest(f"{space}\0{text}".encode("utf-8", "surrogatepass")) - 2**63


def shingle_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """48-bit hashes of the distinct substrings of each text, ascending, one text after the other, and the start of each text's."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    length = np.array([len(t) for t in texts], np.int64)
    n = np.maximum(length - SHINGLE + 1, 0)
    first = np.cumsum(length) - length
    pos = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    h = codes[pos]
    for j in range(1, SHINGLE):
        h = mix(h * _GOLDEN + codes[pos + j])
    # the number of the text goes above the hash, so one sort orders all sets
    key = (np.repeat(np.arange(len(texts)), n).astype(np.uint64) << np.uint64(48)) | (h >> np.uint64(16))
    key.sort()
    key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
    start = np.searchsorted(key >> np.uint64(48), np.arange(len(texts) + 1))
    return key & np.uint64(2**48 - 1), start


def _padded(values: np.ndarray, start: np.ndarray, k: int) -> np.ndarray:
    size = np.diff(start)
    at = np.minimum(start[:-1, None] + np.arange(k), max(len(values) - 1, 0))
    return np.where(np.arange(k) < size[:, None], values[at] if len(values) else _EMPTY, _EMPTY)


def signatures(values: np.ndarray, start: np.ndarray) -> np.ndarray:
    """BITS / 64 words per set: for each order a bit of the least value in each range of the hash, of the next range of the set that has one
    where it is empty. The values of a set come in order of the hash, so those of a range stand together."""
    n = len(start) - 1
    if not len(values):
        return np.zeros((n, BITS // 64), np.uint64)
    slot = np.repeat(np.arange(n), np.diff(start)) * SLOTS + (values >> np.uint64(48 - SLOTS.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
    used, want = slot[first], np.arange(n * SLOTS)
    at = np.searchsorted(used, want)
    # past a set's last range: on to its first one
    over = (at >= len(used)) | (used[np.minimum(at, len(used) - 1)] // SLOTS != want // SLOTS)
    at = np.minimum(np.where(over, np.searchsorted(used, want // SLOTS * SLOTS), at), len(used) - 1)
    out = np.empty((n, ORDERS, SLOTS), np.uint8)
    for k in range(ORDERS):
        bit = (mix(np.minimum.reduceat(values * _ORDER[k], first)) & np.uint64(1)).astype(np.uint8)
        out[:, k] = bit[at].reshape(n, SLOTS)
    return np.packbits(out.reshape(n, BITS), axis=1).view(np.uint64)


def list_keys(values: np.ndarray, start: np.ndarray, exhaustive: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text number, 48-bit key): the inverted lists each text is in, text by text. exhaustive: a similarity of which no pair may be missed."""
    size = np.diff(start)
    if exhaustive is not None:
        # similar sets of sizes n and m share at least exhaustive * max(n, m) values, so one of the first n - that + 1 of either
        n = np.where(size, size - np.ceil(exhaustive * size - 1e-9).astype(np.int64) + 1, 0)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[:-1], n)
        return np.repeat(np.arange(len(size)), n), mix(values[at] + np.uint64(3)) >> np.uint64(16)
    s = _padded(values, start, K)
    runs = s[:, : K - RUN + 1].copy()
    for j in range(1, RUN):
        runs = mix(runs * _GOLDEN + s[:, j : K - RUN + 1 + j])
    count = np.minimum(size, K) - RUN + 1
    # the share of runs kept falls with the size, so a text of a pair keeps all that the larger one keeps
    share = np.clip(KEYS / np.maximum(count, 1), 0, 1)
    keep = (np.arange(K - RUN + 1) < count[:, None]) & ((mix(runs + np.uint64(7)) >> np.uint64(32)).astype(np.float64) < share[:, None] * 2**32)
    doc, at = np.nonzero(keep)
    small = np.flatnonzero(size <= SMALL)
    one = _padded(values, start, SMALL)[small] if len(small) else np.zeros((0, SMALL), np.uint64)
    d, a = np.nonzero(one != _EMPTY)
    doc, key = np.concatenate([doc, small[d]]), np.concatenate([runs[doc, at], mix(one[d, a] + np.uint64(3))]) >> np.uint64(16)
    order = np.argsort(doc, kind="stable")
    return doc[order], key[order]


def smallness(size: np.ndarray) -> np.ndarray:
    """The size of a set as one byte on a logarithmic scale, larger for smaller sets; sizes beyond the scale are alike."""
    return np.clip(255 - np.rint(_SIZE_STEPS * np.log(np.maximum(size, 1))), 0, 255).astype(np.uint8)


def differ_most(size: np.ndarray) -> np.ndarray:
    """Most bits in which a pair may differ whose smaller set has size values: DEVIATIONS over what LEAST gives. Sets that leave ranges of the
    hash empty repeat bits, so theirs vary more; the last factor is fitted to simulated pairs."""
    p = (1 - LEAST) / 2
    return p * BITS + DEVIATIONS * np.sqrt(p * (1 - p) * BITS * (1 + 40 / np.maximum(size, 1)))


_MOST = np.floor(differ_most(np.exp((255 - np.arange(256)) / _SIZE_STEPS))).astype(np.uint16)
#: Sets further apart in size can't have the similarity LEAST; one step more, as both sizes are rounded.
_SIZES_APART = int(-_SIZE_STEPS * np.log(LEAST)) + 1

#: One packed entry: rest of the key, digest, how small the set is, whether it was known before, signature.
ENTRY = np.dtype([("key", "<u4"), ("id", "<i8"), ("small", "u1"), ("old", "u1"), ("sig", "<u8", BITS // 64)])
SKETCH = "id bigint, small tinyint, keys binary, sig binary"


def _groups(items: list, limit: int, weight) -> Iterator[list]:
    out, n = [], 0
    for x in items:
        out.append(x)
        n += weight(x)
        if n >= limit or len(out) >= 60_000:
            yield out
            out, n = [], 0
    if out:
        yield out


def sketched(values: np.ndarray, start: np.ndarray, spaces: list[str], exhaustive: float | None = None) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(small, keys, sig) of sets: size, packed list keys and signature. Keys of different spaces differ."""
    doc, key = list_keys(values, start, exhaustive)
    of = {x: xxhash.xxh3_64_intdigest(x) for x in set(spaces)}
    key = mix(key ^ np.array([of[x] for x in spaces], np.uint64)[doc])
    keys = key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_KEY_BYTES].tobytes()
    at = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(spaces)))]) * _KEY_BYTES
    return pa.array(smallness(np.diff(start)).view(np.int8)), pa.array([keys[i:j] for i, j in zip(at, at[1:], strict=False)], pa.binary()), pa.array([s.tobytes() for s in signatures(values, start)], pa.binary())


def sketches(df: DataFrame, min_chars: int, exhaustive: float | None = None) -> DataFrame:
    """(id, small, keys, sig): the sketch of each class of equal texts, repeats dropped within a task; df: (space, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            fresh = []
            for space, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if text is None or len(t := normalise(text)) < min_chars or (k := digest(t, space)) in seen:
                    continue
                seen.add(k)
                fresh.append((k, space, t))
            if len(seen) > 2_000_000:  # only saves work: repeats over tasks are dropped in the lists
                seen.clear()
            for part in _groups(fresh, _BATCH_CHARS, lambda x: len(x[2])):
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in part], pa.int64()), *sketched(*shingle_sets([x[2] for x in part]), [x[1] for x in part], exhaustive)], ["id", "small", "keys", "sig"])

    return spread(df.select("space", "text")).mapInArrow(run, SKETCH)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, lengths) of a binary column without nulls."""
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int32)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)), np.diff(at)


def keys_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of a column of packed keys."""
    data, size = _bytes_of(column)
    row = np.repeat(np.arange(len(size)), size // _KEY_BYTES)
    full = np.zeros((len(row), 8), np.uint8)
    full[:, :_KEY_BYTES] = data.reshape(-1, _KEY_BYTES)
    return row, full.view("<u8").reshape(-1)


def long_lists(held: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, parts): lists that a sample of SAMPLE classes, by hash, shows to be longer than LIST, and in how many parts to split each. At
    most KEYS * SAMPLE / 3 keys, since one must occur in three texts of the sample at least. held: sketches of n classes."""
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if n <= LIST:
        return none
    share = min(1.0, SAMPLE / n)
    sample = held.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_003)) < int(share * 1_000_003) + 1).dropDuplicates(["id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.stack(keys_of(b.column(0)), axis=1), axis=0)[:, 1].astype(np.int64))], ["key"])

    often = sample.select("keys").mapInArrow(run, "key bigint").groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") >= max(3, math.ceil(LIST * share)))
    got = sorted((r["key"], r["n"]) for r in often.collect())
    return (np.array([k for k, _ in got], np.uint64), np.array([-(-int(c / share) // LIST) + 1 for _, c in got])) if got else none


def cells(key: np.ndarray, ids: np.ndarray, lists: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(entry, key of a list or of a cell of it): each entry once, those of a list in p parts p times, as every two parts meet in one cell."""
    keys, parts = lists
    which = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
    hit = keys[which] == key if len(keys) else np.zeros(len(key), bool)
    n = np.where(hit, parts[which] if len(keys) else 1, 1)
    row = np.repeat(np.arange(len(key)), n)
    other = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    own = (mix(ids.view(np.uint64)) % n.astype(np.uint64)).astype(np.int64)[row]
    cell = (np.minimum(own, other) * n[row] + np.maximum(own, other)).astype(np.uint64)
    return row, np.where(hit[row], mix(key[row] + cell * _GOLDEN), key[row])


def entries(held: DataFrame, buckets: int, lists: tuple[np.ndarray, np.ndarray], wave: int = 0, waves: int = 1, wanted: object = None) -> DataFrame:
    """(bucket, entries): packed entries of the sketches (id, small, keys, sig, old) with the keys of one wave. wanted: a broadcast table of
    bits, eight to a byte; only entries whose key has its bit set are made."""
    sent = held.sparkSession.sparkContext.broadcast(lists)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            ids, small, old = (b.column(k).to_numpy(zero_copy_only=False) for k in ("id", "small", "old"))
            sig = _bytes_of(b.column("sig"))[0].view(np.uint64).reshape(len(ids), -1)
            doc, key = keys_of(b.column("keys"))
            now = key % np.uint64(waves) == wave
            if wanted is not None:
                bit = (key % np.uint64(8 * len(wanted.value))).astype(np.int64)
                now &= (wanted.value[bit >> 3] >> (7 - (bit & 7)) & 1).astype(bool)
            doc, key = doc[now], key[now]
            row, key = cells(key, ids[doc], sent.value)
            doc, key = doc[row], mix(key)
            bucket = ((key >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            now = np.argsort((bucket << 32) | (key & np.uint64(0xFFFFFFFF)).astype(np.int64))
            rows = np.zeros(len(now), ENTRY)
            rows["key"], rows["id"], rows["small"], rows["old"], rows["sig"] = key[now] & np.uint64(0xFFFFFFFF), ids[doc[now]], small.view(np.uint8)[doc[now]], old[doc[now]], sig[doc[now]]
            some, at = np.unique(bucket[now], return_index=True)
            at = np.append(at, len(now))
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([rows[i:j].tobytes() for i, j in zip(at, at[1:], strict=False)], pa.binary())], ["bucket", "entries"])

    return held.select("id", "small", "keys", "sig", "old").mapInArrow(run, "bucket int, entries binary")


def list_pairs(x: np.ndarray, filtered: bool = True) -> np.ndarray:
    """Pairs of ids (smaller first) that share a list of the entries, have sizes that allow the similarity LEAST and whose signatures agree
    (if filtered). Two old entries make no pair and aren't compared."""
    # a list has its old entries first, each part by size; repeats of an entry stand together by some bits of their ids
    order = (x["key"].astype(np.uint64) << np.uint64(32)) | ((1 - x["old"]).astype(np.uint64) << np.uint64(31)) | (x["small"].astype(np.uint64) << np.uint64(23)) | (x["id"].astype(np.uint64) & np.uint64(2**23 - 1))
    at = np.argsort(order)
    order, ids = order[at], x["id"][at]
    once = np.concatenate([[True], (order[1:] != order[:-1]) | (ids[1:] != ids[:-1])]) if len(x) else np.zeros(0, bool)
    at, ids, place = at[once], ids[once], (order[once] >> np.uint64(23)).astype(np.int64)
    small, old, sig = x["small"][at], x["old"][at].astype(bool), [x["sig"][:, k][at] for k in range(BITS // 64)]
    # a new entry meets the new ones after it and the old ones, within reach of its size
    fresh = np.flatnonzero(~old)
    start, size = place[fresh] & ~511, small[fresh].astype(np.int64)
    most = np.minimum(size + _SIZES_APART, 255)
    lo, hi = fresh + 1, np.searchsorted(place, start | 256 | most, side="right")
    if old.any():
        lo = np.concatenate([lo, np.searchsorted(place, start | np.maximum(size - _SIZES_APART, 0))])
        hi = np.concatenate([hi, np.searchsorted(place, start | most, side="right")])
        fresh = np.concatenate([fresh, fresh])
    n = np.maximum(hi - lo, 0)
    load = np.cumsum(n)
    bounds = [*np.unique(np.searchsorted(load, np.arange(0, load[-1], _PAIRS))), len(fresh)] if len(load) and load[-1] else []
    found = []
    for p, q in zip(bounds, bounds[1:], strict=False):
        m = n[p:q]
        i = np.repeat(fresh[p:q], m)
        j = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(lo[p:q], m)
        if filtered:
            most = _MOST[np.maximum(small[i], small[j])]
            d = np.bitwise_count(sig[0][i] ^ sig[0][j]).astype(np.uint16)
            for s in sig[1:]:
                ok = d <= most
                i, j, d, most = i[ok], j[ok], d[ok], most[ok]
                d += np.bitwise_count(s[i] ^ s[j])
            ok = d <= most
            i, j = i[ok], j[ok]
        ok = ids[i] != ids[j]
        i, j = i[ok], j[ok]
        if len(i):
            found.append(np.unique(np.stack([np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])], axis=1), axis=0))
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)


def listed_pairs(parts: list, n: int, filtered: bool = True, keys: float = KEYS + 2) -> DataFrame:
    """(a, b): distinct pairs of the sketches that share a list and pass. parts: functions of (buckets, wave, waves) that give packed entries;
    n: about how many sketches there are."""
    waves = WAVES if n * keys > AT_ONCE else 1
    buckets = max(24 // waves, math.ceil(n * keys / waves / _BUCKET_ENTRIES))

    def join(t: pa.Table) -> pa.Table:
        p = list_pairs(np.frombuffer(b"".join(t.column("entries").to_pylist()), ENTRY), filtered)
        return pa.table({"a": pa.array(p[:, 0]), "b": pa.array(p[:, 1])})

    def one(wave: int) -> DataFrame:
        packed = reduce(DataFrame.unionByName, [f(buckets, wave, waves) for f in parts])
        return cut(packed.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(join, "a bigint, b bigint").distinct())

    return reduce(DataFrame.unionByName, [one(wave) for wave in range(waves)]).distinct() if waves > 1 else one(0)


def candidates(df: DataFrame, min_chars: int, exhaustive: float | None = None) -> DataFrame:
    """(a, b): distinct pairs of digests that share an inverted list and agree in their signatures; df: (space, text)."""
    held = cut(sketches(df, min_chars, exhaustive)).withColumn("old", F.lit(0).cast("byte"))
    n, size = held.agg(F.count("*"), F.coalesce(F.avg(F.length("keys")), F.lit(0.0))).first()
    lists = long_lists(held, n)
    return listed_pairs([lambda *a: entries(held, a[0], lists, *a[1:])], n, exhaustive is None, size / _KEY_BYTES)


def texts(df: DataFrame, min_chars: int) -> DataFrame:
    """(id, text): normalised texts, repeats dropped within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            out = {}
            for space, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if text is not None and len(t := normalise(text)) >= min_chars and (k := digest(t, space)) not in seen:
                    out[k] = t
                    seen.add(k)
            if len(seen) > 2_000_000:
                seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array(out.keys(), pa.int64()), pa.array(out.values(), pa.string())], ["id", "text"])

    return spread(df.select("space", "text")).mapInArrow(run, "id bigint, text string")


def members(df: DataFrame, keep: list[str], min_chars: int) -> DataFrame:
    """The kept columns and ``id``, the class of equal texts, of each row whose text counts; df: (space, text, kept columns)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [None if x is None or len(t := normalise(x)) < min_chars else digest(t, s) for s, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[2:], pa.array(ids, pa.int64())], [*keep, "id"])

    return spread(df.select("space", "text", *keep)).mapInArrow(run, ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep) + ", id bigint").filter(F.col("id").isNotNull())


def shingles(text: str) -> set[str]:
    return {text[i : i + SHINGLE] for i in range(len(text) - SHINGLE + 1)}


def jaccard(a: set, b: set) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both) if a or b else 0.0


def wanted_texts(pairs: DataFrame, df: DataFrame, min_chars: int) -> DataFrame:
    """(id, text) of the classes in the pairs (a, b)."""
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    few = wanted.count() <= _BROADCAST_ROWS
    return texts(df, min_chars).join(F.broadcast(wanted) if few else wanted, "id", "left_semi").groupBy("id").agg(F.first("text").alias("text"))


def exact(pairs: DataFrame, held: DataFrame, least: float) -> DataFrame:
    """(a, b, similarity) of the pairs whose texts' exact similarity is at least least; held: (id, text)."""
    side = lambda k: held.select(F.col("id").alias(k), F.col("text").alias(f"text_{k}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = ([], [], [])
            for i, j, x, y in zip(*(c.to_pylist() for c in b.columns), strict=True):
                p, q = shingles(x), shingles(y)
                if min(len(p), len(q)) >= least * max(len(p), len(q)) and (s := jaccard(p, q)) >= least:
                    for o, v in zip(out, (i, j, s), strict=True):
                        o.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, (pa.int64(), pa.int64(), pa.float64()), strict=True)], ["a", "b", "similarity"])

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint, similarity double")


def similar(df: DataFrame, least: float = LEAST, min_chars: int = 60, exhaustive: bool = False) -> DataFrame:
    """(a, b, similarity): all pairs of different texts of a space with a similarity of at least least; df: (space, text). Similarities under
    LEAST are only found with exhaustive."""
    if least < LEAST:
        raise ValueError(f"lists and filter are made for similarities of {LEAST} and more")
    pairs = cut(candidates(df, min_chars, least if exhaustive else None))
    return exact(pairs, wanted_texts(pairs, df, min_chars), least)


def row_pairs(df: DataFrame, pairs: DataFrame, min_chars: int = 60) -> DataFrame:
    """(space, key_a, key_b, similarity): pairs of rows, equal texts included; df: (space, text, key), pairs: the result of similar()."""
    rows = members(df, ["space", "key"], min_chars)
    # only classes of which there is another row or a similar class
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "similarity"))
    left, right = rows.select("space", F.col("key").alias("key_a"), F.col("id").alias("a")), rows.select(F.col("key").alias("key_b"), F.col("id").alias("b"))
    near = left.join(both, "a").join(right, "b").select("space", "key_a", "key_b", "similarity")
    equal = left.join(right.withColumnRenamed("b", "a"), "a").select("space", "key_a", "key_b", F.lit(1.0).alias("similarity"))
    return near.unionByName(equal).filter("key_a < key_b")
