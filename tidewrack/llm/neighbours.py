"""The most similar vectors of every vector: lists around centroids, and inside a list an adaptive scan over column blocks.

Vectors are scaled to length one and rotated by a fixed random rotation. Centroids (one per square root of the number of vectors) are fitted
on a bounded sample of FIT vectors per model; every vector is put into the list of its nearest centroid and is looked up in the lists of
its PROBES nearest ones (of more than PROBED_OF lists the same share of them), without those whose cosine is more than MARGIN below the best. Inside a list the squared distance of all pairs is added up one block of columns at a time. After each block a
hypothesis test abandons pairs: by the rotation the part seen so far, scaled up, estimates the whole, and a pair whose estimate exceeds
the wanted distance by the factor (1 + EPS / sqrt(columns seen)) squared is dropped. What is left has its cosine computed in full.

What a query has found raises its floor: once it has k, the k-th best takes the place of the least cosine asked for.

Lists that the sample shows to be longer than BLOCK vectors are split into p parts, and into p * p cells in which a part of the vectors meets a
part of the questions, so a list may hold a third of all vectors without a long task. Of vectors that are equal bit by bit the k + 1 with the
least names stand for all as answers and one asks for all.

A vector is usable if it has the length usual for its model (the most frequent, the larger of equally frequent ones), only finite values
and isn't all zero. Others, null vectors and null models have no neighbours. Ties in similarity go to the lesser name in byte order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewrack.session import cut

FIT, PROBES, MARGIN, COLUMNS, EPS, BLOCK = 20_000, 12, 0.1, 16, 2.1, 4096
#: Up to so many lists of a model, PROBES are looked up; of more the same share.
PROBED_OF = 100
_PAIRS, _STRETCH = 4_000_000, 2048


def usable(df: DataFrame, name: str, vector: str, model: str) -> DataFrame:
    """(name, model, vector) of the usable vectors."""
    rows = df.select(F.col(name).alias("name"), F.col(model).alias("model"), F.col(vector).cast("array<float>").alias("vector")).filter("name IS NOT NULL AND model IS NOT NULL AND size(vector) > 0")
    usual = rows.groupBy("model", F.size("vector").alias("n")).count().groupBy("model").agg(F.max_by("n", F.struct("count", "n")).alias("n"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    return rows.join(F.broadcast(usual), "model").filter((F.size("vector") == F.col("n")) & fine).drop("n")


def rotation(d: int) -> np.ndarray:
    """The fixed rotation of d columns."""
    q, r = np.linalg.qr(np.random.default_rng(d).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # tiny and huge values square without loss
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_centroids(x: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    """n directions by k-means over unit vectors."""
    rng = np.random.default_rng(n)
    c = x[rng.choice(len(x), min(n, len(x)), replace=False)].copy()
    for _ in range(rounds):
        at = np.concatenate([(x[i : i + 4096] @ c.T).argmax(axis=1) for i in range(0, len(x), 4096)])
        sums = np.zeros_like(c)
        np.add.at(sums, at, x)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), c)
    return c


def hash_of(name: str) -> int:
    return xxhash.xxh3_64_intdigest(name.encode("utf-8", "surrogatepass")) >> 1


def probed(lists: int, probes: int = PROBES) -> int:
    """How many of a model's lists a vector is looked up in."""
    return min(lists, max(probes, math.ceil(probes * lists / PROBED_OF)))


def scan(query: np.ndarray, base: np.ndarray, least: float, k: int, eps: float = EPS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, base, cosine): the pairs that pass, at most the best k per query and ties of the last. query, base: rotated unit vectors. The
    base is scanned in stretches; what a query has found so far raises its floor: with k found, the k-th best one's cosine."""
    floor = np.full(len(query), float(least))
    held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    for at in range(0, len(base), _STRETCH):
        new = _scan(query, base[at : at + _STRETCH], floor, eps)
        i, j, cos = (np.concatenate(x) for x in zip(held, (new[0], new[1] + at, new[2]), strict=True))
        order = np.lexsort((-cos, i))
        i, j, cos = i[order], j[order], cos[order]
        first = np.searchsorted(i, i)
        rank = np.arange(len(i)) - first
        last = np.minimum(first + k - 1, np.searchsorted(i, i, side="right") - 1)
        ok = (rank < k) | (cos == cos[last])
        full = rank == k - 1
        floor[i[full]] = np.maximum(floor[i[full]], cos[full])
        held = i[ok], j[ok], cos[ok]
    return held


def _scan(query: np.ndarray, base: np.ndarray, floor: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, base, cosine): the pairs that reach their query's floor."""
    d, top = query.shape[1], 2 - 2 * floor + 1e-6
    found = []
    step = max(1, _PAIRS // max(len(base), 1))
    for at in range(0, len(query), step):
        q, most = query[at : at + step], top[at : at + step]
        seen = min(COLUMNS, d)
        part = (q[:, :seen] ** 2).sum(axis=1)[:, None] + (base[:, :seen] ** 2).sum(axis=1) - 2 * (q[:, :seen] @ base[:, :seen].T)
        i, j = np.nonzero(part * d <= (seen * (1 + eps / math.sqrt(seen)) ** 2 * most)[:, None])
        part = part[i, j]
        while seen < d and len(i):
            nxt = min(seen + COLUMNS, d)
            for s in range(0, len(i), _PAIRS // COLUMNS):
                e = slice(s, s + _PAIRS // COLUMNS)
                part[e] += ((q[i[e], seen:nxt] - base[j[e], seen:nxt]) ** 2).sum(axis=1)
            seen = nxt
            ok = part * d <= seen * (1 + eps / math.sqrt(seen)) ** 2 * most[i]
            i, j, part = i[ok], j[ok], part[ok]
        cos = np.concatenate([np.einsum("ij,ij->i", q[i[s : s + _PAIRS // 64]].astype(np.float64), base[j[s : s + _PAIRS // 64]].astype(np.float64)) for s in range(0, len(i), _PAIRS // 64)]) if len(i) else np.zeros(0)
        ok = cos >= floor[at : at + step][i] - 1e-7
        found.append((i[ok] + at, j[ok], cos[ok]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def nearest(df: DataFrame, name: str, vector: str, model: str, k: int = 10, least: float = 0.85, probes: int | None = PROBES, margin: float = MARGIN, eps: float = EPS) -> DataFrame:
    """(name, other, cosine): of each usable vector its k most similar others of the same model, from a cosine of least on. probes None: all
    lists are looked up and no pair is abandoned, so the answer is exact."""
    if probes is None:
        margin, eps = 2.0, 1e9
    rows = usable(df, name, vector, model).withColumn("same", F.xxhash64("model", "vector"))
    # k + 1 stand-ins for equal vectors; Spark limits each group before the shuffle
    held = cut(rows.withColumn("rn", F.row_number().over(Window.partitionBy("model", "same").orderBy("name"))).filter(F.col("rn") <= k + 1))
    sizes = {r["model"]: (r["n"], r["d"]) for r in held.groupBy("model").agg(F.count("*").alias("n"), F.first(F.size("vector")).alias("d")).collect()}
    index: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for m, (n, d) in sizes.items():
        fit = held.filter((F.col("model") == m) & (F.col("rn") == 1)).select("vector", F.xxhash64("name").alias("h")).orderBy("h").limit(FIT).toArrow()
        turn = rotation(d)
        x = (unit(fit.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, d)) @ turn).astype(np.float32)
        centroids = fit_centroids(x, max(1, round(math.sqrt(n))))
        share = np.bincount(np.concatenate([(x[i : i + 4096] @ centroids.T).argmax(axis=1) for i in range(0, len(x), 4096)]), minlength=len(centroids)) / len(x)
        # lists are split by the length that the sample foretells: no pass to count them, and an error only makes parts larger or smaller
        index[m] = (turn.astype(np.float32), centroids, np.maximum(1, np.ceil(share * n / BLOCK)).astype(np.int64))
    models = sorted(index)
    offset = np.cumsum([0, *(len(index[m][1]) for m in models)])
    sent = df.sparkSession.sparkContext.broadcast({m: (*index[m], int(offset[i])) for i, m in enumerate(models)})

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row (list, cell, name, vector) for each vector in its own list, and (list, cell, asks, vector) for the lists it asks; one row is both in
        the own list if that is whole. A list of p parts has p * p cells: its vectors are in those of their part's row, the questions in those
        of their part's column."""
        for b in batches:
            names, ms, same, rn = (np.array(b.column(c).to_pylist(), dtype=object) for c in ("name", "model", "same", "rn"))
            out = []
            for m in set(ms):
                at = np.flatnonzero(ms == m)
                turn, centroids, parts, start = sent.value[m]
                x = (unit(b.column("vector").take(pa.array(at)).flatten().to_numpy().reshape(len(at), -1)) @ turn.astype(np.float64)).astype(np.float32)
                near = x @ centroids.T
                p = near.shape[1] if probes is None else probed(near.shape[1], probes)
                best = np.argpartition(-near, p - 1, axis=1)[:, :p]
                own = near.argmax(axis=1)
                first = (rn[at] == 1).astype(bool)
                asked = (near[np.arange(len(at))[:, None], best] >= near[np.arange(len(at)), own][:, None] - margin) & (best != own[:, None]) & first[:, None]
                r, c = np.nonzero(asked)
                both = first & (parts[own] == 1)
                row, lists = np.concatenate([np.flatnonzero(first & ~both), r]), np.concatenate([own[first & ~both], best[r, c]])
                draw = np.array([hash_of(names[i]) for i in at], np.int64) if (parts > 1).any() else np.zeros(len(at), np.int64)
                for row, lists, asks in ((np.arange(len(at)), own, False), (row, lists, True)):
                    n = parts[lists]
                    each = np.repeat(np.arange(len(row)), n)
                    other = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    mine = draw[row[each]] % n[each]
                    cell = other * n[each] + mine if asks else mine * n[each] + other
                    out.append((lists[each] + start, cell, at[row[each]], x[row[each]], asks, asks | both[row[each]]))
            for lists, cell, i, x, asks, also in out:
                name = pa.nulls(len(i), pa.string()) if asks else pa.array(names[i].tolist(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(lists, pa.int32()), pa.array(cell, pa.int32()), name, pa.array(same[i].astype(np.int64), mask=~also), pa.array([v.tobytes() for v in x], pa.binary())], ["list", "cell", "name", "asks", "v"])

    rows_in = held.select("name", "model", "same", "rn", "vector").mapInArrow(place, "list int, cell int, name string, asks bigint, v binary")

    def look(t: pa.Table) -> pa.Table:
        names, asks = t.column("name").combine_chunks(), t.column("asks").combine_chunks()
        v = t.column("v").combine_chunks()
        x = np.frombuffer(b"".join(v.to_pylist()), np.float32).reshape(len(v), -1) if len(v) else np.zeros((0, 1), np.float32)
        q, b = np.flatnonzero(asks.is_valid().to_numpy(zero_copy_only=False)), np.flatnonzero(names.is_valid().to_numpy(zero_copy_only=False))
        i, j, cos = scan(x[q], x[b], least, k + 1, eps)
        return pa.table({"asks": asks.take(pa.array(q[i])), "name": names.take(pa.array(b[j])), "cosine": pa.array(cos)})

    got = rows_in.groupBy("list", "cell").applyInArrow(look, "asks bigint, name string, cosine double")
    best = got.withColumn("rn", F.row_number().over(Window.partitionBy("asks").orderBy(F.desc("cosine"), "name"))).filter(F.col("rn") <= k + 1)
    answers = best.groupBy("asks").agg(F.sort_array(F.collect_list(F.struct("rn", "name", "cosine"))).alias("a"))
    each = rows.select("name", F.col("same").alias("asks")).join(answers, "asks").select(F.col("name"), F.explode(F.slice(F.filter("a", lambda x: x["name"] != F.col("name")), 1, k)).alias("x"))
    return each.select("name", F.col("x.name").alias("other"), F.col("x.cosine").alias("cosine"))


def pairs(found: DataFrame) -> DataFrame:
    """(a, b, cosine), a < b: pairs of which at least one is among the most similar of the other."""
    return found.groupBy(F.least("name", "other").alias("a"), F.greatest("name", "other").alias("b")).agg(F.max("cosine").alias("cosine"))
