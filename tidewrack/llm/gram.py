"""Items that appear together: a blocked Gram matrix of the binary record-by-item matrix.

Records become lists of item numbers. Each task takes blocks of records as sparse blocks of items (coordinates of the ones), adds up the
products of their transposes (how many records hold both items), and emits what is not zero once at its end, or when it holds _HELD counts, so
that the shuffle holds one partial count per pair and task, not one row per pair and record. Counts are then set against the expected
marginals n_a n_b / N.

Only items that occur in enough records can be in a pair that does. With a least share s of all records there are at most (items per
record) / s such items, whatever the number of records. Up to BROADCAST_ITEMS of them (counted first) their numbering is sent to all tasks;
beyond that it is joined by shuffle. Leaving the others out drops no pair that could be reported.

Null and empty arrays, null and blank items make no record or item; repeated items count once per record; an empty table gives no pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewrack.session import cut

#: Items per block, records per block, and the number of items up to which the numbering is broadcast (some 100 bytes each).
ITEM_BLOCK, RECORD_BLOCK, BROADCAST_ITEMS = 512, 8192, 200_000
#: Pairs a task holds before it emits them, products of one step.
_HELD, _PRODUCTS = 4_000_000, 2_000_000


def baskets(df: DataFrame, items: str) -> DataFrame:
    """One row per record with at least one item left: ``items``, trimmed, lower-cased, distinct."""
    clean = F.array_distinct(F.filter(F.transform(items, lambda x: F.lower(F.regexp_replace(x, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))), lambda x: x.isNotNull() & (x != "")))
    return df.select(clean.alias("items")).filter(F.size("items") > 0)


class _Gram:
    """Adds up co-occurrence counts of records given as sorted item numbers, a pair of sparse item blocks at a time. Holds at most _HELD
    counts and a block's products more; what is over is handed out."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, rows: np.ndarray, cols: np.ndarray) -> Iterator[pa.RecordBatch]:
        """rows, cols: coordinates of the ones of a block of records, a binary matrix, in order of both."""
        # a record with n items gives n (n - 1) / 2 products: as many records at a time as give _PRODUCTS, a long record in parts of its own
        size = np.bincount(rows) if len(rows) else np.zeros(0, np.int64)
        end = np.cumsum(size)[rows] if len(rows) else rows
        after = end - np.arange(len(rows)) - 1
        load = np.cumsum(after)
        cuts = [*np.unique(np.searchsorted(load, np.arange(0, load[-1], _PRODUCTS))), len(rows)] if len(load) and load[-1] else []
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            # the sparse transpose product: each one of the matrix with the ones after it in its row
            n = after[lo:hi]
            i = np.repeat(np.arange(lo, hi), n)
            j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + i + 1
            self._merge([(cols[i], cols[j], np.ones(len(i), np.int64))])
            if self.held > _HELD:
                self._merge()
                if self.held > _HELD:
                    yield self.take()

    def _merge(self, new: list | None = None) -> None:
        """Sums equal pairs, of the new products alone or of all that is held, block of items by block of items."""
        a, b, n = (np.concatenate(x) for x in zip(*(new or self.parts), strict=True))
        order = np.lexsort((b, a, b // ITEM_BLOCK, a // ITEM_BLOCK))
        a, b, n = a[order], b[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.zeros(0, np.int64)
        one = (a[first], b[first], np.add.reduceat(n, first) if len(first) else n)
        self.parts = [*self.parts, one] if new else [one]
        self.held = self.held + len(first) if new else len(first)

    def take(self) -> pa.RecordBatch:
        """All counts, and nothing is held any more."""
        if self.parts:
            self._merge()
        out = self.parts[0] if self.parts else (np.zeros(0, np.int64),) * 3
        self.parts, self.held = [], 0
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["a", "b", "n_ab"])


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    gram = _Gram()
    for b in batches:
        for start in range(0, b.num_rows, RECORD_BLOCK):
            lists = b.column(0).slice(start, RECORD_BLOCK)
            sizes = np.diff(lists.offsets.to_numpy())
            yield from gram.add(np.repeat(np.arange(len(sizes)), sizes), lists.flatten().to_numpy())
    yield gram.take()


def cooccurrence(df: DataFrame, items: str, min_count: int = 1, min_share: float = 0.0) -> DataFrame:
    """(item_a, item_b, n_a, n_b, n_ab, n, lift), item_a < item_b, of the pairs in at least min_count records and at least the share
    min_share of all records with an item; lift is n_ab * n / (n_a * n_b)."""
    rows = baskets(df, items)
    n = rows.count()
    least = max(min_count, math.ceil(n * min_share - 1e-9), 1)
    frequent = rows.select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("n_item")).filter(F.col("n_item") >= least)
    few = frequent.limit(BROADCAST_ITEMS + 1).count() <= BROADCAST_ITEMS
    if few:
        spark = df.sparkSession
        ordered = spark.createDataFrame([(i, k, c) for i, (k, c) in enumerate(sorted((r["item"], r["n_item"]) for r in frequent.collect()))], "at bigint, item string, n_item bigint")
        numbered, send = _by_table(rows, ordered), F.broadcast
    else:
        ordered = _numbered(frequent)
        numbered = rows.withColumn("r", F.monotonically_increasing_id()).select("r", F.explode("items").alias("item")).join(ordered, "item").groupBy("r").agg(F.sort_array(F.collect_list("at")).alias("at"))
        send = lambda x: x
    pairs = numbered.select("at").filter(F.size("at") > 1).mapInArrow(_partial_counts, "a bigint, b bigint, n_ab bigint").groupBy("a", "b").agg(F.sum("n_ab").alias("n_ab")).filter(F.col("n_ab") >= least)
    side = lambda k: send(ordered.select(F.col("at").alias(k), F.col("item").alias(f"item_{k}"), F.col("n_item").alias(f"n_{k}")))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("item_a", "item_b", "n_a", "n_b", "n_ab", F.lit(n).cast("bigint").alias("n"), (F.col("n_ab") * F.lit(float(n)) / (F.col("n_a") * F.col("n_b"))).alias("lift"))


def _by_table(rows: DataFrame, ordered: DataFrame) -> DataFrame:
    """Item numbers from a map that every task holds (at most BROADCAST_ITEMS entries)."""
    table = {r["item"]: r["at"] for r in ordered.collect()}
    held = rows.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = held.value.get
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sorted(k for x in r if (k := get(x)) is not None) for r in b.column(0).to_pylist()], pa.list_(pa.int64()))], ["at"])

    return rows.mapInArrow(run, "at array<bigint>")


def _numbered(items: DataFrame) -> DataFrame:
    """Consecutive numbers in order of the items by a range sort: per-partition ranks plus the sizes of the partitions before."""
    parts = cut(items.repartitionByRange("item").sortWithinPartitions("item").withColumn("p", F.spark_partition_id()).withColumn("k", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)))
    before = parts.groupBy("p").count().withColumn("start", F.sum("count").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)))
    return parts.join(F.broadcast(before.select("p", F.coalesce("start", F.lit(0)).alias("start"))), "p").select("item", "n_item", (F.col("start") + F.col("k")).alias("at"))
