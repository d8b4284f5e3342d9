"""New batches against all history: rows that repeat an item, or nearly repeat a text, already accepted.

The history is a folder with one folder per batch, of four tables: ``classes`` (class of equal texts, text, list keys and signature of its
sketch, pivot distances), ``nodes`` (item or class, its first row, the first row of its set), ``merges`` (sets that the batch joined) and
``refused``. A batch counts once its marker is there, the last file written; a batch that failed is written anew under its name, one that
is complete is answered from what is stored. A batch is sketched once and appended; no stored text is normalised, hashed or sketched again,
and stored texts are never compared with each other: stored sketches make list entries only for keys that the batch has too (told by a
bit table of at most KEY_BITS bits; a full one costs time, loses nothing), and lists compare new with new and new with old.

Pivots: the metric is the size of the symmetric difference of two sets of substrings. The pivots are the empty set and PIVOTS fixed
disjoint sets that share out all substrings by their hash; a text's distances to them are known from its size and its number of values
in each, which is what is stored. By the triangle inequality (summed, as the pivots are disjoint) two texts are at least
sum |c_i - c'_i| apart, and texts of Jaccard similarity s and sizes n, n' are exactly (1 - s) / (1 + s) * (n + n') apart: pairs whose
bound is larger are dropped without their texts being compared. No pair is lost by this. Lists are joined by ranges of the distance to the
empty set (see sketch); as a join by ranges of one such distance alone the bound prunes next to nothing at s = 0.6 (README).

Rows link if they denote the same item of the same platform or if their texts are equal or similar. A row is refused if it links to an
earlier row; it comes out with the first row of all that are linked to it over any number of links. Where a later batch joins two sets,
refused() gives the first row of the joined set for all rows, those of earlier batches too.

Null identifiers denote no item, null and short texts are similar to none; such rows are accepted unless the other part links them.
An empty batch or history gives no rows. Row numbers must be unique, and those of a batch greater than those before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidewrack.llm import sketch
from tidewrack.session import cut, let_go, spread

#: Pivots, the count from which on one tells nothing, most bits of the table of a batch's keys, edges up to which one task finds what is connected.
PIVOTS, OVER, KEY_BITS, EDGES = 128, 255, 2**26, 2_000_000


def item_of(platform: Column, native_id: Column, row_key: Column) -> Column:
    """The item an identifier denotes: platform and the bare identifier, in its own letter case, without address, prefix, parameters and
    space around it. Where native_id is null, that inside row_key (platform:identifier) counts."""
    raw = F.coalesce(native_id, F.regexp_extract(row_key, r"(?s)^[^:]*:(.*)$", 1))
    # most are bare or a plain address already, and the patterns below would give the same for them
    bare_already = F.when(platform == "reddit", F.regexp_replace(raw, r"^[tT]\d_", "")).otherwise(raw)
    s = F.regexp_replace(raw, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
    plain = F.regexp_replace(F.regexp_replace(s, r"[?#].*$", ""), r"/+$", "")
    last = F.regexp_extract(plain, r"([^/]*)$", 1)
    first_of = lambda *c: F.coalesce(*[F.nullif(x, F.lit("")) for x in c])
    number = F.regexp_extract(s, r"(?:^|[=:/])(\d+)(?:\.0*)?/*(?:[&?#].*)?$", 1)
    did = F.regexp_extract(plain, r"(did:[a-z0-9]+:[^/]+)/", 1)
    bare = (
        F.when(platform == "bluesky", F.when(did != "", F.concat_ws("/", did, last)).otherwise(last))
        .when(platform == "youtube", first_of(F.regexp_extract(s, r"[?&]v=([^&#\s]+)", 1), last))
        .when(platform == "reddit", F.regexp_replace(first_of(F.regexp_extract(s, r"/comments/([^/?#]+)", 1), last), r"^[tT]\d_", ""))
        .when(platform.isin("github", "hackernews", "hnjobs"), first_of(number, plain))
        .otherwise(plain)
    )
    address = r"^(?:at://)?(did:[a-z0-9]+:[A-Za-z0-9._-]+)/[A-Za-z0-9._-]+/([A-Za-z0-9_-]+)\z"
    bare = F.when(raw.rlike(r"^[A-Za-z0-9_-]+\z"), bare_already).when((platform == "bluesky") & raw.rlike(address), F.regexp_replace(raw, address, "$1/$2")).otherwise(bare)
    return F.when(platform.isNotNull() & (bare != ""), F.concat(platform, F.lit("|"), bare))


def pivot_counts(values: np.ndarray, start: np.ndarray) -> list[bytes]:
    """Per set the number of its values in each pivot, a byte each."""
    n = len(start) - 1
    doc = np.repeat(np.arange(n), np.diff(start))
    c = np.bincount(doc * PIVOTS + (values % np.uint64(PIVOTS)).astype(np.int64), minlength=n * PIVOTS)
    return [x.tobytes() for x in np.minimum(c, OVER).astype(np.uint8).reshape(-1, PIVOTS)]


def within_bound(x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    """Which pairs of rows of pivot counts can have a similarity of at least least. Counts of OVER and more make the pair pass."""
    x, y = x.astype(np.int64), y.astype(np.int64)
    bound = np.abs(x - y).sum(axis=1)
    return (bound <= (1 - least) / (1 + least) * (x + y).sum(axis=1) + 1e-9) | (x == OVER).any(axis=1) | (y == OVER).any(axis=1)


def near_pairs(pairs: DataFrame, held: DataFrame, least: float) -> DataFrame:
    """(a, b): pairs of classes whose pivots allow it and whose texts are similar; held: (id, text, pivots)."""
    side = lambda k: held.select(F.col("id").alias(k), F.col("pivots").alias(f"pivots_{k}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p, q = (np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint8).reshape(-1, PIVOTS) for k in ("pivots_a", "pivots_b"))
            ok = pa.array(np.flatnonzero(within_bound(p, q, least)), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("a").take(ok), b.column("b").take(ok)], ["a", "b"])

    close = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "pivots_a", "pivots_b").mapInArrow(run, "a bigint, b bigint")
    return sketch.exact(close, held, least).select("a", "b")


def least_nodes(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, roots): each node of the edges u - v with the least that it is connected with."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    root, (u, v) = np.arange(len(nodes)), at.reshape(2, -1)
    while len(u):
        np.minimum.at(root, np.maximum(u, v), np.minimum(u, v))
        while (up := root[root] != root).any():
            root[up] = root[root[up]]
        u, v = root[u], root[v]
        u, v = u[u != v], v[u != v]
    return nodes, nodes[root]


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, root): the least node that each node of the edges (u, v) is connected with, where that is another one. Up to EDGES edges are one
    task's. More take alternating large-star and small-star steps, whose number grows with the logarithm of the longest path, until so few are
    left or nothing changes; each step's edges are written to the shared folder. Raises if rounds don't do."""

    def marked(df: DataFrame) -> tuple[DataFrame, dict]:
        mark = Observation()
        done = cut(df.observe(mark, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.sum(F.xxhash64("u", "v") % 1000003).alias("s")))
        return done, mark.get

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = [(np.zeros(0, np.int64),) * 2, *((b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches)]
        node, root = least_nodes(*(np.concatenate(x) for x in zip(*both, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(x[node != root]) for x in (node, root)], ["node", "root"])

    now, before = marked(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    for _ in range(rounds):
        if before["n"] <= EDGES:
            return cut(now.coalesce(1).mapInArrow(run, "node bigint, root bigint"))
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = both.filter("u > v").join(low, "v").select("u", F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").filter("u <> v").distinct()
        now, after = marked(small)
        if after == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = after
    raise RuntimeError(f"the components weren't found in {rounds} rounds")


def arrivals(df: DataFrame, min_chars: int) -> DataFrame:
    """(row_id, i, id, text): the nodes of the row's item and text, null where there is none, and the normalised text where its task meets it
    first; df: (row_id, item, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            ids, texts = [], []
            for x in b.column(2).to_pylist():
                t = None if x is None else sketch.normalise(x)
                k = None if t is None or len(t) < min_chars else sketch.digest(t, "")
                ids.append(k)
                texts.append(t if k is not None and k not in seen else None)
                seen.add(k)
            if len(seen) > 2_000_000:  # only saves work
                seen.clear()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.int64()), pa.array(texts, pa.string())], ["row_id", "i", "id", "text"])

    return spread(df.select("row_id", F.when(F.col("item").isNotNull(), F.xxhash64(F.lit("item"), F.col("item"))).alias("i"), "text")).mapInArrow(run, "row_id bigint, i bigint, id bigint, text string")


def bit_table(held: DataFrame, bits: int) -> np.ndarray:
    """A table of bits, eight to a byte, with that of every key of the sketches set. It is put together from pieces, each by one task."""
    piece = min(bits, 2**16)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.unique(sketch.keys_of(b.column(0))[1] % np.uint64(bits)).astype(np.int64)
            which, first = np.unique(at // piece, return_index=True)
            parts = np.split((at % piece).astype("<u2"), first[1:]) if len(at) else []
            yield pa.RecordBatch.from_arrays([pa.array(which, pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())], ["piece", "places"])

    def together(t: pa.Table) -> pa.Table:
        own = np.zeros(piece, bool)
        own[np.frombuffer(b"".join(t.column("places").to_pylist()), "<u2")] = True
        return pa.table({"piece": t.column("piece").slice(0, 1), "set": pa.array([np.packbits(own).tobytes()], pa.binary())})

    got = held.select("keys").mapInArrow(places, "piece int, places binary").groupBy("piece").applyInArrow(together, "piece int, set binary").collect()
    table = np.zeros((bits // piece, piece // 8), np.uint8)
    for r in got:
        table[r["piece"]] = np.frombuffer(r["set"], np.uint8)
    return table.reshape(-1)


class History:
    """Accepted rows in a folder, extended batch by batch. Batches come in order of row_id."""

    CLASSES = "id bigint, text string, small tinyint, keys binary, sig binary, pivots binary"

    def __init__(self, spark, path: str, least: float = sketch.LEAST, min_chars: int = 60) -> None:
        self.spark, self.path, self.least, self.min_chars = spark, path.rstrip("/"), least, min_chars
        self._Path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def batches(self) -> list[str]:
        """Names of the complete batches, in order."""
        at = self._Path(f"{self.path}/complete")
        return sorted(x.getPath().getName() for x in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def _stored(self, name: str, schema: str) -> DataFrame:
        paths = [f"{self.path}/batches/{b}/{name}" for b in self.batches()]
        if paths:
            return self.spark.read.schema(schema).parquet(*paths)
        return self.spark.range(0).selectExpr(*[f"CAST(NULL AS {kind}) AS {n}" for n, kind in (x.split(" ") for x in schema.split(", "))])

    def _write(self, batch: str, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.path}/batches/{batch}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _classes(self, fresh: DataFrame, known: DataFrame | None) -> DataFrame:
        """CLASSES of the texts (id, text) of a batch without the known ones (id); a class may come once from each task that meets it."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                texts = b.column("text").to_pylist()
                at = 0
                for part in sketch._groups(texts, sketch._BATCH_CHARS, len):
                    rows, sets = b.slice(at, len(part)), sketch.shingle_sets(part)
                    at += len(part)
                    yield pa.RecordBatch.from_arrays([rows.column("id"), rows.column("text"), *sketch.sketched(*sets, [""] * len(part)), pa.array(pivot_counts(*sets), pa.binary())], ["id", "text", "small", "keys", "sig", "pivots"])

        if known is not None:
            fresh = fresh.join(F.broadcast(known) if known.count() <= sketch._BROADCAST_ROWS else known, "id", "left_anti")
        return fresh.mapInArrow(run, self.CLASSES)

    def _near(self, fresh: DataFrame, old: DataFrame | None) -> DataFrame:
        """(a, b): similar pairs of the new classes, and of new and old ones."""
        n, size = fresh.agg(F.count("*"), F.coalesce(F.avg(F.length("keys")), F.lit(0.0))).first()
        new = fresh.withColumn("old", F.lit(0).cast("byte"))
        lists = sketch.long_lists(new, n)
        parts, both = [lambda *a: sketch.entries(new, a[0], lists, *a[1:])], fresh
        if old is not None:
            # 32 bits a key, where KEY_BITS allow it
            wanted = self.spark.sparkContext.broadcast(bit_table(fresh, min(KEY_BITS, 2 ** (32 * n * int(size) // sketch._KEY_BYTES + 2**16 - 1).bit_length())))
            stored = old.withColumn("old", F.lit(1).cast("byte"))
            parts.append(lambda *a: sketch.entries(stored, a[0], lists, *a[1:], wanted))
            both = both.unionByName(old)
        pairs = cut(sketch.listed_pairs(parts, n, keys=2 * size / sketch._KEY_BYTES))
        ends = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
        few = ends.count() <= sketch._BROADCAST_ROWS
        held = cut(both.select("id", "text", "pivots").join(F.broadcast(ends) if few else ends, "id", "left_semi").dropDuplicates(["id"]))
        return cut(near_pairs(pairs, held, self.least))

    def check(self, batch: DataFrame, name: str | None = None) -> DataFrame:
        """(row_id_a, row_id_b): the refused rows of a batch (row_id, item, text), each with the first row linked to it in the batch and the
        history together; appends the batch under its name (the next number, if that is None)."""
        done = self.batches()
        name = name or f"{len(done):08d}"
        refused = "row_id_a bigint, row_id_b bigint"
        if name in done:
            return self.spark.read.schema(refused).parquet(f"{self.path}/batches/{name}/refused")
        let_go(self.spark)  # what the batch before has left
        came = self._write(name, "arrivals", arrivals(batch, self.min_chars))
        rows = came.select("row_id", "i", "id")
        ids = rows.select("id").filter("id IS NOT NULL").distinct()
        stored = self._stored("classes", self.CLASSES) if done else None
        fresh = self._write(name, "classes", self._classes(came.filter("text IS NOT NULL").select("id", "text"), cut(stored.select("id").join(ids, "id", "left_semi").distinct()) if done else None))
        near = self._near(fresh, stored)

        # nodes of the history that the batch touches, with the first rows of their sets as they are now
        touched = rows.select(F.col("i").alias("node")).union(ids).union(near.select("a")).union(near.select("b")).filter("node IS NOT NULL").distinct()
        old = self._stored("nodes", "node bigint, seen bigint, first bigint").join(touched, "node", "left_semi")
        old = cut(self._now(old, "first"))
        seen = lambda k: old.select(F.col("node").alias(k), F.col("seen").alias("s"))
        first_of = lambda k: rows.filter(F.col(k).isNotNull()).groupBy(k).agg(F.min("row_id").alias("f"), F.count("*").alias("n")).join(seen(k), k, "full_outer").select(k, F.least("s", "f").alias("f"), (F.col("s").isNotNull() | (F.col("n") > 1)).alias("linked"))
        # only what was known, occurs more than once or has a similar text can link
        items = first_of("i").filter("linked").select("i", F.col("f").alias("i_first"))
        classes = cut(first_of("id"))
        both = near.select(F.col("a").alias("id"), F.col("b").alias("other")).unionAll(near.select(F.col("b").alias("id"), F.col("a").alias("other")))
        lowest = both.join(classes.select(F.col("id").alias("other"), F.col("f").alias("o")), "other").groupBy("id").agg(F.min("o").alias("near_first"))
        classes = classes.join(lowest, "id", "left").filter("linked OR near_first IS NOT NULL").select("id", F.col("f").alias("id_first"), "near_first")
        linked = rows.join(items, "i", "left").join(classes, "id", "left").filter("i_first IS NOT NULL OR id_first IS NOT NULL")
        linked = cut(linked.select("row_id", F.when(F.col("i_first").isNotNull(), F.col("i")).alias("i"), F.when(F.col("id_first").isNotNull(), F.col("id")).alias("id"), F.least("i_first", "id_first", "near_first").alias("least")))
        edges = linked.filter("i IS NOT NULL AND id IS NOT NULL").select(F.col("i").alias("u"), F.col("id").alias("v")).unionAll(near.select(F.col("a").alias("u"), F.col("b").alias("v")))
        roots = components(edges.unionAll(old.select(F.col("node").alias("u"), F.xxhash64(F.lit("set"), F.col("first")).alias("v"))))
        at = lambda df: df.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        linked = at(linked.withColumn("node", F.coalesce("i", "id"))).select("row_id", "least", "root")
        sets = at(old).select("root", F.col("first").alias("row_id")).distinct()
        start = cut(linked.select("root", "row_id").unionAll(sets).groupBy("root").agg(F.min("row_id").alias("start")))
        placed = cut(linked.join(start, "root").select("row_id", "least", "start"))
        out = self._write(name, "refused", placed.filter("least < row_id").select(F.col("start").alias("row_id_a"), F.col("row_id").alias("row_id_b")))
        self._write(name, "merges", sets.join(start, "root").filter("row_id <> start").select(F.col("row_id").alias("u"), F.col("start").alias("v")))
        firsts = rows.join(placed.select("row_id", "start"), "row_id", "left").select("row_id", F.coalesce("start", "row_id").alias("first"), F.explode(F.array("i", "id")).alias("node"))
        nodes = firsts.filter("node IS NOT NULL").groupBy("node").agg(F.min("row_id").alias("seen"), F.min("first").alias("first"))
        self._write(name, "nodes", nodes.join(old.select("node"), "node", "left_anti").select("node", "seen", "first"))
        self._fs.create(self._Path(f"{self.path}/complete/{name}"), True).close()
        self._fs.delete(self._Path(f"{self.path}/batches/{name}/arrivals"), True)
        return out

    def _now(self, df: DataFrame, column: str) -> DataFrame:
        """df with first rows of sets replaced by those of the sets that they were joined to since."""
        merges = self._stored("merges", "u bigint, v bigint")
        if merges.isEmpty():
            return df
        now = components(merges).select(F.col("node").alias(column), "root")
        return df.join(now, column, "left").withColumn(column, F.coalesce("root", column)).drop("root").select(*df.columns)

    def refused(self) -> DataFrame:
        """(row_id_a, row_id_b): the refused rows of all batches, each with the first row of its set as it is now."""
        return self._now(self._stored("refused", "row_id_a bigint, row_id_b bigint"), "row_id_a")

    def drop(self) -> None:
        """Deletes the history."""
        self._fs.delete(self._Path(self.path), True)


def repeats(df: DataFrame, path: str, loads: list[tuple[int, int]], order: str = "row_id", least: float = sketch.LEAST, min_chars: int = 60) -> DataFrame:
    """(row_id_a, row_id_b): the refused rows of a whole table (row_id, item, text, order), put into a history load by load; loads: the least
    and greatest value of order of each. path: a folder for the history, deleted at the end."""
    history = History(df.sparkSession, path, least, min_chars)
    try:
        for low, high in loads:
            history.check(df.filter(F.col(order).between(low, high)))
        let_go(df.sparkSession)
        return cut(history.refused())
    finally:
        history.drop()
