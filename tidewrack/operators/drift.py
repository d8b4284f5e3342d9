"""Files whose fields are added, renamed, removed or retyped: a change report per file and one consistent table.

Each field of each file gets a profile of fixed size: the set of its JSON types, the number of its values and a sketch of what the values
look like (counts of hashed content features). A file is compared with the one before it of the same series. Fields gone and fields new
are matched by a maximum-weight bipartite matching over likeness of content and of name; matched pairs of the same types are renames.

Profiles are summed in the workers before the one shuffle by file, so a file that holds a third of all lines costs no more than others
there. Later steps work on one row per file.

Null, blank and broken lines and lines that hold no object are left out; a file that has only such lines still counts as a file, without
fields. Fields that are null on all lines are not held. An empty table gives an empty report. Lines are read whole, repeated lines count
as often as they occur (which changes no result).
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewrack.sources.jsonlines import parse

BUCKETS = 255
#: Bits of a set of JSON types.
TYPES = {"string": 1, "number": 2, "boolean": 4, "array": 8, "object": 16}
#: A pair counts as renamed from this likeness on.
MIN_LIKENESS = 0.6
_FLUSH = 50_000
_WORD, _OTHER, _DIGIT = re.compile(r"\w*"), re.compile(r"[^\w\s]"), re.compile(r"\d")


def type_bit(v: object) -> int:
    if isinstance(v, bool):
        return 4
    return 1 if isinstance(v, str) else 2 if isinstance(v, (int, float)) else 8 if isinstance(v, list) else 16


def content_features(v: object, path: str = "") -> Iterator[str]:
    """What a value looks like: keys of objects, and for texts their length, first word, and the kinds of characters they are made of (the
    shares of letters and digits, and which other characters there are)."""
    if isinstance(v, str):
        yield f"{path}l{len(v) if len(v) < 5 else round(2 * math.log2(len(v)))}"
        yield path + "w" + _WORD.match(v).group().lower()
        other = _OTHER.findall(v)
        digits = len(_DIGIT.findall(v))
        yield f"{path}p{10 * digits // (len(v) or 1)}.{10 * len(other) // (len(v) or 1)}{''.join(sorted(set(other)))}"
    elif isinstance(v, bool):
        yield path + "b"
    elif isinstance(v, (int, float)):
        yield f"{path}n{len(str(abs(int(v)))) if math.isfinite(v) else 'x'}{'.' if isinstance(v, float) else ''}"
    elif isinstance(v, list):
        for x in v:
            yield from content_features(x, path + "[")
    elif isinstance(v, dict):
        for k, x in v.items():
            yield f"{path}k{k}"
            yield from content_features(x, f"{path}{k}.")


def profiles(df: DataFrame, file: str, line: str) -> DataFrame:
    """(file_name, fields): one row per file, fields an array of (field, types, n, sketch) sorted by name; sketch: array of (bucket, count)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, str, int], list[int]] = {}

        def out() -> pa.RecordBatch:
            keys, rest = list(seen), list(seen.values())
            cols = [[k[0] for k in keys], [k[1] for k in keys], [k[2] for k in keys], [x[0] for x in rest], [x[1] for x in rest]]
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int64()), strict=True)], ["file_name", "field", "bucket", "types", "c"])

        for b in batches:
            for f, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if f is None:
                    continue
                seen.setdefault((f, "", -2), [0, 0])
                for name, v in (parse(s) or {}).items():
                    if v is None:
                        continue
                    x = seen.setdefault((f, name, -1), [0, 0])
                    x[0] |= type_bit(v)
                    x[1] += 1
                    for feature in content_features(v):
                        seen.setdefault((f, name, zlib.crc32(feature.encode("utf-8", "surrogatepass")) % BUCKETS), [0, 0])[1] += 1
            if len(seen) > _FLUSH:
                yield out()
        yield out()

    parts = df.select(F.col(file).alias("file_name"), F.col(line).alias("line")).mapInArrow(run, "file_name string, field string, bucket int, types int, c bigint")
    # one shuffle, by file; the groupings below are on more columns and need none
    merged = parts.repartition("file_name").groupBy("file_name", "field", "bucket").agg(F.bit_or("types").alias("types"), F.sum("c").alias("c"))
    fields = merged.groupBy("file_name", "field").agg(F.max("types").alias("types"), F.sum(F.when(F.col("bucket") == -1, F.col("c"))).alias("n"), F.sort_array(F.collect_list(F.when(F.col("bucket") >= 0, F.struct("bucket", "c")))).alias("sketch"))
    return fields.groupBy("file_name").agg(F.sort_array(F.collect_list(F.when(F.col("types") > 0, F.struct("field", "types", "n", "sketch")))).alias("fields"))


def series(file_name: Column) -> tuple[Column, Column]:
    """The series (the folder) and the date of a file."""
    return F.regexp_extract(file_name, r"^(.*)/[^/]*$", 1), F.regexp_extract(file_name, r"(\d{4}-\d{2}-\d{2})[^/]*$", 1)


def name_likeness(a: str, b: str) -> float:
    """Dice coefficient of the letter pairs of two names, without case and separators; 1 if one contains the other."""
    a, b = (re.sub(r"[\W_]", "", x.lower()) for x in (a, b))
    if a and b and (a in b or b in a):
        return 1.0
    p, q = ({x[i : i + 2] for i in range(len(x) - 1)} for x in (a, b))
    return 2 * len(p & q) / (len(p) + len(q)) if p or q else 0.0


def content_likeness(a: list, b: list) -> float:
    """Cosine of the square roots of two sketches' shares."""
    x, y = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for v, s in ((x, a), (y, b)):
        for k, c in s:
            v[k] = math.sqrt(c)
    n = np.linalg.norm(x) * np.linalg.norm(y)
    return float(x @ y / n) if n else 0.0


def likeness(old: dict, new: dict) -> float:
    """0 to 1. Numbers and booleans look alike whatever they mean, so there the names must be alike as well."""
    if old["types"] != new["types"]:
        return 0.0
    content, name = content_likeness(old["sketch"], new["sketch"]), name_likeness(old["field"], new["field"])
    if old["types"] & ~(TYPES["number"] | TYPES["boolean"]) == 0:
        return content * (name if name >= 0.8 else 0.0)
    return 0.9 * content + 0.1 * name


def matching(score: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (row, column) of a maximum-weight matching in a small score matrix; pairs of score 0 are left out. Shortest augmenting paths."""
    n = max(score.shape, default=0)
    if not n:
        return []
    cost = np.zeros((n, n))
    cost[: score.shape[0], : score.shape[1]] = -score
    u, v, col = np.zeros(n + 1), np.zeros(n + 1), np.full(n + 1, n)
    for r in range(n):
        col[n], at, low, done, way = r, n, np.full(n, np.inf), np.zeros(n + 1, bool), np.full(n, n)
        while col[at] != n:
            done[at] = True
            row, free = col[at], ~done[:n]
            reduced = cost[row] - u[row] - v[:n]
            better = free & (reduced < low)
            low[better], way[better] = reduced[better], at
            nxt = int(np.where(free, low, np.inf).argmin())
            step = low[nxt]
            for j in np.flatnonzero(done):
                u[col[j]] += step
                v[j] -= step
            low[free] -= step
            at = nxt
        while at != n:
            col[at] = col[way[at]]
            at = way[at]
    return [(int(col[j]), j) for j in range(score.shape[1]) if col[j] < score.shape[0] and score[col[j], j] > 0]


def compare(old: list[dict], new: list[dict], least: float = MIN_LIKENESS) -> list[tuple[str, str, str, float]]:
    """(field, change, new_field, likeness) from one file's fields to the next one's."""
    a, b = {x["field"]: x for x in old}, {x["field"]: x for x in new}
    gone, come = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    score = np.array([[likeness(a[g], b[c]) for c in come] for g in gone]).reshape(len(gone), len(come))
    score[score < least] = 0
    pairs = {gone[i]: (come[j], float(score[i, j])) for i, j in matching(score)}
    out = [(g, "renamed", c, s) for g, (c, s) in pairs.items()]
    out += [(g, "removed", "", 0.0) for g in gone if g not in pairs]
    taken = {c for c, _ in pairs.values()}
    out += [(c, "added", "", 0.0) for c in come if c not in taken]
    return out + [(f, "retyped", "", 0.0) for f in a if f in b and a[f]["types"] != b[f]["types"]]


def changes(files: DataFrame, least: float = MIN_LIKENESS) -> DataFrame:
    """(file_name, field, change, new_field, likeness) of all files but the first of each series, from the result of profiles()."""
    folder, date = series(F.col("file_name"))
    w = Window.partitionBy("folder").orderBy("date", "file_name")
    pairs = files.withColumns({"folder": folder, "date": date}).withColumn("before", F.lag("fields").over(w)).filter(F.col("before").isNotNull()).select("file_name", "before", "fields")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for r in b.to_pylist():
                sides = [[{**x, "sketch": [(y["bucket"], y["c"]) for y in x["sketch"]]} for x in r[k]] for k in ("before", "fields")]
                rows += [(r["file_name"], *x) for x in compare(*sides, least)]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.string(), pa.string(), pa.float64()))], ["file_name", "field", "change", "new_field", "likeness"])

    return pairs.mapInArrow(run, "file_name string, field string, change string, new_field string, likeness double")


def name_groups(renames: list[tuple[str, str]], known: list[str]) -> dict[str, str]:
    """For each field name the known one it is renamed to or from, over any number of renames. renames: the distinct pairs of names (a handful:
    they are names of columns, not rows); a group without a known name takes its first in order."""
    up: dict[str, str] = {}

    def top(x: str) -> str:
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in renames:
        p, q = sorted((top(a), top(b)), key=lambda x: (x not in known, x))
        up[q] = p
    return {x: top(x) for x in up}


def unified(df: DataFrame, file: str, line: str, keep: list[str], names: dict[str, str], columns: dict[str, str]) -> DataFrame:
    """One row per valid line: the kept columns, each of columns (name: kind, one of string, long, strings, did, json) under its known name
    whatever name the line has for it, and ``rest`` (JSON of all other fields).

    A kind fits the value: strings takes a text, an array or the texts in an object as an array; did takes the identifier out of an object;
    json is the JSON text of an object, also if it came as text or as an array of one. Values that don't fit are null and stay in rest.
    """
    import json

    fit = {"string": _string, "long": _long, "strings": _strings, "did": _did, "json": _json}
    kinds = {"string": "string", "long": "bigint", "strings": "array<string>", "did": "string", "json": "string"}
    arrow = {"string": pa.string(), "long": pa.int64(), "strings": pa.list_(pa.string()), "did": pa.string(), "json": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, cols, rest = [], {c: [] for c in columns}, []
            for i, s in enumerate(b.column(0).to_pylist()):
                o = parse(s)
                if o is None:
                    continue
                at.append(i)
                row, other = {}, {}
                for k, v in o.items():
                    c = k if k in columns else names.get(k, k)
                    x = fit[columns[c]](v) if c in columns and row.get(c) is None else None
                    if x is not None:
                        row[c] = x
                    elif v is not None:
                        other[k] = v
                for c, values in cols.items():
                    values.append(row.get(c))
                rest.append(json.dumps(other, ensure_ascii=False, sort_keys=True) if other else None)
            kept = b.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns[1:], *(pa.array(v, arrow[columns[c]]) for c, v in cols.items()), pa.array(rest, pa.string())], [*keep, *cols, "rest"])

    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), *(f"`{c}` {kinds[k]}" for c, k in columns.items()), "rest string"])
    return df.select(line, *keep).mapInArrow(run, schema)


def _string(v: object) -> str | None:
    return v if isinstance(v, str) else str(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else None


def _long(v: object) -> int | None:
    if isinstance(v, str) and re.fullmatch(r"\s*-?\d{1,18}\s*", v):
        return int(v)
    return v if isinstance(v, int) and not isinstance(v, bool) and abs(v) < 2**63 else None


def _strings(v: object) -> list[str] | None:
    v = [v] if isinstance(v, str) else list(v.values()) if isinstance(v, dict) else v
    return v if isinstance(v, list) and all(isinstance(x, str) for x in v) else None


def _did(v: object) -> str | None:
    v = v.get("did") if isinstance(v, dict) else v
    return v if isinstance(v, str) else None


def _json(v: object) -> str | None:
    import json

    v = v[0] if isinstance(v, list) and len(v) == 1 else v
    if isinstance(v, str):
        v = parse(v)
    return json.dumps(v, ensure_ascii=False, sort_keys=True) if isinstance(v, dict) else None
