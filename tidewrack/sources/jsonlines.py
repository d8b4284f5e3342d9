"""Strict reading of JSON text lines that come as a column. Spark's own parsers accept text after the first value, so lines are parsed in Arrow batches."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


def _no_constant(name: str):
    raise ValueError(name)


def parse(line: str | None) -> dict | None:
    """The object on a line; None for null, blank or broken lines and for lines that hold another kind of value."""
    if line is None or not line.strip():
        return None
    try:
        value = json.loads(line, parse_constant=_no_constant)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def field_texts(df: DataFrame, line: str, field: str, keep: list[str]) -> DataFrame:
    """For each valid line the kept columns and ``value``: the top-level field as text (numbers as they are written), null if it is absent.

    Nulls, blank and broken lines give no row; a field that is an object, array or boolean gives null. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, values = [], []
            for i, s in enumerate(b.column(0).to_pylist()):
                o = parse(s)
                if o is None:
                    continue
                v = o.get(field)
                at.append(i)
                values.append(v if isinstance(v, str) else None if isinstance(v, (bool, dict, list)) or v is None else json.dumps(v))
            rows = b.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*rows.columns[1:], pa.array(values, pa.string())], [*keep, "value"])

    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), "value string"])
    return df.select(line, *keep).mapInArrow(run, schema)
