"""Text expressions."""

from __future__ import annotations

import html
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: First-person trouble, a rough proxy: fixed values, alternatives of one word-bounded pattern.
PAIN_WORDS = (
    "i tried", "doesn.t work", "does not work", "any advice", "too slow", "not working", "can.t get", "struggl", "annoying", "frustrat",
    "failed to", "keeps failing", "help me", "wish there was", "stuck on", "no idea why",
)


def space_trim(c: Column) -> Column:
    """Without Unicode space separators at both ends; tabs and line ends stay."""
    return F.regexp_replace(c, r"^\p{Zs}+|\p{Zs}+$", "")


def strip(c: Column) -> Column:
    """Without any white space at both ends."""
    return F.regexp_replace(c, r"^[\p{Z}\s\x1c-\x1f\x85]+|[\p{Z}\s\x1c-\x1f\x85]+$", "")


def not_blank(c: Column) -> Column:
    """Not null and more than space separators."""
    return c.isNotNull() & (F.length(space_trim(c)) > 0)


def or_null(c: Column) -> Column:
    """The text, null if it is empty."""
    return F.nullif(c, F.lit(""))


def contains_pattern(c: Column, needle: str) -> Column:
    """Case-insensitive LIKE with the needle anywhere; % and _ of the needle are wildcards, a backslash is itself."""
    return c.ilike("%" + needle.replace("\\", "\\\\") + "%")


def pain(c: Column) -> Column:
    """Whether a text voices trouble; false for null. Word bounds and case follow Unicode."""
    return F.coalesce(c.rlike(rf"(?iU)\b({'|'.join(PAIN_WORDS)})\b"), F.lit(False))


def markdown_cell(c: Column) -> Column:
    """A table cell: pipes escaped, line ends as spaces, null and empty as -."""
    return F.coalesce(F.nullif(F.translate(F.replace(c, F.lit("|"), F.lit("\\|")), "\r\n", "  "), F.lit("")), F.lit("-"))


def signed(c: Column) -> Column:
    """A number with its sign."""
    return F.format_string("%+d", c)


def clean_html(df: DataFrame, column: str) -> DataFrame:
    """df with the column's tags removed, entities decoded and ends stripped; empty gives null. The full table of entities is Python's, so
    this runs in Arrow batches."""
    schema = df.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        tag = re.compile(r"<[^>]+>")
        for b in batches:
            i = b.schema.get_field_index(column)
            out = pa.array([(html.unescape(tag.sub("", x)).strip() or None) if x else None for x in b.column(i).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([out if k == i else c for k, c in enumerate(b.columns)], b.schema.names)

    return df.mapInArrow(run, schema)
