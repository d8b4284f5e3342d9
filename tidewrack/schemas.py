"""Tables of the store."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BooleanType, ByteType, FloatType, IntegerType, StringType, StructField, StructType, TimestampNTZType

_S, _T, _L = StringType(), TimestampNTZType(), ArrayType(StringType())


def _table(*fields: tuple) -> StructType:
    return StructType([StructField(n, t, len(x) == 0 or x[0]) for n, t, *x in fields])


POSTS = _table(("id", _S, False), ("platform", _S, False), ("native_id", _S, False), ("author_id", _S), ("author_handle", _S), ("text", _S), ("url", _S), ("lang", _S), ("posted_at", _T), ("collected_at", _T), ("matched_keywords", _L), ("metrics", _S), ("raw", _S), ("extraction_status", _S, False))
INSIGHTS = _table(("post_id", _S, False), ("insight_type", _S, False), ("domain", _S), ("summary", _S), ("pain_level", ByteType()), ("monetizable", BooleanType()), ("competitors", _L), ("confidence", FloatType()), ("extractor_version", _S), ("extracted_at", _T), ("embedding", ArrayType(FloatType())), ("embedding_model", _S))
EDGES = _table(("src_type", _S, False), ("src_id", _S, False), ("dst_type", _S, False), ("dst_id", _S, False), ("edge_type", _S, False), ("weight", FloatType()), ("observed_at", _T))
BATCHES = _table(("batch_id", _S, False), ("created_at", _T), ("post_count", IntegerType()), ("extractor_version", _S), ("loaded_at", _T), ("loaded_count", IntegerType()))
SCHEMA_VERSION = _table(("version", IntegerType(), False), ("applied_at", _T, False), ("note", _S))

#: Forward-only steps: version, note, and the columns a table gains. A table of an older version is brought up by migrate().
MIGRATIONS = ((1, "posts, insights, edges, extraction_batches", {}), (2, "insights.embedding_model", {"insights": ("embedding_model",)}))


def latest_version() -> int:
    return MIGRATIONS[-1][0]


def migrate(df, table: str, version: int):
    """df of a table at a version with the columns later versions add, null; idempotent."""
    from pyspark.sql import functions as F

    types = {"posts": POSTS, "insights": INSIGHTS, "edges": EDGES, "extraction_batches": BATCHES}[table]
    for v, _, columns in MIGRATIONS:
        for c in columns.get(table, ()) if v > version else ():
            if c not in df.columns:
                df = df.withColumn(c, F.lit(None).cast(types[c].dataType))
    return df


def upgrade(tables: dict, versions, now) -> tuple[dict, object, list[int]]:
    """(tables, versions, applied): tables by name brought from the version that versions (SCHEMA_VERSION) records to the latest, and a row
    added for each step taken at the time now. Steps already recorded aren't taken again; no step gives everything back unchanged."""
    from pyspark.sql import functions as F

    at = versions.agg(F.max("version")).first()[0] or 0
    steps = [(v, now, note) for v, note, _ in MIGRATIONS if v > at]
    if not steps:
        return tables, versions, []
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SCHEMA_VERSION.fields)
    return {n: migrate(df, n, at) for n, df in tables.items()}, versions.unionByName(versions.sparkSession.createDataFrame(steps, ddl)), [s[0] for s in steps]
