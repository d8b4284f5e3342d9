"""Strict validation of externally produced insight lines: each line either becomes an insight or a reject with its first reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewrack.functions.json import parsed
from tidewrack.functions.text import strip

# The types of insights.
TYPES = ("need", "complaint", "advantage", "workaround", "none")
SUMMARY_MAX, PAIN_MAX = 400, 3


def _kind(v: Column, field: str) -> Column:
    """The JSON type of a field of a variant, null if it is absent."""
    return F.schema_of_variant(F.try_variant_get(v, f"$.{field}", "variant"))


def judged(lines: DataFrame, domains: list[str], line: str = "line") -> DataFrame:
    """lines with the fields of an insight and ``reason``, null where the line is valid. Blank lines are left out.

    Rules in order, the first that fails is the reason: JSON, object, post_id, insight_type, domain, summary, pain_level, monetizable,
    competitors, confidence. Booleans are no numbers and 2.0 is no whole number.
    """
    v = parsed(F.col(line))
    rows = lines.filter(F.length(strip(F.col(line))) > 0).withColumn("v", v)
    text = lambda f: F.when(_kind(F.col("v"), f) == "STRING", strip(F.try_variant_get("v", f"$.{f}", "string")))
    is_number = lambda f: _kind(F.col("v"), f).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    rows = rows.withColumns(
        {
            "post_id": text("post_id"),
            "insight_type": text("insight_type"),
            "d": F.when(_kind(F.col("v"), "domain") == "STRING", F.try_variant_get("v", "$.domain", "string")),
            "s": text("summary"),
            "pain_level": F.when(_kind(F.col("v"), "pain_level") == "BIGINT", F.try_variant_get("v", "$.pain_level", "bigint")),
            "monetizable": F.when(_kind(F.col("v"), "monetizable") == "BOOLEAN", F.try_variant_get("v", "$.monetizable", "boolean")),
            "c_kind": _kind(F.col("v"), "competitors"),
            "confidence": F.when(is_number("confidence"), F.try_variant_get("v", "$.confidence", "double")),
        }
    )
    names = F.try_variant_get("v", "$.competitors", "array<string>")
    none, fine = F.col("insight_type") == "none", lambda c: F.coalesce(c, F.lit(False))
    rules = (
        ("json", F.col("v").isNotNull()),
        ("object", F.schema_of_variant("v").startswith("OBJECT")),
        ("post_id", fine(F.col("post_id") != "")),
        ("insight_type", fine(F.col("insight_type").isin(*TYPES))),
        ("domain", fine(none | F.col("d").isin(*domains))),
        ("summary", fine(none | ((F.col("s") != "") & (F.length("s") <= SUMMARY_MAX)))),
        ("pain_level", fine(F.col("pain_level").between(0, PAIN_MAX) & (~none | (F.col("pain_level") == 0)))),
        ("monetizable", F.col("monetizable").isNotNull()),
        ("competitors", F.col("c_kind").isNull() | F.col("c_kind").isin("ARRAY<STRING>", "ARRAY<VOID>") & ~fine(F.exists(names, lambda x: x.isNull()))),
        ("confidence", fine(F.col("confidence").between(0, 1))),
    )
    reason = F.coalesce(*[F.when(~ok, name) for name, ok in rules])
    kept = F.filter(F.transform(F.coalesce(names, F.array().cast("array<string>")), strip), lambda x: x != "")
    return rows.withColumn("reason", reason).withColumns({"domain": F.when(~none, F.col("d")), "summary": F.when(~none, F.col("s")), "competitors": kept, "pain_level": F.col("pain_level").cast("byte")}).drop("v", "d", "s", "c_kind")


def load(lines: DataFrame, batch_ids: DataFrame, domains: list[str]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of numbered lines (line_no, line): of the valid lines those whose post is in the batch, the first per post.
    Reasons added to those of judged(): batch, duplicate."""
    rows = judged(lines, domains).join(batch_ids.select(F.col("id").alias("post_id"), F.lit(True).alias("_in")).distinct(), "post_id", "left")
    rows = rows.withColumn("reason", F.coalesce("reason", F.when(F.col("_in").isNull(), "batch")))
    rank = F.row_number().over(Window.partitionBy("post_id", F.col("reason").isNull()).orderBy("line_no"))
    rows = rows.withColumn("reason", F.coalesce("reason", F.when(rank > 1, "duplicate")))
    fields = ("post_id", "insight_type", "domain", "summary", "pain_level", "monetizable", "competitors", "confidence")
    return rows.filter("reason IS NULL").select("line_no", *fields), rows.filter("reason IS NOT NULL").select("line_no", "post_id", "reason")


def error_lines(rejected: DataFrame) -> DataFrame:
    """(value): the JSON lines of an errors file."""
    return rejected.orderBy("line_no").select(F.to_json(F.struct(F.col("line_no").alias("line"), "post_id", "reason")).alias("value"))
