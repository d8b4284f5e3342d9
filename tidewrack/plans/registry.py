"""Collects the queries of the core."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewrack.plans import general, made, reference

MODULES = (reference, made, general)


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["edges_cooccurs"](spark, sf_dir)


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {k: q for m in MODULES for k, q in getattr(m, "oracle_sql", dict)().items()}
