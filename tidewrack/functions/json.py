"""JSON expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed(c: Column) -> Column:
    """The value (variant) of a text that is one JSON value and nothing else, null otherwise. The engine's parser stops after the first value
    of a text; inside brackets and inside braces what follows must fit, and nothing but white space fits both."""
    inside = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), c, F.lit("]"))), "$[0]", "variant")
    return F.when(F.try_parse_json(F.concat(F.lit('{"v":'), c, F.lit("}"))).isNotNull(), inside)
