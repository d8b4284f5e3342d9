"""Time expressions."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ISO 8601 as landing records hold it: year, month, day, hour, minute, second, fraction, offset.
ISO = r"^(\d{4})-?(\d{2})-?(\d{2})(?:[T ](\d{2}):?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?(Z|[+-]\d{2}:?(?:\d{2})?)?\z"


def iso_utc(c: Column) -> Column:
    """ISO 8601 text as naive UTC; without an offset it is UTC; anything else is null."""
    g = lambda i, d="": F.coalesce(F.nullif(F.regexp_extract(c, ISO, i), F.lit("")), F.lit(d))
    wall = F.concat(g(1), F.lit("-"), g(2), F.lit("-"), g(3), F.lit(" "), g(4, "00"), F.lit(":"), g(5, "00"), F.lit(":"), g(6, "00"), F.lit("."), F.rpad(F.substring(g(7, "0"), 1, 6), 6, "0"))
    digits = F.rpad(F.regexp_replace(F.substring(g(8), 2, 5), ":", ""), 4, "0")
    minutes = F.when(g(8).isin("", "Z"), F.lit(0)).otherwise(F.when(g(8).startswith("-"), -1).otherwise(1) * (F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int")))
    return F.when(c.rlike(ISO), wall.try_cast("timestamp_ntz") - F.make_dt_interval(mins=minutes))


def epoch_iso(c: Column) -> Column:
    """Seconds since 1970 as ISO 8601 with offset +00:00; '' for null and for times outside years 1 to 9999."""
    ok = c.isNotNull() & (c.cast("double") >= -62135596800) & (c.cast("double") < 253402300800)
    t = F.timestamp_micros((F.when(ok, c.cast("double")).otherwise(0.0) * 1_000_000).cast("bigint"))
    micro = F.when(F.date_format(t, "SSSSSS") == "000000", "").otherwise(F.concat(F.lit("."), F.date_format(t, "SSSSSS")))
    return F.when(ok, F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"), micro, F.lit("+00:00"))).otherwise("")


def in_period(c: Column, since: datetime, until: datetime) -> Column:
    """Half open: from since on, before until."""
    return (c >= F.lit(since).cast("timestamp_ntz")) & (c < F.lit(until).cast("timestamp_ntz"))


def since_of(text: str, until: datetime) -> datetime:
    """'7d' before until."""
    m = re.fullmatch(r"(\d+)d", text)
    if not m:
        raise ValueError(f"not a number of days: {text!r}")
    return until - timedelta(days=int(m[1]))
