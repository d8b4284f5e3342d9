"""Time texts of mixed formats, precisions and zones to one form: microseconds since 1970-01-01 UTC.

An ordered cascade of anchored patterns; the first that matches the whole text decides, and a text that no pattern matches is no time.
Everything is column expressions (JVM, no Python), one pass over the rows, no shuffle.

Policy: a zone or offset in the text holds. Otherwise the text is a wall clock time of the row's default zone (UTC where that is null).
Wall clock times that occur twice or never in their zone name no single instant and give null, as do impossible dates, hours over 23,
minutes or seconds over 59, offsets over 18 hours, a weekday that contradicts the date, unknown zones and date-only texts. Null and
blank texts give null. Digits beyond microseconds are dropped.
"""

from __future__ import annotations

import zoneinfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Abbreviations with one usual meaning, in minutes east of UTC. Ambiguous ones (IST, BST) are left out.
ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "GMT": 0, "UT": 0,
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
    "WET": 0, "WEST": 60, "CET": 60, "CEST": 120, "EET": 120, "EEST": 180,
    "JST": 540, "KST": 540, "AEST": 600, "AEDT": 660, "ACST": 570, "ACDT": 630, "AWST": 480, "NZST": 720, "NZDT": 780,
}
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
WEEKDAYS = ("mon", "tue", "wed", "thu", "fri", "sat", "sun")

_CLOCK = r"(?<h>\d{2}):(?<mi>\d{2})(?::(?<s>\d{2})(?:[.,](?<f>\d+))?)?"
_ZONE = r"(?<z>[Zz]|[+-]\d{2}(?::?\d{2})?|[A-Z]{2,5})"
_REGION = r"(?:\[(?<r>[A-Za-z][A-Za-z0-9_+/-]*)\])"
_MONTH = r"(?<mon>Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)(?:(?<=Jan)uary|(?<=Feb)ruary|(?<=Mar)ch|(?<=Apr)il|(?<=Jun)e|(?<=Jul)y|(?<=Aug)ust|(?<=Sep)t(?:ember)?|(?<=Oct)ober|(?<=Nov)ember|(?<=Dec)ember)?"
_DAY = r"(?<wd>[A-Z][a-z]{2})"

#: The cascade, in order. Named groups: y m d h mi s f (fraction) z (offset or abbreviation) r (region) mon wd ap (AM or PM).
PATTERNS = (
    rf"(?<y>\d{{4}})-(?<m>\d{{2}})-(?<d>\d{{2}})(?:[Tt]| +){_CLOCK} ?{_ZONE}?{_REGION}?",
    r"(?<y>\d{4})(?<m>\d{2})(?<d>\d{2})[Tt](?<h>\d{2})(?<mi>\d{2})(?:(?<s>\d{2})(?:[.,](?<f>\d+))?)?" + rf"{_ZONE}?{_REGION}?",
    rf"(?<d>\d{{1,2}})\.(?<m>\d{{1,2}})\.(?<y>\d{{4}}),? {_CLOCK}(?: ?{_ZONE})?",
    rf"(?:{_DAY}, )?(?<d>\d{{1,2}}) {_MONTH} (?<y>\d{{4}}) {_CLOCK}(?: {_ZONE})?",
    rf"{_DAY} {_MONTH} +(?<d>\d{{1,2}}) {_CLOCK}(?: {_ZONE})? (?<y>\d{{4}})",
    rf"{_MONTH} (?<d>\d{{1,2}}), (?<y>\d{{4}}),? (?<h>\d{{1,2}}):(?<mi>\d{{2}})(?::(?<s>\d{{2}})(?:[.,](?<f>\d+))?)? (?<ap>[AaPp][Mm])(?: {_ZONE})?",
    rf"{_MONTH} (?<d>\d{{1,2}}), (?<y>\d{{4}}),? {_CLOCK}(?: {_ZONE})?",
    r"(?<y>\d{4})年(?<m>\d{1,2})月(?<d>\d{1,2})日\s*(?<h>\d{1,2})時(?<mi>\d{1,2})分(?:(?<s>\d{1,2})秒)?",
)
_GROUPS = ("y", "m", "d", "h", "mi", "s", "f", "z", "r", "mon", "wd", "ap")
#: Bare numbers: 9 to 19 digits; under 10^11 seconds, under 10^14 milliseconds, under 10^17 microseconds, else nanoseconds.
_NUMBER = r"(\d{9,19})(?:\.(\d+))?"
_DAY_US = 86_400_000_000


def known_zones(spark: SparkSession) -> list[str]:
    """Names of regions that the JVM knows; of Python's, where there is no JVM at hand."""
    try:
        return sorted(spark._jvm.java.time.ZoneId.getAvailableZoneIds())
    except Exception:
        return sorted(zoneinfo.available_timezones())


def _group_order(pattern: str) -> list[str]:
    import re

    return re.findall(r"\((?:\?<(\w+)>)", pattern)


def _offset_minutes(z: Column) -> Column:
    """Minutes east of UTC of an offset or abbreviation; null if it is neither."""
    digits = F.regexp_replace(F.substring(z, 2, 9), ":", "")
    h, m = F.substring(digits, 1, 2).try_cast("int"), F.coalesce(F.nullif(F.substring(digits, 3, 2), F.lit("")), F.lit("00")).try_cast("int")
    n = h * 60 + m
    table = F.create_map(*[F.lit(x) for kv in ABBREVIATIONS.items() for x in kv])
    return F.when(z.rlike(r"^[+-]\d"), F.when((n <= 18 * 60) & (m < 60), F.when(z.startswith("-"), -n).otherwise(n))).otherwise(F.try_element_at(table, F.upper(z)))


def _wall_us(g) -> Column:
    """Microseconds of the wall clock time as if it were UTC; null for impossible ones. g: group name to column."""
    number = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit("0")).try_cast("int")
    month = F.when(g("mon") != "", F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(g("mon"))).cast("int")).otherwise(number(g("m")))
    h = number(g("h"))
    hour = F.when(g("ap") == "", h).when((h >= 1) & (h <= 12), h % 12 + F.when(F.lower(g("ap")) == "pm", 12).otherwise(0))
    ok = (hour <= 23) & (number(g("mi")) <= 59) & (number(g("s")) <= 59) & (number(g("y")) >= 1)
    day = F.try_make_timestamp(number(g("y")), month, number(g("d")), F.lit(0), F.lit(0), F.lit(0).cast("decimal(8,6)"), F.lit("UTC"))
    fraction = F.rpad(F.substring(g("f"), 1, 6), 6, "0").try_cast("long")
    return F.when(ok, F.unix_micros(day) + (hour * 3600 + number(g("mi")) * 60 + number(g("s"))).cast("long") * 1_000_000 + F.coalesce(fraction, F.lit(0)))


def _local(us: Column, zone: Column) -> Column:
    """Wall clock microseconds in the zone of an instant."""
    return F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(us), zone))


def _number_us(t: Column) -> Column:
    """A bare number in the unit that its size implies."""
    whole, part = F.regexp_extract(t, f"^{_NUMBER}$", 1), F.regexp_extract(t, f"^{_NUMBER}$", 2)
    n = whole.try_cast("long")
    extra = lambda k: F.coalesce(F.rpad(F.substring(part, 1, k), k, "0").try_cast("long"), F.lit(0))
    return F.when(n < 10**11, n * 1_000_000 + extra(6)).when(n < 10**14, n * 1000 + extra(3)).when(n < 10**17, n).otherwise(F.substring(whole, 1, F.length(whole) - 3).try_cast("long"))


def with_epoch_us(df: DataFrame, text: str, default_zone: str, out: str, zones: list[str]) -> DataFrame:
    """df with ``out``: microseconds since 1970 UTC of each text, or null. See the module's text for the rules; zones: names of known regions.

    Each step is a column of its own, so that nothing is computed twice: which pattern matches, its groups, the wall clock time, and for
    zones the two offsets that can hold (those in force a day before and a day after), each giving a candidate that counts if the zone's
    clock shows the wanted time then.
    """
    c = lambda n: F.col(f"_ts_{n}")
    step = lambda d, /, **cols: d.withColumns({f"_ts_{k}": v for k, v in cols.items()})
    df = step(df, t=F.regexp_replace(text, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    which = F.when(c("t").rlike(f"^{_NUMBER}$"), -1)
    for i, p in enumerate(PATTERNS):
        which = which.when(c("t").rlike(f"^{p}$"), i)
    df = step(df, k=which)

    def group(name: str) -> Column:
        out = None
        for i, p in enumerate(PATTERNS):
            order = _group_order(p)
            if name in order:
                x = F.regexp_extract(c("t"), f"^{p}$", order.index(name) + 1)
                out = F.when(c("k") == i, x) if out is None else out.when(c("k") == i, x)
        return out.otherwise("")

    df = step(df, **{g: group(g) for g in _GROUPS})
    df = step(df, wall=_wall_us(c))
    weekday = F.array_position(F.array(*map(F.lit, WEEKDAYS)), F.lower(c("wd"))) - 1
    zone = F.coalesce(F.nullif(c("r"), F.lit("")), F.col(default_zone), F.lit("UTC"))
    df = step(df, wall=F.when((c("wd") == "") | (weekday == F.pmod(F.floor(c("wall") / _DAY_US) + 3, F.lit(7))), c("wall")), zone=F.when((c("z") == "") & zone.isin(zones), zone))
    df = step(df, a=c("wall") - (_local(c("wall") - _DAY_US, c("zone")) - (c("wall") - _DAY_US)), b=c("wall") - (_local(c("wall") + _DAY_US, c("zone")) - (c("wall") + _DAY_US)))
    df = step(df, a_ok=_local(c("a"), c("zone")) == c("wall"), b_ok=_local(c("b"), c("zone")) == c("wall"))
    local = F.when(c("a") == c("b"), F.when(c("a_ok"), c("a"))).when(c("a_ok") & c("b_ok"), F.lit(None)).when(c("a_ok"), c("a")).when(c("b_ok"), c("b"))
    got = F.when(c("k") == -1, _number_us(c("t"))).when(c("z") != "", c("wall") - _offset_minutes(c("z")).cast("long") * 60_000_000).otherwise(local)
    # a generator of one element per row: a filter on the result stays above it. Pushed down through the steps, it would hold each step's
    # expression as often as the next ones use it, and grow without bound
    kept = [x for x in df.columns if not x.startswith("_ts_") and x != out]
    return df.select(*kept, F.explode_outer(F.array(got)).alias(out))
