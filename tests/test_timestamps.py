from datetime import UTC, datetime, timedelta
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from tidewrack.operators.timestamps import known_zones, with_epoch_us


def us(*a):
    return round((datetime(*a, tzinfo=UTC) - datetime(1970, 1, 1, tzinfo=UTC)) / timedelta(microseconds=1))


CASES = [
    ("2024-07-30T20:45:17", "Europe/London", us(2024, 7, 30, 19, 45, 17)),
    ("2024-07-30 20:45:17", None, us(2024, 7, 30, 20, 45, 17)),
    ("2024-07-30T20:45Z", "Asia/Tokyo", us(2024, 7, 30, 20, 45)),
    ("2024-07-30t20:45:17z", None, us(2024, 7, 30, 20, 45, 17)),
    ("  2024-07-30T20:45:17.123456789Z \n", None, us(2024, 7, 30, 20, 45, 17, 123456)),
    ("2024-07-30T20:45:17+05:30", "Asia/Tokyo", us(2024, 7, 30, 15, 15, 17)),
    ("2024-07-30T20:45:17-07", None, us(2024, 7, 31, 3, 45, 17)),
    ("2024-07-30 20:45:17 -0700", None, us(2024, 7, 31, 3, 45, 17)),
    ("2024-07-30 20:45:17 PDT", "Asia/Tokyo", us(2024, 7, 31, 3, 45, 17)),
    ("2024-07-30T20:45:17+02:00[Europe/Berlin]", "Asia/Tokyo", us(2024, 7, 30, 18, 45, 17)),
    ("20240730T204517Z", None, us(2024, 7, 30, 20, 45, 17)),
    ("30.07.2024 19:45:17", None, us(2024, 7, 30, 19, 45, 17)),
    ("Tue, 30 Jul 2024 19:45:17 +0900", None, us(2024, 7, 30, 10, 45, 17)),
    ("Tue Jul 30 19:45:17 +0000 2024", "Asia/Tokyo", us(2024, 7, 30, 19, 45, 17)),
    ("Jul 30, 2024 12:05:01 AM EDT", None, us(2024, 7, 30, 4, 5, 1)),
    ("Jul 3, 2024 12:05:01 PM EDT", None, us(2024, 7, 3, 16, 5, 1)),
    ("2025年7月21日 3時09分20秒", "Asia/Tokyo", us(2025, 7, 20, 18, 9, 20)),
    ("1777881277", "Australia/Sydney", 1777881277_000000),
    ("1777881277.5", None, 1777881277_500000),
    ("1777881277123", None, 1777881277123_000),
    ("1777881277123456", None, 1777881277123456),
    ("1777881277123456789", None, 1777881277123456),
    # twice, never
    ("2024-10-27 02:30:00", "Europe/Berlin", None),
    ("2024-03-31 02:30:00", "Europe/Berlin", None),
    ("2024-10-27 02:30:00", None, us(2024, 10, 27, 2, 30)),
    ("2024-10-27 02:30:00 CEST", "Europe/Berlin", us(2024, 10, 27, 0, 30)),
    # impossible, no time, nothing
    ("2025-04-31 12:00:00", None, None),
    ("2025-02-29 12:00:00", None, None),
    ("2024-13-01 00:00:00", None, None),
    ("2026-07-05T25:10:00Z", None, None),
    ("2026-07-05T10:61:00Z", None, None),
    ("2026-07-05T10:10:60Z", None, None),
    ("2026-07-05T10:10:00+25:00", None, None),
    ("Mon, 30 Jul 2024 19:45:17 +0900", None, None),
    ("0000-00-00 00:00:00", None, None),
    ("2024-07-30", None, None),
    ("Jul 30, 2024 13:05:01 PM EDT", None, None),
    ("2024-07-30 20:45:17", "No/Where", None),
    ("yesterday", None, None),
    ("", None, None),
    ("   ", None, None),
    ("2024", None, None),
    (None, "Asia/Tokyo", None),
    ("x" * 100_000, None, None),
]


def test_cases(spark):
    df = spark.createDataFrame([(i, t, z) for i, (t, z, _) in enumerate(CASES)], "i int, t string, z string")
    got = {r["i"]: r["us"] for r in with_epoch_us(df, "t", "z", "us", known_zones(spark)).collect()}
    assert [(t, got[i]) for i, (t, _, _) in enumerate(CASES)] == [(t, w) for t, _, w in CASES]


@pytest.mark.parametrize("zone", ["Europe/London", "America/New_York", "Australia/Sydney", "Asia/Kolkata", "Australia/Lord_Howe"])
def test_against_python_zones(spark, zone):
    """Each half hour around the changes of a year, against the definition: instants whose clock shows the time."""
    z = ZoneInfo(zone)
    walls = [datetime(2025, 1, 1) + timedelta(minutes=30 * k + 7) for k in range(48 * 365)]
    shown: dict = {}
    t = datetime(2024, 12, 31, tzinfo=UTC)
    while t < datetime(2026, 1, 2, tzinfo=UTC):
        shown.setdefault(t.astimezone(z).replace(tzinfo=None), []).append(t)
        t += timedelta(minutes=30)
    df = spark.createDataFrame([(w.strftime("%Y-%m-%d %H:%M:%S"),) for w in walls], "t string")
    got = {r["t"]: r["us"] for r in with_epoch_us(df.withColumn("z", F.lit(zone)), "t", "z", "us", known_zones(spark)).collect()}
    for w in walls:
        base = w - timedelta(minutes=7)
        instants = shown.get(base, [])
        want = us(*(instants[0] + timedelta(minutes=7)).timetuple()[:6]) if len(instants) == 1 else None
        assert got[w.strftime("%Y-%m-%d %H:%M:%S")] == want, (zone, w)


def test_table(spark, data):
    from tidewrack.plans.general import p1_found, p1_times

    found, times = p1_found(spark, data), p1_times(spark, data)
    assert found.columns == ["source", "record_key", "epoch_us"]
    assert found.groupBy("source", "record_key").count().filter("count > 1").count() == 0
    assert times.count() >= found.count() > 0
    assert times.filter("epoch_us IS NULL AND time_text LIKE '%Z'").filter("NOT time_text RLIKE '25:10|10:61|-30T|-31'").count() == 0
