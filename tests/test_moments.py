import datetime as dt

import pytest

from sieveline.functions import moments as M

CASES = [
    ("2024-11-03 01:30:00", "America/New_York", "2024-11-03T05:30:00"),  # twice: the first
    ("2024-03-10 02:30:00", "America/New_York", "2024-03-10T07:30:00"),  # skipped: forward by the hour
    ("03/04/2025", "America/New_York", "2025-03-04T05:00:00"),
    ("03/04/2025", "Europe/London", "2025-04-02T23:00:00"),
    ("2020-10-25 03:15 CET", "Europe/Berlin", "2020-10-25T02:15:00"),
    ("2021-07-01 10:00 CET", "Europe/Berlin", "2021-07-01T09:00:00"),
    ("2022-02-26 11:14 CST", "Asia/Shanghai", "2022-02-26T03:14:00"),
    ("2022-02-26 11:14 CST", "America/Chicago", "2022-02-26T17:14:00"),
    ("２０２２年４月５日 １６：５１", "Asia/Shanghai", "2022-04-05T08:51:00"),
    ("2023年1月2日下午12时05分", "Asia/Shanghai", "2023-01-02T04:05:00"),
    ("2020-12-31T24:00:00", "Asia/Shanghai", "2020-12-31T16:00:00"),
    ("2020-W53-7T03:15", "UTC", "2021-01-03T03:15:00"),
    ("2021-W53-1", "UTC", None),
    ("20220811", "UTC", "2022-08-11T00:00:00"),
    ("1639301978", "Asia/Tokyo", "2021-12-12T09:39:38"),
    ("1729981548206", "UTC", "2024-10-26T22:25:48.206000"),
    ("90000000", "Asia/Tokyo", "1972-11-07T16:00:00"),  # seconds before 1973
    ("7", "UTC", "1970-01-01T00:00:07"),
    ("-86400", "UTC", "1969-12-31T00:00:00"),
    ("1639301978.5004", "UTC", "2021-12-12T09:39:38.500400"),
    ("1729981548206.7509", "UTC", "2024-10-26T22:25:48.206750"),
    ("32503680000000", "UTC", "3000-01-01T00:00:00"),  # milliseconds of 14 places
    ("1729981548206123", "UTC", "2024-10-26T22:25:48.206123"),
    ("20241350", "UTC", None),
    ("20241350101010", "UTC", None),
    ("1234567890123456789", "UTC", None),
    ("D:20210812064111-04'00'", "UTC", "2021-08-12T10:41:11"),
    ("D:2021", "UTC", "2021-01-01T00:00:00"),
    ("Thu Apr  2 14:34:46 2020", "UTC", "2020-04-02T14:34:46"),
    ("Sat, 13 Jun 2026 04:43:22 +0800", "UTC", "2026-06-12T20:43:22"),
    ("2022-12-14 14:11:31.751598999", "UTC", "2022-12-14T14:11:31.751598"),
    ("29. März 2026, 3.15 Uhr", "Europe/Berlin", "2026-03-29T01:15:00"),
    ("1er février 2026 à 3h08", "Europe/Paris", "2026-02-01T02:08:00"),
    ("0000-00-00", "UTC", None),
    ("2026年2月30日", "UTC", None),
    ("2025-13-01T09:00:00Z", "UTC", None),
    ("25:61", "UTC", None),
    ("", "UTC", None),
    (None, "UTC", None),
    ("长期", "Asia/Shanghai", None),
    ("2024-01-01", "No/Such_Zone", None),
    ("2024-01-01", None, None),
    ("2024-01-01T00:00:00Z", None, "2024-01-01T00:00:00"),
]


def test_forms(spark):
    df = spark.createDataFrame([(i, t, z, "other") for i, (t, z, _) in enumerate(CASES)], "i int, text string, tz string, spans string")
    got = {r.i: r.utc_us for r in M.to_utc(df, "text", "tz").collect()}
    assert len(got) == len(CASES)
    for i, (text, zone, want) in enumerate(CASES):
        us = None if want is None else int((dt.datetime.fromisoformat(want) - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1))
        assert got[i] == us, (text, zone, want, got[i])


@pytest.mark.parametrize("text, n", [("2024-11-03 01:30:00", 2), ("2024-03-10 02:30:00", 0), ("2024-06-01", 1)])
def test_intervals(spark, text, n):
    df = spark.createDataFrame([(text, "America/New_York")], "text string, tz string")
    assert M.matches(df, "text", "tz").first().n_intervals == n


def test_empty(spark):
    df = spark.createDataFrame([], "text string, tz string")
    assert M.to_utc(df, "text", "tz").count() == 0
    assert M.to_utc(df, "text", None).count() == 0


def test_zone_transitions_agree_with_zoneinfo():
    from zoneinfo import ZoneInfo

    spans = M.transitions("Europe/Paris")
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    for sec in range(0, 1_900_000_000, 7_777_777):
        want = dt.datetime.fromtimestamp(sec, ZoneInfo("Europe/Paris")).utcoffset().total_seconds()
        assert [o for a, b, o, _ in spans if a <= sec < b] == [want]


def test_years_beyond_the_list(spark):
    from zoneinfo import ZoneInfo

    zones = ["UTC", "Europe/Berlin", "America/New_York", "Australia/Sydney", "Africa/Casablanca", "Asia/Shanghai"]
    times = [(y, m, d) for y in (1100, 1799, 1850, 1899, 1941, 1965, 1969, 2100, 2101, 2128, 2129, 2150, 2200, 2396, 2400, 5003, 9998) for m, d in ((1, 1), (3, 28), (7, 1), (10, 30), (12, 31))]
    df = spark.createDataFrame([(f"{y:04}-{m:02}-{d:02} 12:00:00", z) for y, m, d in times for z in zones], "text string, tz string")
    for r in M.to_utc(df, "text", "tz").collect():
        at = dt.datetime.fromisoformat(r.text).replace(tzinfo=ZoneInfo(r.tz))
        want = at.replace(tzinfo=None) - at.utcoffset() - dt.datetime(1970, 1, 1)
        assert r.utc_us == want // dt.timedelta(microseconds=1), (r.text, r.tz)
    meta = spark.createDataFrame([("D:19690101120000",)], "text string")
    assert M.to_utc(meta, "text", None).first().utc_us == -364 * 86_400_000_000 - 43_200_000_000
    ways = spark.createDataFrame([("2150-11-01 01:30:00", "America/New_York"), ("2150-03-08 02:30:00", "America/New_York")], "text string, tz string")
    assert [r.n_intervals for r in M.matches(ways, "text", "tz").collect()] == [2, 0]
