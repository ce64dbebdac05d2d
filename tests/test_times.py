"""Clock handling: epoch ms -> instant -> London text, keys and object names."""

import datetime as dt

from pyspark.sql import functions as F

from trackside.functions.times import (epoch_seconds, iso_london, london_date, ms_to_ts,
                                       object_name, partition_keys)


def _ms(s: str) -> int:
    d = dt.datetime.fromisoformat(s).replace(tzinfo=dt.timezone.utc)
    return int(d.timestamp() * 1000)


# UTC instant -> London ISO text (FIXTURES.md section 5, both clock changes)
CLOCK_CASES = [
    ("2024-06-30 23:30:00", "2024-07-01T00:30:00+01:00"),
    ("2024-01-01 00:00:07.179", "2024-01-01T00:00:07.179000+00:00"),
    ("2024-03-31 00:59:59", "2024-03-31T00:59:59+00:00"),
    ("2024-03-31 01:00:00", "2024-03-31T02:00:00+01:00"),
    ("2024-10-27 00:30:00", "2024-10-27T01:30:00+01:00"),
    ("2024-10-27 01:30:00", "2024-10-27T01:30:00+00:00"),
]


def test_iso_london_across_clock_changes(spark):
    rows = [(str(_ms(u)), want) for u, want in CLOCK_CASES]
    df = spark.createDataFrame(rows, "ms string, want string")
    got = df.select(iso_london(ms_to_ts("ms")).alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_python_isoformat_matches(spark):
    """Same text as a zone-aware Python datetime's isoformat()."""
    from zoneinfo import ZoneInfo
    cases = [_ms("2024-05-05 12:00:00.5"), _ms("2023-12-31 23:59:59.999"), 0, 1]
    df = spark.createDataFrame([(str(c),) for c in cases], "ms string")
    got = [r[0] for r in df.select(iso_london(ms_to_ts("ms"))).collect()]
    want = [dt.datetime.fromtimestamp(c / 1000, ZoneInfo("Europe/London")).isoformat()
            for c in cases]
    assert got == want


def test_partition_keys_and_date_use_london_day(spark):
    df = spark.createDataFrame([(str(_ms("2024-06-30 23:30:00")),)], "ms string")
    r = df.select(*partition_keys(ms_to_ts("ms")), london_date(ms_to_ts("ms")).alias("d"),
                  object_name(ms_to_ts("ms"), F.lit(None).cast("string")).alias("o")).first()
    assert (r.year, r.month, r.day) == (2024, "07", "01")
    assert r.d == dt.date(2024, 7, 1)
    assert r.o == "20240701-003000-None.json"


def test_bad_ms_text_is_null_and_seconds_are_double(spark):
    df = spark.createDataFrame([("abc",), ("",), (None,), ("1704067207179",)], "ms string")
    rows = df.select(ms_to_ts("ms").alias("t"), epoch_seconds("ms").alias("s")).collect()
    assert [r.t for r in rows[:3]] == [None, None, None]
    assert rows[3].s == 1704067207.179
