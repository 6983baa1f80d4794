from __future__ import annotations

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import rows
from silverair.operators import state

NOW = datetime(2026, 5, 10, 12)


def test_next_windows(spark):
    sensors = spark.createDataFrame([(1,), (2,), (3,), (4,)], "s int")
    known = [(1, datetime(2026, 5, 9)), (2, datetime(2026, 4, 1)), (3, None), (9, datetime(2026, 5, 9))]
    old = spark.createDataFrame(known, "s int, last_timestamp timestamp")
    earliest = datetime(2026, 5, 7, 12)
    assert rows(state.next_windows(sensors, old, "s", F.lit(NOW)), "s") == [
        (1, datetime(2026, 5, 9, 0, 0, 1), NOW),
        (2, earliest, NOW),
        (3, earliest, NOW),
        (4, earliest, NOW),
    ]


def test_state_never_moves_backwards(spark):
    schema = "s int, last_timestamp timestamp"
    day = [datetime(2026, 5, d) for d in range(1, 5)]
    old = spark.createDataFrame([(1, day[3]), (2, day[0]), (3, day[1])], schema)
    batch = spark.createDataFrame([(1, day[0]), (2, day[2]), (4, day[2])], schema)
    merged = state.advance_state(old, batch, "s")
    assert rows(merged, "s") == [(1, day[3]), (2, day[2]), (3, day[1]), (4, day[2])]
    assert rows(state.advance_state(merged, batch, "s"), "s") == rows(merged, "s")


def test_last_readings_ignore_missing_times(spark):
    df = spark.createDataFrame([(1, "2026-01-02T00:00:00Z"), (1, "2026-01-02T01:00:00+02:00"), (2, ""), (3, None)], "s int, t string")
    # As text the second time would be greater; as an instant it is earlier.
    got = state.last_readings(df, "s", F.col("t").try_cast("timestamp"))
    assert rows(got) == [(1, datetime(2026, 1, 2))]


def windows(spark, start, end):
    df = spark.createDataFrame([(1, start, end)], "s int, a timestamp, b timestamp")
    found = state.month_requests(df, F.col("a"), F.col("b")).select("date_from", "date_to")
    return rows(found, "date_from")


def test_month_requests(spark):
    d = datetime
    assert windows(spark, d(2026, 1, 5), d(2026, 1, 9)) == [(d(2026, 1, 5), d(2026, 1, 9))]
    assert windows(spark, d(2026, 1, 5), d(2026, 1, 5)) == [(d(2026, 1, 5), d(2026, 1, 5))]
    assert windows(spark, d(2025, 11, 20, 8), d(2026, 1, 1)) == [
        (d(2025, 11, 20, 8), d(2025, 11, 30, 23, 59, 59)),
        (d(2025, 12, 1), d(2025, 12, 31, 23, 59, 59)),
        (d(2026, 1, 1), d(2026, 1, 1)),
    ]
    assert windows(spark, d(2026, 1, 9), d(2026, 1, 5)) == []
    assert windows(spark, d(2026, 3, 1), d(2026, 1, 5)) == []


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(start=st.datetimes(datetime(2015, 1, 1), datetime(2025, 1, 1)), seconds=st.integers(0, 90_000_000))
def test_month_requests_tile_the_range(start, seconds, spark):
    start = start.replace(microsecond=0)
    end = start + timedelta(seconds=seconds)
    found = windows(spark, start, end)
    assert found[0][0] == start and found[-1][1] == end
    assert all(b == a + timedelta(seconds=1) and b.day == 1 for (_, a), (b, _) in zip(found, found[1:], strict=False))
    assert all(a <= b and (a.year, a.month) == (b.year, b.month) for a, b in found)


def test_within_window_includes_both_ends(spark):
    readings = spark.createDataFrame([(1, NOW), (1, NOW - timedelta(days=1)), (1, NOW - timedelta(days=2)), (2, NOW)], "s int, at timestamp")
    requests = spark.createDataFrame([(1, NOW - timedelta(days=1), NOW)], "s int, date_from timestamp, date_to timestamp")
    got = state.within_window(readings, requests, ["s"], "at").select("at")
    assert rows(got, "at") == [(NOW - timedelta(days=1),), (NOW,)]
