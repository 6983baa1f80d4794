"""Per-sensor watermarks, covered ranges and request windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverair.functions.times import month_window, months
from silverair.operators import ranges as rg
from silverair.operators.lookup import lookup_join

LAST = "last_timestamp"
COVERED = "covered"


def next_windows(
    sensors: DataFrame, state: DataFrame, key: str, now: Column, lookback_days: int = 3, catch_up: bool = False
) -> DataFrame:
    """Add ``date_from`` and ``date_to`` to every sensor.

    The window starts one second behind the last reading; without a state it
    starts at the lookback. Unless ``catch_up``, it never starts before the lookback,
    and a sensor that stopped earlier has a gap.
    """
    earliest = now - F.make_dt_interval(F.lit(lookback_days))
    resume = F.col(LAST) + F.expr("interval 1 second")
    joined = sensors.join(state.select(key, LAST), key, "left")
    # Both skip NULLs, so a missing state leaves the lookback.
    first = F.coalesce(resume, earliest) if catch_up else F.greatest(resume, earliest)
    return joined.withColumns({"date_from": first, "date_to": now}).drop(LAST)


def open_windows(windows: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """``windows`` without what was asked for before: a row per gap of the ledger in ``state``.

    A sensor that is silent has been asked for up to the last run, so its next
    window begins there and not at its last reading.
    """
    gaps = rg.missing(F.col("date_from"), F.col("date_to"), F.col(COVERED))
    rows = windows.distinct().join(state.select(key, COVERED), key, "left").select(key, F.explode(gaps).alias("gap"))
    return rows.select(key, F.col("gap.start").alias("date_from"), F.col("gap.stop").alias("date_to"))


def asked_ranges(requests: DataFrame, key: str, landed: DataFrame, at: str, n: int | None = None) -> DataFrame:
    """Ranges per sensor that a run has covered.

    If a run takes ``n`` rows per sensor at most, a sensor that reached this number
    is covered up to its last row only.
    """
    asked = requests.groupBy(key).agg(F.collect_set(rg.time_range("date_from", "date_to")).alias(COVERED))
    if n is None:
        return asked
    full = landed.groupBy(key).agg(F.count(F.lit(1)).alias("__rows"), F.max(at).alias("__last")).where(F.col("__rows") >= n)
    cut = F.when(F.col("__last").isNull(), F.col(COVERED)).otherwise(rg.up_to(F.col(COVERED), F.col("__last")))
    return asked.join(full, key, "left").select(key, cut.alias(COVERED))


def stopped_before(sensors: DataFrame, state: DataFrame, key: str, earliest: Column) -> DataFrame:
    """One row: ``sensors`` that stopped before ``earliest``, and the ``oldest`` of their watermarks."""
    known = state.join(sensors.select(key).distinct(), key, "left_semi").where(F.col(LAST) < earliest)
    return known.agg(F.count(F.lit(1)).alias("sensors"), F.min(LAST).alias("oldest"))


def month_requests(sensors: DataFrame, start: Column, end: Column, month: str = "month") -> DataFrame:
    """One request per sensor and month of a backfill: ``month``, ``date_from``, ``date_to``."""
    bounded = sensors.withColumns({"__start": start, "__end": end})
    exploded = bounded.select("*", F.explode(months("__start", "__end")).alias(month))
    date_from, date_to = month_window(month, "__start", "__end")
    requests = exploded.withColumns({"date_from": date_from, "date_to": date_to}).drop("__start", "__end")
    # A range that starts in the last second of a month leaves nothing of it.
    return requests.filter(F.col("date_from") <= F.col("date_to"))


def last_readings(rows: DataFrame, key: str, ended_at: Column) -> DataFrame:
    """Newest end time per sensor; sensors without a valid one are absent."""
    ends = rows.select(key, ended_at.alias(LAST)).filter(F.col(LAST).isNotNull())
    return ends.groupBy(key).agg(F.max(LAST).alias(LAST))


def advance_state(state: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Old and new watermarks merged; a watermark never moves backwards."""
    merged = state.select(key, LAST).unionByName(batch.select(key, LAST))
    return merged.groupBy(key).agg(F.max(LAST).alias(LAST))


def advance_ledger(state: DataFrame, ends: DataFrame, asked: DataFrame, key: str) -> DataFrame:
    """Old watermarks and covered ranges merged with those of a run.

    Neither ever shrinks, and the order of runs does not matter.
    """
    never = F.lit(None).cast("timestamp").alias(LAST)
    merged = (
        state.select(key, LAST, COVERED)
        .unionByName(ends.select(key, LAST, rg.no_ranges().alias(COVERED)))
        .unionByName(asked.select(key, never, COVERED))
    )
    covered = rg.merged(F.flatten(F.collect_list(COVERED))).alias(COVERED)
    return merged.groupBy(key).agg(F.max(LAST).alias(LAST), covered)


def within_window(rows: DataFrame, requests: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """Rows whose time lies in the request window of their key."""
    # A sensor that is listed twice is asked for once.
    windows = requests.select(*keys, "date_from", "date_to").distinct()
    joined = lookup_join(rows, windows, keys, [at])
    return joined.filter(F.col(at).between(F.col("date_from"), F.col("date_to")))
