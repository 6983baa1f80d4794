"""Ranges of time that were asked for: islands, and the gaps between them.

Ranges are structs of ``start`` and ``stop``, both included. A key holds its ranges
in one array that is merged whenever it changes, so it has as many as the key has
gaps, and all functions work inside a row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RANGES = "array<struct<start: timestamp, stop: timestamp>>"


def step() -> Column:
    """Timestamps have microseconds, so nothing lies between a range and one that begins a microsecond behind it."""
    return F.expr("interval 1 microsecond")


def time_range(start: Column | str, stop: Column | str) -> Column:
    return F.struct(F.col(start) if isinstance(start, str) else start, F.col(stop) if isinstance(stop, str) else stop).cast(
        "struct<start: timestamp, stop: timestamp>"
    )


def no_ranges() -> Column:
    return F.array().cast(RANGES)


def merged(ranges: Column) -> Column:
    """Islands of ``ranges`` in order; ranges that overlap or touch become one. Null ranges are none."""
    valid = F.filter(F.coalesce(ranges, no_ranges()), lambda r: r["start"] <= r["stop"])

    def add(islands: Column, r: Column) -> Column:
        last = F.get(islands, F.size(islands) - 1)
        before = F.slice(islands, F.lit(1), F.greatest(F.size(islands) - 1, F.lit(0)))
        longer = time_range(last["start"], F.greatest(last["stop"], r["stop"]))
        return F.when(r["start"] <= last["stop"] + step(), F.concat(before, F.array(longer))).otherwise(
            F.concat(islands, F.array(r))
        )

    return F.aggregate(F.array_sort(valid), no_ranges(), add)


def missing(start: Column, stop: Column, islands: Column) -> Column:
    """The parts of ``start`` to ``stop`` that ``islands`` (merged) leave open."""
    islands = F.coalesce(islands, no_ranges())
    begins = F.concat(F.array(start), F.transform(islands, lambda r: r["stop"] + step()))
    ends = F.concat(F.transform(islands, lambda r: r["start"] - step()), F.array(stop))
    gaps = F.zip_with(begins, ends, lambda b, e: time_range(F.greatest(b, start), F.least(e, stop)))
    return F.filter(gaps, lambda r: r["start"] <= r["stop"])


def up_to(ranges: Column, last: Column) -> Column:
    """``ranges`` without what lies behind ``last``."""
    cut = F.transform(ranges, lambda r: time_range(r["start"], F.least(r["stop"], last)))
    return F.filter(cut, lambda r: r["start"] <= r["stop"])
