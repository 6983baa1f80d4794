"""Instants, days, month windows and load windows."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from silverair.functions.text import as_column

# The formats in which call times and readings are stored.
FRACTION_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
SECOND_FORMAT = "yyyy-MM-dd'T'HH:mm:ssXXX"


def load_instant(text: Column | str) -> Column:
    """Call time of a request, with or without a six-digit fraction."""
    text = as_column(text)
    return F.coalesce(
        F.try_to_timestamp(text, F.lit(FRACTION_FORMAT)),
        F.try_to_timestamp(text, F.lit(SECOND_FORMAT)),
    )


def reading_instant(text: Column | str) -> Column:
    """Time of a raw reading: whole seconds, ``Z`` or an offset."""
    return F.try_to_timestamp(as_column(text), F.lit(SECOND_FORMAT))


def iso_instant(text: Column | str) -> Column:
    """Any ISO text as an instant; NULL when it cannot be read."""
    return as_column(text).try_cast("timestamp")


def date_id(day: Column | str) -> Column:
    return F.date_format(as_column(day), "yyyyMMdd")


def local_day(instant: Column | str, zone: Column | str | None = None) -> Column:
    """Day of an instant in the session zone, or in the zone of the site."""
    instant = as_column(instant)
    if zone is None:
        return F.to_date(instant)
    return F.to_date(F.from_utc_timestamp(instant, as_column(zone)))


def normalise_iso(text: Column | str, end_of_day: bool = False) -> Column:
    """Complete a bare date to an ISO instant; blank text becomes NULL."""
    text = F.nullif(F.trim(as_column(text)), F.lit(""))
    suffix = "T23:59:59+00:00" if end_of_day else "T00:00:00+00:00"
    return F.when(F.contains(text, F.lit("T")), text).otherwise(F.concat(text, F.lit(suffix)))


def month_start(instant: Column | str) -> Column:
    return F.date_trunc("month", as_column(instant))


def next_month(instant: Column | str) -> Column:
    return month_start(instant) + F.expr("interval 1 month")


def months(start: Column | str, end: Column | str) -> Column:
    """Array of the month starts that cover ``[start, end]``; empty when ``start`` is after ``end``."""
    start, end = as_column(start), as_column(end)
    # sequence() rejects a start behind its end, also in rows that are not kept.
    last = F.greatest(month_start(start), end)
    covered = F.sequence(month_start(start), last, F.expr("interval 1 month"))
    return F.when(start <= end, covered)


def month_window(month: Column | str, start: Column | str, end: Column | str) -> tuple[Column, Column]:
    """First and last instant of the part of ``[start, end]`` that lies in ``month``.

    The first window is clipped to ``start``, the last to ``end``; the others
    end one second before the next month.
    """
    last_second = next_month(month) - F.expr("interval 1 second")
    return F.greatest(as_column(month), as_column(start)), F.least(last_second, as_column(end))


def run_partition(instant: Column | str) -> Column:
    """Partition text of a run, ``year=YYYY/month=MM/day=DD``."""
    return F.date_format(as_column(instant), "'year='yyyy'/month='MM'/day='dd")


def run_number(instant: Column | str) -> Column:
    """Numeric run id, ``yyyyMMddHHmmss``."""
    return F.date_format(as_column(instant), "yyyyMMddHHmmss").cast("bigint")


def days_before(instant: Column | str, days: int) -> Column:
    return as_column(instant) - F.make_dt_interval(F.lit(days))


def measurement_window(
    now: datetime, historical: bool = False, date_from: str | None = None, date_to: str | None = None
) -> tuple[str, str, str]:
    """Load type and day range of a measurement run: given range or yesterday to today."""
    if historical:
        if not date_from or not date_to:
            raise ValueError("a historical load needs date_from and date_to")
        return "historical", date_from, date_to
    return "daily", f"{now - timedelta(days=1):%Y-%m-%d}", f"{now:%Y-%m-%d}"


def weather_window(now: datetime, start: str | None = None, end: str | None = None) -> tuple[str, str]:
    """Day range of a weather run: the two days before today unless given."""
    return (
        start or f"{now - timedelta(days=2):%Y-%m-%d}",
        end or f"{now - timedelta(days=1):%Y-%m-%d}",
    )
