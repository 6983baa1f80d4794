"""Jobs that land the flat tables, with their pointers, watermarks and run logs."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverair.functions.scoring import DEFAULT_RADIUS_M
from silverair.operators import state as st
from silverair.operators.quality import observed, run_counters
from silverair.operators.ranking import slice_rows
from silverair.plans import bronze
from silverair.plans.silver import PM25_ID
from silverair.schemas import LOCATION, SENSOR_STATE, SENSORS
from silverair.session import staged
from silverair.sinks import files, versions
from silverair.sources.files import list_files, read_results, result_errors


def locations(
    spark: SparkSession, responses: str, root: str, now: datetime, batch: tuple[int, int | None] = (0, None)
) -> tuple[DataFrame, dict[str, Any]]:
    """Land the locations of a run and their fine-dust sensors; returns the sensors of ``batch`` and the run log.

    ``responses`` is the folder of landed answers. Those that cannot be read, and
    elements of another shape, are landed as error rows. A sensor that several
    locations list counts once, for the one with the greatest id. ``batch`` are the
    first and last (excluded) place of a sensor in the order of ids.
    """
    version = versions.new_version()
    with staged(read_results(spark, responses, LOCATION), "locations") as found:
        landed = files.land(found, f"{root}/locations", F.lit(now), run=version)
        known = files.land(bronze.sensors(found, ["id"]), f"{root}/sensors", F.lit(now), run=version)
    errors = files.land(result_errors(spark, responses, LOCATION), f"{root}/errors", F.lit(now), run=version)
    asked = spark.createDataFrame([], SENSORS)
    if known:
        day = f"year={now:%Y}/month={now:%m}/day={now:%d}/run={version}"
        asked = slice_rows(spark.read.schema(SENSORS).parquet(f"{root}/sensors/{day}"), ["sensor_id"], *batch)
    return asked, {"locations": landed, "sensors": known, "errors": errors}


def measurements(
    pages: DataFrame, sensors: DataFrame, window: tuple[str, str, str], root: str, now: datetime
) -> dict[str, Any] | None:
    """Land the daily values of a run and point to them; ``None`` if there are none."""
    load_type, date_from, date_to = window
    spark = pages.sparkSession
    rows = bronze.measurements(pages, sensors, window)
    version = versions.new_version()
    written = files.land(rows, f"{root}/data", F.lit(now), run=version)
    if not written:
        return None
    path = f"{root}/data/year={now:%Y}/month={now:%m}/day={now:%d}/run={version}"
    details = {
        "historical_load": load_type == "historical",
        "load_type": load_type,
        "parameter_id": PM25_ID,
        "sensors_count": sensors.count(),
        "date_from": date_from,
        "date_to": date_to,
    }
    return {**details, **versions.publish(spark, root, version, path, written, details, now)}


def weather(sites: DataFrame, payloads: DataFrame, start_date: str, path: str, now: datetime) -> dict[str, int]:
    """Land weather rows by day; days that are landed again are replaced. Returns the run log."""
    rows = bronze.weather(sites, payloads, start_date, F.lit(now.isoformat()))
    counted, log = observed(rows, "weather", *run_counters())
    files.replace_partitions(
        files.with_month_partition(counted, "record_date"), path, ["year", "month", "record_date"]
    )
    return log.get


def weather_run(sites: DataFrame, payloads: DataFrame, start_date: str, path: str, now: datetime) -> dict[str, int]:
    """``weather`` with the sites in its log: how many were asked for, how many failed, and the days and files written."""
    with staged(sites, "sites") as asked, staged(payloads, "answers") as given:
        log = weather(asked, given, start_date, path, now)
        called = F.lit(now.isoformat())
        failed = F.count_if(F.col("__failure").isNotNull()).alias("sites_failed")
        counts = bronze.answers(asked, given, called).agg(F.count(F.lit(1)).alias("sites_requested"), failed).first()
    files_now = list_files(asked.sparkSession, path).count()
    return {**log, **counts.asDict(), "files": files_now}


def site_features(
    sites: DataFrame,
    payloads: DataFrame,
    root: str,
    now: datetime,
    ordinal: Sequence[str] = bronze.ORDINAL,
    radius_m: int = DEFAULT_RADIUS_M,
) -> dict[str, Any]:
    """Publish the features of all sites as the current snapshot; returns the run log."""
    rows = bronze.site_features(sites, payloads, F.lit(now), ordinal, radius_m)
    log = versions.refresh(rows, root, {"radius_m": radius_m}, run_counters(), now=now)
    return {**log, "deleted_files": versions.retain(sites.sparkSession, root)}


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """Watermark and covered ranges of every sensor that was asked for; empty before the first run."""
    if versions.current(spark, root) is None:
        return spark.createDataFrame([], SENSOR_STATE)
    return versions.read_current(spark, root, SENSOR_STATE)


def read_state(spark: SparkSession, root: str) -> DataFrame:
    """Watermarks of all sensors with readings."""
    return read_ledger(spark, root).select("sensor_id", st.LAST).where(F.col(st.LAST).isNotNull())


def _land_readings(
    spark: SparkSession,
    rows: DataFrame,
    requests: DataFrame,
    at: str,
    path: str,
    state_root: str,
    now: datetime,
    granularity: str,
    n: int | None = None,
) -> dict[str, int]:
    # Landed rows and watermarks must agree, so the batch is fixed first.
    with staged(rows, "readings") as batch:
        written = files.land(bronze.landed(batch, F.lit(now.isoformat()), granularity), path, F.lit(now), "json")
        ends = st.last_readings(batch, "sensor_id", F.col(at))
        asked = st.asked_ranges(requests, "sensor_id", batch, at, n)
        known = F.count(st.LAST).alias("sensors")
        # Another run may advance the state meanwhile; both then count.
        log = versions.update(
            spark, state_root, SENSOR_STATE, lambda old: st.advance_ledger(old, ends, asked, "sensor_id"), metrics=[known], now=now
        )
    versions.retain(spark, state_root)
    return {"written": written, "sensors": log["sensors"]}


def incremental_measurements(
    sensors: DataFrame,
    readings: DataFrame,
    path: str,
    state_root: str,
    now: datetime,
    at: str,
    lookback_days: int = 3,
    max_per_sensor: int | None = None,
    catch_up: bool = True,
) -> dict[str, int]:
    """Land the readings behind the watermarks as envelopes and advance the watermarks.

    A window begins behind the last reading of its sensor, but nothing is asked for
    twice: the ledger of covered ranges is taken off, so a sensor that sends nothing
    costs no more from run to run. Sensors that stopped before the lookback are
    read from where they stopped, unless ``catch_up`` is off; ``behind`` in the log
    counts those whose window begins before the lookback. The state is written
    last: a run that fails before is repeated with the same windows.
    """
    spark = sensors.sparkSession
    ledger, clock = read_ledger(spark, state_root), F.lit(now)
    earliest = clock - F.make_dt_interval(F.lit(lookback_days))
    windows = st.next_windows(sensors.select("sensor_id"), ledger, "sensor_id", clock, lookback_days, catch_up)
    with staged(st.open_windows(windows, ledger, "sensor_id"), "requests") as requests:
        early = F.col("date_from") < earliest
        behind = requests.agg(F.count_distinct(F.when(early, F.col("sensor_id"))), F.min(F.when(early, F.col("date_from")))).first()
        since = F.lit(behind[1]) if behind[0] else None
        rows = bronze.capped(bronze.requested_readings(readings, requests, earliest, clock, at, since), at, max_per_sensor)
        log = _land_readings(spark, rows, requests, at, path, state_root, now, "day", max_per_sensor)
    return {**log, "behind": behind[0] if catch_up else _stopped(sensors, ledger, earliest)}


def _stopped(sensors: DataFrame, ledger: DataFrame, earliest: Column) -> int:
    return st.stopped_before(sensors, ledger, "sensor_id", earliest).first()["sensors"]


def backfill_measurements(
    sensors: DataFrame,
    readings: DataFrame,
    path: str,
    state_root: str,
    start: datetime,
    end: datetime,
    now: datetime,
    at: str,
    max_per_window: int | None = None,
) -> dict[str, int]:
    """Land the readings of a range, month by month and sensor, and advance the watermarks.

    A range counts as covered unless ``max_per_window`` may have cut it short.
    """
    rows = bronze.backfill_measurements(sensors, readings, F.lit(start), F.lit(end), at, max_per_window)
    windows = sensors.select("sensor_id", F.lit(start).cast("timestamp").alias("date_from"), F.lit(end).cast("timestamp").alias("date_to"))
    asked = windows if max_per_window is None else windows.limit(0)
    return _land_readings(sensors.sparkSession, rows, asked, at, path, state_root, now, "measurement")
