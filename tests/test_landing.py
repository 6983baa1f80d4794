from __future__ import annotations

import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from helpers import rows
from silverair import schemas
from silverair.operators.nested import unwrap_envelope
from silverair.plans import landing
from silverair.sinks import versions
from silverair.sources.tables import scan
from test_bronze import readings, sites

NOW = datetime(2026, 4, 30, 10, 15, 30, tzinfo=UTC)
PAGES = (
    "request_id string, page int, sensor_id bigint, url string, called_at string, "
    "results array<struct<value: double, period: struct<datetimeTo: struct<utc: string>>>>"
)


def test_measurements_are_landed_under_the_run_and_pointed_to(spark, tmp_path):
    root = str(tmp_path / "measurements")
    fields = "sensor_id bigint, sensor_name string, parameter_id int, parameter_name string, parameter_units string, parameter_display_name string"
    sensors = spark.createDataFrame([(10, "s", 2, "pm25", "u", "d"), (11, "t", 2, "pm25", "u", "d")], fields)
    window = ("daily", "2026-04-29", "2026-04-30")
    empty = spark.createDataFrame([("a", 1, 10, "u", "t", [])], PAGES)
    assert landing.measurements(empty, sensors, window, root, NOW) is None
    assert versions.current(spark, root) is None
    for value in (1.0, 2.0):
        pages = spark.createDataFrame([("a", 1, 10, "u", "t", [(value, None), (value, None)])], PAGES)
        pointer = landing.measurements(pages, sensors, window, root, NOW)
    assert pointer["rows"] == 2 and pointer["sensors_count"] == 2 and not pointer["historical_load"]
    assert f"{root}/data/year=2026/month=04/day=30/run=" in pointer["path"]
    assert json.loads(versions.current(spark, root)["details"])["date_from"] == "2026-04-29"
    latest = versions.read_current(spark, root, "sensor_id bigint, value double, load_date_to string")
    assert rows(latest) == [(10, 2.0, "2026-04-30")] * 2
    every = scan(spark, f"{root}/data", "value double, year string, month string, day string, run string")
    assert every.count() == 4


def test_weather_replaces_days_and_logs_the_run(spark, tmp_path):
    path = str(tmp_path / "weather")

    def payload(site, code, error=None):
        return (site, (["2026-04-28", "2026-04-29"], [code] * 2, *[[0.5] * 2] * 6), error)

    first = spark.createDataFrame([payload(1, 1), payload(2, 1, "HTTP 500")], schemas.WEATHER_PAYLOADS)
    assert landing.weather(sites(spark, 1, 2), first, "2026-04-28", path, NOW) == {"processed": 3, "succeeded": 2, "failed": 1}
    again = spark.createDataFrame([(1, (["2026-04-29"], [9], *[[0.5]] * 6), None)], schemas.WEATHER_PAYLOADS)
    landing.weather(sites(spark, 1), again, "2026-04-29", path, NOW)
    stored = scan(spark, path, schemas.WEATHER + ", year string, month string")
    assert rows(stored.select("location_id", "record_date", "weather_code", "status"), "record_date", "location_id") == [
        (1, "2026-04-28", 1, "success"), (2, "2026-04-28", None, "error"), (1, "2026-04-29", 9, "success"),
    ]


def test_site_features_keep_two_snapshots(spark, tmp_path):
    root = str(tmp_path / "features")
    payloads = spark.createDataFrame([(1, [("way", 1, {"highway": "x"})], None), (2, None, "timeout")], schemas.ELEMENT_PAYLOADS)
    logs = [landing.site_features(sites(spark, 1, 2), payloads, root, NOW, ["ordinal"]) for _ in range(2)]
    assert [(log["processed"], log["succeeded"], log["failed"]) for log in logs] == [(2, 1, 1)] * 2
    assert [log["deleted_files"] for log in logs] == [0, 0] and versions.manifest(spark, root).count() == 2
    stored = versions.read_current(spark, root, schemas.SITE_FEATURES)
    assert rows(stored.select("sys_primary_key", "location_id", "highway_count"), "location_id") == [
        (20260430101530002, 1, 1), (20260430101530001, 2, None),
    ]


def test_incremental_runs_continue_from_the_written_state(spark, tmp_path):
    path, state = str(tmp_path / "landed"), str(tmp_path / "state")
    sensors = spark.createDataFrame([(1,), (2,)], "sensor_id int")
    data = readings(spark, (1, 8), (1, 9), (1, 19), (2, 20))
    start, end = datetime(2026, 1, 8, tzinfo=UTC), datetime(2026, 1, 8, 23, tzinfo=UTC)
    logs = [landing.backfill_measurements(sensors, data, path, state, start, end, datetime(2026, 1, 9, tzinfo=UTC), "at")]
    for day in (10, 10, 21):
        now = datetime(2026, 1, day, tzinfo=UTC)
        logs.append(landing.incremental_measurements(sensors, data, path, state, now, "at"))
    assert [log["written"] for log in logs] == [1, 1, 0, 2]
    assert [log["sensors"] for log in logs] == [1, 1, 1, 2]
    assert [log.get("behind") for log in logs] == [None, 0, 0, 1]
    schema = (
        "data struct<at: timestamp>, sys struct<load_date: string, source: string, sensor_id: int, granularity: string>, "
        "year string, month string, day string"
    )
    landed = unwrap_envelope(scan(spark, path, schema, "json")).select("sensor_id", F.dayofmonth("at"), "granularity")
    assert rows(landed) == [(1, 19, "day"), (1, 8, "measurement"), (1, 9, "day"), (2, 20, "day")]
    assert rows(landing.read_state(spark, state), "sensor_id") == [(1, datetime(2026, 1, 19)), (2, datetime(2026, 1, 20))]
