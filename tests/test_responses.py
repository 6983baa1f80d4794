from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import functions as F

from helpers import rows
from silverair import schemas
from silverair.plans import bronze, landing
from silverair.sources.files import read_results, response_shape, result_errors
from silverair.sources.tables import scan
from test_bronze import sites

NOW = datetime(2026, 4, 30, 10, tzinfo=UTC)
ITEM = "struct<value: double, id: bigint>"


def put(spark, path: str, *lines: str) -> str:
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    return path


def test_every_misshapen_answer_and_element_is_an_error_row(spark, tmp_path):
    path = put(
        spark,
        str(tmp_path / "answers"),
        '{"results": [{"value": 1.5, "id": 3, "more": [1]}], "url": "a"}',
        '{"results": {"value": 2}}',
        '{"error": "busy"}',
        '{"results": [{"value": "x", "id": 4}, {"value": null}, {"id": "7"}, {"id": 1.5, "value": true}], "url": "b"}',
        '{"results": [',
        "[1]",
        '{"results": []}',
        "  ",
    )
    found = result_errors(spark, path, ITEM)
    got = rows(found.select(F.regexp_replace("sys_source_from", "^file:.*", "file"), "error_message", "payload"))
    assert got == sorted(
        [
            ("file", "unexpected response: OBJECT<results: OBJECT<value: BIGINT>>", '{"results": {"value": 2}}'),
            ("file", "unexpected response: OBJECT<error: STRING>", '{"error": "busy"}'),
            ("b", "unexpected type: value", '{"id":4,"value":"x"}'),
            ("b", "unexpected type: id", '{"id":"7"}'),
            ("b", "unexpected type: value, id", '{"id":1.5,"value":true}'),
            ("file", "unreadable response", '{"results": ['),
            ("file", "unexpected response: ARRAY<BIGINT>", "[1]"),
        ],
        key=repr,
    )
    assert read_results(spark, path, ITEM).where("value = 1.5 and id = 3").count() == 1


def test_shape_of_good_answers(spark, tmp_path):
    path = put(spark, str(tmp_path / "a"), '{"results": [{"id": 1}]}', '{"results": [{"id": 2, "value": 1.5}], "url": "u"}', "{")
    assert rows(response_shape(spark, path)) == [("OBJECT<results: ARRAY<OBJECT<id: BIGINT, value: DECIMAL(2,1)>>, url: STRING>", 2)]
    assert result_errors(spark, put(spark, str(tmp_path / "b"), '{"results": [{"id": 1}]}'), ITEM).count() == 0


def location(i: int, *sensors: tuple[int, object], **other) -> dict:
    parameter = {"name": "pm25", "units": "u", "displayName": "PM"}
    return {"id": i, "name": f"l{i}", "sensors": [{"id": s, "name": f"s{s}", "parameter": {"id": p, **parameter}} for s, p in sensors], **other}


def test_locations_to_the_sensors_of_a_batch(spark, tmp_path):
    answers = put(
        spark,
        str(tmp_path / "answers"),
        json.dumps({"results": [location(1, (11, 2), (12, 7)), location(2, (13, "2"), (11, 2))], "url": "u"}),
        json.dumps({"results": [location(3, (10, 2), (14, 2)), location(4, sensors=None)], "url": "u"}),
        '{"results": "none"}',
    )
    root = str(tmp_path / "landed")
    batch, log = landing.locations(spark, answers, root, NOW, (1, 3))
    assert log == {"locations": 4, "sensors": 4, "errors": 1}
    assert rows(batch.select("sensor_id", "location_id", "parameter_id")) == [(11, 2, 2), (13, 2, 2)]
    everything = scan(spark, f"{root}/sensors", schemas.SENSORS + ", year string, month string, day string, run string")
    assert rows(everything.select("sensor_id", "location_id", "day"), "sensor_id") == [(10, 3, "30"), (11, 2, "30"), (13, 2, "30"), (14, 3, "30")]
    assert spark.read.parquet(f"{root}/errors").first().error_message.startswith("unexpected response")
    # Its result is what the next jobs take.
    asked, _ = landing.locations(spark, answers, root, NOW)
    assert asked.count() == 4 and asked.columns[:2] == ["sensor_id", "sensor_name"]


def test_a_run_without_locations_has_no_sensors(spark, tmp_path):
    answers = put(spark, str(tmp_path / "answers"), '{"results": []}')
    batch, log = landing.locations(spark, answers, str(tmp_path / "landed"), NOW)
    assert batch.count() == 0 and log == {"locations": 0, "sensors": 0, "errors": 0}


def test_from_landed_answers_to_the_state(spark, tmp_path):
    """Locations, the pages of their sensors, the end times of the records, and the watermarks."""
    root, state = str(tmp_path / "landed"), str(tmp_path / "state")
    answers = put(spark, str(tmp_path / "answers"), json.dumps({"results": [location(1, (11, 2), (12, 2))], "url": "u"}))
    sensors, _ = landing.locations(spark, answers, root, NOW)
    ends = ["2026-04-28T00:00:00Z", "2026-04-29T00:00:00Z"]
    page = [(json.dumps({"value": 1.0, "period": {"datetimeTo": {"utc": end}}})) for end in ends] + ['{"value": 2.0}']
    pages = spark.createDataFrame([("r", 1, 11, "u", "t", page)], "request_id string, page int, sensor_id bigint, url string, called_at string, results array<string>")
    readings = bronze.ended_readings(bronze.measurements(pages, sensors, ("daily", "2026-04-27", "2026-04-30")))
    log = landing.incremental_measurements(sensors, readings, f"{root}/measurements", state, NOW, "at")
    assert (log["written"], log["behind"]) == (2, 0)
    assert rows(landing.read_state(spark, state)) == [(11, datetime(2026, 4, 29))]
    assert landing.read_ledger(spark, state).count() == 2


def test_weather_log_counts_sites_and_files(spark, tmp_path):
    def payload(site, error=None):
        return (site, (["2026-04-28", "2026-04-29"], [1] * 2, *[[0.5] * 2] * 6), error)

    answers = spark.createDataFrame([payload(1), payload(2, "HTTP 500")], schemas.WEATHER_PAYLOADS)
    log = landing.weather_run(sites(spark, 1, 2, 3), answers, "2026-04-28", str(tmp_path / "w"), NOW)
    assert log == {"processed": 4, "succeeded": 2, "failed": 2, "sites_requested": 3, "sites_failed": 2, "files": 2}
