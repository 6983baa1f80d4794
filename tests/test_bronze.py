from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from helpers import plan, rows
from silverair import schemas
from silverair.operators import state
from silverair.operators.nested import unwrap_envelope
from silverair.plans import bronze
from test_silver import PM, location, locations, sensor

CALLED = "2026-04-30T10:15:30.000000+00:00"


def ordered(df):
    return df.withColumn("ordinal", F.col("id"))


def test_sensors_last_entry_wins(spark):
    df = locations(
        spark,
        location(1, [sensor(10), sensor(10, ("2", "late", "u", "d")), sensor(11, ("2.0", *PM[1:])), sensor(12, ("x", *PM[1:]))]),
        location(2, [sensor(20), (None, "no id", PM), sensor(21, None)], country=None, coordinates=None),
        location(3, [sensor(20, ("2", "newest", "u", "d"))], place=None),
        location(4, None),
        location(5, []),
    )
    got = bronze.sensors(ordered(df), ["ordinal"])
    assert got.columns == [
        "sensor_id", "sensor_name", "parameter_id", "parameter_name", "parameter_units", "parameter_display_name",
        "location_id", "location_name", "locality", "timezone", "country_id", "country_code", "country_name",
        "location_latitude", "location_longitude",
    ]
    assert rows(got.select("sensor_id", "parameter_name", "location_id", "locality"), "sensor_id") == [
        (10, "late", 1, "Bonn"),
        (20, "newest", 3, None),
    ]


def test_sites_keep_the_first_of_a_key(spark):
    df = locations(
        spark,
        location(1, None, place=None),
        location(2, None, place=None),
        location(3, None, coordinates=None),
        location(4, None, country=None),
        location(5, None, coordinates=(50.7, None)),
        location(6, None, coordinates=(50.8, 7.1)),
    )
    got = bronze.sites(ordered(df), ["ordinal"])
    assert rows(got.select("location_id"), "location_id") == [(1,), (4,), (6,)]
    assert rows(bronze.sites(ordered(df), ["ordinal"], limit=2).select("location_id"), "location_id") == [(1,), (4,)]
    unknown = ordered(df).withColumn("id", F.when(F.col("id") != 6, F.col("id")))
    assert bronze.sites(unknown, ["ordinal"]).count() == 2
    assert bronze.sites(unknown, ["ordinal"], required=["latitude", "longitude"]).count() == 3


def sites(spark, *ids):
    schema = "location_id bigint, country_name string, city_or_locality string, longitude double, latitude double, ordinal int"
    return spark.createDataFrame([(i, "Germany", "Bonn", 7.1, 50.7, -i) for i in ids], schema)


def test_weather_rows_and_error_rows(spark):
    daily = (["2026-01-01", "2026-01-02"], [1], [0.1, 0.2, 0.3], None, [], [0.5, None], [1.0, 2.0], [3.0, 4.0])
    payloads = spark.createDataFrame(
        [(1, daily, None), (2, None, None), (3, daily, "HTTP 500"), (4, None, "bad JSON"), (5, ([],) + (None,) * 7, None)],
        schemas.WEATHER_PAYLOADS,
    )
    got = bronze.weather(sites(spark, 1, 2, 3, 4, 5, 6), payloads, "2026-01-01", F.lit(CALLED))
    assert got.columns == [c.strip().split()[0] for c in schemas.WEATHER.split(",")]
    short = got.select("location_id", "record_date", "weather_code", "precipitation_sum", "snowfall_sum", "status", "error_message")
    assert rows(short, "location_id", "record_date") == [
        (1, "2026-01-01", 1, 0.1, 0.5, "success", None),
        (1, "2026-01-02", None, 0.2, None, "success", None),
        (3, "2026-01-01", None, None, None, "error", "HTTP 500"),
        (4, "2026-01-01", None, None, None, "error", "bad JSON"),
        (6, "2026-01-01", None, None, None, "error", "no response"),
    ]


def test_site_features(spark):
    payloads = spark.createDataFrame(
        [
            (1, [("way", 1, {"building": "yes"}), ("way", 2, {"highway": "primary"})], None),
            (2, None, "timeout"),
            (3, [], None),
        ],
        schemas.ELEMENT_PAYLOADS,
    )
    at = F.lit("2026-04-30 10:15:30").cast("timestamp")
    got = bronze.site_features(sites(spark, 1, 2, 3, 4), payloads, at, ["ordinal"])
    assert got.columns == StructType.fromDDL(schemas.SITE_FEATURES).names
    assert got.first()["api_call_timestamp"] == "2026-04-30T10:15:30.000000Z"
    short = got.select(
        F.col("sys_primary_key").cast("bigint"), "location_id", "building_count_all", "main_building_count", "highway_count",
        "area_tag", "radius_m", "status", "error_message",
    )
    assert rows(short, "location_id") == [
        (20260430101530004, 1, 1, 1, 1, "unknown", 300, "success", ""),
        (20260430101530003, 2, None, None, None, None, 300, "error", "timeout"),
        (20260430101530002, 3, 0, 0, 0, "unknown", 300, "success", ""),
        (20260430101530001, 4, None, None, None, None, 300, "error", "no response"),
    ]


def test_features_around(spark):
    near = spark.createDataFrame([(1, 50.0, 7.0), (2, 0.0, 0.0)], "location_id bigint, lat double, lon double")
    elements = spark.createDataFrame(
        [
            ("way", 1, {"building": "house"}, 50.001, 7.001),
            ("way", 1, {"building": "house"}, 50.001, 7.001),
            ("way", 2, {"building": "garage"}, 50.0, 7.0),
            ("way", 3, {"highway": "x"}, 50.002, 7.0),
            ("way", 4, {"highway": "x"}, 50.01, 7.0),  # 1.1 km away
            ("way", 5, {"landuse": "far"}, 50.002, 7.0),
            ("way", 6, {"landuse": "near"}, 50.001, 7.0),
        ],
        "type string, id bigint, tags map<string,string>, lat double, lon double",
    )
    assert rows(bronze.features_around(near, elements).drop("lat", "lon"), "location_id") == [
        (1, 2, 1, 1, "landuse=near", "landuse"),
        (2, 0, 0, 0, "unknown", "fallback"),
    ]


def record(**given):
    """JSON text of a reading; ``__`` in a name leads to a nested field."""
    nested: dict = {}
    for name, value in given.items():
        *outer, last = name.split("__")
        at = nested
        for part in outer:
            at = at.setdefault(part, {})
        at[last] = value
    return json.dumps(nested)


@pytest.mark.parametrize("case_sensitive", ["false", "true"])
def test_end_time_tries_all_paths_in_order(spark, case_sensitive):
    spark.conf.set("spark.sql.caseSensitive", case_sensitive)
    data, want = [], []
    for hour, path in enumerate(schemas.END_TIME_PATHS):
        later = {p.replace(".", "__"): "2026-01-09T00:00:00Z" for p in schemas.END_TIME_PATHS[hour + 1 :]}
        data.append((hour, record(**{path.replace(".", "__"): f"2026-01-01T0{hour}:00:00Z", **later})))
        want.append((hour, datetime(2026, 1, 1, hour)))
    data += [(8, record(date__utc="", datetimeTo="2026-01-02T00:00:00Z")), (9, record(value=1.0)), (10, record(date__utc="bad"))]
    want += [(8, datetime(2026, 1, 2)), (9, None), (10, None)]
    df = spark.createDataFrame(data, f"n int, record {schemas.READING}")
    try:
        assert rows(df.select("n", bronze.end_time("record").alias("t")), "n") == want
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_landed_json_keeps_fields_that_differ_by_case(spark, tmp_path):
    records = [
        {"value": 1.5, "period": {"datetimeto": {"utc": "2026-01-01T01:00:00Z"}, "datetimeTo": {"utc": "2026-01-01T02:00:00Z"}}},
        {"value": 2.5, "period": {"datetimeTo": {"utc": "2026-01-01T03:00:00Z"}}, "datetimeTo": "2026-01-01T04:00:00Z"},
        {"value": 3.5, "coverage": {"datetimeto": {"utc": ""}}, "datetimeto": {"utc": "2026-01-01T05:00:00Z"}},
        {"value": 4.5, "date": {"utc": None}},
    ]
    sys = {"load_date": "2026-01-02", "source": "s", "sensor_id": 7, "granularity": "day"}
    (tmp_path / "landed.json").write_text("\n".join(json.dumps({"data": r, "sys": sys}) for r in records) + '\n{"data": {')
    landed = spark.read.schema(schemas.ENVELOPE).json(str(tmp_path / "landed.json")).filter("sys is not null")
    value = F.get_json_object("data", "$.value").cast("double").alias("value")
    ends = landed.select(value, bronze.end_time("data").alias("at"), F.col("sys.sensor_id").alias("s"))
    assert [(v, at and at.hour) for v, at, _ in rows(ends, "value")] == [(1.5, 1), (2.5, 3), (3.5, 5), (4.5, None)]
    assert rows(state.last_readings(ends, "s", F.col("at"))) == [(7, datetime(2026, 1, 1, 5))]


def test_measurements(spark):
    def value(v):
        return record(value=v, period__datetimeto__utc="x", period__datetimeTo__utc="2026-01-02T00:00:00Z", coverage__n=v)

    pages = spark.createDataFrame(
        [
            ("a", 1, 10, [value(1.0), value(2.0)], "u1", "t1"),
            ("a", 2, 10, [value(3.0)], "u2", "t2"),
            ("a", 3, 10, [], "u3", "t3"),
            ("b", 1, 11, [], "u4", "t4"),
            ("c", 1, 99, [value(9.0)], "u5", "t5"),
        ],
        schemas.MEASUREMENT_PAGES,
    )
    sensors = bronze.sensors(ordered(locations(spark, location(1, [sensor(10), sensor(11)]))), ["ordinal"])
    got = bronze.measurements(pages, sensors, ("historical", "2026-01-01", "2026-01-31"))
    short = got.select("sensor_id", "value", "historical_load", "load_date_from", "api_call_timestamp", "sys_source_from", "period.datetimeTo.utc")
    end = "2026-01-02T00:00:00Z"
    assert rows(short, "value") == [
        (10, 1.0, True, "2026-01-01", "t1", "u1", end),
        (10, 2.0, True, "2026-01-01", "t1", "u1", end),
        (10, 3.0, True, "2026-01-01", "t2", "u2", end),
    ]
    capped = bronze.measurements(pages, sensors, ("daily", "2026-01-01", "2026-01-31"), max_records=1)
    assert rows(capped.select("value", "historical_load")) == [(1.0, False)]


def readings(spark, *data):
    return spark.createDataFrame([(s, datetime(2026, 1, *at)) for s, *at in data], "sensor_id int, at timestamp")


def test_two_incremental_runs_and_their_gap(spark):
    sensors = spark.createDataFrame([(1,), (2,)], "sensor_id int")
    data = readings(spark, (1, 8), (1, 9), (1, 19), (1, 30), (2, 3), (2, 31), (9, 9))
    watermarks = spark.createDataFrame([], "sensor_id int, last_timestamp timestamp")
    taken = []
    for day in (10, 21, 31):
        now = F.lit(datetime(2026, 1, day))
        batch = bronze.incremental_measurements(sensors, data, watermarks, now, "at")
        taken.append([(s, at.day) for s, at in rows(batch.select("sensor_id", "at"), "sensor_id", "at")])
        last = state.last_readings(batch, "sensor_id", F.col("at"))
        watermarks = state.advance_state(watermarks, last, "sensor_id")
    # The third of January is older than the lookback of the first run: a lasting gap.
    assert taken == [[(1, 8), (1, 9)], [(1, 19)], [(1, 30), (2, 31)]]
    assert rows(watermarks, "sensor_id") == [(1, datetime(2026, 1, 30)), (2, datetime(2026, 1, 31))]


def test_cap_per_sensor_and_per_month(spark):
    sensors = spark.createDataFrame([(1,)], "sensor_id int")
    data = readings(spark, (1, 9), (1, 8), (1, 10)).unionByName(
        readings(spark, (1, 5), (1, 6)).withColumn("at", F.add_months("at", 1).cast("timestamp"))
    )
    empty = spark.createDataFrame([], "sensor_id int, last_timestamp timestamp")
    now = F.lit(datetime(2026, 1, 10))
    one = bronze.incremental_measurements(sensors, data, empty, now, "at", max_per_sensor=1)
    assert [r.at.day for r in one.collect()] == [8]
    start, end = F.lit(datetime(2026, 1, 9)), F.lit(datetime(2026, 3, 1))
    whole = bronze.backfill_measurements(sensors, data, start, end, "at")
    assert [(r.at.month, r.at.day) for r in whole.orderBy("at").collect()] == [(1, 9), (1, 10), (2, 5), (2, 6)]
    capped = bronze.backfill_measurements(sensors, data, start, end, "at", max_per_window=1)
    assert [(r.at.month, r.at.day) for r in capped.orderBy("at").collect()] == [(1, 9), (2, 5)]


def test_landed_envelopes_read_back(spark):
    wrapped = bronze.landed(readings(spark, (1, 9)), F.lit(CALLED), "day")
    assert wrapped.select("sys.*").first().asDict() == {
        "load_date": CALLED, "source": "openaq_lambda", "sensor_id": 1, "granularity": "day",
    }
    assert unwrap_envelope(wrapped).select("at").first()[0] == datetime(2026, 1, 9)


def test_windows_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "readings")
    readings(spark, (1, 8), (1, 9)).write.parquet(path)
    stored = spark.read.parquet(path)
    sensors = spark.createDataFrame([(1,), (1,)], "sensor_id int")
    watermarks = spark.createDataFrame([], "sensor_id int, last_timestamp timestamp")
    frames = [
        bronze.incremental_measurements(sensors, stored, watermarks, F.lit(datetime(2026, 1, 10)), "at"),
        bronze.backfill_measurements(sensors, stored, F.lit(datetime(2026, 1, 1)), F.lit(datetime(2026, 1, 31)), "at"),
    ]
    for frame in frames:
        assert len(rows(frame)) == 2
        text = plan(frame)
        assert "GreaterThanOrEqual(at" in text and "LessThanOrEqual(at" in text


def test_a_backfill_joins_sensors_and_not_their_months(spark):
    sensors = spark.range(2000).select(F.col("id").alias("sensor_id")).unionByName(spark.range(10).select(F.col("id").alias("sensor_id")))
    at = F.lit(datetime(2016, 1, 1)) + F.make_interval(days=F.col("id") % 4000, secs=(F.col("id") % 7).cast("decimal(18,6)"))
    data = spark.range(6000).select((F.col("id") % 3000).alias("sensor_id"), F.col("id").alias("value"), at.alias("at"))
    start, end = F.lit(datetime(2017, 3, 5, 12)), F.lit(datetime(2025, 2, 10))
    found = bronze.backfill_measurements(sensors, data, start, end, "at")
    want = data.where(F.col("at").between(start, end) & (F.col("sensor_id") < 2000))
    assert rows(found) == rows(want) and found.columns == ["sensor_id", "value", "at"]
    text = plan(found)
    # A hundred months of each sensor would be generated.
    assert "Generate" not in text and "LeftSemi" in text
