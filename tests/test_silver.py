from __future__ import annotations

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from silverair import schemas
from silverair.operators.quality import QualityError
from silverair.plans import jobs, silver
from silverair.sinks import increments, versions
from silverair.sources.tables import scan

PM = ("2", "pm25", "ug/m3", "PM2.5")


def location(id, sensors, *, at="2026-01-01T00:00:00+00:00", country=(1, "Germany", "DE"), place="Bonn",
             coordinates=(50.7, 7.1), top=(None, None), name=None):
    return (id, name or f"site {id}", place, "Europe/Berlin", country, coordinates, *top, sensors, at, "url")


def locations(spark, *data):
    return spark.createDataFrame(list(data), schemas.LOCATIONS)


def sensor(id, parameter=PM):
    return (id, f"s{id}", parameter)


def test_sensor_location(spark):
    df = locations(
        spark,
        location(1, [sensor(10), sensor(11, ("x", "o3", "ppm", "O3"))]),
        location(1, [sensor(10)], at="2026-01-02T00:00:00.500000+00:00", name="renamed"),
        location(1, [sensor(10)], at="not a time", name="unknown time"),
        location(2, []),
        location(3, None),
        location(4, [sensor(12, None), (None, "s", PM)], country=None, coordinates=None),
        location(5, [sensor(13)], top=(1.0, 2.0)),
    )
    got = silver.sensor_location(df)
    assert got.columns == list(schemas.DIM_SENSOR_LOCATION.columns)
    kept = got.select("sys_unique_key", "location_name", "location_latitude", "country_code", "sensor_id", "sys_load_ts")
    assert rows(kept, "sys_unique_key") == [
        ("1_10", "renamed", 50.7, "DE", 10, datetime(2026, 1, 2, 0, 0, 0, 500000)),
        ("4", "site 4", None, None, None, datetime(2026, 1, 1)),
        ("5_13", "site 5", 1.0, "DE", 13, datetime(2026, 1, 1)),
    ]
    existing = spark.createDataFrame([("1_10",)], "sys_unique_key string")
    assert rows(silver.sensor_location(df, existing).select("sys_unique_key")) == [("4",), ("5_13",)]


def measurement(sensor_id, day, value="1.5", called="2026-02-01T00:00:00+00:00", end=None):
    return (sensor_id, "s", 2, "pm25", "ug/m3", "PM2.5", value, False, True, day, day, called, "url", ((end,),))


def reading(sensor_id, at, value, units="ug/m3", parameter="pm25"):
    return tuple(None if v is None else f'"{v}"' for v in (sensor_id, parameter, units, value, at))


def sources(spark, current, historical):
    return (
        spark.createDataFrame(current, schemas.MEASUREMENTS),
        spark.createDataFrame(historical, schemas.MEASUREMENTS_HISTORICAL),
    )


def test_sensor_measure(spark):
    current = [
        measurement(1, "2026-01-01", "1.0"),
        measurement(1, "2026-01-01", "2.0", "2026-02-01T00:00:00.000001+00:00"),
        measurement(1, "2026-01-02", None),
        measurement(2, "2026-01-01", "n/a"),
        measurement(None, "2026-01-01"),
        measurement(1, None),
    ]
    historical = [
        reading(1, "2026-01-01T10:00:00Z", 90),  # the API row wins
        reading(1, "2026-01-02T10:00:00Z", 91),  # even without a value
        reading(1, "2026-01-03T10:00:00Z", 3),
        reading(1, "2026-01-03T12:00:00Z", 5),
        reading(1, "2026-01-02T23:30:00-05:00", 7),  # 04:30 UTC on the third
        reading(1, "2026-01-03T11:00:00Z", "bad"),
        reading(1, "2026-01-03T11:00:00Z", 99, parameter="pm10"),
        reading(3, "2026-01-03T01:00:00Z", 10, units="a"),
        reading(3, "2026-01-03T02:00:00Z", 20, units="b"),  # later first reading
        reading(3, "3 January", 1),
        reading(None, "2026-01-03T01:00:00Z", 1),
        ("4", "pm25", "u", "8", "2026-01-03T01:00:00Z"),  # without quotes
    ]
    got = silver.sensor_measure(*sources(spark, current, historical))
    assert got.columns == [
        "sys_unique_key", "sensor_id", "sensor_name", "parameter_name", "parameter_units", "parameter_value",
        "load_date", "date_id", "sys_load_ts", "sys_source_from",
    ]
    short = got.select("sys_unique_key", "parameter_value", "sensor_name", "date_id", "sys_source_from")
    assert rows(short, "sys_unique_key") == [
        ("1-2026-01-01", 2.0, "s", "20260101", "url"),
        ("1-2026-01-02", None, "s", "20260102", "url"),
        ("1-2026-01-03", 5.0, "pm25 ug/m3", "20260103", "historical_openaq"),
        ("2-2026-01-01", None, "s", "20260101", "url"),
        ("3-2026-01-03", 20.0, "pm25 b", "20260103", "historical_openaq"),
        ("4-2026-01-03", 8.0, "pm25 u", "20260103", "historical_openaq"),
    ]
    first = got.filter("sys_unique_key = '1-2026-01-03'").select("sys_load_ts").first()[0]
    assert first == datetime(2026, 1, 3, 4, 30)
    assert got.count() == got.select("sensor_id", "load_date").distinct().count()


def test_date_basis_and_site_days(spark):
    current = [
        measurement(1, "2026-01-01", "1", end="2026-01-02T00:00:00Z"),
        measurement(1, "2026-01-01", "2", end="2026-01-03T00:00:00Z"),
        measurement(1, "2026-01-01", "3", end=None),
    ]
    historical = [reading(9, "2026-01-03T02:00:00Z", 1)]
    request = silver.sensor_measure(*sources(spark, current, historical))
    assert rows(request.select("sys_unique_key")) == [("1-2026-01-01",), ("9-2026-01-03",)]
    record = silver.sensor_measure(
        *sources(spark, current, historical), date_basis="record", zone=F.lit("America/New_York")
    )
    assert rows(record.select("sys_unique_key")) == [("1-2026-01-01",), ("1-2026-01-02",), ("9-2026-01-02",)]
    with pytest.raises(ValueError, match="date basis"):
        silver.current_measures(sources(spark, current, historical)[0], "day")


def test_result_does_not_depend_on_input_order(spark):
    rng = random.Random(2)
    current = [measurement(rng.randrange(4), f"2026-01-0{rng.randrange(1, 4)}", str(rng.randrange(9))) for _ in range(60)]
    historical = [reading(rng.randrange(6), f"2026-01-0{rng.randrange(1, 6)}T0{h}:00:00Z", h) for h in range(9) for _ in range(6)]
    want = None
    for parts in (1, 3, 8):
        rng.shuffle(current)
        rng.shuffle(historical)
        a, b = sources(spark, current, historical)
        got = rows(silver.sensor_measure(a.repartition(parts), b.repartition(parts)), "sys_unique_key")
        want = want or got
        assert got == want


def weather(location_id, day, called, status="success", lat=1.5, lon=-2.5, code=1):
    return (location_id, called, "DE", "Bonn", lat, lon, day, code, *[0.5] * 6, status, None)


def test_weather_fact(spark):
    raw = spark.createDataFrame(
        [
            weather(1, "2026-01-01", "2026-01-02T00:00:00+00:00", code=1),
            weather(2, "2026-01-01", "2026-01-04T00:00:00.250000+00:00", code=2),  # same coordinate
            weather(1, "2026-01-01", "2026-01-03T00:00:00+00:00", code=3),
            weather(1, "2026-01-01", "2026-01-09T00:00:00+00:00", status="error", code=4),
            weather(1, "2026-01-02", "2026-01-03T00:00:00+00:00", code=5),
            weather(None, "2026-01-03", "2026-01-03T00:00:00+00:00"),
            weather(1, None, "2026-01-03T00:00:00+00:00"),
            weather(1, "2026-01-03", "2026-01-03T00:00:00+00:00", lat=None),
            weather(1, "2026-01-03", "2026-01-03T00:00:00+00:00", lon=None),
        ],
        schemas.WEATHER,
    )
    got = silver.weather(raw)
    assert rows(got.select("dw_unique_key", "sys_source_id", "date_id", "weather_code"), "date_id") == [
        ("1.5--2.5-2026-01-01", "2", "20260101", 2),
        ("1.5--2.5-2026-01-02", "1", "20260102", 5),
    ]
    assert got.first()["sys_load_ts"] is not None
    known = spark.createDataFrame([("1.5--2.5-2026-01-01",)], "dw_unique_key string")
    assert rows(silver.weather(raw, known).select("weather_code")) == [(5,)]


def test_weather_filters_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([], schemas.WEATHER).write.parquet(str(tmp_path / "w"))
    text = plan(silver.latest_weather(scan(spark, str(tmp_path / "w"), schemas.WEATHER)))
    assert "EqualTo(status,success)" in text and "IsNotNull(lat)" in text and "IsNotNull(record_date)" in text
    assert "error_message" not in text and "country_name" not in text


def features(spark, data):
    full = [
        (pk, loc, "t", "DE", "Bonn", 1.0, 2.0, main, main, highways, "a", "b", radius, status, "")
        for pk, loc, main, highways, radius, status in data
    ]
    return spark.createDataFrame([(Decimal(key), *rest) for key, *rest in full], schemas.SITE_FEATURES)


def test_urbanity(spark):
    area = 3.141592653589793 * 9
    counts = [int(area * d) for d in (5.99, 6.05, 9.05, 12.05, 14.05)]
    data = [(i, 100 + i, n, highways, 300, "success") for i, (n, highways) in enumerate(zip(counts, [0, 0, 0, 7, 9], strict=True))]
    data += [(10, 110, None, 1, 300, "success"), (11, 111, 1, None, 300, "success"), (12, 112, 1, 1, 300, "error")]
    got = silver.urbanity(features(spark, data))
    assert rows(got, "location_id") == [
        ("100", 1, 1, 1), ("101", 2, 2, 2), ("102", 3, 3, 3), ("103", 4, 4, 4), ("104", 5, 5, 5),
    ]


def test_urbanity_with_few_rows_and_missing_ids(spark):
    # Three rows fill three of five buckets; a row without a site still takes its rank.
    data = [(1, None, 400, 1, None, "success"), (2, 7, 400, 2, None, "success"), (3, 8, 0, 3, 100, "success")]
    assert rows(silver.urbanity(features(spark, data)), "location_id") == [("7", 4, 5, 2), ("8", 2, 1, 3)]


def test_date_dimension(spark):
    calendar = silver.date_dimension(spark.range(1), F.lit(date(2020, 1, 1)), F.lit(date(2030, 12, 31)))
    assert calendar.columns == list(schemas.DIM_DATE.columns)
    assert [k for _, k in schemas.DIM_DATE.conform(calendar).dtypes] == [k for k, _ in schemas.DIM_DATE.columns.values()]
    spot = calendar.filter("sys_unique_key in ('20261129', '20270101', '20241230')").drop("full_date")
    assert rows(spot, "sys_unique_key") == [
        ("20241230", 2024, 4, 12, "December", 30, 2, "Monday", 1, False),
        ("20261129", 2026, 4, 11, "November", 29, 1, "Sunday", 48, True),
        ("20270101", 2027, 1, 1, "January", 1, 6, "Friday", 53, False),
    ]


def test_jobs_end_to_end(spark, tmp_path):
    nested = locations(spark, location(1, [sensor(10), sensor(11)]), location(2, [sensor(12)]))
    path = str(tmp_path / "dim")
    assert jobs.sensor_locations(nested.filter("id = 1"), path)["inserted"] == 2
    assert jobs.sensor_locations(nested, path)["inserted"] == 1
    assert jobs.sensor_locations(nested, path)["inserted"] == 0
    assert scan(spark, path, schemas.DIM_SENSOR_LOCATION.ddl).count() == 3

    root = str(tmp_path / "fact")
    for value in ("1", "2"):
        result = jobs.sensor_measures(*sources(spark, [measurement(1, "2026-01-01", value)], []), root)
    assert result["rows"] == 1 and result["deleted_files"] == 0
    stored = versions.read_current(spark, root, schemas.FACT_SENSOR_MEASURE.ddl)
    assert rows(stored.select("parameter_value")) == [(2.0,)]

    scored = jobs.urbanity_scores(features(spark, [(1, 5, 200, 1, 300, "success")]), str(tmp_path / "score"))
    assert scored["rows"] == 1
    calendar = jobs.dates(spark, date(2020, 1, 1), date(2030, 12, 31), str(tmp_path / "dates"))
    assert calendar["rows"] == 4018


def test_gate_keeps_bad_rows_out(spark, tmp_path):
    repeated = features(spark, [(1, 5, 200, 1, 300, "success"), (2, 5, 200, 2, 300, "success")])
    root = str(tmp_path / "score")
    with pytest.raises(QualityError, match=r"unique\(location_id\): 1"):
        jobs.urbanity_scores(repeated, root)
    assert versions.current(spark, root) is None


def test_jdbc_copies_see_the_written_rows(spark, tmp_path, monkeypatch):
    copies = []
    for name in ("append", "replace"):
        monkeypatch.setattr(jobs.warehouse, name, lambda df, table, options, how=name: copies.append((how, table.name, df.count(), dict(options))))
    options = {"url": "jdbc:postgresql://db/warehouse"}
    nested = locations(spark, location(1, [sensor(10)]))
    for _ in range(2):
        jobs.sensor_locations(nested, str(tmp_path / "dim"), options)
    jobs.dates(spark, date(2026, 1, 1), date(2026, 1, 31), str(tmp_path / "d"), options)
    assert copies == [
        ("append", "dim_sensor_location", 1, options),
        ("append", "dim_sensor_location", 0, options),
        ("replace", "dim_date", 31, options),
    ]


def test_bad_rows_are_kept_beside_the_target(spark, tmp_path):
    good, bad = weather(1, "2026-01-02", "2026-01-03T00:00:00+00:00"), weather(1, "no day", "2026-01-03T00:00:00+00:00")
    raw = spark.createDataFrame([good, bad], schemas.WEATHER)
    path = str(tmp_path / "w")
    logs = [jobs.weather(raw, path) for _ in range(3)]
    assert logs == [{"inserted": 1, "quarantined": 1}] + [{"inserted": 0, "quarantined": 0}] * 2
    assert spark.read.parquet(path).count() == 1
    aside = spark.read.parquet(increments.quarantine_path(path))
    assert [r.broken_rules for r in aside.collect()] == [["not_null(date_id)"]]


def test_ungated_job_writes_what_it_gets_once(spark, tmp_path):
    raw = spark.createDataFrame([weather(1, "no day", "2026-01-03T00:00:00+00:00")], schemas.WEATHER)
    late = spark.createDataFrame([weather(1, "2020-01-01", "2026-01-03T00:00:00+00:00")], schemas.WEATHER)
    got = [jobs.weather(df, str(tmp_path / "w"), gated=False)["inserted"] for df in (raw, raw, raw.union(late), late)]
    assert got == [1, 0, 1, 0]


def test_a_failed_copy_is_made_up_for(spark, tmp_path, monkeypatch):
    raw = spark.createDataFrame([weather(1, "2026-01-02", "2026-01-03T00:00:00+00:00")], schemas.WEATHER)
    more = spark.createDataFrame([weather(1, "2026-01-04", "2026-01-05T00:00:00+00:00")], schemas.WEATHER)
    copied, path = [], str(tmp_path / "w")

    def append(df, table, options):
        if options["fail"]:
            raise ConnectionError
        copied.extend(r.date_id for r in df.collect())

    monkeypatch.setattr(jobs.warehouse, "append", append)
    with pytest.raises(ConnectionError):
        jobs.weather(raw, path, {"fail": True})
    assert spark.read.parquet(path).count() == 1 and copied == []
    assert jobs.weather(more, path, {"fail": False})["inserted"] == 1
    assert copied == ["20260102", "20260104"] and spark.read.parquet(path).count() == 2


def test_catalog_tables_follow_the_jobs(spark, tmp_path):
    for value in ("1", "2"):
        measures = sources(spark, [measurement(1, "2026-01-01", value)], [])
        jobs.sensor_measures(*measures, str(tmp_path / "it's fact"), catalog_table="fact_sensor_measure")
        assert rows(spark.table("fact_sensor_measure").select("parameter_value")) == [(float(value),)]
    nested = locations(spark, location(1, [sensor(10)]))
    for _ in range(2):
        jobs.sensor_locations(nested, str(tmp_path / "dim"), catalog_table="dim_sensor_location")
    assert spark.table("dim_sensor_location").count() == 1
    for name in ("fact_sensor_measure", "dim_sensor_location"):
        spark.sql(f"DROP TABLE {name}")


def test_label_filter_reaches_the_scan(spark, tmp_path):
    labels = ["pm25", '"pm25"', '"pm25', 'pm25"', '""pm25""', "pm10", '"pm25 "', None]
    data = [("1", label, "u", "1", f"2026-01-0{i + 1}T00:00:00Z") for i, label in enumerate(labels)]
    spark.createDataFrame(data, schemas.MEASUREMENTS_HISTORICAL).write.parquet(str(tmp_path / "h"))
    clean = silver.clean_readings(scan(spark, str(tmp_path / "h"), schemas.MEASUREMENTS_HISTORICAL))
    assert sorted(r[0].day for r in clean.select("day").collect()) == [1, 2, 3, 4]
    assert "In(parameter, [" in plan(clean).split("PushedFilters")[1]
