from __future__ import annotations

from datetime import UTC, date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import rows, values
from silverair.functions import elements, scoring, text, times


def ask(spark, item, build, kind="string"):
    return values(spark, "v", [item], kind).select(build(F.col("v")).alias("r")).first()[0]


@pytest.mark.parametrize(
    ("given", "want"),
    [('"a"\n', "a\n"), ("\n", "\n"), ('a\n"', "a\n"), ('"\r\n', "\r\n"), ('"é"', "é"), ("", ""), ('"a"', "a"), ("a", "a"), ('"a"b"', 'a"b'), ('""', ""), ('"', ""), ('a"b', 'a"b'), (None, None)],
)
def test_strip_quotes(spark, given, want):
    assert ask(spark, given, text.strip_quotes) == want


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text('"a\n\r\u2028é', max_size=5), min_size=1, max_size=60))
def test_strip_quotes_equals_the_pattern(texts, spark):
    df = values(spark, "v", texts)
    pattern = F.regexp_replace("v", '^"|"$', "")
    assert df.filter(text.strip_quotes("v") != pattern).isEmpty()


def test_natural_key_skips_nulls_and_is_never_null(spark):
    df = spark.createDataFrame([(1, "x", 2.5), (None, None, None), (7, None, -0.125)], "a int, b string, c double")
    assert rows(df.select(text.natural_key("-", "a", "b", "c"))) == [("",), ("1-x-2.5",), ("7--0.125",)]


def test_first_present_skips_null_and_blank(spark):
    df = spark.createDataFrame([(None, "", "c"), ("a", "b", None), (None, "", "")], "x string, y string, z string")
    assert rows(df.select(text.first_present("x", "y", "z"))) == [("a",), ("c",), (None,)]


def test_list_items(spark):
    assert ask(spark, " 92,22, ,54,, 110 ", text.list_items) == ["92", "22", "54", "110"]
    assert ask(spark, "", text.list_items) == []


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("2026-01-02T03:04:05.123456+00:00", datetime(2026, 1, 2, 3, 4, 5, 123456)),
        ("2026-01-02T03:04:05+00:00", datetime(2026, 1, 2, 3, 4, 5)),
        ("2026-01-02T03:04:05+02:00", datetime(2026, 1, 2, 1, 4, 5)),
        ("2026-01-02", None),
        ("never", None),
        (None, None),
    ],
)
def test_load_instant(spark, given, want):
    assert ask(spark, given, times.load_instant) == want


def test_reading_instant_and_utc_day(spark):
    assert ask(spark, "2026-01-02T23:30:00Z", times.reading_instant) == datetime(2026, 1, 2, 23, 30)
    shifted = "2026-01-02T23:30:00-05:00"
    assert ask(spark, shifted, lambda c: times.local_day(times.reading_instant(c))) == date(2026, 1, 3)
    assert ask(spark, shifted, lambda c: times.local_day(times.reading_instant(c), F.lit("America/New_York"))) == date(2026, 1, 2)
    assert ask(spark, "02.01.2026", times.reading_instant) is None


def test_iso_instant_accepts_what_the_state_may_hold(spark):
    assert ask(spark, "2026-01-02T03:04:05.5Z", times.iso_instant) == datetime(2026, 1, 2, 3, 4, 5, 500000)
    assert ask(spark, "2026-01-02", times.iso_instant) == datetime(2026, 1, 2)
    assert ask(spark, "soon", times.iso_instant) is None


def test_normalise_iso(spark):
    assert ask(spark, " 2024-05-01 ", times.normalise_iso) == "2024-05-01T00:00:00+00:00"
    assert ask(spark, "2024-05-01", lambda c: times.normalise_iso(c, end_of_day=True)) == "2024-05-01T23:59:59+00:00"
    assert ask(spark, "2024-05-01T10:00:00Z", times.normalise_iso) == "2024-05-01T10:00:00Z"
    assert ask(spark, "  ", times.normalise_iso) is None


def test_run_labels(spark):
    at = datetime(2026, 4, 30, 10, 15, 30)
    assert ask(spark, at, times.run_partition, "timestamp") == "year=2026/month=04/day=30"
    assert ask(spark, at, times.run_number, "timestamp") == 20260430101530
    assert ask(spark, at, times.month_start, "timestamp") == datetime(2026, 4, 1)
    assert ask(spark, datetime(2026, 12, 31, 5), times.next_month, "timestamp") == datetime(2027, 1, 1)
    assert ask(spark, at, lambda c: times.days_before(c, 31), "timestamp") == datetime(2026, 3, 30, 10, 15, 30)
    assert ask(spark, date(2026, 4, 3), times.date_id, "date") == "20260403"


def test_load_windows():
    now = datetime(2026, 3, 1, 4, tzinfo=UTC)
    assert times.measurement_window(now) == ("daily", "2026-02-28", "2026-03-01")
    assert times.measurement_window(now, True, "2024-01-01", "2024-02-01") == ("historical", "2024-01-01", "2024-02-01")
    for bounds in ((None, "2024-02-01"), ("2024-01-01", ""), (None, None)):
        with pytest.raises(ValueError, match="date_from and date_to"):
            times.measurement_window(now, True, *bounds)
    assert times.weather_window(now) == ("2026-02-27", "2026-02-28")
    assert times.weather_window(now, start="2025-01-01") == ("2025-01-01", "2026-02-28")


def test_density_uses_the_radius(spark):
    df = spark.createDataFrame([(100, 300), (100, 100), (None, 300)], "n bigint, r int")
    got = [r[0] for r in rows(df.select(F.round(scoring.density_per_hectare("n", F.col("r")), 6)))]
    assert got == [3.536777, 31.830989, None]


def test_band_edges(spark):
    df = values(spark, "d", [5.999, 6.0, 8.999, 9.0, 11.999, 12.0, 13.999, 14.0, 99.0], "double")
    assert [r[0] for r in df.select(scoring.band("d")).collect()] == [1, 2, 2, 3, 3, 4, 4, 5, 5]


def test_weighted_score_for_all_pairs(spark):
    df = spark.range(25).select((F.col("id") / 5 + 1).cast("int").alias("b"), (F.col("id") % 5 + 1).cast("int").alias("h"))
    for b, h, score in rows(df.select("b", "h", scoring.weighted_score("b", "h"))):
        assert score == (7 * b + 3 * h + 5) // 10


ELEMENTS = "array<struct<type:string,id:bigint,tags:map<string,string>>>"


def features(spark, items):
    df = spark.createDataFrame([(items,)], f"elements {ELEMENTS}")
    return tuple(df.select(elements.element_features("elements").alias("f")).select("f.*").first())


def test_element_features(spark):
    items = [
        ("node", 1, {"building": "yes"}),  # nodes do not count
        ("way", 1, {"building": "House"}),
        ("way", 1, {"building": "House", "highway": "service"}),  # seen again with another tag
        ("relation", 1, {"building": "GARAGE"}),  # excluded whatever its case
        ("way", 2, {"building": None}),  # a tag without a value is still a building
        ("relation", 3, {"highway": "primary"}),  # only ways are highways
        ("way", 4, None),
        ("node", 5, {"landuse": "forest"}),
        ("way", 6, {"landuse": "meadow"}),
    ]
    assert features(spark, items) == (3, 2, 1, "landuse=forest", "landuse")


def test_element_features_without_elements(spark):
    assert features(spark, []) == (0, 0, 0, "unknown", "fallback")
    assert features(spark, None) == (0, 0, 0, "unknown", "fallback")
    assert features(spark, [("way", 1, {"landuse": None})]) == (0, 0, 0, "landuse=None", "landuse")


def test_every_excluded_building_is_no_main_building(spark):
    items = [("way", i, {"building": name.title()}) for i, name in enumerate(elements.EXCLUDED_BUILDINGS)]
    assert len(items) == 18
    assert features(spark, items)[:2] == (18, 0)
