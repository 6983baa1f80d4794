from __future__ import annotations

from pyspark.sql import functions as F

from helpers import plan, rows
from silverair.operators.dedupe import distinct_sites, first_per_key, last_per_key, latest_per_key, top_per_key


def test_latest_per_key_is_the_same_for_any_layout(spark):
    data = [(k, t, v, {"a": str(v)}) for k in ("x", None) for t in (1, 2, None) for v in (5, 3)]
    want = [("x", 2, 3), (None, 2, 3)]
    for parts in (1, 3, 7):
        for seed in (1, 2):
            df = spark.createDataFrame(data, "k string, t int, v int, m map<string,string>")
            mixed = df.orderBy(F.rand(seed)).repartition(parts)
            got = latest_per_key(mixed, ["k"], "t").select("k", "t", "v")
            assert sorted(rows(got), key=repr) == sorted(want, key=repr)


def test_null_order_value_loses(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 0, 2)], "k string, t int, v int")
    assert rows(latest_per_key(df, ["k"], "t")) == [("a", 0, 2)]


def test_first_and_last_per_key_treat_nulls_as_equal(spark):
    df = spark.createDataFrame(
        [("DE", None, 1), ("DE", None, 2), ("DE", "Bonn", 3), (None, None, 4), (None, None, 5)],
        "country string, place string, pos int",
    )
    assert rows(first_per_key(df, ["country", "place"], ["pos"]).select("pos"), "pos") == [(1,), (3,), (4,)]
    assert rows(last_per_key(df, ["country", "place"], ["pos"]).select("pos"), "pos") == [(2,), (3,), (5,)]


def test_top_per_key_cuts_before_the_shuffle(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("k"), "id")
    for n in (1, 20, 1500):
        top = top_per_key(df, ["k"], [F.col("id").desc()], n)
        assert top.count() == 3 * n
        text = plan(top)
        assert text.count("WindowGroupLimit") == 2, n
        assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_distinct_sites_need_coordinates_and_keep_input_order(spark):
    df = spark.createDataFrame(
        [
            (9, "DE", None, 7.0, 50.0, 1),
            (8, "DE", None, 7.0, 50.0, 2),
            (7, "DE", None, None, 50.0, 3),
            (None, "DE", "Bonn", 7.1, 50.0, 4),
            (6, "FR", "Lyon", 4.8, 45.7, 5),
            (5, "FR", "Lyon", 4.8, 45.8, 6),
        ],
        "location_id int, country_name string, city_or_locality string, longitude double, latitude double, pos int",
    )
    weather = distinct_sites(df, ["pos"], ["location_id", "latitude", "longitude"])
    assert rows(weather.select("location_id"), "location_id") == [(5,), (6,), (9,)]
    features = distinct_sites(df, ["pos"], ["latitude", "longitude"], limit=3)
    assert rows(features.select("pos"), "pos") == [(1,), (4,), (5,)]
