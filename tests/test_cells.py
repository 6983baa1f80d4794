"""Sums over cells equal those over pairs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from silverair.operators import cells
from silverair.operators.cells import sums_within
from silverair.operators.features import FEATURE_COUNTS, features_near, tag_features
from silverair.operators.spatial import radius_join

CORNERS = [(0, 0), (48, 11), (60, 179.99), (-60, -179.99), (84.99, 20), (89.99, 5), (-89.95, -170)]


def points(rng, n, spread=0.1):
    at = []
    for i in range(n):
        lat, lon = rng.choice(CORNERS)
        at.append((i, max(-90.0, min(90.0, lat + rng.uniform(-spread, spread))), lon + rng.uniform(-spread, spread)))
    return [*at, (n, 60.0, 180.0), (n + 1, 60.0, -180.0), (n + 2, 90.0, 0.0), (n + 3, None, None), (n + 4, 48.0, None)]


@pytest.mark.parametrize("radius", [0.01, 4000.0, 25_000_000.0])
def test_sums_equal_pairs(spark, radius):
    rng = random.Random(int(radius))
    sites = spark.createDataFrame(points(rng, 60), "location_id int, lat double, lon double")
    crowd = points(rng, 300) + [(1000 + i, 48.0 + i % 7 * 1e-4, 11.0) for i in range(200)]
    elements = spark.createDataFrame(crowd, "id int, lat double, lon double").withColumn("one", F.lit(1).cast("bigint"))
    elements = elements.withColumn("odd", F.when(F.col("id") % 2 == 1, F.col("id").cast("bigint")))
    want = radius_join(sites, elements, min(radius, 30_000.0)) if radius < 1e6 else sites.dropna().crossJoin(
        elements.dropna(subset=["lat", "lon"]).drop("lat", "lon")
    )
    want = want.groupBy("location_id").agg(F.sum("one").alias("one"), F.sum("odd").alias("odd"))
    for few in (1, 50):
        got = sums_within(sites.union(sites), elements, radius, ["one", "odd"], few=few)
        assert rows(got, "location_id") == rows(want, "location_id"), few


def test_no_sites_and_no_elements(spark):
    none = spark.createDataFrame([], "location_id int, lat double, lon double, one bigint")
    some = spark.createDataFrame([(1, 1.0, 1.0, 1)], none.schema)
    assert rows(sums_within(none, some, 300, ["one"])) == rows(sums_within(some, none, 300, ["one"])) == []
    assert rows(sums_within(some, some, 300, ["one"])) == [(1, 1)]


def test_counts_near_equal_the_pairs(spark):
    rng = random.Random(5)
    # Numbers come again at other places, with other tags, and at the same one.
    names = ["House", "shed", None]
    data = [
        (rng.choice(["node", "way", "relation", None]), rng.choice([rng.randrange(400), None, n]),
         {k: rng.choice(names) for k in ("building", "highway") if rng.random() < 0.6} or None, lat, lon)
        for n, lat, lon in points(rng, 400, 0.02) * 2
    ]
    elements = spark.createDataFrame(data, "type string, id bigint, tags map<string,string>, lat double, lon double")
    sites = spark.createDataFrame(points(rng, 40, 0.02), "location_id int, lat double, lon double")
    pairs = radius_join(sites, elements, 2000.0).withColumn("pos", F.lit(0))
    want = tag_features(pairs, "location_id").select("location_id", *FEATURE_COUNTS)
    got = features_near(sites, elements, 2000.0, "location_id").select("location_id", *FEATURE_COUNTS)
    nonzero = " + ".join(FEATURE_COUNTS) + " > 0"
    assert rows(got.where(nonzero), "location_id") == rows(want.where(nonzero), "location_id")
    assert got.where(nonzero).count() > 10


@pytest.mark.parametrize("lat", [50.0, 89.0])
def test_a_crowded_cell_leaves_no_pairs(spark, monkeypatch, lat):
    """A third of all elements within the circles, at single positions or in a ring near the pole: cells count, not pairs."""
    n = 60_000
    place = F.when(F.col("id") % 3 == 0, F.col("id") / 10**9).otherwise(F.col("id") * 0.7 % 350 + 1)
    elements = spark.range(0, n, 1, 12).select(F.lit(lat).alias("lat"), place.alias("lon"), F.lit(1).cast("bigint").alias("one"))
    sites = spark.range(500).select(F.col("id").alias("location_id"), F.lit(lat).alias("lat"), (F.col("id") / 10**7).alias("lon"))
    paired = []

    def lookup_join(large, lookup, keys, spread, how="inner"):
        out = large.join(lookup, list(keys), how)
        paired.append((out.count(), large.groupBy(*keys).count().agg(F.max("count")).first()[0]))
        return out

    monkeypatch.setattr(cells, "lookup_join", lookup_join)
    got = sums_within(sites, elements, 300.0, ["one"])
    assert got.agg(F.count("*"), F.min("one"), F.max("one")).first() == (500, n // 3, n // 3)
    pairs, _ = paired[0]
    assert pairs < 500 * n / 3 / 1000
