"""What is in reach of sites equals what pairs say, and what is shuffled grows with the rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from silverair.operators import features, reach
from silverair.operators.features import FEATURE_COUNTS, features_near
from silverair.operators.spatial import radius_join
from suite import QUERIES

CORNERS = [(0, 0), (48, 11), (60, 179.99), (89.99, 5), (-89.95, -170)]


def points(rng, n, spread):
    at = []
    for i in range(n):
        lat, lon = rng.choice(CORNERS)
        at.append((i, max(-90.0, min(90.0, lat + rng.uniform(-spread, spread))), lon + rng.uniform(-spread, spread)))
    return [*at, (n, 60.0, 180.0), (n + 1, 60.0, -180.0), (n + 2, 90.0, 0.0), (n + 3, None, None), (n + 4, float("nan"), 1.0)]


@pytest.mark.parametrize("radius, small", [(0.01, False), (4000.0, False), (4000.0, True), (25_000_000.0, False)])
def test_what_is_in_reach_equals_the_pairs(spark, monkeypatch, radius, small):
    if small:
        for name, size in (("BLOCK_SITES", 7), ("BLOCK_ELEMENTS", 30), ("GROUP", 3), ("COLUMNS", 5)):
            monkeypatch.setattr(reach, name, size)
    rng = random.Random(int(radius))
    sites = spark.createDataFrame(points(rng, 80, 0.05), "location_id int, lat double, lon double")
    # Rows of an element have several values and places, and there are equal rows.
    crowd = [(rng.choice(["a", "b", None]), rng.choice([n % 60, None]), rng.choice([0, 1, 3]), rng.choice(["x", "y", None]), lat, lon)
             for n, lat, lon in points(rng, 300, 0.05) * 2]
    elements = spark.createDataFrame(crowd, "type string, id bigint, v bigint, area string, lat double, lon double")
    # Elements at the places of sites tie at 0 m.
    elements = elements.union(sites.select(F.lit("a"), F.lit(7), F.lit(2), F.lit("z"), "lat", "lon"))
    placed = elements.where("lat <= 90")
    pairs = (
        radius_join(sites.where("lat <= 90"), placed, radius)
        if radius < 1e6
        else sites.where("lat <= 90").select("location_id").crossJoin(placed).withColumn("distance_m", F.lit(0.0))
    )
    # A repeated site has its pairs again.
    got = reach.reach(sites.union(sites), elements, radius, ["v"], least="id").select("location_id", "v", "id")
    want = pairs.groupBy("location_id").agg(2 * F.sum("v"), F.min("id"))
    assert rows(got, "location_id") == rows(want, "location_id")
    got = reach.reach(sites, elements, radius, ["v"], same=["type", "id"], nearest=["type", "id", "area"])
    once = pairs.groupBy("location_id", "type", "id").agg(F.max("v").alias("v"))
    assert rows(got.select("location_id", "v"), "location_id") == rows(once.groupBy("location_id").agg(F.sum("v")), "location_id")
    if radius < 1e6:
        chosen = F.min(F.when(F.col("area").isNotNull(), F.struct("distance_m", "type", "id", "area"))).alias("n")
        want = pairs.groupBy("location_id").agg(chosen).select("location_id", "n.type", "n.id", "n.area")
        assert rows(got.select("location_id", "nearest.type", "nearest.id", "nearest.area"), "location_id") == rows(want, "location_id")
        metres = {r[0]: r[1] for r in pairs.where("area is not null").groupBy("location_id").agg(F.min("distance_m")).collect()}
        for key, near in got.select("location_id", "nearest.distance_m").collect():
            assert near == pytest.approx(metres.get(key), abs=1e-6)


def test_nothing_in_reach(spark):
    none = spark.createDataFrame([], "location_id int, lat double, lon double, one bigint")
    some = spark.createDataFrame([(1, 1.0, 1.0, 1)], none.schema)
    far = spark.createDataFrame([(1, 1.01, 1.0, 1)], none.schema)
    for sites, elements in ((none, some), (some, none), (some, far)):
        assert rows(reach.reach(sites, elements, 300, ["one"])) == []
    assert rows(reach.reach(some, some, 300, ["one"])) == [(1, 1)]


def test_features_make_no_rows_per_pair(spark, monkeypatch):
    """3,000 sites see 3,000 elements with two positions each and 1,000 areas: no pair leaves its task."""
    made = []

    def no_pairs(*_):
        made.append(1)
        raise AssertionError("pairs are made")

    monkeypatch.setattr(features, "radius_join", no_pairs)
    sites = spark.range(3000).select(F.col("id").alias("location_id"), F.lit(48.0).alias("lat"), (F.col("id") / 1e6).alias("lon"))
    n = F.col("id")
    tags = F.when(n % 6 == 0, F.create_map(F.lit("landuse"), F.concat(F.lit("p"), n))).otherwise(F.create_map(F.lit("building"), F.lit("yes")))
    elements = spark.range(6000).select(
        F.lit("way").alias("type"), F.floor(n / 2).alias("id"), tags.alias("tags"), F.lit(48.0).alias("lat"), (n / 1e6 + 0.0005).alias("lon")
    )
    found = features_near(sites, elements, 1000.0, "location_id")
    assert found.agg(F.count("*"), *[F.min(c) for c in FEATURE_COUNTS], F.count("area")).first() == (3000, 3000, 3000, 0, 3000)
    assert "Join" not in plan(found).replace("BroadcastHashJoin", "") and not made


def test_a_site_with_two_positions_counts_an_element_once(spark):
    sites = spark.createDataFrame([(1, 48.0, 11.0), (1, 48.001, 11.0), (2, 48.0, 11.0)], "location_id int, lat double, lon double")
    elements = spark.createDataFrame(
        [("way", 1, {"building": "yes"}, 48.0005, 11.0), ("way", 2, {"landuse": "farm"}, 48.0012, 11.0)],
        "type string, id bigint, tags map<string,string>, lat double, lon double",
    )
    got = features_near(sites, elements, 300.0, "location_id").select("location_id", "building_count_all", "area")
    assert rows(got) == [(1, 1, "landuse=farm"), (2, 1, "landuse=farm")]


def test_the_radius_query_compares_in_blocks(spark, tmp_path):
    """Tasks are as many as the work asks for, however few bytes it reads, and repeated rows have their pairs."""
    for name, key, balance, n in (("customer", "c_custkey", "c_acctbal", 4000), ("supplier", "s_suppkey", "s_acctbal", 300)):
        row = F.col("id") % (n - 5)
        spark.range(n).select(row.alias(key), (row * 7919 % 1_000_000 / 100.0).alias(balance)).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = QUERIES["q_radius_join"](spark, str(tmp_path))
    s, e = (spark.read.parquet(str(tmp_path / f"{name}.parquet")) for name in ("customer", "supplier"))
    place = lambda df, key, bal, f, p, name: df.select(
        F.col(key).alias(name), (F.lit(45) + F.col(bal) / 10000).alias("lat"), (7 + F.col(key) * f % p / F.lit(float(p))).alias("lon")
    )
    pairs = radius_join(place(s, "c_custkey", "c_acctbal", 37, 1009, "site_id"), place(e, "s_suppkey", "s_acctbal", 61, 1013, "element_id"), 5000)
    want = pairs.groupBy("site_id").agg(F.count("*"), F.round(F.min("distance_m"), 3), F.min("element_id"))
    assert rows(got, "site_id") == rows(want, "site_id")
    assert "CoGroup" in plan(got)


def test_work_decides_the_number_of_tasks(spark, monkeypatch):
    monkeypatch.setattr(reach, "TASK_PAIRS", 1000)
    at = spark.range(300).select(F.col("id").alias("location_id"), F.lit(48.0).alias("lat"), (F.col("id") / 1000).alias("lon"), F.lit(1).alias("one"))
    found = reach.reach(at, at, 1000.0, ["one"])
    assert found.agg(F.count("*"), F.min("one")).first() == (300, 14)
    assert plan(found).count("REPARTITION_BY_NUM") >= 2
