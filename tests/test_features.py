from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from helpers import rows
from silverair.functions.elements import element_features
from silverair.operators.features import tag_features
from silverair.operators.nested import explode_where
from silverair.operators.spatial import haversine_m, radius_join


def test_tag_features_equals_the_array_form(spark):
    rng = random.Random(3)
    kinds, names = ["node", "way", "relation", None], ["House", "shed", "GARAGE", None, "yes"]

    def element():
        tags = {k: rng.choice(names) for k in ("building", "highway", "landuse") if rng.random() < 0.4}
        return (rng.choice(kinds), rng.randrange(6), tags or None)

    data = [(site, [element() for _ in range(rng.randrange(1, 12))]) for site in range(60)]
    df = spark.createDataFrame(data, "site int, elements array<struct<type:string,id:bigint,tags:map<string,string>>>")
    want = df.select("site", element_features("elements").alias("f")).select("site", "f.*")
    flat = explode_where(df, "elements", None, "e").select("site", "e.*", F.col("e_pos").alias("pos"))
    assert rows(tag_features(flat, "site"), "site") == rows(want, "site")


def brute_force(sites, elements, radius):
    def distance(a, b):
        la, lb = math.radians(a[1]), math.radians(b[1])
        h = math.sin((lb - la) / 2) ** 2
        h += math.cos(la) * math.cos(lb) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
        return 2 * 6_371_008.8 * math.asin(min(1.0, math.sqrt(h)))

    return sorted((s[0], e[0]) for s in sites for e in elements if distance(s, e) <= radius)


def test_radius_join_equals_brute_force(spark):
    rng = random.Random(11)

    def points(n):
        at = []
        for i in range(n):
            corner = rng.choice([(0, 0), (48, 11), (-33, 151), (60, 179.99), (-60, -179.99), (84.99, 20), (89.9, 5), (-89.95, -170)])
            at.append((i, max(-90.0, min(90.0, corner[0] + rng.uniform(-0.1, 0.1))), corner[1] + rng.uniform(-0.1, 0.1)))
        # Longitudes may be given beyond the date line.
        return [*at, (n, 60.0, 180.0), (n + 1, 60.0, -180.0), (n + 2, 90.0, 0.0), (n + 3, None, None)]

    sites, elements = points(150), points(150)
    s = spark.createDataFrame(sites, "site int, lat double, lon double")
    e = spark.createDataFrame(elements, "element int, lat double, lon double")
    for radius in (300.0, 4000.0, 30_000.0):
        got = sorted(rows(radius_join(s, e, radius).select("site", "element")))
        assert got == brute_force(sites[:-1], elements[:-1], radius)
        assert len(got) == len(set(got))


def test_haversine(spark):
    df = spark.createDataFrame([(48.1372, 11.5756, 52.52, 13.405)], "a double, b double, c double, d double")
    assert abs(df.select(haversine_m("a", "b", "c", "d")).first()[0] - 504_400) < 500
