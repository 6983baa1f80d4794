"""Features per site from a table of tagged map elements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverair.functions import elements as E
from silverair.operators.reach import located, reach
from silverair.operators.spatial import radius_join
from silverair.session import materialise

FEATURE_COUNTS = ("building_count_all", "main_building_count", "highway_count")


def tag_features(
    elements: DataFrame, site: str, kind: str = "type", number: str = "id", tags: str = "tags", pos: str = "pos"
) -> DataFrame:
    """Distinct building, main building and highway counts and the first area tag per site.

    Elements are first folded by identity and then by site. Both steps combine
    on the map side, so a site with a third of all elements stays spread out.
    Areas are few and their text would keep the counts from hash aggregation, so
    they are folded on their own.
    """
    k, t = F.col(kind), F.col(tags)
    flags = {"building": E.is_building(k, t), "main": E.is_main_building(k, t), "highway": E.is_highway(k, t)}
    tests = elements.select(
        site, k.alias("__kind"), F.col(number).alias("__number"),
        *[F.coalesce(test, F.lit(False)).alias(f"__{name}") for name, test in flags.items()],
    )
    counted = F.col("__building") | F.col("__highway")
    # Elements that count for nothing fall together; their site must stay.
    by_identity = tests.groupBy(
        site, F.when(counted, F.col("__kind")).alias("__kind"), F.when(counted, F.col("__number")).alias("__number")
    ).agg(*[F.max(f"__{name}").cast("bigint").alias(f"__{name}") for name in flags])
    counts = by_identity.groupBy(site).agg(
        F.sum("__building").alias("building_count_all"),
        F.sum("__main").alias("main_building_count"),
        F.sum("__highway").alias("highway_count"),
    )
    first_area = F.min_by(E.area_label(t), F.col(pos)).alias("__area")
    areas = elements.filter(E.has_area(t) & F.col(site).isNotNull()).groupBy(site).agg(first_area)
    return counts.join(areas, site, "left").select(
        *counts.columns,
        F.coalesce("__area", F.lit(E.NO_AREA[0])).alias("area_tag"),
        F.when(F.col("__area").isNotNull(), F.lit("landuse")).otherwise(F.lit(E.NO_AREA[1])).alias("area_tag_source"),
    )


def features_near(sites: DataFrame, elements: DataFrame, radius_m: float, site: str) -> DataFrame:
    """``FEATURE_COUNTS`` of distinct elements and the label of the nearest area, at most ``radius_m`` away.

    Only sites with something in reach are in the result; ``area`` may be null. An
    element may have several rows, and its tags in any of them. One with several
    positions may be in reach of a site more than once, and is counted once. Equally
    near areas go by type and number. Sites with several positions, which should be
    few, are paired with their elements, so that they too count each of them once.
    """
    k, t = F.col("type"), F.col("tags")
    tests = (E.is_building(k, t), E.is_main_building(k, t), E.is_highway(k, t))
    flags = [F.coalesce(test, F.lit(False)).cast("bigint").alias(n) for n, test in zip(FEATURE_COUNTS, tests, strict=True)]
    label = F.when(E.has_area(t), E.area_label(t)).alias("area")
    used = located(elements).select("type", "id", "lat", "lon", *flags, label)
    used = used.where(" + ".join(FEATURE_COUNTS) + " > 0 or area is not null")
    most = [F.max(n).alias(n) for n in FEATURE_COUNTS]
    # Read once to count the rows of a tile, and once to deal them out.
    folded = materialise(used.groupBy("type", "id", "lat", "lon").agg(*most, F.min("area").alias("area")), "elements")

    placed = located(sites.select(site, "lat", "lon")).distinct()
    ends = [f(c).alias(f"__{f.__name__}_{c}") for f in (F.min, F.max) for c in ("lat", "lon")]
    several = placed.groupBy(site).agg(*ends).where("__min_lat < __max_lat or __min_lon < __max_lon").select(site)
    several = materialise(several, "several")
    if several.isEmpty():
        found = reach(placed, folded, radius_m, FEATURE_COUNTS, site, ["type", "id"], nearest=["type", "id", "area"])
        return found.select(site, *FEATURE_COUNTS, F.col("nearest.area").alias("area"))
    own = several.select(F.col(site).alias("__site"))
    same = F.col(site).eqNullSafe(F.col("__site"))
    one = placed.join(own, same, "left_anti")
    found = reach(one, folded, radius_m, FEATURE_COUNTS, site, ["type", "id"], nearest=["type", "id", "area"])
    pairs = radius_join(placed.join(own, same, "left_semi"), folded, radius_m)
    near = F.min(F.when(F.col("area").isNotNull(), F.struct("distance_m", "type", "id", "area"))).alias("nearest")
    once = pairs.groupBy(site, "type", "id").agg(*most, near)
    paired = once.groupBy(site).agg(*[F.sum(n).alias(n) for n in FEATURE_COUNTS], F.min("nearest").alias("nearest"))
    return found.unionByName(paired).select(site, *FEATURE_COUNTS, F.col("nearest.area").alias("area"))
