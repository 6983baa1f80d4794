"""Counts and tags over the map elements found around a site."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from silverair.functions.text import as_column, tagged

# Building tags that do not count as main buildings.
EXCLUDED_BUILDINGS = (
    "shed", "garage", "garages", "carport", "roof", "greenhouse", "greenhouse_horticulture",
    "hut", "cabin", "static_caravan", "houseboat", "container", "kiosk", "service",
    "transformer_tower", "construction", "ruins", "collapsed",
)
BUILDING_TYPES = ("way", "relation")
HIGHWAY_TYPES = ("way",)
NO_AREA = ("unknown", "fallback")


def identity(kind: Column | str, number: Column | str) -> Column:
    """Identity of an element; numbers are only unique within a type."""
    return F.concat_ws(":", as_column(kind), as_column(number).cast("string"))


def is_building(kind: Column, tags: Column) -> Column:
    return F.map_contains_key(tags, "building") & kind.isin(*BUILDING_TYPES)


def is_main_building(kind: Column, tags: Column) -> Column:
    value = F.coalesce(F.lower(F.try_element_at(tags, F.lit("building"))), F.lit("none"))
    return is_building(kind, tags) & ~value.isin(*EXCLUDED_BUILDINGS)


def is_highway(kind: Column, tags: Column) -> Column:
    return F.map_contains_key(tags, "highway") & kind.isin(*HIGHWAY_TYPES)


def has_area(tags: Column) -> Column:
    return F.map_contains_key(tags, "landuse")


def area_label(tags: Column) -> Column:
    return tagged("landuse", F.try_element_at(tags, F.lit("landuse")))


def element_features(elements: Column | str) -> Column:
    """Features of one site from the elements of its own response.

    Array functions keep the work inside the row, so no shuffle is needed.
    For element tables use ``operators.features.tag_features``.
    """
    elements = F.coalesce(
        as_column(elements), F.array().cast("array<struct<type:string,id:bigint,tags:map<string,string>>>")
    )

    def distinct_count(accept) -> Column:
        kept = F.filter(elements, lambda e: accept(e["type"], e["tags"]))
        names = F.transform(kept, lambda e: identity(e["type"], e["id"]))
        return F.size(F.array_distinct(names)).cast("bigint")

    first_area = F.get(F.filter(elements, lambda e: has_area(e["tags"])), F.lit(0))
    found = first_area.isNotNull()
    return F.struct(
        distinct_count(is_building).alias("building_count_all"),
        distinct_count(is_main_building).alias("main_building_count"),
        distinct_count(is_highway).alias("highway_count"),
        F.when(found, area_label(first_area["tags"])).otherwise(F.lit(NO_AREA[0])).alias("area_tag"),
        F.when(found, F.lit("landuse")).otherwise(F.lit(NO_AREA[1])).alias("area_tag_source"),
    )
