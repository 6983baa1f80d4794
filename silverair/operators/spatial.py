"""Elements within a radius of a site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverair.functions.text import as_column
from silverair.operators.lookup import lookup_join

EARTH_RADIUS_M = 6_371_008.8
METRES_PER_DEGREE = 110_574.0
# Highest latitude for which grid cells are built; beyond it one row of cells
# would have to span most of a parallel.
MAX_LATITUDE = 85.0


def haversine_m(lat1: Column | str, lon1: Column | str, lat2: Column | str, lon2: Column | str) -> Column:
    """Great-circle distance in metres."""
    lat1, lon1, lat2, lon2 = (F.radians(as_column(c)) for c in (lat1, lon1, lat2, lon2))
    a = F.pow(F.sin((lat2 - lat1) / 2), 2) + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def radius_join(sites: DataFrame, elements: DataFrame, radius_m: float, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """All (site, element) pairs at most ``radius_m`` apart, with ``distance_m``.

    Both sides carry ``lat`` and ``lon``; those of the elements come back as
    ``element_lat`` and ``element_lon``. Elements fall into one grid cell and
    sites look into the cells around them, so the join is an equi-join on cells;
    crowded cells are spread over several tasks. Beyond latitude 85 a cell spans
    its whole parallel. Rows without coordinates match nothing.
    """
    step = radius_m * 1.01 / METRES_PER_DEGREE
    row = F.floor(F.col(lat) / step)
    # Columns are widened by the latitude of their row edge farthest from the
    # equator, so that one column is at least a radius wide everywhere in the
    # neighbouring rows too.
    def columns(in_row: Column) -> Column:
        edge = F.least((F.abs(in_row) + 2) * step, F.lit(MAX_LATITUDE + 2 * step))
        wide = F.lit(step) / F.cos(F.radians(edge))
        return F.greatest(F.floor(F.lit(360.0) / wide), F.lit(1))

    def column_of(longitude: Column, in_row: Column) -> Column:
        turn = F.pmod(longitude + 180.0, F.lit(360.0)) / 360.0
        count = columns(in_row)
        return F.when(F.abs(in_row * step) > MAX_LATITUDE, F.lit(0)).otherwise(
            F.least(F.floor(turn * count), count - 1)
        )

    placed = elements.select(
        *[c for c in elements.columns if c not in (lat, lon)],
        F.col(lat).alias("element_lat"),
        F.col(lon).alias("element_lon"),
        row.alias("__row"),
        column_of(F.col(lon), row).alias("__col"),
    )
    rows = F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda d: row + d)
    near = sites.select("*", F.explode(rows).alias("__row"))
    count = columns(F.col("__row"))
    own = column_of(F.col(lon), F.col("__row"))
    around = F.when(F.abs(F.col("__row") * step) > MAX_LATITUDE, F.array(F.lit(0).cast("bigint"))).otherwise(
        F.array_distinct(F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda d: F.pmod(own + d, count)))
    )
    near = near.select("*", F.explode(around).alias("__col"))
    distance = haversine_m(lat, lon, "element_lat", "element_lon")
    joined = lookup_join(placed, near, ["__row", "__col"], ["element_lat", "element_lon"])
    pairs = joined.withColumn("distance_m", distance)
    return pairs.filter(F.col("distance_m") <= radius_m).drop("__row", "__col")
