"""Sums over the elements within a radius, folded in cells before a site meets them."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverair.operators.lookup import lookup_join
from silverair.operators.spatial import EARTH_RADIUS_M, haversine_m
from silverair.session import materialise

# A cell is divided into 4 x 4 x 4, down to four sizes, unless it holds few positions.
BITS = 2
SIZES = 4
FEW = 64
# Cells are compared with a circle in coordinates of the unit sphere. What comes
# closer to its edge than this (0.06 mm) is left to the distance itself.
SLACK = 1e-11

AXES = ("__x", "__y", "__z")
CELL = ["__size", *AXES]


def _on_sphere(lat: str, lon: str) -> list[Column]:
    phi, theta = F.radians(F.col(lat)), F.radians(F.col(lon))
    return [F.cos(phi) * F.cos(theta), F.cos(phi) * F.sin(theta), F.sin(phi)]


def _near_and_far(edge: float) -> tuple[Column, Column]:
    """Squared distances of a site to the nearest and the farthest point of the cell in its row."""
    near, far = [], []
    for axis in AXES:
        at, low = F.col(f"__site{axis}"), F.col(axis) * edge - 1
        near.append(F.pow(F.greatest(low - at, at - low - edge, F.lit(0.0)), 2))
        far.append(F.pow(F.greatest(F.abs(low - at), F.abs(low + edge - at)), 2))
    return near[0] + near[1] + near[2], far[0] + far[1] + far[2]


def _positions(elements: DataFrame, sums: Sequence[str], edge: float, lat: str, lon: str) -> DataFrame:
    """One row per position, with its sums and its cell of the smallest size."""
    folded = elements.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).groupBy(
        F.col(lat).alias("__lat"), F.col(lon).alias("__lon")
    )
    cells = [F.floor((at + 1) / edge).alias(axis) for axis, at in zip(AXES, _on_sphere("__lat", "__lon"), strict=True)]
    return folded.agg(*[F.sum(s).alias(s) for s in sums]).select("*", *cells)


def _in_all_sizes(positions: DataFrame, sizes: int) -> DataFrame:
    shift = (F.lit(sizes - 1) - F.col("__size")) * BITS
    sized = positions.select("*", F.explode(F.sequence(F.lit(0), F.lit(sizes - 1))).alias("__size"))
    return sized.withColumns({axis: F.call_function("shiftright", axis, shift) for axis in AXES})


def sums_within(
    sites: DataFrame,
    elements: DataFrame,
    radius_m: float,
    sums: Sequence[str],
    site: str = "location_id",
    lat: str = "lat",
    lon: str = "lon",
    sizes: int = SIZES,
    few: int = FEW,
) -> DataFrame:
    """``site`` and the sums of the columns ``sums`` over all elements at most ``radius_m`` away.

    Space, not the map, is divided into cells: points of the unit sphere lie in
    cubes, so neither a pole nor the date line is a special case and all cells are
    alike. The largest are wider than a circle. A cell that lies within a circle
    counts as a whole; one that is cut by it is looked at in smaller cells where it
    is crowded, and element by element only where it is not, or at the smallest size.

    Elements at one position count as one row from the start. Pairs exist only
    for cells on the edge of a circle and are summed where they are made.
    Sites without an element in reach, and rows without coordinates, are not in
    the result. A repeated row of ``sites`` counts once. Null summands count nothing.
    """
    chord = 2 * math.sin(min(radius_m / (2 * EARTH_RADIUS_M), math.pi / 2))
    widest = max(2.1 * chord, 1e-6)
    edges = [widest / (1 << BITS * size) for size in range(sizes)]
    reach = F.lit((chord + SLACK) ** 2)
    covered = F.lit(max(chord - SLACK, 0.0) ** 2)

    # Read by the cells and by the comparison, and the fold is a shuffle of all elements.
    positions = materialise(_positions(elements, sums, edges[-1], lat, lon), "positions")
    cells = _in_all_sizes(positions, sizes).groupBy(*CELL)
    cells = materialise(cells.agg(F.count(F.lit(1)).alias("__n"), *[F.sum(s).alias(s) for s in sums]), "cells")

    placed = sites.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(
        F.col(site).alias("__site"), F.col(lat).alias("__site_lat"), F.col(lon).alias("__site_lon")
    )
    asked = placed.distinct().select(
        "*", *[at.alias(f"__site{axis}") for axis, at in zip(AXES, _on_sphere("__site_lat", "__site_lon"), strict=True)]
    )
    carried = asked.columns
    for axis in AXES:
        first, last = (F.floor((F.col(f"__site{axis}") + side * (chord + SLACK) + 1) / widest) for side in (-1, 1))
        asked = asked.select("*", F.explode(F.sequence(first, last)).alias(axis))

    whole, cut = [], []
    for size, edge in enumerate(edges):
        near, far = _near_and_far(edge)
        known = cells.where(F.col("__size") == size)
        # A cell has one row, so a crowd of sites in a cell does not multiply; AQE splits it.
        met = asked.where(near <= reach).join(known, list(AXES)).withColumn("__whole", far <= covered)
        looked = materialise(met, "looked")
        whole.append(looked.where("__whole").select("__site", *sums))
        crowded = F.lit(size + 1 < sizes) & (F.col("__n") > few)
        cut.append(looked.where(~F.col("__whole") & ~crowded).select("__site", "__site_lat", "__site_lon", *CELL))
        deeper = looked.where(~F.col("__whole") & crowded)
        if size + 1 == sizes or deeper.isEmpty():
            break
        asked = deeper.select(*carried, *AXES)
        for axis in AXES:
            inner = F.col(axis) * (1 << BITS)
            children = F.explode(F.sequence(inner, inner + (1 << BITS) - 1)).alias(axis)
            asked = asked.select(*[c for c in asked.columns if c != axis], children)

    on_edge = reduce(DataFrame.unionByName, cut)
    pairs = lookup_join(_in_all_sizes(positions, sizes), on_edge, CELL, ["__lat", "__lon"])
    within = pairs.where(haversine_m("__site_lat", "__site_lon", "__lat", "__lon") <= radius_m)
    # Pairs are folded in the stage that makes them, cells as a whole beside them.
    parts = [part.groupBy("__site").agg(*[F.sum(s).alias(s) for s in sums]) for part in (within, reduce(DataFrame.unionByName, whole))]
    total = parts[0].unionByName(parts[1]).groupBy("__site").agg(*[F.sum(s).alias(s) for s in sums])
    return total.withColumnRenamed("__site", site)
