"""What sites have in reach, summed up where sites and elements meet, so that no pair leaves its task."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverair.operators.lookup import lookup_join
from silverair.operators.spatial import EARTH_RADIUS_M
from silverair.session import materialise

# Lengths are chords of the unit sphere. What comes closer to the edge of a circle than
# this (0.06 mm) is left to the distance itself.
SLACK = 1e-11
# Sites and elements of a block. A tile with more is divided into several blocks.
BLOCK_SITES = 1 << 14
BLOCK_ELEMENTS = 1 << 18
# Neighbouring sites that are compared with elements at once, and the columns of such a
# comparison. They bound work and memory only.
GROUP = 64
COLUMNS = 1 << 13
# Pairs of sites and elements in the blocks of a task, of which most are settled for many at once.
TASK_PAIRS = 20_000_000
PARTITIONS = 4096

AXES = ("__x", "__y", "__z")
BLOCK = (*AXES, "__site_part", "__element_part")
NONE = np.iinfo(np.int64).max


def located(df: DataFrame) -> DataFrame:
    """Rows with coordinates, as doubles."""
    at = {c: F.col(c).cast("double") for c in ("lat", "lon")}
    return df.withColumns(at).where(" and ".join(f"abs({c}) < double('infinity')" for c in at))


def _on_sphere() -> list[Column]:
    phi, theta = F.radians("lat"), F.radians("lon")
    return [F.cos(phi) * F.cos(theta), F.cos(phi) * F.sin(theta), F.sin(phi)]


def _spread(elements: DataFrame, far: float, edge: float) -> DataFrame:
    """A row per element and tile of which a point lies in its reach."""
    around = elements.withColumns({f"__at{axis}": at for axis, at in zip(AXES, _on_sphere(), strict=True)})
    apart = F.lit(0.0)
    for axis in AXES:
        at = F.col(f"__at{axis}")
        first, last = (F.floor((at + side * far + 1) / edge) for side in (-1, 1))
        around = around.select("*", F.explode(F.sequence(first, last)).alias(axis))
        low = F.col(axis) * edge - 1
        apart = apart + F.pow(F.greatest(low - at, at - low - edge, F.lit(0.0)), 2)
    return around.where(apart <= far * far).select(*elements.columns, *AXES)


def _dealt(rows: DataFrame, tiles: DataFrame, own: str, by: Sequence[str], other: str) -> DataFrame:
    """Rows of a tile in its parts, each of them once for every part of the other side."""
    part = F.pmod(F.xxhash64(*by), F.col(own)).cast("int").alias(own)
    met = lookup_join(rows, tiles, AXES, ["lat", "lon"])
    return met.select(*rows.columns, part, F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other))


def reach(
    sites: DataFrame,
    elements: DataFrame,
    radius_m: float,
    sums: Sequence[str],
    site: str = "location_id",
    same: Sequence[str] = (),
    least: str | None = None,
    nearest: Sequence[str] | None = None,
) -> DataFrame:
    """``site`` with the sums, the least and the nearest of all elements at most ``radius_m`` away.

    Both sides carry ``lat`` and ``lon``. Of each of the columns ``sums`` (integers) the sum is
    taken over all rows in reach. With ``same``, the columns that identify an element, those of its
    rows that are in reach count once, with the largest value. ``least`` is an integer column
    whose minimum is wanted. ``nearest`` asks for the struct ``nearest``: ``distance_m`` and these
    columns of the nearest row whose last one is not null; equally near rows go by the columns.
    Each row of ``sites`` is looked at, and rows of one site are added up. Sites without an
    element in reach, and rows without coordinates, are not in the result.

    Space is divided into tiles as wide as the radius. A site belongs to one, an element is sent
    to those that it reaches, about eight on a plane, and only where there are sites. Thus
    what is shuffled grows with the rows and not with the pairs. A crowded tile is dealt
    out to several blocks; rows of an element stay together. In a block, elements that are in
    reach of all or of none of some neighbouring sites are settled for these sites at once.
    """
    chord = 2 * math.sin(min(radius_m / (2 * EARTH_RADIUS_M), math.pi / 2))
    far = chord + SLACK
    edge = max(far + SLACK, 1e-6)
    carried = list(dict.fromkeys([*same, *(nearest or ()), *([least] if least else []), *sums]))
    asked = located(sites.select(site, "lat", "lon"))
    asked = asked.select("*", *[F.floor((at + 1) / edge).alias(axis) for axis, at in zip(AXES, _on_sphere(), strict=True)])
    spread = _spread(located(elements.select("lat", "lon", *carried)), far, edge)

    def parts(rows: DataFrame, size: int, name: str) -> DataFrame:
        n = F.count(F.lit(1))
        return rows.groupBy(*AXES).agg(n.cast("double").alias(f"{name}_rows"), F.ceil(n / size).cast("int").alias(name))

    tiles = parts(asked, BLOCK_SITES, "__site_part").join(parts(spread, BLOCK_ELEMENTS, "__element_part"), list(AXES))
    tiles = materialise(tiles, "tiles")
    pairs, blocks = F.col("__site_part_rows") * F.col("__element_part_rows"), F.col("__site_part").cast("long") * F.col("__element_part")
    known = tiles.agg(F.sum(pairs).alias("pairs"), F.sum(blocks).alias("blocks")).first()
    # Work grows faster than bytes do, so blocks are put together by the pairs that they compare.
    n = min(known.blocks or 1, math.ceil((known.pairs or 1) / TASK_PAIRS) + 7, PARTITIONS)
    tiles = tiles.select(*AXES, "__site_part", "__element_part")
    asked = _dealt(asked, tiles, "__site_part", [site, "lat", "lon"], "__element_part").repartition(n, *BLOCK)
    spread = _dealt(spread, tiles, "__element_part", list(same) or ["lat", "lon"], "__site_part").repartition(n, *BLOCK)

    kinds = {f.name: f.dataType for f in elements.schema.fields}
    fields = [T.StructField(site, sites.schema[site].dataType), *(T.StructField(s, T.LongType()) for s in sums)]
    fields += [T.StructField("least", T.LongType())] if least else []
    if nearest is not None:
        fields += [T.StructField("distance_m", T.DoubleType()), *(T.StructField(f"nearest_{c}", kinds[c]) for c in nearest)]
    work = meet(radius_m, chord, site, sums, same, least, nearest)
    found = asked.groupBy(*BLOCK).cogroup(spread.groupBy(*BLOCK)).applyInArrow(work, T.StructType(fields))
    folded = [F.sum(s).alias(s) for s in sums] + ([F.min("least").alias(least)] if least else [])
    if nearest is not None:
        named = F.struct("distance_m", *[F.col(f"nearest_{c}").alias(c) for c in nearest])
        folded.append(F.min(F.when(F.col("distance_m").isNotNull(), named)).alias("nearest"))
    return found.groupBy(site).agg(*folded)


def meet(
    radius_m: float, chord: float, site: str, sums: Sequence[str], same: Sequence[str], least: str | None, nearest: Sequence[str] | None
) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Sites and elements of a block to a row per site that has something in reach."""

    def work(sites: pa.Table, elements: pa.Table) -> pa.Table:
        columns = [site, *sums, *(["least"] if least else []), *(["distance_m"] if nearest is not None else [])]
        if sites.num_rows and elements.num_rows:
            order = list(dict.fromkeys([*same, *(nearest or ())]))
            if order:
                keys = [(c, "ascending") for c in order]
                elements = elements.take(pc.sort_indices(elements, sort_keys=keys, null_placement="at_start"))
            eligible = elements.column(nearest[-1]).is_valid().to_numpy() if nearest else np.ones(elements.num_rows, bool)
            block = Elements(
                *(elements.column(c).to_numpy() for c in ("lat", "lon")),
                np.column_stack([elements.column(s).fill_null(0).to_numpy() for s in sums]),
                starts_of(elements, same),
                elements.column(least).fill_null(NONE).to_numpy() if least else None,
                eligible if nearest is not None else None,
                radius_m,
                chord,
            )
            lat, lon = (sites.column(c).to_numpy() for c in ("lat", "lon"))
            results = [(some, *block.around(lat[some], lon[some])) for some in neighbours(lat, lon)]
            place, reached, total, lowest, row, distance = (np.concatenate(x)[...] for x in zip(*results, strict=True))
            place, total, lowest, row, distance = (x[reached] for x in (place, total, lowest, row, distance))
        else:
            place = lowest = row = np.zeros(0, np.int64)
            total, distance = np.zeros((0, len(sums)), np.int64), np.zeros(0)
        made = [sites.column(site).take(pa.array(place)), *(pa.array(t) for t in total.T)]
        made += [pa.array(lowest, mask=lowest == NONE)] if least else []
        if nearest is not None:
            made.append(pa.array(distance, mask=row < 0))
            chosen = pa.array(row, mask=row < 0)
            made += [elements.column(c).take(chosen) for c in nearest]
            columns += [f"nearest_{c}" for c in nearest]
        return pa.table(made, names=columns)

    return work


def starts_of(elements: pa.Table, same: Sequence[str]) -> np.ndarray:
    """Where the rows of an element begin, in rows ordered by ``same``; without it each row is an element."""
    differs = np.full(max(elements.num_rows - 1, 0), not same)
    for name in same:
        column = elements.column(name).combine_chunks()
        one, next_one = column[:-1], column[1:]
        null = [c.is_null().to_numpy(zero_copy_only=False) for c in (one, next_one)]
        equal = pc.fill_null(pc.equal(one, next_one), False).to_numpy(zero_copy_only=False) | (null[0] & null[1])
        differs |= ~equal
    return np.flatnonzero(np.append(True, differs))


def on_sphere(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    phi, theta = np.radians(lat), np.radians(lon)
    return np.column_stack([np.cos(phi) * np.cos(theta), np.cos(phi) * np.sin(theta), np.sin(phi)])


def haversine(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    """Great-circle distance in metres, as ``spatial.haversine_m``."""
    lat1, lon1, lat2, lon2 = (np.radians(c) for c in (lat1, lon1, lat2, lon2))
    a = np.sin((lat2 - lat1) / 2) ** 2 + np.cos(lat1) * np.cos(lat2) * np.sin((lon2 - lon1) / 2) ** 2
    return 2 * EARTH_RADIUS_M * np.arcsin(np.minimum(1.0, np.sqrt(a)))


def neighbours(lat: np.ndarray, lon: np.ndarray) -> Iterator[np.ndarray]:
    """Numbers of sites in groups of neighbours, along a curve that fills space."""
    at = on_sphere(lat, lon)
    low = at.min(axis=0)
    step = ((at - low) / max((at.max(axis=0) - low).max(), SLACK) * 1023).astype(np.int64)
    code = np.zeros(len(at), np.int64)
    for bit in range(10):
        for axis in range(3):
            code |= (step[:, axis] >> bit & 1) << (3 * bit + axis)
    order = np.argsort(code, kind="stable")
    for i in range(0, len(order), GROUP):
        yield order[i : i + GROUP]


class Elements:
    """Elements of a block, rows of one element together."""

    def __init__(
        self,
        lat: np.ndarray,
        lon: np.ndarray,
        values: np.ndarray,
        starts: np.ndarray,
        least: np.ndarray | None,
        eligible: np.ndarray | None,
        radius_m: float,
        chord: float,
    ) -> None:
        self.lat, self.lon, self.values, self.least = lat, lon, values, least
        self.radius_m, self.chord = radius_m, chord
        self.at = on_sphere(lat, lon)
        sizes = np.diff(np.append(starts, len(lat)))
        owner = np.repeat(np.arange(len(starts)), sizes)
        self.single = sizes[owner] == 1
        # Elements of several rows: their rows, and the number of the element among those.
        self.several = np.flatnonzero(~self.single)
        self.several_owner = np.unique(owner[self.several], return_inverse=True)[1]
        self.eligible = None if eligible is None else np.flatnonzero(eligible)

    def within(self, sites: np.ndarray, lat: np.ndarray, lon: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Sites x rows: whether they are in reach."""
        # Differences from a point nearby keep all digits.
        a, b = sites - sites[0], self.at[rows] - sites[0]
        apart = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
        inside = apart <= self.chord**2
        low, high = max(self.chord - SLACK, 0.0) ** 2, (self.chord + SLACK) ** 2
        i, j = np.nonzero((apart >= low) & (apart <= high))
        if len(i):
            inside[i, j] = haversine(lat[i], lon[i], self.lat[rows[j]], self.lon[rows[j]]) <= self.radius_m
        return inside

    def around(self, lat: np.ndarray, lon: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of each site: whether anything is in reach, sums, least, and row and distance of the nearest."""
        sites = on_sphere(lat, lon)
        centre = sites.mean(axis=0)
        wide = math.sqrt(((sites - centre) ** 2).sum(axis=1).max()) + SLACK
        away = np.sqrt(((self.at - centre) ** 2).sum(axis=1))
        sure = away <= self.chord - wide - SLACK
        unsure = ~sure & (away <= self.chord + wide + SLACK)

        total = np.zeros((len(lat), self.values.shape[1]), np.int64) + self.values[sure & self.single].sum(axis=0)
        reached = np.full(len(lat), bool(sure.any()))
        lowest = np.full(len(lat), self.least[sure].min() if self.least is not None and sure.any() else NONE)
        rows = np.flatnonzero(unsure & self.single)
        for i in range(0, len(rows), COLUMNS):
            some = rows[i : i + COLUMNS]
            inside = self.within(sites, lat, lon, some)
            reached |= inside.any(axis=1)
            total += np.rint(inside.astype(float) @ self.values[some].astype(float)).astype(np.int64)
            if self.least is not None:
                lowest = np.minimum(lowest, np.where(inside, self.least[some], NONE).min(axis=1))
        if len(self.several):
            self._several(sites, lat, lon, sure, unsure, total, reached, lowest)
        row, distance = self._nearest(lat, lon, away, wide)
        return reached, total, lowest, row, distance

    def _several(
        self, sites: np.ndarray, lat: np.ndarray, lon: np.ndarray, sure: np.ndarray, unsure: np.ndarray,
        total: np.ndarray, reached: np.ndarray, lowest: np.ndarray,
    ) -> None:
        """Adds elements of several rows: the largest value of their rows in reach."""
        here = sure[self.several]
        known = np.zeros((self.several_owner[-1] + 1, self.values.shape[1]), np.int64)
        np.maximum.at(known, self.several_owner[here], self.values[self.several[here]])
        total += known.sum(axis=0)
        open_ = np.flatnonzero(unsure[self.several])
        rows, owner = self.several[open_], self.several_owner[open_]
        i = 0
        while i < len(rows):
            # Rows of an element are not divided.
            end = int(np.searchsorted(owner, owner[min(i + COLUMNS, len(rows)) - 1], "right"))
            some, first = rows[i:end], np.flatnonzero(np.append(True, np.diff(owner[i:end]) != 0))
            before = known[owner[i:end][first]]
            inside = self.within(sites, lat, lon, some)
            reached |= inside.any(axis=1)
            for k in range(total.shape[1]):
                value = self.values[some, k]
                if (value > 0).any():
                    largest = np.maximum.reduceat(inside * value, first, axis=1)
                    total[:, k] += np.maximum(largest - before[:, k], 0).sum(axis=1)
            if self.least is not None:
                np.minimum(lowest, np.where(inside, self.least[some], NONE).min(axis=1), out=lowest)
            i = end

    def _nearest(self, lat: np.ndarray, lon: np.ndarray, away: np.ndarray, wide: float) -> tuple[np.ndarray, np.ndarray]:
        row, distance = np.full(len(lat), -1), np.full(len(lat), np.inf)
        if self.eligible is None or not len(self.eligible):
            return row, distance
        away = away[self.eligible]
        rows = self.eligible[away <= min(away.min() + 2 * wide, self.chord + wide) + SLACK]
        # In their order, so the first of equally near ones is taken.
        for i in range(0, len(rows), COLUMNS):
            some = rows[i : i + COLUMNS]
            metres = haversine(lat[:, None], lon[:, None], self.lat[some], self.lon[some])
            best = metres.argmin(axis=1)
            found = metres[np.arange(len(lat)), best]
            better = (found <= self.radius_m) & (found < distance)
            row[better], distance[better] = some[best[better]], found[better]
        return row, distance
