"""First, last and newest rows per key.

All of them rank inside the key and keep the first ranks. Spark applies that
limit in every map task before the shuffle (``WindowGroupLimit``), so a key that
holds a third of the table sends a few rows per map task and not its whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverair.operators.ranking import slice_rows

RANK = "__rank"


def remaining_order(df: DataFrame, used: Sequence[str]) -> list[Column]:
    """Columns that complete an ordering to a total one, so ties are reproducible."""

    def has_map(kind: T.DataType) -> bool:
        if isinstance(kind, T.MapType):
            return True
        if isinstance(kind, T.ArrayType):
            return has_map(kind.elementType)
        if isinstance(kind, T.StructType):
            return any(has_map(f.dataType) for f in kind.fields)
        return False

    rest = [f for f in df.schema.fields if f.name not in used]
    return [F.to_json(F.struct(f.name)) if has_map(f.dataType) else F.col(f.name) for f in rest]


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every key; ``order`` should be total."""
    ranked = df.withColumn(RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(RANK) <= n).drop(RANK)


def latest_per_key(df: DataFrame, keys: Sequence[str], by: str, tie: Sequence[Column] | None = None) -> DataFrame:
    """The row with the greatest ``by`` per key; NULL keys form one key, NULL ``by`` loses."""
    tie = remaining_order(df, [*keys, by]) if tie is None else tie
    return top_per_key(df, keys, [F.col(by).desc_nulls_last(), *tie], 1)


def first_per_key(df: DataFrame, keys: Sequence[str], ordinal: Sequence[str]) -> DataFrame:
    """First row seen per key; NULLs in keys equal each other."""
    return top_per_key(df, keys, [F.col(c).asc() for c in ordinal], 1)


def last_per_key(df: DataFrame, keys: Sequence[str], ordinal: Sequence[str]) -> DataFrame:
    """Last row seen per key."""
    return top_per_key(df, keys, [F.col(c).desc() for c in ordinal], 1)


def distinct_sites(
    locations: DataFrame,
    ordinal: Sequence[str],
    required: Sequence[str],
    keys: Sequence[str] = ("country_name", "city_or_locality", "longitude", "latitude"),
    limit: int | None = None,
) -> DataFrame:
    """Sites with coordinates, first of each key; the first ``limit`` of them in input order if given."""
    sites = first_per_key(locations.na.drop("any", subset=list(required)), keys, ordinal)
    return sites if limit is None else slice_rows(sites, ordinal, 0, limit)
