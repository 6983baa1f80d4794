"""Arrays, structs and envelopes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_where(df: DataFrame, array: str, accept: Callable[[Column], Column] | None, name: str) -> DataFrame:
    """One row per accepted element, with its position as ``<name>_pos``.

    Elements are tested inside the array, so rejected ones never become rows.
    Rows with a NULL or empty array vanish.
    """
    items = F.transform(F.col(array), lambda item, i: F.struct(i.alias("pos"), item.alias("item")))
    if accept is not None:
        items = F.filter(items, lambda pair: accept(pair["item"]))
    exploded = df.select(*[c for c in df.columns if c != array], F.explode(items).alias("__pair"))
    return exploded.select(
        *[c for c in df.columns if c != array],
        F.col("__pair.pos").alias(f"{name}_pos"),
        F.col("__pair.item").alias(name),
    )


def zip_rows(driver: Column, others: Mapping[str, Column], name: str) -> Column:
    """Array of structs, one per element of ``driver``; short arrays pad NULL, long ones are cut.

    The structs are built inside the row. Exploding ``driver`` alone would copy
    all other arrays into every output row.
    """
    return F.transform(
        driver,
        lambda value, i: F.struct(
            value.alias(name), *[F.get(array, i).alias(field) for field, array in others.items()]
        ),
    )


def zip_explode(df: DataFrame, driver: str, others: Mapping[str, str], name: str, keep: Sequence[str]) -> DataFrame:
    """One row per element of ``driver`` with the elements of ``others`` at its position."""
    arrays = {field: F.col(column) for field, column in others.items()}
    return df.select(*keep, F.inline(zip_rows(F.col(driver), arrays, name)))


def wrap_envelope(df: DataFrame, load_date: Column, source: str, sensor: str, granularity: str) -> DataFrame:
    """``{data, sys}`` records as they are landed."""
    return df.select(
        F.struct(*[c for c in df.columns if c != sensor]).alias("data"),
        F.struct(
            load_date.alias("load_date"),
            F.lit(source).alias("source"),
            F.col(sensor).alias("sensor_id"),
            F.lit(granularity).alias("granularity"),
        ).alias("sys"),
    )


def unwrap_envelope(df: DataFrame) -> DataFrame:
    """Landed envelopes as flat rows."""
    return df.select("data.*", "sys.*")


def stamp_source(df: DataFrame, url: Column, called_at: Column) -> DataFrame:
    """Give every row of a response its request URL and call time."""
    return df.withColumns({"sys_source_from": url, "api_call_timestamp": called_at})
