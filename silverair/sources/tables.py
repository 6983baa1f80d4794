"""Table scans, optional scans, named-frame SQL and day spines."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverair.sources.files import exists


def scan(spark: SparkSession, name: str, schema: str | None = None, format: str = "parquet") -> DataFrame:
    """A catalog table by name, or a path-backed table when ``schema`` is given."""
    if schema is None:
        return spark.table(name)
    return spark.read.schema(schema).format(format).load(name)


def optional_scan(spark: SparkSession, name: str, schema: str | None = None) -> DataFrame | None:
    """The table, or ``None`` if it does not exist yet; any other error propagates."""
    if schema is None:
        return spark.table(name) if spark.catalog.tableExists(name) else None
    return scan(spark, name, schema) if exists(spark, name) else None


def run_sql(spark: SparkSession, text: str, frames: Mapping[str, DataFrame]) -> DataFrame:
    """SQL over named frames; the text refers to them as ``{name}``. Leaves no view behind."""
    return spark.sql(text, **frames)


def day_spine(bounds: DataFrame, start: Column, end: Column, name: str = "full_date") -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    days = F.sequence(F.to_date(start), F.to_date(end), F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias(name))
