"""Jobs: one evaluation of the plan, the quality rules, the write, the JDBC copy."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import UTC, date, datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverair.operators.quality import check, enforce
from silverair.plans import silver
from silverair.schemas import (
    DIM_DATE,
    DIM_SENSOR_LOCATION,
    DIM_URBANITY_SCORE,
    FACT_SENSOR_MEASURE,
    FACT_WEATHER,
    MEASURE_PARTS,
    Table,
)
from silverair.session import staged
from silverair.sinks import files, increments, partitions, versions, warehouse
from silverair.sources.tables import scan

JdbcOptions = Mapping[str, str] | None


def _gate(table: Table, gated: bool) -> Callable[[DataFrame], None] | None:
    return (lambda rows: enforce(check(rows, table.rules))) if gated else None


def insert_only(
    batch: DataFrame,
    table: Table,
    path: str,
    partition_by: Sequence[str] = (),
    jdbc: JdbcOptions = None,
    gated: bool = True,
    catalog_table: str | None = None,
) -> dict[str, int]:
    """Append the rows of ``batch`` whose key is new; returns the numbers of inserted and quarantined rows.

    A gated job keeps rows that break a constraint of ``table`` beside the target,
    with the reason, and loads the rest. Repeated keys in one batch stop the load.
    """
    copy = (lambda rows: warehouse.append(rows, table, jdbc)) if jdbc else None
    rules = table.rules if gated else ()
    return increments.insert(
        table.conform(batch), path, table.key, table.ddl, partition_by, rules, catalog_table, copy
    )


def full_refresh(
    df: DataFrame,
    table: Table,
    root: str,
    jdbc: JdbcOptions = None,
    gated: bool = True,
    catalog_table: str | None = None,
    keep: int = 2,
    grace: timedelta = timedelta(days=1),
    now: datetime | None = None,
) -> dict[str, Any]:
    """Replace the published version of ``table``; versions beyond ``keep`` go after ``grace``.

    A gated job publishes nothing if a constraint of ``table`` is violated.
    """
    spark = df.sparkSession
    result = versions.refresh(table.conform(df), root, validate=_gate(table, gated), now=now or datetime.now(UTC))
    if catalog_table:
        versions.register(spark, root, catalog_table, table.ddl)
    if jdbc:
        warehouse.replace(versions.read_current(spark, root, table.ddl), table, jdbc)
    result["deleted_files"] = versions.retain(spark, root, keep, grace)
    return result


def sensor_locations(locations: DataFrame, path: str, jdbc: JdbcOptions = None, **options: Any) -> dict[str, int]:
    return insert_only(silver.sensor_location(locations), DIM_SENSOR_LOCATION, path, jdbc=jdbc, **options)


def sensor_measures(
    measurements: DataFrame, historical: DataFrame, root: str, jdbc: JdbcOptions = None, **options: Any
) -> dict[str, Any]:
    return full_refresh(silver.sensor_measure(measurements, historical), FACT_SENSOR_MEASURE, root, jdbc, **options)


def merge_measures(
    measurements: DataFrame,
    historical: DataFrame,
    root: str,
    batch: str,
    gated: bool = True,
    keep: int = 2,
    grace: timedelta = timedelta(days=1),
    now: datetime | None = None,
    **options: Any,
) -> dict[str, Any]:
    """Add a batch of API rows and readings to the measure fact; returns the pointer.

    Aggregates of the batch are kept by day under ``root/parts``. Only the days that
    the batch has rows for are merged again and published, so late readings cost
    what their days hold and history is not read. A batch that is loaded again
    under its name replaces itself. ``measures`` reads the result.
    """
    spark = historical.sparkSession
    with staged(silver.measure_parts(measurements, historical, **options), "measure-parts") as parts:
        files.replace_partitions(parts.withColumn("batch", F.lit(batch)), f"{root}/parts", ["load_date", "batch"])
        # As many as the batch has days.
        days = [r[0] for r in parts.select("load_date").distinct().collect()]

    def build() -> DataFrame:
        stored = scan(spark, f"{root}/parts", MEASURE_PARTS)
        day = F.col("load_date")
        touched = day.isin([d for d in days if d]) | (day.isNull() if None in days else F.lit(False))
        return FACT_SENSOR_MEASURE.conform(silver.merged_measures(stored.where(touched).drop("batch")))

    published = partitions.replace(spark, f"{root}/fact", "load_date", build, _gate(FACT_SENSOR_MEASURE, gated), now)
    return {**published, "deleted_partitions": partitions.retain(spark, f"{root}/fact", keep, grace)}


def measures(spark: SparkSession, root: str) -> DataFrame:
    """The measure fact that ``merge_measures`` keeps."""
    return partitions.read(spark, f"{root}/fact", FACT_SENSOR_MEASURE.ddl)


def weather(raw: DataFrame, path: str, jdbc: JdbcOptions = None, **options: Any) -> dict[str, int]:
    return insert_only(silver.latest_weather(raw), FACT_WEATHER, path, ["date_id"], jdbc, **options)


def urbanity_scores(features: DataFrame, root: str, jdbc: JdbcOptions = None, **options: Any) -> dict[str, Any]:
    return full_refresh(silver.urbanity(features), DIM_URBANITY_SCORE, root, jdbc, **options)


def dates(
    spark: SparkSession, first: date, last: date, root: str, jdbc: JdbcOptions = None, **options: Any
) -> dict[str, Any]:
    calendar = silver.date_dimension(spark.range(1), F.lit(first), F.lit(last))
    return full_refresh(calendar, DIM_DATE, root, jdbc, **options)
