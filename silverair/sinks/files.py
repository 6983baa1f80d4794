"""Parquet and JSON writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from silverair.functions.times import FRACTION_FORMAT

MAX_ROWS_PER_FILE = 20_000_000


def balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition together, but split partitions that are large.

    A plain ``repartition`` by the column would write a hot day in one task.
    """
    return df.hint("rebalance", *partition_by)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = (), table: str | None = None) -> None:
    """Append snappy parquet; register it as ``table`` if a name is given."""
    if partition_by:
        df = balanced(df, partition_by)
    writer = df.write.mode("append").option("compression", "snappy").option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if table:
        writer.format("parquet").option("path", path).saveAsTable(table)
    else:
        writer.parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Write ``df`` and replace exactly the partitions that it has rows for."""
    (
        balanced(df, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
        .partitionBy(*partition_by)
        .parquet(path)
    )


def with_month_partition(df: DataFrame, day: str) -> DataFrame:
    """Add ``year`` and ``month`` of a day text; text that is no day gets its own partition."""
    parsed = F.try_to_date(F.col(day), "yyyy-MM-dd")
    return df.withColumns(
        {
            "year": F.coalesce(F.date_format(parsed, "yyyy"), F.lit("unknown_year")),
            "month": F.coalesce(F.date_format(parsed, "MM"), F.lit("unknown_month")),
        }
    )


def land(df: DataFrame, path: str, run_at: Column, format: str = "parquet", run: str | None = None) -> int:
    """Append ``df`` under the day of the run, ``year=/month=/day=``; returns the number of rows.

    ``run`` adds a folder for the run below its day. Rows are counted while they
    are written, so the plan is evaluated once; an empty frame leaves no file.
    """
    parts = {
        "year": F.date_format(run_at, "yyyy"),
        "month": F.date_format(run_at, "MM"),
        "day": F.date_format(run_at, "dd"),
    }
    if run is not None:
        parts["run"] = F.lit(run)
    counter = Observation()
    counted = df.observe(counter, F.count(F.lit(1)).alias("rows"))
    writer = counted.withColumns(parts).write.mode("append").partitionBy(*parts).format(format)
    if format == "json":
        # The default keeps milliseconds only.
        writer = writer.option("timestampFormat", FRACTION_FORMAT)
    writer.option("maxRecordsPerFile", MAX_ROWS_PER_FILE).save(path)
    return counter.get["rows"]
