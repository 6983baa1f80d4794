"""JDBC copies of the silver tables.

Connection options come from the caller. The writers open one connection per
partition, so the number of partitions is bounded.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, DataFrameWriter

from silverair.schemas import Table

CONNECTIONS = 16
BATCH_ROWS = 10_000


def _writer(df: DataFrame, table: Table, options: Mapping[str, str]) -> DataFrameWriter:
    return (
        table.conform(df)
        .write.format("jdbc")
        .option("dbtable", table.name)
        .option("numPartitions", CONNECTIONS)
        .option("batchsize", BATCH_ROWS)
        .option("createTableColumnTypes", table.jdbc_types)
        .options(**options)
    )


def append(df: DataFrame, table: Table, options: Mapping[str, str]) -> None:
    _writer(df, table, options).mode("append").save()


def replace(df: DataFrame, table: Table, options: Mapping[str, str]) -> None:
    """Replace all rows and keep the table, with its constraints."""
    _writer(df, table, options).option("truncate", "true").mode("overwrite").save()
