"""Insert-only appends that survive bad rows, repeated batches and a lagging warehouse."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from silverair.operators.increment import insert_new
from silverair.operators.quality import Rule, broken_rules, check, enforce
from silverair.session import staged
from silverair.sinks.files import append
from silverair.sinks.versions import new_version
from silverair.sources.files import delete_folder, folders
from silverair.sources.tables import optional_scan

REASON = "broken_rules"
ROW = "row_hash"


def quarantine_path(path: str) -> str:
    return f"{path.rstrip('/')}_quarantine"


def pending_path(path: str) -> str:
    return f"{path.rstrip('/')}_pending"


def _counted(rows: DataFrame, write: Callable[[DataFrame], None]) -> int:
    counter = Observation()
    write(rows.observe(counter, F.count(F.lit(1)).alias("rows")))
    return _seen(counter, "rows")


def _seen(counter: Observation, name: str) -> int:
    try:
        return counter.get[name]
    except Py4JJavaError as error:
        # A plan that turns out empty runs no task, and an observation without tasks has no row to give.
        if "assertion failed" not in str(error):
            raise
        return 0


def _set_aside(bad: DataFrame, path: str) -> int:
    """Keep each bad row once, however often it arrives, with the rules that it breaks."""
    columns = [F.col(c) for c in bad.columns if c != REASON]
    marked = bad.withColumn(ROW, F.xxhash64(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})))
    known = optional_scan(bad.sparkSession, path, marked.schema)
    fresh = insert_new(marked.dropDuplicates([ROW]), known, ROW)
    return _counted(fresh, lambda rows: append(rows, path))


def insert(
    batch: DataFrame,
    path: str,
    key: str,
    schema: str,
    partition_by: Sequence[str] = (),
    rules: Sequence[Rule] = (),
    catalog_table: str | None = None,
    copy: Callable[[DataFrame], None] | None = None,
) -> dict[str, int]:
    """Append the rows of ``batch`` whose key is new; returns ``inserted`` and ``quarantined``.

    The batch is written once, and deleted at the end. Rows that break a row-local
    rule go to a table beside the target and do not stop the rest; a broken
    uniqueness rule raises before anything is appended.

    ``copy`` brings appended rows to another system. They are first written beside
    the target and stay there until the copy succeeded, so that a later run makes
    up for a copy that failed. A run that is lost between the two repeats the copy.
    """
    spark = batch.sparkSession
    prune_by = partition_by[0] if partition_by else None
    counts = {"inserted": 0, "quarantined": 0}
    if copy:
        counts["inserted"] += settle(spark, path, key, schema, partition_by, catalog_table, copy)
    counter = Observation()
    marked = batch.withColumn(REASON, broken_rules(rules))
    with staged(marked.observe(counter, F.count_if(F.size(REASON) > 0).alias("bad")), "increment") as rows:
        good = rows.where(F.size(REASON) == 0).drop(REASON)
        if _seen(counter, "bad"):
            counts["quarantined"] = _set_aside(rows.where(F.size(REASON) > 0), quarantine_path(path))
        new = insert_new(good, optional_scan(spark, path, schema), key, prune_by)
        keys = [r for r in rules if r.unique]
        if keys:
            enforce(check(new, keys))
        if copy:
            new.write.parquet(f"{pending_path(path)}/{new_version()}")
            counts["inserted"] += settle(spark, path, key, schema, partition_by, catalog_table, copy)
        else:
            counts["inserted"] = _counted(new, lambda df: append(df, path, partition_by, catalog_table))
    return counts


def settle(
    spark: SparkSession,
    path: str,
    key: str,
    schema: str,
    partition_by: Sequence[str],
    catalog_table: str | None,
    copy: Callable[[DataFrame], None],
) -> int:
    """Append and copy all pending batches, oldest first; returns the number of appended rows."""
    appended = 0
    for folder in sorted(folders(spark, pending_path(path))):
        rows = spark.read.schema(schema).parquet(folder)
        # They may have been appended before the run was lost.
        missing = insert_new(rows, optional_scan(spark, path, schema), key, partition_by[0] if partition_by else None)
        appended += _counted(missing, lambda df: append(df, path, partition_by, catalog_table))
        copy(rows)
        delete_folder(spark, folder)
    return appended
