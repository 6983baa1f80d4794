"""Versioned refresh: write beside the old data, then point to it.

Readers resolve the pointer first. A refresh that fails half way leaves the
pointer, and with it the old data, untouched. Pointers are numbered files that are
never overwritten: the newest number counts, and of two writers that build on
the same version only one gets the next number. The other builds on the newer
version (``update``), or takes the number behind it (``publish``).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import UTC, datetime, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from silverair.sinks.files import MAX_ROWS_PER_FILE
from silverair.sources.files import create_once, delete_folder, exists, file_names, list_files

MANIFEST = "number bigint, version string, path string, rows bigint, details string, created_at string, committed_at string"
# Runs that lose the race this often in a row give up.
ATTEMPTS = 20


def _manifest_path(root: str) -> str:
    return f"{root.rstrip('/')}/manifest"


class Conflict(RuntimeError):
    """Other writers were faster, again and again."""


def new_version() -> str:
    """The name of a folder for new data. Its number, given when it is published, decides what is newer."""
    return f"{datetime.now(UTC):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """All versions that are kept, one row each."""
    return spark.read.schema(MANIFEST).json(_manifest_path(root))


def current(spark: SparkSession, root: str) -> dict[str, Any] | None:
    """Pointer to the newest published version, or ``None`` before the first one."""
    names = [name for name in file_names(spark, _manifest_path(root)) if name.endswith(".json")]
    if not names:
        return None
    # Names are padded numbers, so the last one is the newest.
    return spark.read.schema(MANIFEST).json(f"{_manifest_path(root)}/{max(names)}").first().asDict()


def read_current(spark: SparkSession, root: str, schema: str | StructType) -> DataFrame:
    pointer = current(spark, root)
    if pointer is None:
        raise FileNotFoundError(f"nothing published under {root}")
    return spark.read.schema(schema).parquet(pointer["path"])


def commit(
    spark: SparkSession,
    root: str,
    base: Mapping[str, Any] | None,
    version: str,
    path: str,
    rows: int,
    details: Mapping[str, Any],
    now: datetime,
) -> dict[str, Any] | None:
    """Point to ``path`` as the successor of ``base``; ``None`` if ``base`` has one already."""
    number = (base["number"] if base else 0) + 1
    entry = {
        "number": number,
        "version": version,
        "path": path,
        "rows": rows,
        "details": json.dumps(dict(details)),
        "created_at": now.isoformat(),
        "committed_at": datetime.now(UTC).isoformat(),
    }
    return entry if create_once(spark, f"{_manifest_path(root)}/{number:020d}.json", json.dumps(entry)) else None


def publish(
    spark: SparkSession, root: str, version: str, path: str, rows: int, details: Mapping[str, Any], now: datetime
) -> dict[str, Any]:
    """Point to ``path``, whatever was published before; call this after its data was committed."""
    for _ in range(ATTEMPTS):
        if entry := commit(spark, root, current(spark, root), version, path, rows, details, now):
            return {name: entry[name] for name in ("version", "path", "rows", "created_at")}
    raise Conflict(f"{root} changed {ATTEMPTS} times")


def _write(df: DataFrame, path: str, metrics: Sequence[Column]) -> dict[str, Any]:
    """Write ``df`` and return the row count and ``metrics``, taken on the way."""
    counters = Observation()
    counted = df.observe(counters, F.count(F.lit(1)).alias("rows"), *metrics)
    (
        counted.write.mode("errorifexists")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
        .parquet(path)
    )
    return counters.get


def update(
    spark: SparkSession,
    root: str,
    schema: str,
    change: Callable[[DataFrame], DataFrame],
    details: Mapping[str, Any] | None = None,
    metrics: Sequence[Column] = (),
    now: datetime | None = None,
) -> dict[str, Any]:
    """Publish ``change`` of the current content; returns the pointer and the counters.

    ``change`` gets an empty frame before the first version. If another writer
    publishes meanwhile, it is applied again to what that one left, so no update
    is lost. It must not depend on anything else that the other writer changed.
    """
    now = now or datetime.now(UTC)
    for _ in range(ATTEMPTS):
        base = current(spark, root)
        old = spark.read.schema(schema).parquet(base["path"]) if base else spark.createDataFrame([], schema)
        version = new_version()
        path = f"{root.rstrip('/')}/data/version={version}"
        observed = _write(change(old), path, metrics)
        if entry := commit(spark, root, base, version, path, observed["rows"], details or {}, now):
            return {**observed, **{name: entry[name] for name in ("version", "path", "rows", "created_at")}}
        delete_folder(spark, path)
    raise Conflict(f"{root} changed {ATTEMPTS} times")


def refresh(
    df: DataFrame,
    root: str,
    details: Mapping[str, Any] | None = None,
    metrics: Sequence[Column] = (),
    validate: Callable[[DataFrame], None] | None = None,
    now: datetime | None = None,
) -> dict[str, Any]:
    """Publish ``df`` as the new content of ``root``; returns the pointer and the counters.

    The row count and ``metrics`` are taken while the data is written.
    ``validate`` sees the written rows and raises to keep them unpublished.
    """
    spark = df.sparkSession
    now = now or datetime.now(UTC)
    version = new_version()
    path = f"{root.rstrip('/')}/data/version={version}"
    observed = _write(df, path, metrics)
    if validate:
        validate(spark.read.schema(df.schema).parquet(path))
    return {**observed, **publish(spark, root, version, path, observed["rows"], details or {}, now)}


def register(spark: SparkSession, root: str, table: str, schema: str) -> None:
    """Let the catalog table ``table`` show the current version; creates the table if needed."""
    pointer = current(spark, root)
    if pointer is None:
        raise FileNotFoundError(f"nothing published under {root}")
    if spark.catalog.tableExists(table):
        location = pointer["path"].replace("'", "\\'")
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
        spark.catalog.refreshTable(table)
    else:
        columns = spark.read.schema(schema).parquet(pointer["path"]).schema
        spark.catalog.createTable(table, path=pointer["path"], source="parquet", schema=columns)


def retain(spark: SparkSession, root: str, versions: int = 2, grace: timedelta = timedelta(days=1)) -> int:
    """Delete old versions and their pointers; returns the number of deleted data files.

    The newest ``versions`` stay, and whatever was replaced less than ``grace`` ago:
    a reader that opened a version before a refresh can finish. Deleted versions
    leave the manifest, so it holds what still exists and later calls look at that.
    """
    listed = manifest(spark, root).select("*", "_metadata.file_path").orderBy(F.desc("number")).collect()
    deleted = 0
    # A version is as old as its successor, which replaced it.
    for newer, old in zip(listed[versions - 1 :], listed[versions:], strict=False):
        if datetime.now(UTC) - datetime.fromisoformat(newer["committed_at"]) < grace:
            continue
        if exists(spark, old["path"]):
            deleted += list_files(spark, old["path"]).count()
            delete_folder(spark, old["path"])
        delete_folder(spark, old["file_path"])
    return deleted

