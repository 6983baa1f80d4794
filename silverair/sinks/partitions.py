"""Tables whose partitions are replaced one by one behind a pointer.

A version writes only the partitions that changed. Its pointer lists for every
partition the folders that hold it, so readers see all partitions of one moment,
and those that opened an older version go on reading it. ``append`` adds a folder
to its partitions, and ``compact`` makes one of many.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping
from datetime import UTC, datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from silverair.sinks import versions
from silverair.sinks.files import MAX_ROWS_PER_FILE, balanced
from silverair.sources.files import delete_folder, folders

# Files of a compacted partition have this size, but for its last one.
TARGET_BYTES = 128 << 20

# Partition folder name, such as ``day=2026-01-01``, to the version folder that holds it.
Layout = dict[str, str]
# The same, to all version folders that hold a part of it.
Pieces = dict[str, list[str]]


def layout(pointer: Mapping[str, Any] | None) -> Layout:
    """The folder that was last written as a whole, or first appended, for every partition."""
    return {name: folders[0] for name, folders in pieces(pointer).items()}


def pieces(pointer: Mapping[str, Any] | None) -> Pieces:
    if not pointer:
        return {}
    details = json.loads(pointer["details"])
    appended = details.get("appended", {})
    return {name: [folder, *appended.get(name, [])] for name, folder in details["partitions"].items()}


def _details(by: str, parts: Pieces) -> dict[str, Any]:
    more = {name: folders[1:] for name, folders in parts.items() if len(folders) > 1}
    return {"by": by, "partitions": {name: folders[0] for name, folders in parts.items()}, "appended": more}


def read(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """All partitions of the current version; empty before the first one."""
    return _read(spark, root, schema, pieces(versions.current(spark, root)))


def _read(spark: SparkSession, root: str, schema: str, parts: Pieces) -> DataFrame:
    empty = spark.createDataFrame([], schema)
    if not parts:
        return empty
    paths = [f"{folder}/{name}" for name, folders in sorted(parts.items()) for folder in folders]
    return spark.read.schema(schema).option("basePath", f"{root.rstrip('/')}/data").parquet(*paths).select(*empty.columns)


def _write(spark: SparkSession, root: str, by: str, rows: DataFrame) -> tuple[str, str, set[str]]:
    """Version, folder and partition names of ``rows``, written but not published."""
    version = versions.new_version()
    path = f"{root.rstrip('/')}/data/version={version}"
    (
        balanced(rows, [by])
        .write.mode("errorifexists")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
        .partitionBy(by)
        .parquet(path)
    )
    return version, path, {f.rpartition("/")[2] for f in folders(spark, path) if f"/{by}=" in f}


def append(spark: SparkSession, root: str, by: str, rows: DataFrame, now: datetime | None = None) -> dict[str, Any]:
    """Add ``rows`` to the partitions that they belong to. Whatever others publish meanwhile, they are written once."""
    now = now or datetime.now(UTC)
    version, path, names = _write(spark, root, by, rows)
    count = spark.read.schema(rows.schema).parquet(path).count()
    for _ in range(versions.ATTEMPTS):
        base = versions.current(spark, root)
        parts = pieces(base)
        parts |= {name: [*parts.get(name, []), path] for name in names}
        if entry := versions.commit(spark, root, base, version, path, count, _details(by, parts), now):
            return {"version": version, "path": path, "rows": count, "partitions": len(names), "created_at": entry["created_at"]}
    delete_folder(spark, path)
    raise versions.Conflict(f"{root} changed {versions.ATTEMPTS} times")


def _crowded(spark: SparkSession, parts: Pieces, target_bytes: int) -> set[str]:
    """Partitions with more files than their bytes need. Only the listing is read."""
    paths = [f"{folder}/{name}" for name, held in parts.items() for folder in held]
    if not paths:
        return set()
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(paths)
    sizes = listed.groupBy(F.element_at(F.split("path", "/"), -2).alias("name")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )
    return {r["name"] for r in sizes.where(F.col("files") > F.ceil(F.col("bytes") / target_bytes)).collect()}


def compact(
    spark: SparkSession, root: str, by: str, schema: str, target_bytes: int = TARGET_BYTES, now: datetime | None = None
) -> dict[str, Any]:
    """Write partitions with needlessly many files anew and publish them; returns ``partitions`` and ``rows``.

    Readers go on with the files that they opened. What others append meanwhile
    stays beside the compacted folder. A partition that others replaced meanwhile is
    left to them. ``retain`` deletes the small files after their time.
    """
    now = now or datetime.now(UTC)
    read = pieces(versions.current(spark, root))
    old = {name: read[name] for name in _crowded(spark, read, target_bytes)}
    if not old:
        return {"partitions": 0, "rows": 0}
    rows = _read(spark, root, schema, old)
    version, path, _ = _write(spark, root, by, rows)
    count = spark.read.schema(schema).parquet(path).count()
    if count != (before := rows.count()):
        delete_folder(spark, path)
        raise RuntimeError(f"{count} of {before} rows written to {path}")
    for _ in range(versions.ATTEMPTS):
        base = versions.current(spark, root)
        parts = pieces(base)
        whole = {name for name, held in old.items() if set(held) <= set(parts.get(name, []))}
        if not whole:
            break
        parts |= {name: [path, *[f for f in parts[name] if f not in old[name]]] for name in whole}
        if versions.commit(spark, root, base, version, path, count, _details(by, parts), now):
            return {"partitions": len(whole), "rows": count}
    delete_folder(spark, path)
    if whole:
        raise versions.Conflict(f"{root} changed {versions.ATTEMPTS} times")
    return {"partitions": 0, "rows": 0}


def replace(
    spark: SparkSession,
    root: str,
    by: str,
    build: Callable[[], DataFrame],
    validate: Callable[[DataFrame], None] | None = None,
    now: datetime | None = None,
) -> dict[str, Any]:
    """Publish the rows of ``build`` in place of the partitions that they belong to; others stay as they are.

    If another writer published some of the same partitions meanwhile, ``build`` is
    called again and must take that into account. Partitions that others changed
    elsewhere are taken over without building anew. ``validate`` sees the written
    rows and raises to keep them unpublished.
    """
    now = now or datetime.now(UTC)
    base, names = None, None
    for _ in range(versions.ATTEMPTS):
        newest = versions.current(spark, root)
        changed = {name for name, held in pieces(newest).items() if pieces(base).get(name) != held}
        if names is None or changed & names:
            if names is not None:
                delete_folder(spark, path)
            rows = build()
            version, path, names = _write(spark, root, by, rows)
            stored = spark.read.schema(rows.schema).parquet(path)
            if validate:
                validate(stored)
            count = stored.count()
        base = newest
        parts = {**pieces(base), **{name: [path] for name in names}}
        if entry := versions.commit(spark, root, base, version, path, count, _details(by, parts), now):
            return {"version": version, "path": path, "rows": count, "partitions": len(names), "created_at": entry["created_at"]}
    delete_folder(spark, path)
    raise versions.Conflict(f"{root} changed {versions.ATTEMPTS} times")


def retain(spark: SparkSession, root: str, keep: int = 2, grace: timedelta = timedelta(days=1)) -> int:
    """Delete partitions that no kept version refers to, and the pointers of the others; returns their number.

    The newest ``keep`` versions stay, and whatever was replaced less than ``grace`` ago.
    """
    listed = sorted(versions.manifest(spark, root).select("*", "_metadata.file_path").collect(), key=lambda r: -r["number"])
    gone = [
        old
        for newer, old in zip(listed[keep - 1 :], listed[keep:], strict=False)
        if datetime.now(UTC) - datetime.fromisoformat(newer["committed_at"]) >= grace
    ]
    def held(entries: Iterable[Row]) -> set[tuple[str, str]]:
        return {(name, folder) for r in entries for name, parts in pieces(r.asDict()).items() for folder in parts}

    dead = held(gone) - held(r for r in listed if r not in gone)
    for name, folder in sorted(dead):
        delete_folder(spark, f"{folder}/{name}")
    for old in gone:
        delete_folder(spark, old["file_path"])
    return len(dead)
