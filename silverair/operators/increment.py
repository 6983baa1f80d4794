"""Insert-only increments, left joins back and unions by source priority."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverair.operators.dedupe import remaining_order, top_per_key

PRIORITY = "source_priority"


def insert_new(current: DataFrame, existing: DataFrame | None, key: str, prune_by: str | None = None) -> DataFrame:
    """Rows of ``current`` whose ``key`` is not in ``existing``; rows without a key are dropped.

    ``existing`` is ``None`` on the first load. ``prune_by`` names a partition
    column of ``existing``: only partitions that the batch has rows for are read,
    and the one without a value. A late row adds its own partition, not the
    range up to it. Materialise ``current`` before, since its values are read too.
    """
    keyed = current.filter(F.col(key).isNotNull())
    if existing is None:
        return keyed
    if prune_by:
        parts = keyed.agg(F.collect_set(prune_by)).scalar()
        existing = existing.filter(F.array_contains(parts, F.col(prune_by)) | F.col(prune_by).isNull())
    return keyed.join(existing.select(key), key, "left_anti")


def join_back(base: DataFrame, scores: DataFrame, key: str, required: Sequence[str] = ()) -> DataFrame:
    """Put ``scores`` back on all rows of ``base``; drop rows that miss a required value."""
    joined = base.join(scores, key, "left")
    return joined.na.drop("any", subset=list(required)) if required else joined


def priority_union(
    sources: Sequence[DataFrame], keys: Sequence[str], newest: str, tie: Sequence[Column] | None = None
) -> DataFrame:
    """One row per key from the first source that has the key, newest row first.

    ``sources`` are ordered by priority and share their column names.
    """
    merged = None
    for priority, source in enumerate(sources, start=1):
        ranked = source.withColumn(PRIORITY, F.lit(priority))
        merged = ranked if merged is None else merged.unionByName(ranked)
    if tie is None:
        tie = remaining_order(merged, [*keys, newest, PRIORITY])
    order = [F.col(PRIORITY).asc(), F.col(newest).desc_nulls_last(), *tie]
    return top_per_key(merged, keys, order, 1).drop(PRIORITY)
