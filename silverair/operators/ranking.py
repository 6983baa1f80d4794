"""Global row numbers, quantile buckets and slices without a single-task sort.

The built-in window over a whole table moves all rows into one task. Here the
rows are range-partitioned by a total order instead, which also splits a value
that many rows share. Only one count per partition is accumulated centrally.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverair.session import materialise

# monotonically_increasing_id() puts the partition above these bits and the
# position inside the partition below them.
POSITION_BITS = 33


def number_rows(df: DataFrame, order: Sequence[str | Column], name: str = "row_number", total: str | None = None) -> DataFrame:
    """Add the 1-based position of every row in ``order``, and the row count as ``total``.

    ``order`` must end in a unique column. The sorted rows are written once, so
    that counting and numbering see the same partitions. Select the needed
    columns before the call.
    """
    place = F.col("__place")
    ordered = materialise(
        df.orderBy(*order).withColumn("__place", F.monotonically_increasing_id()), "ordered"
    )
    part = F.shiftright(place, POSITION_BITS)
    # One row per sorted partition: bounded by the number of shuffle partitions.
    parts = ordered.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = parts.select(
        "__part",
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"),
        F.sum("__rows").over(everything).alias("__total"),
    )
    placed = ordered.withColumn("__part", part).join(F.broadcast(offsets), "__part")
    position = place.bitwiseAND((1 << POSITION_BITS) - 1)
    numbered = placed.withColumn(name, F.col("__offset") + position + 1)
    if total:
        numbered = numbered.withColumnRenamed("__total", total)
    return numbered.drop("__place", "__part", "__offset", "__total")


def bucket_of(position: str, total: str, buckets: int) -> Column:
    """Bucket of a 1-based position: sizes differ by at most one, larger ones first.

    All divisions are integer divisions; doubles would blur large positions.
    """
    size = f"({total} div {buckets})"
    larger = f"({total} % {buckets})"
    cut = f"({larger} * ({size} + 1))"
    in_larger = f"(({position} - 1) div ({size} + 1) + 1)"
    in_smaller = f"({larger} + ({position} - {cut} - 1) div nullif({size}, 0) + 1)"
    return F.expr(f"CAST(CASE WHEN {position} <= {cut} THEN {in_larger} ELSE {in_smaller} END AS INT)")


def quantile_bucket(df: DataFrame, buckets: int, order: Sequence[str], name: str) -> DataFrame:
    """``ntile(buckets)`` over the whole table; ``order`` must end in a unique column."""
    numbered = number_rows(df, order, "__position", "__count")
    return numbered.withColumn(name, bucket_of("__position", "__count", buckets)).drop("__position", "__count")


def slice_rows(df: DataFrame, order: Sequence[str], start: int = 0, end: int | None = None) -> DataFrame:
    """Rows ``start`` (included) to ``end`` (excluded) of the ordered table."""
    if end is not None and end <= start:
        return df.limit(0)
    numbered = number_rows(df, order, "__position")
    kept = numbered.filter(F.col("__position") > start)
    if end is not None:
        kept = kept.filter(F.col("__position") <= end)
    return kept.drop("__position")


def run_ids(df: DataFrame, order: Sequence[str], run_number: Column, name: str) -> DataFrame:
    """Run number followed by the ordinal of the row, at least three digits, as one decimal number.

    From 100,000 rows on an id has more digits than a 64-bit number.
    """
    numbered = number_rows(df, order, "__ordinal")
    text = F.format_string("%d%03d", run_number.cast("bigint"), F.col("__ordinal").cast("bigint"))
    return numbered.withColumn(name, text.cast("decimal(38,0)")).drop("__ordinal")
