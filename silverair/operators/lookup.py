"""Joins of a large table with a lookup table, whatever key is hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from silverair.session import scratch_path
from silverair.sources.files import folder_bytes

# A lookup within both bounds is broadcast, so the large side is not shuffled.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 32 << 20
# Beyond them every key of the large side is spread over this many tasks.
SALTS = 16
SALT = "__salt"


def lookup_join(large: DataFrame, lookup: DataFrame, keys: Sequence[str], spread: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``large`` with ``lookup`` on ``keys``; ``how`` is ``inner`` or ``left``.

    The lookup is written once, which measures it. A small one is broadcast. For
    a larger one, rows of ``large`` get a salt from their ``spread`` columns and
    the lookup is repeated per salt. Salted keys also put a shuffle directly
    below both sides of the join, and only then can AQE split a partition that
    is still too large.
    """
    spark = large.sparkSession
    path, counter = scratch_path(spark, "lookup"), Observation()
    lookup.observe(counter, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    stored = spark.read.schema(lookup.schema).parquet(path)
    if counter.get["rows"] <= BROADCAST_ROWS and folder_bytes(spark, path) <= BROADCAST_BYTES:
        return large.join(F.broadcast(stored), list(keys), how)
    salted = large.withColumn(SALT, F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int"))
    repeated = stored.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias(SALT))
    return salted.join(repeated, [*keys, SALT], how).drop(SALT)
