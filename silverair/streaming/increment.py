"""Insert-only increments over arriving files.

The checkpoint remembers which files were read. Everything else is kept in the
target table: a batch that is repeated after a failure finds its keys there and
inserts nothing twice. A run therefore gives the same table as one batch over
the same files in the same order.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from silverair.operators.quality import Rule
from silverair.sinks.increments import insert
from silverair.streaming.run_log import logged


def insert_batches(
    transform: Callable[[DataFrame], DataFrame],
    target: str,
    key: str,
    schema: str,
    partition_by: Sequence[str] = (),
    rules: Sequence[Rule] = (),
    count: Callable[[int, Mapping[str, int]], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that appends the new keys of every batch to ``target``.

    Rows that break a rule are kept beside the target; see ``sinks.increments``.
    ``count`` gets the number of the batch and its counters.
    """

    def insert_batch(batch: DataFrame, number: int) -> None:
        counters = insert(transform(batch), target, key, schema, partition_by, rules)
        if count:
            count(number, counters)

    return insert_batch


def run_increment(
    spark: SparkSession,
    source: str,
    source_schema: str,
    transform: Callable[[DataFrame], DataFrame],
    target: str,
    target_schema: str,
    key: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    format: str = "parquet",
    max_files: int | None = None,
    rules: Sequence[Rule] = (),
    log: str | None = None,
) -> StreamingQuery:
    """Process all files that arrived since the last run, then stop; ``log`` is a table for one row per batch."""
    reader = spark.readStream.schema(source_schema).format(format)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    with logged(spark, log) if log else nullcontext() as counters:
        batches = insert_batches(transform, target, key, target_schema, partition_by, rules, counters and counters.count)
        writer = reader.load(source).writeStream.foreachBatch(batches).option("checkpointLocation", checkpoint)
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
    return query
