"""Appends that keep a bounded memory of keys instead of asking the target."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import nullcontext

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from silverair.streaming.run_log import logged


def append_once(
    spark: SparkSession,
    source: str,
    source_schema: str,
    key: Sequence[str],
    event_time: str,
    delay: str,
    target: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    format: str = "parquet",
    max_files: int | None = None,
    log: str | None = None,
) -> StreamingQuery:
    """Append the first row of every ``key`` from the files that arrived since the last run, then stop.

    The state holds the keys of the last ``delay`` of event time, whatever the size
    of the target, and is spread by key; the target is never read. A key that
    comes again within the delay of its first row is ignored. Rows that are older than the newest
    event time of earlier batches by more than the delay can no longer be told
    from repetitions and are not appended: ``late_rows`` in the table ``log`` counts them. Where those
    have to count, use ``increment.run_increment``, which looks into the target.

    Rows without event time are never old; their keys are forgotten by the next batch.
    The log of the file sink makes a repeated batch count once. A reader of the whole
    folder follows that log.
    """
    reader = spark.readStream.schema(source_schema).format(format)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    first = reader.load(source).withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(key))
    writer = first.writeStream.outputMode("append").format("parquet").option("path", target)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with logged(spark, log) if log else nullcontext():
        query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    return query
