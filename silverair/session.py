"""Session settings, the shared scratch folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Every setting here can be changed on a running session, so the same
# function serves sessions that this package did not create.
RUNTIME_SETTINGS = {
    # Days are UTC days; see functions.times.local_day for site-local days.
    "spark.sql.session.timeZone": "UTC",
    # Bad text is turned into NULL by try_* functions only, never silently.
    "spark.sql.ansi.enabled": "true",
    # Joins start as shuffle joins where sizes are unknown. AQE switches to a
    # broadcast once the measured size allows it and splits hot partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # "First n rows per key" keeps n rows per key and map task before the
    # shuffle. The limit streams over sorted rows, so a large n is safe.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to ``spark`` and return it."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build_session(app: str = "silverair", master: str | None = None, **settings: str) -> SparkSession:
    """Create (or fetch) a configured session; ``settings`` use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return configure(builder.getOrCreate())


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a temporary folder, because there all tasks share one disk.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="silverair-")
    context.setCheckpointDir(root)
    return context.getCheckpointDir()


def scratch_folder(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this application.

    Frames read from it until they are used up, so it is left to the caller to
    delete it when the application ends.
    """
    return f"{scratch_root(spark).rstrip('/')}/silverair/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the scratch folder that nothing else uses."""
    return f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder once and return a scan of it.

    The scan has no lineage, survives lost executors and prunes columns, so
    several readers cost less than several evaluations of the plan.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, label: str = "stage") -> Iterator[DataFrame]:
    """As ``materialise``, for the length of a ``with`` block: the written table is deleted behind it."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    try:
        df.write.mode("errorifexists").parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
