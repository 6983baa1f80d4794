"""File listings, newest files and landed responses."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _filesystem(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    filesystem, target = _filesystem(spark, path)
    return filesystem.exists(target)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Folders directly below ``path``; none if it does not exist."""
    filesystem, target = _filesystem(spark, path)
    if not filesystem.exists(target):
        return []
    return [s.getPath().toString() for s in filesystem.listStatus(target) if s.isDirectory()]


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly in ``path``; none if it does not exist."""
    filesystem, target = _filesystem(spark, path)
    if not filesystem.exists(target):
        return []
    return [s.getPath().getName() for s in filesystem.listStatus(target) if s.isFile()]


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file ``path`` with ``text``; ``False`` and nothing changed if it exists.

    The text is written beside it and renamed, which never replaces a file, so
    readers see the whole text or none. As for stream checkpoints, the file
    system must rename atomically.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    filesystem, target = _filesystem(spark, path)
    target = filesystem.makeQualified(target)
    draft = hadoop.Path(target.getParent(), f"_{uuid.uuid4().hex}")
    stream = filesystem.create(draft, False)
    stream.write(text.encode())
    stream.close()
    context = hadoop.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    keep = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    keep[0] = hadoop.Options.Rename.NONE
    try:
        context.rename(draft, target, keep)
    except Py4JJavaError as error:
        filesystem.delete(draft, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Stored size of all files below ``path``."""
    filesystem, target = _filesystem(spark, path)
    return filesystem.getContentSummary(target).getLength()


def delete_folder(spark: SparkSession, path: str) -> bool:
    filesystem, target = _filesystem(spark, path)
    return filesystem.delete(target, True)


def list_files(spark: SparkSession, prefix: str, pattern: str = "*.parquet") -> DataFrame:
    """``path`` and ``modificationTime`` of all files under ``prefix``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(prefix)
        .select("path", "modificationTime")
    )


def latest_file(spark: SparkSession, prefix: str, pattern: str = "*.parquet") -> str:
    """Newest file under ``prefix``; the first path wins a tie.

    Only the listing is ranked, so no other file is opened.
    """
    newest = (
        list_files(spark, prefix, pattern)
        .orderBy(F.col("modificationTime").desc(), F.col("path").asc())
        .limit(1)
        .collect()
    )
    if not newest:
        raise FileNotFoundError(f"no {pattern} file under {prefix}")
    return newest[0]["path"]


def read_latest(spark: SparkSession, prefix: str, schema: str) -> DataFrame:
    """All files of the newest snapshot: those in the folder of the newest file."""
    return spark.read.schema(schema).parquet(latest_file(spark, prefix).rpartition("/")[0])


def with_ordinal(df: DataFrame, file: str = "file_ordinal", row: str = "row_ordinal") -> DataFrame:
    """Input order of a parquet scan: file path, then row position in the file."""
    return df.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))


def read_results(spark: SparkSession, path: str, item: str, keep: str = "") -> DataFrame:
    """Rows of landed responses: one per element of ``results``, with its provenance.

    ``item`` is the DDL type of an element and ``keep`` the DDL of further fields
    of the response. Responses without results give no rows, and neither do those
    that cannot be read: ``result_errors`` has them, and elements of another type.
    """
    fields = f"{keep}, " if keep else ""
    schema = f"{fields}results array<{item}>, url string, called_at string"
    landed = spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
    names = [c for c in landed.columns if c not in ("results", "url", "called_at")]
    rows = landed.select(
        *names,
        F.coalesce("url", "_metadata.file_path").alias("sys_source_from"),
        F.coalesce(F.col("called_at"), F.col("_metadata.file_modification_time").cast("string")).alias(
            "api_call_timestamp"
        ),
        F.explode("results").alias("record"),
    )
    return rows.select(*names, "record.*", "sys_source_from", "api_call_timestamp")


def result_errors(spark: SparkSession, path: str, item: str) -> DataFrame:
    """One error row per landed line, or element of its results, that ``read_results`` cannot give as ``item``.

    ``sys_source_from``, ``error_message`` and the ``payload``: the line if it is not JSON
    or has no list of results, the element if a field of it has another type. Lines
    are parsed to VARIANT, so fields that nobody asked for do not matter.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value").where(F.trim("value") != "")
    parsed = lines.select("file", "value", F.try_parse_json("value").alias("response"))
    results = F.try_variant_get("response", "$.results", "array<variant>")
    marked = parsed.select(
        F.coalesce(F.try_variant_get("response", "$.url", "string"), F.col("file")).alias("sys_source_from"),
        F.when(F.col("response").isNull(), "unreadable response")
        .when(results.isNull(), F.concat(F.lit("unexpected response: "), F.schema_of_variant("response")))
        .alias("error_message"),
        F.col("value").alias("payload"),
        results.alias("results"),
    )
    whole = marked.where(F.col("error_message").isNotNull()).drop("results")
    elements = marked.where(F.col("error_message").isNull()).select("sys_source_from", F.explode("results").alias("element"))
    read = elements.withColumn("read", F.from_json(F.to_json("element"), item))
    wrong = [F.when(_unread("element", "read", name), F.lit(name)) for name in read.schema["read"].dataType.names]
    failed = read.withColumn("fields", F.array_compact(F.array(*wrong))).where(F.size("fields") > 0)
    return whole.unionByName(
        failed.select(
            "sys_source_from",
            F.concat(F.lit("unexpected type: "), F.array_join("fields", ", ")).alias("error_message"),
            F.to_json("element").alias("payload"),
        )
    )


def _unread(element: str, read: str, name: str) -> Column:
    """Whether a field is there but was read as NULL."""
    given = F.try_variant_get(element, f"$.{name}", "variant")
    return given.isNotNull() & ~F.is_variant_null(given) & F.col(f"{read}.{name}").isNull()


def response_shape(spark: SparkSession, path: str) -> DataFrame:
    """One row: the ``shape`` that all landed responses have in common, as a VARIANT schema, and their number."""
    parsed = spark.read.text(path).select(F.try_parse_json("value").alias("response")).where(F.col("response").isNotNull())
    return parsed.agg(F.schema_of_variant_agg("response").alias("shape"), F.count(F.lit(1)).alias("responses"))


def unreadable_results(spark: SparkSession, path: str) -> DataFrame:
    """One error row per landed line that is not JSON: ``sys_source_from``, ``error_message`` and the ``payload``."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("sys_source_from"), "value")
    broken = (F.trim("value") != "") & F.try_parse_json("value").isNull()
    return lines.where(broken).select(
        "sys_source_from", F.lit("unreadable response").alias("error_message"), F.col("value").alias("payload")
    )
