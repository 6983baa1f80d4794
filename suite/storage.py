"""Writes and reads: each query returns what a reader sees afterwards.

Files go to a new folder under the shared scratch root of the session.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverair.operators.dedupe import latest_per_key
from silverair.operators.increment import insert_new
from silverair.operators.quality import Rule
from silverair.session import scratch_path
from silverair.sinks import files, partitions, versions
from silverair.sources.files import read_latest, read_results, unreadable_results
from silverair.sources.tables import optional_scan, scan
from silverair.streaming.increment import run_increment
from silverair.streaming.once import append_once
from silverair.streaming.run_log import read_log
from suite.base import Tables, day_text, instant_sql, instant_text, money, money_sql, query

MIDDLE = "2024-01-16"


def before_middle() -> Column:
    return F.col("ts") < F.lit(MIDDLE).cast("timestamp_ntz")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def q_append_parquet(t: Tables) -> DataFrame:
    """Finished and open orders appended one after the other."""
    path = scratch_path(t.spark, "append")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    done = F.col("o_orderstatus") == "F"
    for part in (orders.filter(done), orders.filter(~done)):
        files.append(part.drop("o_orderstatus"), path)
    return scan(t.spark, path, "o_orderkey bigint, o_custkey bigint, o_totalprice double")


@query("""
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS record_date,
           CASE WHEN strftime(ts, '%Y-%m-%d') IN ('2024-01-10', '2024-01-11') THEN -value ELSE value END AS value
    FROM events
""")
def q_partition_overwrite(t: Tables) -> DataFrame:
    """All days are landed, then two of them again with corrected values."""
    path = scratch_path(t.spark, "days")
    days = t.events.select("event_id", "value", day_text("ts").alias("record_date"))
    keys = ["year", "month", "record_date"]
    files.replace_partitions(files.with_month_partition(days, "record_date"), path, keys)
    again = days.filter(F.col("record_date").isin("2024-01-10", "2024-01-11")).withColumn("value", -F.col("value"))
    files.replace_partitions(files.with_month_partition(again, "record_date"), path, keys)
    stored = scan(t.spark, path, "event_id bigint, value double, year string, month string, record_date string")
    return stored.select("event_id", "record_date", "value")


@query("""
    SELECT event_id, user_id, value, 2 AS versions, (SELECT count(*) FROM events) AS published_rows FROM events
""")
def q_full_refresh(t: Tables) -> DataFrame:
    """A first version with half of the rows, then the whole table; readers see the second."""
    root = scratch_path(t.spark, "refresh")
    rows = t.events.select("event_id", "user_id", "value", "ts")
    versions.refresh(rows.filter(before_middle()).drop("ts"), root)
    result = versions.refresh(rows.drop("ts"), root, details={"reason": "full refresh"})
    published = versions.manifest(t.spark, root).count()
    versions.retain(t.spark, root, 1, timedelta(0))
    current = versions.read_current(t.spark, root, "event_id bigint, user_id bigint, value double")
    return current.select(
        "*", F.lit(published).alias("versions"), F.lit(result["rows"]).cast("bigint").alias("published_rows")
    )


@query(f"""
    SELECT event_id, user_id, value, {instant_sql("ts")} AS ts, CAST(regexp_extract(props, ':\\s*(-?[0-9]+)', 1) AS INTEGER) AS k,
           f AS format, '2024/02/01' AS landed_on
    FROM events, unnest(['json', 'parquet']) AS s(f)
""")
def q_json_roundtrip(t: Tables) -> DataFrame:
    """The same rows landed as JSON and as parquet under the day of the run."""
    run_at = F.lit("2024-02-01 05:00:00").cast("timestamp")
    rows = t.events.select(
        "event_id", "user_id", "value", instant_text("ts").alias("ts"), F.from_json("props", "k int").alias("props")
    )
    schema = (
        "event_id bigint, user_id bigint, value double, ts string, props struct<k: int>, "
        "year string, month string, day string"
    )
    read = []
    for kind in ("json", "parquet"):
        path = scratch_path(t.spark, kind)
        files.land(rows, path, run_at, kind)
        files.land(rows.filter("false"), path, run_at, kind)
        stored = scan(t.spark, path, schema, kind)
        # Partition values are typed by the schema, so leading zeros survive.
        landed_on = F.concat_ws("/", "year", "month", "day")
        read.append(
            stored.select(
                "event_id", "user_id", "value", "ts", F.col("props.k").alias("k"),
                F.lit(kind).alias("format"), landed_on.alias("landed_on"),
            )
        )
    return read[0].unionByName(read[1])


@query(f"""
    SELECT event_type, count(*) AS n, {money_sql("value")} AS total FROM events GROUP BY event_type
""")
def q_latest_file(t: Tables) -> DataFrame:
    """Two snapshots of several files; the newer one is read, all of it."""
    prefix = scratch_path(t.spark, "snapshots")
    for name, rows in (("a", t.events.filter(before_middle())), ("b", t.events)):
        summary = rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), money("value").alias("total"))
        summary.repartition(3, "event_type").write.parquet(f"{prefix}/{name}")
    return read_latest(t.spark, prefix, "event_type string, n bigint, total double")


@query("""
    SELECT user_id, min(load) AS load FROM (
        SELECT user_id, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'first' ELSE 'second' END AS load FROM events
    ) GROUP BY user_id
""")
def q_optional_scan(t: Tables) -> DataFrame:
    """First load without a target: all users. Second load: users that are not there yet."""
    path = scratch_path(t.spark, "optional")
    schema = "user_id bigint, load string"
    for name, rows in (("first", t.events.filter(before_middle())), ("second", t.events)):
        batch = rows.select("user_id", F.lit(name).alias("load")).distinct()
        files.append(insert_new(batch, optional_scan(t.spark, path, schema), "user_id"), path)
    return scan(t.spark, path, schema)


_STREAM_SQL = f"""
    WITH batches AS (
        SELECT user_id, strftime(ts, '%Y%m%d') AS date_id, event_id, value, ts, 1 AS batch FROM events WHERE ts < TIMESTAMP '{MIDDLE}'
        UNION ALL
        SELECT user_id, strftime(ts, '%Y%m%d'), event_id, value * 2, ts, 2 FROM events
    )
    SELECT CAST(user_id AS VARCHAR) || '-' || date_id AS dw_unique_key, date_id, event_id, value FROM batches
    QUALIFY row_number() OVER (PARTITION BY user_id, date_id ORDER BY batch, ts DESC, event_id) = 1
"""


@query(_STREAM_SQL)
def q_stream_increment(t: Tables) -> DataFrame:
    """Two file drops as two stream runs; the second corrects old days, which are ignored."""
    source, target, checkpoint = (scratch_path(t.spark, label) for label in ("drops", "target", "stream"))
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, value double"
    target_schema = "dw_unique_key string, event_id bigint, value double, date_id string"

    def newest(batch: DataFrame) -> DataFrame:
        keyed = batch.withColumn("date_id", F.date_format("ts", "yyyyMMdd"))
        keyed = keyed.withColumn("dw_unique_key", F.concat_ws("-", "user_id", "date_id"))
        kept = latest_per_key(keyed, ["dw_unique_key"], "ts", tie=[F.col("event_id")])
        return kept.select("dw_unique_key", "event_id", "value", "date_id")

    rows = t.events.select("event_id", "ts", "user_id", "value")
    corrected = rows.withColumn("value", F.col("value") * 2)
    for drop in (rows.filter(before_middle()), corrected):
        drop.write.mode("append").parquet(source)
        run_increment(
            t.spark, source, schema, newest, target, target_schema, "dw_unique_key", checkpoint, ["date_id"]
        )
    return scan(t.spark, target, target_schema).select("dw_unique_key", "date_id", "event_id", "value")


@query("""
    SELECT event_id, value, 'https://api.example/' || CAST(user_id AS VARCHAR) AS sys_source_from, '2024-02-01' AS api_call_timestamp,
           (SELECT count(DISTINCT event_type) FROM events) AS unreadable
    FROM events
""")
def q_landed_results(t: Tables) -> DataFrame:
    """Landed responses, one per user, and one broken line per event type that becomes an error row."""
    path = scratch_path(t.spark, "responses")
    result = F.struct("event_id", "value")
    responses = t.events.groupBy("user_id").agg(F.collect_list(result).alias("results")).select(
        "results",
        F.concat(F.lit("https://api.example/"), F.col("user_id").cast("string")).alias("url"),
        F.lit("2024-02-01").alias("called_at"),
    )
    broken = t.events.select(F.concat(F.lit('{"results": [{"event_id": '), "event_type").alias("value")).distinct()
    responses.select(F.to_json(F.struct("*")).alias("value")).union(broken).write.text(path)
    errors = unreadable_results(t.spark, path).count()
    rows = read_results(t.spark, path, "struct<event_id: bigint, value: double>")
    return rows.withColumn("unreadable", F.lit(errors).cast("bigint"))


@query("""
    WITH bounds AS (SELECT TIMESTAMP '2024-01-16' AS middle, date_trunc('millisecond', max(ts)) - INTERVAL 3 DAY AS late_until
                    FROM events WHERE event_id % 50 <> 0),
    kept AS (SELECT event_type, value FROM events, bounds WHERE event_id % 50 <> 0 OR ts > late_until)
    SELECT event_type, count(*) AS n_rows, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM kept GROUP BY event_type
    UNION ALL SELECT 'late', count(*), 0.0 FROM events, bounds WHERE ts <= late_until
""")
def q_stream_watermark(t: Tables) -> DataFrame:
    """Three drops with overlaps; events that come in the last one only are appended or counted, as their age allows."""
    source, target, checkpoint, log = (scratch_path(t.spark, label) for label in ("drops", "once", "stream", "log"))
    schema = "event_id bigint, at timestamp, event_type string, value double"
    rows = t.events.select("event_id", F.col("ts").cast("timestamp").alias("at"), "event_type", "value")
    middle = F.lit(MIDDLE).cast("timestamp")
    early = rows.where(F.col("event_id") % 50 != 0)
    drops = (early.where(F.col("at") < middle), early.where(F.col("at") >= middle - F.expr("INTERVAL 2 DAYS")), rows)
    for drop in drops:
        drop.write.mode("append").parquet(source)
        append_once(t.spark, source, schema, ["event_id"], "at", "3 days", target, checkpoint, log=log)
    late = read_log(t.spark, log).agg(F.sum("late_rows").alias("n_rows"))
    kept = t.spark.read.schema(schema).parquet(target).groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"), money("value").alias("total"))
    return kept.unionByName(late.select(F.lit("late").alias("event_type"), "n_rows", F.lit(0.0).alias("total")))


@query(f"""
    WITH drops AS (
        SELECT 0 AS batch_id, event_id, user_id, value, ts FROM events WHERE ts < TIMESTAMP '{MIDDLE}'
        UNION ALL SELECT 1, event_id, user_id, value, ts FROM events
    ), good AS (
        SELECT event_id, min(batch_id) AS batch_id FROM drops WHERE value <= 20 GROUP BY event_id
    ), bad AS (
        SELECT event_id, min(batch_id) AS batch_id FROM drops WHERE value > 20 GROUP BY event_id
    )
    SELECT CAST(batch_id AS BIGINT) AS batch_id, count(*) AS input_rows, CAST(0 AS BIGINT) AS late_rows,
           (SELECT count(*) FROM good g WHERE g.batch_id = d.batch_id) AS inserted,
           (SELECT count(*) FROM bad b WHERE b.batch_id = d.batch_id) AS quarantined
    FROM drops d GROUP BY batch_id
""")
def q_stream_run_log(t: Tables) -> DataFrame:
    """The log of two stream runs: rows read, inserted and set aside per micro-batch."""
    source, target, checkpoint, log = (scratch_path(t.spark, label) for label in ("drops", "target", "stream", "log"))
    schema = "event_id bigint, user_id bigint, value double"
    rows = t.events.select("event_id", "user_id", "value", "ts")
    rules = [Rule("small", F.col("value") > 20)]
    for drop in (rows.where(before_middle()), rows):
        drop.select("event_id", "user_id", "value").write.mode("append").parquet(source)
        run_increment(t.spark, source, schema, lambda batch: batch, target, schema, "event_id", checkpoint, rules=rules, log=log)
    return read_log(t.spark, log).select("batch_id", "input_rows", "late_rows", "inserted", "quarantined")


@query("""
    SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n_rows, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total,
           count(DISTINCT event_type < 'm') > 1 AS fewer
    FROM events GROUP BY 1
""")
def q_compact(t: Tables) -> DataFrame:
    """Two loads by event type, compacted: the same rows in fewer files per day."""
    root, schema = scratch_path(t.spark, "compacted"), "event_id bigint, value double, day string"
    rows = t.events.select("event_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type")
    first = F.col("event_type") < "m"
    for load in (rows.where(first), rows.where(~first)):
        partitions.append(t.spark, root, "day", load.drop("event_type"))

    def files() -> DataFrame:
        return partitions.read(t.spark, root, schema).groupBy("day").agg(F.count_distinct("_metadata.file_path").alias("files"))

    before = files()
    partitions.compact(t.spark, root, "day", schema)
    stored = partitions.read(t.spark, root, schema).groupBy("day").agg(F.count(F.lit(1)).alias("n_rows"), money("value").alias("total"))
    counted = before.join(files().withColumnRenamed("files", "now"), "day")
    return stored.join(counted, "day").select("day", "n_rows", "total", (F.col("now") < F.col("files")).alias("fewer"))
