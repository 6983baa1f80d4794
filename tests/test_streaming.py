from __future__ import annotations

from pyspark.sql import functions as F

from helpers import rows
from silverair import schemas
from silverair.plans import silver
from silverair.schemas import FACT_WEATHER
from silverair.sinks.increments import quarantine_path
from silverair.streaming.increment import insert_batches, run_increment
from test_silver import weather


def newest(batch):
    return FACT_WEATHER.conform(silver.latest_weather(batch))


def run(spark, tmp_path, **kwargs):
    return run_increment(
        spark, str(tmp_path / "in"), schemas.WEATHER, newest, str(tmp_path / "out"), FACT_WEATHER.ddl, "dw_unique_key",
        str(tmp_path / "checkpoint"), ["date_id"], **kwargs,
    )


def drop(spark, tmp_path, *data):
    spark.createDataFrame(list(data), schemas.WEATHER).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))


def stored(spark, tmp_path):
    df = spark.read.schema(FACT_WEATHER.ddl).parquet(str(tmp_path / "out"))
    return rows(df.select("dw_unique_key", "weather_code"), "dw_unique_key")


def test_runs_take_only_new_files_and_new_keys(spark, tmp_path):
    drop(spark, tmp_path, weather(1, "2026-01-01", "2026-01-02T00:00:00Z", code=1), weather(1, "2026-01-01", "2026-01-03T00:00:00Z", code=2))
    run(spark, tmp_path)
    assert stored(spark, tmp_path) == [("1.5--2.5-2026-01-01", 2)]
    assert run(spark, tmp_path).lastProgress is None or run(spark, tmp_path).lastProgress["numInputRows"] == 0
    drop(spark, tmp_path, weather(1, "2026-01-01", "2026-01-09T00:00:00Z", code=3), weather(1, "2026-01-02", "2026-01-09T00:00:00Z", code=4))
    run(spark, tmp_path)
    assert stored(spark, tmp_path) == [("1.5--2.5-2026-01-01", 2), ("1.5--2.5-2026-01-02", 4)]


def test_stream_equals_batch(spark, tmp_path):
    data = [weather(i, f"2026-01-0{i % 5 + 1}", f"2026-01-0{i % 9 + 1}T00:00:00Z", lat=i % 3 + 0.5, code=i) for i in range(40)]
    drop(spark, tmp_path, *data)
    run(spark, tmp_path)
    batch = silver.latest_weather(spark.createDataFrame(data, schemas.WEATHER))
    assert stored(spark, tmp_path) == rows(batch.select("dw_unique_key", "weather_code"), "dw_unique_key")


def test_repeated_batch_inserts_nothing(spark, tmp_path):
    target = str(tmp_path / "t")
    insert = insert_batches(lambda df: df, target, "k", "k bigint, v int, day string", ["day"])
    batch = spark.range(6).select(F.col("id").alias("k"), F.lit(1).alias("v"), (F.col("id") % 2).cast("string").alias("day"))
    for number in (0, 0, 1):
        insert(batch, number)
    assert spark.read.schema("k bigint, v int, day string").parquet(target).count() == 6


def test_bad_and_late_days_come_in_once(spark, tmp_path):
    data = [weather(1, d, "2026-01-02T00:00:00Z", code=1) for d in ("no day", "2026-01-02", "2019-05-05")]
    for _ in range(3):
        drop(spark, tmp_path, *data)
        run(spark, tmp_path, rules=FACT_WEATHER.rules)
    assert stored(spark, tmp_path) == [("1.5--2.5-2019-05-05", 1), ("1.5--2.5-2026-01-02", 1)]
    aside = spark.read.parquet(quarantine_path(str(tmp_path / "out")))
    assert [r.broken_rules for r in aside.collect()] == [["not_null(date_id)"]]
