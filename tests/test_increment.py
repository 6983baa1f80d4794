from __future__ import annotations

from pyspark.sql import functions as F

from helpers import plan, rows
from silverair.operators.increment import insert_new, join_back, priority_union


def test_insert_new(spark):
    current = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    existing = spark.createDataFrame([("b", 9), ("b", 8), (None, 7)], "k string, v int")
    assert rows(insert_new(current, existing, "k")) == [("a", 1)]
    assert rows(insert_new(current, None, "k")) == [("a", 1), ("b", 2)]


def test_insert_new_twice_is_once(spark):
    batch = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    target = insert_new(batch, None, "k")
    again = insert_new(batch.withColumn("v", F.col("v") * 10), target, "k")
    assert rows(target.unionByName(again)) == rows(batch)


def test_insert_new_reads_only_partitions_of_the_batch(spark, tmp_path):
    path = str(tmp_path / "target")
    days = spark.range(100).select((F.col("id") % 10).cast("string").alias("day"), F.col("id").alias("k"))
    days.write.partitionBy("day").parquet(path)
    batch = spark.createDataFrame([(34, "4"), (1005, "5")], "k bigint, day string")
    new = insert_new(batch, spark.read.schema("k bigint, day string").parquet(path), "k", prune_by="day")
    assert rows(new) == [(1005, "5")]
    scan = next(line for line in plan(new).splitlines() if "FileScan" in line)
    assert "Subquery" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "ReadSchema: struct<k:bigint>" in scan


def test_join_back_keeps_unscored_rows_until_values_are_required(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, n string")
    scores = spark.createDataFrame([(1, 5, None), (1, 6, 7)], "k int, x int, y int")
    assert rows(join_back(base, scores, "k")) == [(1, "a", 5, None), (1, "a", 6, 7), (2, "b", None, None)]
    required = join_back(base, scores, "k", ["x", "y"])
    assert rows(required) == [(1, "a", 6, 7)]
    # Spark turns the outer join with required values into an inner join.
    assert "Inner" in plan(required)


def test_priority_union(spark):
    schema = "k int, ts int, v string"
    first = spark.createDataFrame([(1, 1, None), (2, 1, "old"), (2, 5, "new")], schema)
    second = spark.createDataFrame([("z", 9, 1), ("b", 2, 3), ("a", 2, 3)], "v string, ts int, k int")
    got = priority_union([first, second], ["k"], "ts")
    # A row of the first source wins even without a value; a tie is settled by the rest of the row.
    assert rows(got) == [(1, 1, None), (2, 5, "new"), (3, 2, "a")]
