from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import plan, rows, values
from silverair.operators.ranking import bucket_of, number_rows, quantile_bucket, run_ids, slice_rows


@pytest.mark.parametrize("n", [0, 1, 3, 5, 7, 1000])
def test_quantile_bucket_equals_ntile(spark, n):
    # More than a third of the rows share one value and some have none.
    value = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 7 != 1, F.col("id") % 5)
    df = spark.range(n).select("id", value.alias("v"))
    got = quantile_bucket(df, 5, ["v", "id"], "bucket")
    want = df.withColumn("bucket", F.ntile(5).over(Window.orderBy("v", "id")))
    assert rows(got, "id") == rows(want, "id")


@pytest.mark.parametrize("buckets", [1, 2, 5, 50])
def test_quantile_bucket_of_other_values(spark, buckets):
    value = F.when(F.col("id") % 4 == 0, float("nan")).when(F.col("id") % 4 == 1, -0.0).otherwise(F.col("id") % 11)
    df = spark.range(301).select(value.alias("v"), F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"))
    want = df.withColumn("b", F.ntile(buckets).over(Window.orderBy("v", "k")))
    got = quantile_bucket(df, buckets, ["v", "k"], "b")
    assert rows(got.select("k", "b"), "k") == rows(want.select("k", "b"), "k")


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(total=st.integers(1, 400), buckets=st.integers(1, 30))
def test_bucket_formula(total, buckets, spark):
    df = spark.range(1, total + 1).select("id", F.lit(total).cast("bigint").alias("n"))
    want = F.ntile(buckets).over(Window.orderBy("id"))
    assert df.select(bucket_of("id", "n", buckets).alias("b"), want.alias("w")).filter("b <> w").isEmpty()


def test_bucket_formula_is_exact_for_large_positions(spark):
    total = 3 * 10**17 + 2
    df = values(spark, "p", [1, 10**17 + 1, 10**17 + 2, 2 * 10**17 + 2, 2 * 10**17 + 3, total], "bigint")
    df = df.withColumn("n", F.lit(total))
    assert [r[0] for r in df.select(bucket_of("p", "n", 3)).collect()] == [1, 1, 2, 2, 3, 3]


def test_number_rows_has_no_row_level_single_partition(spark):
    df = spark.range(5000).select("id", F.lit(0).alias("v")).repartition(6)
    got = number_rows(df, ["v", F.col("id").desc()], "n", "total")
    assert rows(got.select("id", "n", "total"), "n") == [(4999 - i, i + 1, 5000) for i in range(5000)]
    # Rows reach the result through the broadcast of one row per partition.
    head = plan(got).split("BroadcastExchange")[0]
    assert "SinglePartition" not in head and "Exchange" not in head


@pytest.mark.parametrize(("start", "end"), [(0, None), (3, None), (2, 5), (5, 5), (6, 2), (8, 30), (2, 20_000), (30, None)])
def test_slice_rows(spark, start, end):
    df = spark.range(10).repartition(3)
    assert [r[0] for r in rows(slice_rows(df, ["id"], start, end), "id")] == list(range(10))[start:end]


def test_run_ids(spark):
    df = values(spark, "k", ["b", "a", "c"])
    run = F.lit(20260430101530)
    want = [("a", 20260430101530001), ("b", 20260430101530002), ("c", 20260430101530003)]
    assert rows(run_ids(df, ["k"], run, "id")) == want
    assert rows(run_ids(df, ["k"], run, "id").select("k", F.col("id").cast("bigint"))) == want
