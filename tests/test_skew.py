"""One key holds more than a third of the rows; no task may get its whole group."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import plan
from silverair.operators import lookup
from silverair.operators.dedupe import latest_per_key
from silverair.operators.features import tag_features
from silverair.operators.paging import concat_pages
from silverair.operators.ranking import number_rows, quantile_bucket
from silverair.operators.spatial import radius_join
from silverair.operators.state import within_window

ROWS = 120_000


def hot_key():
    return F.when(F.col("id") % 5 < 2, F.lit(0)).otherwise(F.col("id"))


@pytest.fixture
def large_lookups(spark, monkeypatch):
    """No lookup counts as small, and partitions are not merged again."""
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", -1)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def largest_share(df):
    """Share of the fullest partition in all rows."""
    sizes = [r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect()]
    return max(sizes) / sum(sizes)


def test_newest_row_of_a_hot_key(spark):
    df = spark.range(0, ROWS, 1, 12).select(hot_key().alias("k"), "id")
    newest = latest_per_key(df, ["k"], "id")
    assert newest.filter("k = 0").select("id").first()[0] == ROWS - 4
    assert newest.count() == ROWS * 3 // 5 + 1
    text = plan(newest)
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def sensor_rows(spark):
    readings = spark.range(0, ROWS, 1, 12).select(hot_key().alias("s"), F.timestamp_seconds(F.col("id")).alias("at"))
    bounds = [F.timestamp_seconds(F.lit(n)).alias(name) for name, n in (("date_from", 10), ("date_to", 10**9))]
    return readings, readings.select("s").distinct().select("s", *bounds)


def test_windows_of_a_hot_sensor(spark, large_lookups):
    kept = within_window(*sensor_rows(spark), ["s"], "at")
    assert kept.count() == ROWS - 10
    assert largest_share(kept) < 0.2
    assert "SortMergeJoin" in plan(kept)


def test_small_lookups_are_broadcast(spark):
    kept = within_window(*sensor_rows(spark), ["s"], "at")
    text = plan(kept)
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    assert kept.count() == ROWS - 10


def test_lookup_beyond_its_bounds_is_not_broadcast(spark, monkeypatch):
    readings, requests = sensor_rows(spark)
    for name in ("BROADCAST_ROWS", "BROADCAST_BYTES"):
        with monkeypatch.context() as patch:
            patch.setattr(lookup, name, 5)
            joined = lookup.lookup_join(readings, requests, ["s"], ["at"], "left")
            assert lookup.SALT in plan(joined)
            assert joined.count() == ROWS and joined.columns == ["s", "at", "date_from", "date_to"]
    some = lookup.lookup_join(readings, requests.filter("s = 0"), ["s"], ["at"], "left")
    assert some.filter("date_from is null").count() == ROWS * 3 // 5


def test_aqe_can_split_what_is_left_of_a_hot_key(spark, large_lookups, monkeypatch):
    monkeypatch.setattr(lookup, "SALTS", 2)
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        kept = within_window(*sensor_rows(spark), ["s"], "at")
        assert len(kept.collect()) == ROWS - 10
        assert "skew=true" in plan(kept)
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_pages_of_a_hot_request(spark, large_lookups):
    pages = spark.range(0, ROWS, 1, 12).select(
        F.when(F.col("id") < ROWS // 2, -1).otherwise(F.col("id")).alias("r"),
        F.when(F.col("id") < ROWS // 2, F.col("id") + 1).otherwise(1).alias("p"),
        F.array(F.col("id"), -F.col("id")).alias("results"),
    )
    got = concat_pages(pages, "r", "p", "results", "item")
    assert got.count() == 2 * ROWS
    assert largest_share(got) < 0.2


def test_elements_of_a_crowded_cell(spark, large_lookups):
    place = F.lit(50.0).alias("lat")
    elements = spark.range(0, ROWS, 1, 12).select("id", place, (F.lit(7) + F.col("id") / 10**9).alias("lon"))
    sites = spark.range(3).select(F.col("id").alias("site"), place, F.lit(7.0).alias("lon"))
    pairs = radius_join(sites, elements, 300.0)
    assert pairs.count() == 3 * ROWS
    assert largest_share(pairs) < 0.4


def test_capped_hot_request_is_cut_before_the_shuffle(spark):
    pages = spark.range(0, 5000, 1, 4).select(F.lit(1).alias("r"), (F.col("id") + 1).alias("p"), F.array("id").alias("results"))
    got = concat_pages(pages, "r", "p", "results", "item", max_records=1200)
    assert got.agg(F.count("*"), F.max("item")).first() == (1200, 1199)


def test_features_of_a_hot_site_are_folded_on_the_map_side(spark):
    tags = F.create_map(F.concat(F.lit("build"), F.substring(F.lit("ing"), 1, (F.col("id") % 3 + 3).cast("int"))), F.lit("yes"))
    df = spark.range(0, ROWS, 1, 12).select(
        hot_key().alias("site"), F.lit("way").alias("type"), (F.col("id") % 1000).alias("id"), tags.alias("tags"), F.col("id").alias("pos")
    )
    got = tag_features(df, "site")
    assert got.filter("site = 0").select("building_count_all", "area_tag").first() == (400, "unknown")
    text = plan(got)
    assert text.count("partial_sum(__building") and text.count("partial_max(__building")


@pytest.mark.parametrize("hot_share", [1, 3])
def test_quantiles_with_a_hot_value_use_all_partitions(spark, large_lookups, hot_share):
    df = spark.range(0, ROWS, 1, 12).select((F.when(F.col("id") % hot_share == 0, 0).otherwise(F.col("id"))).alias("v"), "id")
    got = quantile_bucket(df, 5, ["v", "id"], "b")
    assert {r[0]: r[1] for r in got.groupBy("b").count().collect()} == {b: ROWS // 5 for b in range(1, 6)}
    # With one scan partition per file: every sorted file holds its share, also of the hot value.
    spark.conf.set("spark.sql.files.openCostInBytes", "1g")
    try:
        assert largest_share(number_rows(df, ["v", "id"])) < 0.2
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
