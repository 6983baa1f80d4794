from __future__ import annotations

from pyspark.sql import functions as F

from helpers import plan, rows
from silverair.operators.nested import explode_where, stamp_source, unwrap_envelope, wrap_envelope, zip_explode


def test_explode_where_keeps_positions_and_drops_empty_rows(spark):
    df = spark.createDataFrame([(1, [10, None, 30]), (2, []), (3, None)], "id int, items array<int>")
    assert rows(explode_where(df, "items", None, "item"), "item_pos") == [(1, 0, 10), (1, 1, None), (1, 2, 30)]
    assert rows(explode_where(df, "items", lambda i: i > 10, "item")) == [(1, 2, 30)]


def test_zip_explode_follows_the_driver_array(spark):
    df = spark.createDataFrame(
        [(1, ["a", "b", "c"], [1], [7, 8, 9, 10]), (2, [], [1], [2]), (3, None, [1], [2]), (4, ["z"], None, [5])],
        "id int, days array<string>, short array<int>, long array<int>",
    )
    got = zip_explode(df, "days", {"s": "short", "l": "long"}, "day", ["id"])
    assert rows(got, "id", "day") == [(1, "a", 1, 7), (1, "b", None, 8), (1, "c", None, 9), (4, "z", None, 5)]
    # The arrays themselves are not copied into the exploded rows.
    generate = next(line for line in plan(got).splitlines() if "Generate inline" in line)
    assert "[id#" in generate and "long#" not in generate.split("), [")[-1]


def test_envelope_round_trip(spark):
    df = spark.createDataFrame([(1, 2.5, "x")], "sensor_id int, value double, note string")
    wrapped = wrap_envelope(df, F.lit("2024-01-01"), "me", "sensor_id", "day")
    assert wrapped.columns == ["data", "sys"]
    assert unwrap_envelope(wrapped).columns == ["value", "note", "load_date", "source", "sensor_id", "granularity"]
    assert rows(unwrap_envelope(wrapped)) == [(2.5, "x", "2024-01-01", "me", 1, "day")]


def test_stamp_source(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert rows(stamp_source(df, F.lit("u"), F.lit("t"))) == [(1, "u", "t")]
