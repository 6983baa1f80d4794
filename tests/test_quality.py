from __future__ import annotations

import pytest

from helpers import rows
from silverair.operators import quality
from silverair.schemas import DIM_DATE, WAREHOUSE


def test_check_counts_violations(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, None, 50), (None, "b", None)], "k int, s string, n int")
    report = quality.check(
        df,
        [
            quality.not_null("s"), quality.in_range("n", 0, 10), quality.accepted("s", ["a"]),
            quality.unique("k"), quality.unique("k", "s"),
        ],
    )
    assert rows(report, "rule") == [
        ("accepted(s)", 1, False),
        ("column_count", 3, True),
        ("in_range(n)", 1, False),
        ("not_null(s)", 1, False),
        ("unique(k)", 1, False),
        ("unique(k,s)", 0, True),
    ]
    with pytest.raises(quality.QualityError, match=r"not_null\(s\): 1"):
        quality.enforce(report)


@pytest.mark.parametrize("table", WAREHOUSE.values(), ids=lambda t: t.name)
def test_empty_tables_pass_their_rules(spark, table):
    empty = table.empty(spark)
    assert empty.columns == list(table.columns)
    report = quality.check(empty, table.rules)
    assert all(passed for _, _, passed in rows(report))
    quality.enforce(report)


def test_source_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "sys_source_from string")
    assert sorted(rows(quality.source_counts(df)), key=repr) == sorted(
        [("a", False, 2), (None, False, 1), (None, True, 3)], key=repr
    )


def test_counters_are_taken_while_writing(spark, tmp_path):
    df = spark.createDataFrame([("success",), ("error",), ("success",)], "status string")
    counted, observation = quality.observed(df, "run", *quality.run_counters())
    counted.write.parquet(str(tmp_path / "out"))
    assert observation.get == {"processed": 3, "succeeded": 2, "failed": 1}
    assert rows(quality.run_log(df, quality.run_counters())) == [(3, 2, 1)]


def test_create_statement():
    text = DIM_DATE.create_statement()
    assert text.startswith("CREATE TABLE IF NOT EXISTS dim_date (")
    assert "sys_unique_key VARCHAR(8) PRIMARY KEY" in text
    assert "full_date DATE NOT NULL UNIQUE" in text
    assert "is_weekend BOOLEAN NOT NULL" in text
    assert DIM_DATE.jdbc_types == "sys_unique_key VARCHAR(8), month_name VARCHAR(20), day_name VARCHAR(20)"
