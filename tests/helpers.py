from __future__ import annotations

from pyspark.sql import DataFrame


def rows(df: DataFrame, *order: str) -> list[tuple]:
    """Rows as tuples, in ``order`` or in a stable one."""
    got = [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
    return got if order else sorted(got, key=repr)


def plan(df: DataFrame) -> str:
    """Physical plan, final if the frame was executed."""
    return df._jdf.queryExecution().executedPlan().toString()


def values(spark, name: str, items: list, kind: str = "string") -> DataFrame:
    return spark.createDataFrame([(i,) for i in items], f"{name} {kind}")
