"""Registry and shared columns of the driver queries.

The given tables are not sensor data, so each query states which columns stand
for sensors, days, sources and sites. Instants and days are returned as text, so
that both engines print them alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverair.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The parquet tables of one folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = configure(spark)
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None) -> Callable:
    """Register a query under the name of its function."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[build.__name__] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            SQL[build.__name__] = sql
        return build

    return register


def instant_text(instant: Column | str) -> Column:
    return F.date_format(instant, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def instant_sql(instant: str) -> str:
    return f"strftime({instant}, '%Y-%m-%d %H:%M:%S.%f')"


def day_text(day: Column | str) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def money(column: Column | str) -> Column:
    """Sum of amounts with two decimals, exact in any order."""
    column = F.col(column) if isinstance(column, str) else column
    return F.sum(column.cast("decimal(18,2)")).cast("double")


def money_sql(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


# Locations built from customers and their nation. The number of sensors, their
# parameter and the gaps depend on the row alone, so nothing is collected.
LOCATIONS_SQL = """
    locations AS (
        SELECT c_custkey AS id, c_name AS name,
               nullif(c_mktsegment, 'MACHINERY') AS locality, r_name AS timezone,
               CAST(n_nationkey AS BIGINT) AS country_id, n_name AS country_name, substr(n_name, 8) AS country_code,
               CASE WHEN c_acctbal >= 0 THEN floor(c_acctbal / 1000) END AS latitude,
               CAST(c_nationkey AS DOUBLE) AS longitude,
               CASE WHEN c_nationkey % 4 = 0 THEN NULL ELSE c_nationkey % 4 END AS n_sensors
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    ),
    location_sensors AS (
        SELECT l.*, i AS pos, CAST(id // 2 * 10 + i AS BIGINT) AS sensor_id,
               'sensor ' || CAST(id AS VARCHAR) || '/' || CAST(i AS VARCHAR) AS sensor_name,
               CASE (id + i) % 3 WHEN 0 THEN '2' WHEN 1 THEN '7' ELSE 'x' END AS parameter_id
        FROM locations l, unnest(range(1, n_sensors + 1)) AS s(i)
    )
"""


def locations(t: Tables) -> DataFrame:
    """Nested locations as an API would deliver them."""
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    c = c.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    n = F.col("c_nationkey") % 4
    key = F.col("c_custkey")

    def sensor(i: Column) -> Column:
        kind = (key + i) % 3
        parameter = F.when(kind == 0, "2").when(kind == 1, "7").otherwise("x")
        return F.struct(
            (F.floor(key / 2) * 10 + i).cast("bigint").alias("id"),
            F.concat(F.lit("sensor "), key.cast("string"), F.lit("/"), i.cast("string")).alias("name"),
            F.struct(
                parameter.alias("id"),
                F.lit("pm25").alias("name"),
                F.lit("ug/m3").alias("units"),
                F.concat(F.lit("PM "), parameter).alias("displayName"),
            ).alias("parameter"),
        )

    return c.select(
        key.alias("id"),
        F.col("c_name").alias("name"),
        F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("locality"),
        F.col("r_name").alias("timezone"),
        F.struct(
            F.col("n_nationkey").cast("bigint").alias("id"),
            F.col("n_name").alias("name"),
            F.expr("substring(n_name, 8)").alias("code"),
        ).alias("country"),
        F.struct(
            F.when(F.col("c_acctbal") >= 0, F.floor(F.col("c_acctbal") / 1000).cast("double")).alias("latitude"),
            F.col("c_nationkey").cast("double").alias("longitude"),
        ).alias("coordinates"),
        F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
        F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), sensor)).alias("sensors"),
        F.when(key % 2 == 0, "2024-02-01T00:00:00+00:00").otherwise("2024-02-01T00:00:00.250000+00:00").alias(
            "api_call_timestamp"
        ),
        F.lit("https://api.example/locations").alias("sys_source_from"),
    )
