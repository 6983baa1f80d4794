"""Calendars, month windows, global ranks and slices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverair.functions import times
from silverair.operators.ranking import quantile_bucket, run_ids, slice_rows
from silverair.operators.state import month_requests
from silverair.plans import jobs
from silverair.plans.silver import date_dimension
from silverair.schemas import DIM_DATE
from silverair.session import scratch_path
from silverair.sinks import versions
from suite.base import Tables, day_text, instant_sql, instant_text, money, money_sql, query

_CALENDAR_SQL = """
    calendar AS (
        SELECT strftime(d, '%Y%m%d') AS sys_unique_key, strftime(d, '%Y-%m-%d') AS full_date,
               CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
               CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
               CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
               strftime(d, '%A') AS day_name, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
               dayofweek(d) IN (0, 6) AS is_weekend
        FROM (SELECT unnest(generate_series(
                  CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE), INTERVAL 1 DAY)) AS d FROM orders)
    )
"""


def calendar(t: Tables) -> DataFrame:
    """Calendar over the days of the orders."""
    bounds = t.orders.agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    return date_dimension(bounds, F.col("first"), F.col("last"))


@query(f"WITH {_CALENDAR_SQL} SELECT * FROM calendar")
def q_date_dim(t: Tables) -> DataFrame:
    return calendar(t).withColumn("full_date", day_text("full_date"))


@query(f"WITH {_CALENDAR_SQL} SELECT * FROM calendar")
def q_dates_published(t: Tables) -> DataFrame:
    """The same through the job: published, and read through the pointer."""
    root = scratch_path(t.spark, "dates")
    first, last = t.orders.agg(F.min("o_orderdate").cast("date"), F.max("o_orderdate").cast("date")).first()
    jobs.dates(t.spark, first, last, root)
    return versions.read_current(t.spark, root, DIM_DATE.ddl).withColumn("full_date", day_text("full_date"))


@query(f"""
    WITH {_CALENDAR_SQL}
    SELECT year, day_name, is_weekend, count(*) AS n_orders, {money_sql("o_totalprice")} AS spent
    FROM orders JOIN calendar ON strftime(o_orderdate, '%Y%m%d') = sys_unique_key
    GROUP BY year, day_name, is_weekend
""")
def q_join_date_dim(t: Tables) -> DataFrame:
    """Orders per weekday, through the calendar key."""
    days = calendar(t).select("sys_unique_key", "year", "day_name", "is_weekend")
    # Orders are summed per day first, so the join sees one row per day.
    daily = t.orders.groupBy(times.date_id("o_orderdate").alias("sys_unique_key")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total")
    )
    joined = daily.join(days, "sys_unique_key").groupBy("year", "day_name", "is_weekend")
    return joined.agg(F.sum("n").alias("n_orders"), F.sum("total").cast("double").alias("spent"))


@query(f"""
    WITH bounds AS (SELECT o_custkey, min(o_orderdate) AS s, max(o_orderdate) AS e FROM orders GROUP BY o_custkey),
    windows AS (
        SELECT o_custkey, greatest(m, s) AS window_start, least(m + INTERVAL 1 MONTH - INTERVAL 1 SECOND, e) AS window_end
        FROM (SELECT *, unnest(generate_series(date_trunc('month', s), e, INTERVAL 1 MONTH)) AS m FROM bounds)
    )
    SELECT w.o_custkey, {instant_sql("window_start")} AS window_start, {instant_sql("window_end")} AS window_end,
           count(o_orderkey) AS n_orders
    FROM windows w LEFT JOIN orders o ON o.o_custkey = w.o_custkey AND o_orderdate BETWEEN window_start AND window_end
    GROUP BY w.o_custkey, window_start, window_end
""")
def q_month_windows(t: Tables) -> DataFrame:
    """Month requests over the active range of each customer, with the orders in each."""
    orders = t.orders.withColumn("at", F.col("o_orderdate").cast("timestamp"))
    bounds = orders.groupBy("o_custkey").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    requests = month_requests(bounds, F.col("first"), F.col("last"))
    # Inside the active range a month is exactly one window.
    counts = orders.groupBy("o_custkey", times.month_start("at").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    joined = requests.join(counts, ["o_custkey", "month"], "left")
    return joined.select(
        "o_custkey",
        instant_text("date_from").alias("window_start"),
        instant_text("date_to").alias("window_end"),
        F.coalesce("n", F.lit(0)).alias("n_orders"),
    )


@query("""
    SELECT event_id, CAST(ntile(5) OVER (ORDER BY value, event_id) AS INTEGER) AS bucket FROM events
""")
def q_ntile_distributed(t: Tables) -> DataFrame:
    return quantile_bucket(t.events.select("event_id", "value"), 5, ["value", "event_id"], "bucket").drop("value")


@query("""
    SELECT o_orderkey, CAST(ntile(7) OVER (ORDER BY o_orderstatus, o_orderkey) AS INTEGER) AS bucket FROM orders
""")
def q_ntile_hot_values(t: Tables) -> DataFrame:
    """Three values share the table; each is split by its second order column."""
    ranked = quantile_bucket(
        t.orders.select("o_orderkey", "o_orderstatus"), 7, ["o_orderstatus", "o_orderkey"], "bucket"
    )
    return ranked.drop("o_orderstatus")


@query("""
    SELECT o_orderkey, o_custkey FROM orders
    QUALIFY row_number() OVER (ORDER BY o_orderdate, o_orderkey) > 1000
""")
def q_slice(t: Tables) -> DataFrame:
    """All orders behind position 1,000 in date order."""
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return slice_rows(orders, ["o_orderdate", "o_orderkey"], 1000).drop("o_orderdate")


@query("""
    SELECT o_orderkey, printf('20260430101530%03d', row_number() OVER (ORDER BY o_orderdate, o_orderkey)) AS run_id
    FROM orders
""")
def q_run_ids(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_orderdate")
    run = times.run_number(F.lit("2026-04-30 10:15:30").cast("timestamp"))
    numbered = run_ids(orders, ["o_orderdate", "o_orderkey"], run, "run_id")
    return numbered.select("o_orderkey", F.col("run_id").cast("string").alias("run_id"))
