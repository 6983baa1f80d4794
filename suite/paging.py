"""Landed pages: a conversation is a request, a turn is a page, a word is a result."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverair.operators.paging import concat_pages
from silverair.plans import bronze, landing
from silverair.schemas import MEASUREMENTS
from silverair.session import scratch_path
from silverair.sinks import versions
from suite.base import Tables, query

_PAGES_SQL = """
    pages AS (
        SELECT conv_id, turn + CASE WHEN contains(text, 'x') THEN 1001 ELSE 1 END AS page,
               string_split(text, ' ') AS words, contains(text, 'q') AS is_blank
        FROM conversations
    ),
    stops AS (
        SELECT conv_id, min(page) AS stop FROM (
            SELECT conv_id, page FROM pages WHERE is_blank
            UNION ALL
            SELECT conv_id, page + 1 FROM pages p
            WHERE NOT EXISTS (SELECT 1 FROM pages n WHERE n.conv_id = p.conv_id AND n.page = p.page + 1)
            UNION ALL
            SELECT conv_id, 1 FROM pages GROUP BY conv_id HAVING min(page) > 1
        ) GROUP BY conv_id
    ),
    results AS (
        SELECT p.conv_id, page, CAST(i AS INTEGER) AS pos, words[i + 1] AS word
        FROM pages p JOIN stops s ON s.conv_id = p.conv_id AND page < stop, unnest(range(0, len(words))) AS r(i)
    )
"""


def pages(t: Tables) -> DataFrame:
    """Turns with an ``x`` are landed far behind, which leaves a gap; turns with a ``q`` are empty pages."""
    far = F.when(F.contains("text", F.lit("x")), 1001).otherwise(1)
    words = F.split("text", " ")
    none = F.array().cast("array<string>")
    return t.conversations.select(
        "conv_id",
        (F.col("turn") + far).alias("page"),
        F.when(F.contains("text", F.lit("q")), none).otherwise(words).alias("results"),
    )


@query(f"WITH {_PAGES_SQL} SELECT * FROM results")
def q_pages(t: Tables) -> DataFrame:
    """All results up to the first empty or missing page of a request."""
    rows = concat_pages(pages(t), "conv_id", "page", "results", "word")
    return rows.select("conv_id", "page", F.col("word_pos").alias("pos"), "word")


@query(f"WITH {_PAGES_SQL} SELECT * FROM results")
def q_pages_retried(t: Tables) -> DataFrame:
    """Every page was landed twice, first with other results; the newer landing counts, once."""
    landed = pages(t)
    first = landed.withColumns({"results": F.reverse("results"), "called_at": F.lit("2024-01-01")})
    both = first.unionByName(landed.withColumn("called_at", F.lit("2024-01-02")))
    rows = concat_pages(both, "conv_id", "page", "results", "word")
    return rows.select("conv_id", "page", F.col("word_pos").alias("pos"), "word")


@query(f"""
    WITH {_PAGES_SQL} SELECT * FROM results
    QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY page, pos) <= 40
""")
def q_pages_capped(t: Tables) -> DataFrame:
    """The same with a cap of 40 results per request, which may end inside a page."""
    rows = concat_pages(pages(t), "conv_id", "page", "results", "word", max_records=40)
    return rows.select("conv_id", "page", F.col("word_pos").alias("pos"), "word")


_WINDOW = ("daily", "2024-01-29", "2024-01-30")
_MEASUREMENTS_SQL = f"""
    WITH {_PAGES_SQL}
    SELECT conv_id AS sensor_id, c_name AS sensor_name, CAST(2 AS INTEGER) AS parameter_id, CAST(length(word) AS DOUBLE) AS value,
           FALSE AS historical_load, TRUE AS daily_average_load, '2024-01-29' AS load_date_from, '2024-01-30' AS load_date_to,
           'page ' || CAST(page AS VARCHAR) AS api_call_timestamp,
           'https://api.example/' || CAST(conv_id AS VARCHAR) AS sys_source_from, word AS period_end
    FROM results JOIN customer ON c_custkey = conv_id
"""


def measurement_pages(t: Tables) -> DataFrame:
    """Words as results with a value and a period."""
    return pages(t).select(
        F.col("conv_id").cast("string").alias("request_id"),
        "page",
        F.col("conv_id").alias("sensor_id"),
        F.transform(
            "results",
            lambda word: F.struct(
                F.length(word).cast("double").alias("value"),
                F.struct(F.struct(word.alias("utc")).alias("datetimeTo")).alias("period"),
            ),
        ).alias("results"),
        F.concat(F.lit("https://api.example/"), F.col("conv_id").cast("string")).alias("url"),
        F.concat(F.lit("page "), F.col("page").cast("string")).alias("called_at"),
    )


def customer_sensors(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("sensor_id"),
        F.col("c_name").alias("sensor_name"),
        F.lit(2).alias("parameter_id"),
        F.lit("pm25").alias("parameter_name"),
        F.lit("ug/m3").alias("parameter_units"),
        F.lit("PM2.5").alias("parameter_display_name"),
    )


def printed_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        "sensor_id", "sensor_name", "parameter_id", "value", "historical_load", "daily_average_load",
        "load_date_from", "load_date_to", "api_call_timestamp", "sys_source_from",
        F.col("period.datetimeTo.utc").alias("period_end"),
    )


@query(_MEASUREMENTS_SQL)
def q_bronze_measurements(t: Tables) -> DataFrame:
    """Pages to flat rows with the columns of sensor and request; customers are the sensors."""
    return printed_rows(bronze.measurements(measurement_pages(t), customer_sensors(t), _WINDOW))


@query(_MEASUREMENTS_SQL)
def q_landed_measurements(t: Tables) -> DataFrame:
    """The same through the job: landed under its run, and read where the pointer leads."""
    root = scratch_path(t.spark, "measurements")
    now = datetime(2024, 1, 30, 8, tzinfo=UTC)
    landing.measurements(measurement_pages(t), customer_sensors(t), _WINDOW, root, now)
    return printed_rows(versions.read_current(t.spark, root, MEASUREMENTS.replace("value string", "value double")))
