"""Projections, filters, joins, unions, aggregates and quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverair.functions import scoring, times
from silverair.functions.text import list_items, natural_key, strip_quotes
from silverair.operators import quality
from silverair.operators.dedupe import latest_per_key, top_per_key
from silverair.operators.increment import insert_new, join_back, priority_union
from silverair.sources.tables import run_sql
from suite.base import Tables, day_text, instant_sql, instant_text, money, money_sql, query


@query("""
    SELECT concat_ws('-', CAST(user_id AS VARCHAR), CAST(event_id AS VARCHAR)) AS sys_unique_key,
           user_id AS sensor_id, CAST(value AS DOUBLE) AS parameter_value,
           strftime(ts, '%Y-%m-%d') AS load_date, strftime(ts, '%Y%m%d') AS date_id,
           CAST(regexp_extract(props, ':\\s*(-?[0-9]+)', 1) AS INTEGER) AS k,
           CAST(NULL AS DOUBLE) AS not_a_number, 'success' AS status, CAST(1 AS INTEGER) AS source_priority
    FROM events
""")
def q_typed_projection(t: Tables) -> DataFrame:
    """user = sensor; bad text becomes NULL instead of an error."""
    return t.events.select(
        natural_key("-", "user_id", "event_id").alias("sys_unique_key"),
        F.col("user_id").try_cast("bigint").alias("sensor_id"),
        F.col("value").try_cast("double").alias("parameter_value"),
        day_text("ts").alias("load_date"),
        times.date_id(F.to_date("ts")).alias("date_id"),
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
        F.col("event_type").try_cast("double").alias("not_a_number"),
        F.lit("success").alias("status"),
        F.lit(1).alias("source_priority"),
    )


@query("""
    SELECT event_id, user_id, value FROM events
    WHERE event_type = 'purchase' AND value IS NOT NULL AND user_id IS NOT NULL AND dayofweek(ts) IN (0, 6)
""")
def q_filter_status(t: Tables) -> DataFrame:
    """event type = status; weekend readings with a value."""
    e = t.events
    kept = e.filter((F.col("event_type") == "purchase") & F.col("value").isNotNull() & F.col("user_id").isNotNull())
    return kept.filter(F.dayofweek("ts").isin(1, 7)).select("event_id", "user_id", "value")


@query("""
    SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id) = 1
""")
def q_latest_per_key(t: Tables) -> DataFrame:
    """Newest reading per user and day."""
    e = t.events.withColumn("day", day_text("ts"))
    newest = latest_per_key(e, ["user_id", "day"], "ts", tie=[F.col("event_id")])
    return newest.select("user_id", "day", "event_id", "event_type", "value")


@query(f"""
    WITH current_rows AS (
        SELECT user_id, CAST(ts AS DATE) AS day, event_type AS source, value, ts, 1 AS priority
        FROM events WHERE event_type IN ('purchase', 'signup')
    ), historical AS (
        SELECT user_id, CAST(ts AS DATE) AS day, event_type AS source, avg(value) AS value, min(ts) AS ts, 2 AS priority
        FROM events WHERE event_type NOT IN ('purchase', 'signup')
        GROUP BY user_id, CAST(ts AS DATE), event_type
    )
    SELECT user_id, strftime(day, '%Y-%m-%d') AS day, source, round(value, 8) AS value, {instant_sql("ts")} AS loaded_at
    FROM (SELECT * FROM current_rows UNION ALL SELECT * FROM historical)
    QUALIFY row_number() OVER (PARTITION BY user_id, day ORDER BY priority, ts DESC, source, value) = 1
""")
def q_priority_union(t: Tables) -> DataFrame:
    """Two event types are current rows; the others count as raw readings and are averaged per day."""
    e = t.events.withColumn("day", day_text("ts")).withColumnRenamed("event_type", "source")
    is_current = F.col("source").isin("purchase", "signup")
    current = e.filter(is_current).select("user_id", "day", "source", "value", "ts")
    historical = (
        e.filter(~is_current)
        .groupBy("user_id", "day", "source")
        .agg(F.avg("value").alias("value"), F.min("ts").alias("ts"))
    )
    tie = [F.col("source"), F.col("value")]
    best = priority_union([current, historical], ["user_id", "day"], "ts", tie)
    return best.select(
        "user_id", "day", "source", F.round("value", 8).alias("value"), instant_text("ts").alias("loaded_at")
    )


@query("""
    WITH batch AS (
        SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1995-07-01'
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1
    )
    SELECT * FROM batch
    WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1995-07-01')
""")
def q_insert_new(t: Tables) -> DataFrame:
    """Customers of the later orders that have no earlier order."""
    late = F.col("o_orderdate") >= F.lit("1995-07-01").cast("timestamp_ntz")
    batch = latest_per_key(t.orders.filter(late), ["o_custkey"], "o_orderdate", tie=[F.col("o_orderkey")])
    new = insert_new(batch, t.orders.filter(~late), "o_custkey")
    return new.select("o_custkey", "o_orderkey", "o_totalprice")


@query(f"""
    SELECT c_custkey, c_name, n_orders, spent
    FROM customer LEFT JOIN (
        SELECT o_custkey, count(*) AS n_orders, {money_sql("o_totalprice")} AS spent FROM orders GROUP BY o_custkey
    ) ON c_custkey = o_custkey
    WHERE spent IS NOT NULL
""")
def q_left_join_back(t: Tables) -> DataFrame:
    """Scores of customers put back on all customers; those without a score are dropped."""
    scores = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"), money("o_totalprice").alias("spent")
    )
    return join_back(t.customer.select("c_custkey", "c_name"), scores, "c_custkey", ["spent"])


@query("""
    SELECT doc_id, md5(text) AS cleaned, lang FROM documents WHERE lang = 'en'
""")
def q_quote_clean(t: Tables) -> DataFrame:
    """Quoted text and language; the filter uses the language without quotes."""
    quoted = t.documents.select(
        "doc_id",
        F.concat(F.lit('"'), "text", F.lit('"')).alias("text"),
        F.concat(F.lit('"'), "lang", F.lit('"')).alias("lang"),
    )
    clean = quoted.select("doc_id", strip_quotes("text").alias("text"), strip_quotes("lang").alias("lang"))
    return clean.filter(F.col("lang") == "en").select("doc_id", F.md5("text").alias("cleaned"), "lang")


@query(f"""
    WITH spent AS (
        SELECT c_custkey, coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS total, count(o_orderkey) AS n
        FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey
    ), scored AS (
        SELECT c_custkey, CAST(floor(CAST(total AS DOUBLE) / 10000) AS DOUBLE) / (pi() * 300 * 300 / 10000.0) AS density,
               CASE WHEN n < 6 THEN 1 WHEN n < 9 THEN 2 WHEN n < 12 THEN 3 WHEN n < 14 THEN 4 ELSE 5 END AS h
        FROM spent
    ), banded AS (
        SELECT *, CASE WHEN density < 6 THEN 1 WHEN density < 9 THEN 2 WHEN density < 12 THEN 3
                       WHEN density < 14 THEN 4 ELSE 5 END AS b
        FROM scored
    )
    SELECT c_custkey, round(density, 6) AS density, CAST(b AS INTEGER) AS building_score, CAST(h AS INTEGER) AS highway_score,
           CAST(round(0.7 * b + 0.3 * h) AS INTEGER) AS urbanity_score
    FROM banded
""")
def q_band_score(t: Tables) -> DataFrame:
    """Density of spending, its band, and the weighted score with a second band."""
    joined = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    spent = joined.groupBy("c_custkey").agg(
        F.coalesce(money("o_totalprice"), F.lit(0.0)).alias("total"), F.count("o_orderkey").alias("n")
    )
    density = scoring.density_per_hectare(F.floor(F.col("total") / 10000))
    scored = spent.select("c_custkey", density.alias("density"), scoring.band("n").alias("highway_score"))
    banded = scored.withColumn("building_score", scoring.band("density"))
    return banded.select(
        "c_custkey",
        F.round("density", 6).alias("density"),
        "building_score",
        "highway_score",
        scoring.weighted_score("building_score", "highway_score").alias("urbanity_score"),
    )


@query("""
    SELECT user_id, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) <= 20
""")
def q_cap_per_key(t: Tables) -> DataFrame:
    """The first 20 readings per user in time order."""
    capped = top_per_key(t.events, ["user_id"], [F.col("ts").asc(), F.col("event_id").asc()], 20)
    return capped.select("user_id", "event_id", "value")


@query("""
    SELECT event_type AS source, count(*) AS rows FROM events GROUP BY event_type
    UNION ALL SELECT 'all sources', count(*) FROM events
""")
def q_source_counts(t: Tables) -> DataFrame:
    counts = quality.source_counts(t.events, "event_type")
    return counts.select(F.when(F.col("is_total"), "all sources").otherwise(F.col("event_type")).alias("source"), "rows")


@query(f"""
    SELECT event_id, {instant_sql("date_trunc('second', ts)")} AS read_at, {instant_sql("ts")} AS loaded_at,
           strftime(date_trunc('second', ts) + INTERVAL 5 HOUR, '%Y-%m-%d') AS shifted_day,
           strftime(ts, '%Y-%m-%d') || 'T23:59:59+00:00' AS day_end, CAST(NULL AS VARCHAR) AS malformed
    FROM events
""")
def q_iso_parse(t: Tables) -> DataFrame:
    """Instants printed in several ISO shapes and read back."""
    e = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    shapes = e.select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("load_text"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("read_text"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'-05:00'").alias("shifted_text"),
        F.date_format("ts", "yyyy-MM-dd").alias("day_text"),
        F.date_format("ts", "dd/MM/yyyy HH:mm").alias("malformed_text"),
    )
    return shapes.select(
        "event_id",
        instant_text(times.reading_instant("read_text")).alias("read_at"),
        instant_text(times.load_instant("load_text")).alias("loaded_at"),
        day_text(times.local_day(times.iso_instant("shifted_text"))).alias("shifted_day"),
        times.normalise_iso("day_text", end_of_day=True).alias("day_end"),
        times.load_instant("malformed_text").cast("string").alias("malformed"),
    )


@query("""
    SELECT item, count(*) AS parts FROM (SELECT unnest(string_split(p_name, ' ')) AS item FROM part)
    WHERE item <> '' GROUP BY item
""")
def q_csv_list(t: Tables) -> DataFrame:
    """Names written as untidy lists, split again and counted per item."""
    untidy = t.part.select(F.concat(F.lit(" ,"), F.replace("p_name", F.lit(" "), F.lit(" , ,"))).alias("items"))
    items = untidy.select(F.explode(list_items("items")).alias("item"))
    return items.groupBy("item").agg(F.count(F.lit(1)).alias("parts"))


@query("""
    WITH observed AS (
        SELECT 'column_count' AS rule, 5 AS observed
        UNION ALL SELECT 'not_null(c_name)', (SELECT count(*) FROM customer WHERE c_name IS NULL)
        UNION ALL SELECT 'in_range(c_acctbal)', (SELECT count(*) FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9999.99)
        UNION ALL SELECT 'accepted(c_mktsegment)', (SELECT count(*) FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'FURNITURE'))
        UNION ALL SELECT 'unique(c_custkey)', (SELECT count(*) - count(DISTINCT c_custkey) FROM customer)
        UNION ALL SELECT 'unique(c_nationkey,c_mktsegment)',
            (SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer)) FROM customer)
    )
    SELECT rule, CAST(observed AS BIGINT) AS observed,
           CASE WHEN rule = 'column_count' THEN observed > 0 ELSE observed = 0 END AS passed
    FROM observed
""")
def q_quality(t: Tables) -> DataFrame:
    rules = [
        quality.not_null("c_name"),
        quality.in_range("c_acctbal", 0, 9999.99),
        quality.accepted("c_mktsegment", ["BUILDING", "FURNITURE"]),
        quality.unique("c_custkey"),
        quality.unique("c_nationkey", "c_mktsegment"),
    ]
    return quality.check(t.customer, rules)


@query("""
    SELECT count(*) AS processed, count(*) FILTER (WHERE event_type <> 'error') AS succeeded,
           count(*) FILTER (WHERE event_type = 'error') AS failed
    FROM events
""")
def q_run_log(t: Tables) -> DataFrame:
    status = F.when(F.col("event_type") == "error", "error").otherwise("success")
    return quality.run_log(t.events.select(status.alias("status")), quality.run_counters())


@query(f"""
    SELECT c_mktsegment, count(*) AS n_orders, {money_sql("o_totalprice")} AS spent
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment
""")
def q_sql_frames(t: Tables) -> DataFrame:
    """SQL over named frames."""
    text = """
        WITH joined AS (SELECT * FROM {sales} JOIN {buyers} ON o_custkey = c_custkey)
        SELECT c_mktsegment, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent
        FROM joined GROUP BY c_mktsegment
    """
    return run_sql(t.spark, text, {"sales": t.orders, "buyers": t.customer})


@query("""
    SELECT concat_ws('-', CAST(c_acctbal AS VARCHAR), CAST(CAST(c_nationkey AS DOUBLE) AS VARCHAR), c_name) AS dw_unique_key
    FROM customer
""")
def q_double_key(t: Tables) -> DataFrame:
    """Doubles as parts of a text key."""
    key = natural_key("-", "c_acctbal", F.col("c_nationkey").cast("double"), "c_name")
    return t.customer.select(key.alias("dw_unique_key"))


@query("""
    SELECT event_id, 'historical' AS load_type FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'
    UNION ALL
    SELECT event_id, 'daily' FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-29' AND DATE '2024-01-30'
""")
def q_load_window(t: Tables) -> DataFrame:
    """Readings of a given range and of a daily run."""
    from datetime import UTC, datetime

    now = datetime(2024, 1, 30, 6, tzinfo=UTC)
    windows = [
        times.measurement_window(now, historical=True, date_from="2024-01-10", date_to="2024-01-20"),
        times.measurement_window(now),
    ]
    parts = []
    for kind, first, last in windows:
        # Compare the instant itself, so that the filter reaches the scan.
        start = F.lit(first).cast("timestamp_ntz")
        end = F.lit(last).cast("timestamp_ntz") + F.expr("interval 1 day")
        kept = t.events.filter((F.col("ts") >= start) & (F.col("ts") < end))
        parts.append(kept.select("event_id", F.lit(kind).alias("load_type")))
    return parts[0].unionByName(parts[1])
