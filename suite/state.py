"""Watermarks, incremental loads and month backfills."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverair.functions import times
from silverair.operators import ranges as rg
from silverair.operators import state as st
from silverair.operators.nested import unwrap_envelope
from silverair.plans import bronze, landing
from silverair.schemas import END_TIME_PATHS
from silverair.session import scratch_path
from silverair.sinks import versions
from silverair.sources.tables import scan
from suite.base import Tables, instant_sql, instant_text, query


def readings(t: Tables) -> DataFrame:
    """Events as readings: user = sensor, event time = end of the reading."""
    return t.events.select(
        F.col("user_id").alias("sensor_id"), "event_id", "event_type", "value", F.col("ts").cast("timestamp").alias("at")
    )


@query(f"""
    WITH last AS (SELECT user_id, max(ts) AS ts FROM events WHERE event_type = 'purchase' GROUP BY user_id),
    clock AS (SELECT max(ts) AS now FROM events)
    SELECT u.user_id AS sensor_id,
           {instant_sql("greatest(coalesce(last.ts + INTERVAL 1 SECOND, now - INTERVAL 10 DAY), now - INTERVAL 10 DAY)")} AS date_from,
           {instant_sql("now")} AS date_to
    FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN last ON last.user_id = u.user_id, clock
""")
def q_watermark_window(t: Tables) -> DataFrame:
    """Watermarks from purchases; the next request of every user looks back ten days at most."""
    rows = readings(t)
    state = st.last_readings(rows.filter(F.col("event_type") == "purchase"), "sensor_id", F.col("at"))
    now = rows.agg(F.max("at")).scalar()
    windows = st.next_windows(rows.select("sensor_id").distinct(), state, "sensor_id", now, 10)
    return windows.select(
        "sensor_id", instant_text("date_from").alias("date_from"), instant_text("date_to").alias("date_to")
    )


@query(f"""
    SELECT user_id AS sensor_id, {instant_sql("max(ts)")} AS last_timestamp FROM events
    WHERE event_type IN ('purchase', 'click') GROUP BY user_id
""")
def q_state_upsert(t: Tables) -> DataFrame:
    """A batch of clicks merged into a state of purchases; no watermark moves backwards."""
    rows = readings(t)
    state = st.last_readings(rows.filter(F.col("event_type") == "purchase"), "sensor_id", F.col("at"))
    ended = F.when(F.col("event_type") == "click", F.col("at"))
    batch = st.last_readings(rows, "sensor_id", ended)
    merged = st.advance_state(state, batch, "sensor_id")
    return merged.select("sensor_id", instant_text("last_timestamp").alias("last_timestamp"))


@query("""
    SELECT o_orderkey, o_custkey AS sensor_id FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderdate BETWEEN TIMESTAMP '1996-03-15' AND TIMESTAMP '1999-02-10'
    QUALIFY row_number() OVER (PARTITION BY o_custkey, date_trunc('month', o_orderdate) ORDER BY o_orderdate, o_orderkey) <= 1
""")
def q_backfill(t: Tables) -> DataFrame:
    """Orders of all customers, asked for by customer and month, at most one per request."""
    sensors = t.customer.select(F.col("c_custkey").alias("sensor_id"))
    rows = t.orders.select(
        F.col("o_custkey").alias("sensor_id"), "o_orderkey", F.col("o_orderdate").cast("timestamp").alias("at")
    )
    start, end = (F.lit(day).cast("timestamp") for day in ("1996-03-15", "1999-02-10"))
    found = bronze.backfill_measurements(sensors, rows, start, end, "at", max_per_window=1)
    return found.select("o_orderkey", "sensor_id")


_ROUNDS_SQL = """
    first_round AS (
        SELECT event_id, user_id, ts, value, '2024-01-16T00:00:00+00:00' AS load_date FROM events
        WHERE ts BETWEEN TIMESTAMP '2024-01-06' AND TIMESTAMP '2024-01-16'
    ),
    last AS (SELECT user_id, max(ts) AS ts FROM first_round GROUP BY user_id),
    second_round AS (
        SELECT event_id, e.user_id, e.ts, value, '2024-01-31T00:00:00+00:00' AS load_date FROM events e LEFT JOIN last l ON l.user_id = e.user_id
        WHERE e.ts BETWEEN coalesce(l.ts + INTERVAL 1 SECOND, TIMESTAMP '2024-01-11') AND TIMESTAMP '2024-01-31'
    ),
    rounds AS (SELECT * FROM first_round UNION ALL SELECT * FROM second_round)
"""


def incremental_runs(t: Tables, runs: tuple, catch_up: bool = True) -> tuple[str, str]:
    """Incremental runs (day and lookback): the folders of landed envelopes and of the state."""
    rows = readings(t).drop("event_type")
    sensors = rows.select("sensor_id").distinct()
    path, state_root = scratch_path(t.spark, "envelopes"), scratch_path(t.spark, "state")
    for day, lookback in runs:
        now = datetime(2024, 1, day, tzinfo=UTC)
        landing.incremental_measurements(sensors, rows, path, state_root, now, "at", lookback, catch_up=catch_up)
    return path, state_root


def two_rounds(t: Tables, runs: tuple = ((16, 10), (31, 20)), catch_up: bool = True) -> tuple[DataFrame, DataFrame]:
    """Landed envelopes of two runs, and the state after the second one."""
    path, state_root = incremental_runs(t, runs, catch_up)
    schema = (
        "data struct<event_id: bigint, value: double, at: timestamp>, "
        "sys struct<load_date: string, source: string, sensor_id: bigint, granularity: string>, "
        "year string, month string, day string"
    )
    return unwrap_envelope(scan(t.spark, path, schema, "json")), landing.read_state(t.spark, state_root)


@query(f"""
    WITH {_ROUNDS_SQL}
    SELECT event_id, value, {instant_sql("ts")} AS at, load_date, 'openaq_lambda' AS source, user_id AS sensor_id,
           'day' AS granularity
    FROM rounds
""")
def q_bronze_incremental(t: Tables) -> DataFrame:
    landed, _ = two_rounds(t)
    return landed.withColumn("at", instant_text("at"))


@query(f"""
    WITH {_ROUNDS_SQL}
    SELECT user_id AS sensor_id, {instant_sql("max(ts)")} AS last_timestamp FROM rounds GROUP BY user_id
""")
def q_incremental_state(t: Tables) -> DataFrame:
    _, state = two_rounds(t)
    return state.select("sensor_id", instant_text("last_timestamp").alias("last_timestamp"))


@query("""
    SELECT event_id, 'year=' || strftime(ts, '%Y') || '/month=' || strftime(ts, '%m') || '/day=' || strftime(ts, '%d') AS run_partition,
           CAST(strftime(ts, '%Y%m%d%H%M%S') AS BIGINT) AS run_number,
           strftime(date_trunc('month', ts) + INTERVAL 1 MONTH, '%Y-%m-%d') AS next_month,
           strftime(ts - INTERVAL 2 DAY, '%Y-%m-%d') AS two_days_before
    FROM events
""")
def q_run_labels(t: Tables) -> DataFrame:
    """Partition text, run number, next month and earlier days of every instant."""
    e = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return e.select(
        "event_id",
        times.run_partition("ts").alias("run_partition"),
        times.run_number("ts").alias("run_number"),
        F.date_format(times.next_month("ts"), "yyyy-MM-dd").alias("next_month"),
        F.date_format(times.days_before("ts", 2), "yyyy-MM-dd").alias("two_days_before"),
    )


_GAP_SQL = """
    WITH early AS (
        SELECT event_id, user_id, ts FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-06'
    ),
    last AS (SELECT user_id, max(ts) AS ts FROM early GROUP BY user_id),
    later AS (
        SELECT event_id, e.user_id, e.ts FROM events e LEFT JOIN last l ON l.user_id = e.user_id
        WHERE e.ts BETWEEN {start} AND TIMESTAMP '2024-01-31'
    )
    SELECT event_id, user_id AS sensor_id FROM early UNION ALL SELECT event_id, user_id FROM later
"""


@query(_GAP_SQL.format(start="coalesce(l.ts + INTERVAL 1 SECOND, TIMESTAMP '2024-01-28')"))
def q_incremental_gap(t: Tables) -> DataFrame:
    """An outage longer than the lookback: sensors go on where they stopped."""
    landed, _ = two_rounds(t, ((6, 3), (31, 3)))
    return landed.select("event_id", "sensor_id")


@query(_GAP_SQL.format(start="greatest(coalesce(l.ts + INTERVAL 1 SECOND, TIMESTAMP '2024-01-28'), TIMESTAMP '2024-01-28')"))
def q_incremental_lookback(t: Tables) -> DataFrame:
    """The same with windows that never begin before the lookback."""
    landed, _ = two_rounds(t, ((6, 3), (31, 3)), catch_up=False)
    return landed.select("event_id", "sensor_id")


_FIRST_DAY, _LAST_DAY = "2024-01-01", "2024-01-31"


@query(f"""
    WITH users AS (SELECT DISTINCT user_id FROM events),
    r1 AS (SELECT user_id, TIMESTAMP '2024-01-03' AS a, TIMESTAMP '2024-01-06' AS b FROM users),
    last1 AS (SELECT user_id, max(ts) AS ts FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-06' GROUP BY user_id),
    r2 AS (
        SELECT user_id, coalesce(ts + INTERVAL 1 SECOND, TIMESTAMP '2024-01-13') AS a, TIMESTAMP '2024-01-16' AS b
        FROM users LEFT JOIN last1 USING (user_id)
    ),
    last2 AS (
        SELECT e.user_id, max(e.ts) AS ts FROM events e JOIN (SELECT * FROM r1 UNION ALL SELECT * FROM r2) r
        ON e.user_id = r.user_id AND e.ts BETWEEN r.a AND r.b GROUP BY e.user_id
    ),
    r3 AS (
        SELECT user_id, coalesce(ts + INTERVAL 1 SECOND, TIMESTAMP '2024-01-28') AS a, TIMESTAMP '2024-01-31' AS b
        FROM users LEFT JOIN last2 USING (user_id)
    ),
    asked AS (SELECT * FROM r1 UNION ALL SELECT * FROM r2 UNION ALL SELECT * FROM r3),
    behind AS (
        SELECT *, max(b) OVER (PARTITION BY user_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM asked
    ),
    flagged AS (
        SELECT *, sum(CASE WHEN a <= before + INTERVAL 1 MICROSECOND THEN 0 ELSE 1 END)
            OVER (PARTITION BY user_id ORDER BY a, b) AS island FROM behind
    ),
    covered AS (SELECT user_id, min(a) AS a, max(b) AS b FROM flagged GROUP BY user_id, island),
    gaps AS (
        SELECT user_id, lag(b + INTERVAL 1 MICROSECOND, 1, TIMESTAMP '{_FIRST_DAY}') OVER (PARTITION BY user_id ORDER BY a) AS a,
               a - INTERVAL 1 MICROSECOND AS b
        FROM covered
    )
    SELECT user_id AS sensor_id, kind, {instant_sql("a")} AS range_from, {instant_sql("b")} AS range_to
    FROM (SELECT *, 'covered' AS kind FROM covered UNION ALL SELECT *, 'missing' FROM gaps)
""")
def q_covered_ranges(t: Tables) -> DataFrame:
    """Three runs with outages between them: what every sensor was asked for, and what is missing of the month."""
    _, state_root = incremental_runs(t, ((6, 3), (16, 3), (31, 3)))
    ledger = landing.read_ledger(t.spark, state_root)
    gaps = rg.missing(*(F.lit(day).cast("timestamp") for day in (_FIRST_DAY, _LAST_DAY)), F.col("covered"))
    kinds = F.array(
        *[F.struct(F.lit(kind).alias("kind"), found.alias("ranges")) for kind, found in (("covered", F.col("covered")), ("missing", gaps))]
    )
    listed = ledger.select("sensor_id", F.explode(kinds).alias("at")).select("sensor_id", "at.kind", F.explode("at.ranges").alias("range"))
    return listed.select(
        "sensor_id", "kind", instant_text("range.start").alias("range_from"), instant_text("range.stop").alias("range_to")
    )


@query(f"""
    SELECT user_id AS sensor_id, {instant_sql("max(ts)")} AS last_timestamp FROM events
    WHERE event_type IN ('purchase', 'click', 'view') GROUP BY user_id
""")
def q_concurrent_state(t: Tables) -> DataFrame:
    """Two runs that start from the same state and overlap: the watermarks of both survive."""
    root, rows = scratch_path(t.spark, "shared-state"), readings(t)

    def ends(kind: str) -> DataFrame:
        return st.last_readings(rows.filter(F.col("event_type") == kind), "sensor_id", F.col("at"))

    def advance(kind: str, meanwhile: Callable[[], None] = lambda: None) -> None:
        def change(old: DataFrame) -> DataFrame:
            made = st.advance_state(old, ends(kind), "sensor_id")
            meanwhile()
            return made

        versions.update(t.spark, root, "sensor_id bigint, last_timestamp timestamp", change)

    other_runs = [lambda: advance("click")]
    advance("purchase")
    # The first attempt of this run is overtaken by another run, the second is not.
    advance("view", lambda: other_runs.pop()() if other_runs else None)
    state = versions.read_current(t.spark, root, "sensor_id bigint, last_timestamp timestamp")
    return state.select("sensor_id", instant_text("last_timestamp").alias("last_timestamp"))


@query(f"""
    SELECT event_id, CASE WHEN event_id % 9 < 8 THEN {instant_sql("ts")} END AS ended FROM events
""")
def q_end_time(t: Tables) -> DataFrame:
    """Readings as JSON text with their end under each of the known paths in turn, or under none."""
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    shapes = []
    for path in END_TIME_PATHS:
        names = path.split(".")
        head = "".join(f'{{"{name}":' for name in names)
        shapes.append(F.concat(F.lit(f"{head}\""), text, F.lit('"' + "}" * len(names))))
    record = F.get(F.array(*shapes, F.lit('{"value": 1}')), (F.col("event_id") % 9).cast("int"))
    # The text is looked up under eight paths, so it is built in a step of its own.
    built = t.events.select("event_id", record.alias("record"))
    return built.select("event_id", instant_text(bronze.end_time("record")).alias("ended"))
