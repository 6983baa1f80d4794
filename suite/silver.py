"""The silver tables and the landed tables they are made of, end to end."""

from __future__ import annotations

from datetime import UTC, datetime
from types import SimpleNamespace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverair.plans import bronze, jobs, landing, silver
from silverair.schemas import (
    DIM_SENSOR_LOCATION,
    DIM_URBANITY_SCORE,
    FACT_SENSOR_MEASURE,
    FACT_WEATHER,
    SITE_FEATURES,
    WEATHER,
    WEATHER_METRICS,
)
from silverair.session import scratch_path
from silverair.sinks import increments, versions
from silverair.sources.files import with_ordinal
from silverair.sources.tables import scan
from suite.base import LOCATIONS_SQL, SQL, Tables, day_text, instant_sql, instant_text, locations, money, query

LATER = "2024-01-16"


@query(f"""
    WITH {LOCATIONS_SQL}
    SELECT CAST(id AS VARCHAR) || '_' || CAST(sensor_id AS VARCHAR) AS sys_unique_key, CAST(id AS VARCHAR) AS location_id,
           CASE WHEN timezone IN ('ASIA', 'EUROPE') THEN name ELSE upper(name) END AS location_name, timezone,
           latitude AS location_latitude, longitude AS location_longitude, country_id, country_name, country_code, sensor_id,
           CASE WHEN id % 2 = 0 THEN '2024-02-01 00:00:00.000000' ELSE '2024-02-01 00:00:00.250000' END AS sys_load_ts,
           'https://api.example/locations' AS sys_source_from
    FROM location_sensors WHERE parameter_id = '2'
""")
def q_sensor_dim(t: Tables) -> DataFrame:
    """Two regions first, then all locations under new names; known sensors keep their row."""
    path = scratch_path(t.spark, "sensor-dim")
    nested = locations(t)
    jobs.sensor_locations(nested.filter(F.col("timezone").isin("ASIA", "EUROPE")), path)
    jobs.sensor_locations(nested.withColumn("name", F.upper("name")), path)
    stored = scan(t.spark, path, DIM_SENSOR_LOCATION.ddl)
    return stored.withColumn("sys_load_ts", instant_text("sys_load_ts"))


_CURRENT = ("purchase", "signup")


def measurement_sources(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Events as daily API rows and, for the other types, as quoted raw readings."""
    e = t.events
    kind, user = F.col("event_type"), F.col("user_id")

    def quoted(text: Column) -> Column:
        return F.concat(F.lit('"'), text, F.lit('"'))

    value = F.col("value").cast("string")
    precise = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    rounded = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    current = e.filter(kind.isin(*_CURRENT)).select(
        user.alias("sensor_id"),
        F.concat(F.lit("user "), user.cast("string")).alias("sensor_name"),
        kind.alias("parameter_display_name"),
        F.lit("ug").alias("parameter_units"),
        value.alias("value"),
        day_text("ts").alias("load_date_from"),
        F.when(kind == "signup", rounded).otherwise(precise).alias("api_call_timestamp"),
        F.lit("https://api.example/days").alias("sys_source_from"),
    )
    utc = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    local = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'-05:00'")
    historical = e.filter(~kind.isin(*_CURRENT)).select(
        quoted(user.cast("string")).alias("sensors_id"),
        F.when(kind == "error", F.lit("pm10")).otherwise(quoted(F.lit("pm25"))).alias("parameter"),
        quoted(F.when(kind == "view", "mg").otherwise("ug")).alias("units"),
        quoted(F.when(F.col("value") < 1, "n/a").otherwise(value)).alias("value"),
        quoted(F.when(kind == "view", local).otherwise(utc)).alias("datetime"),
    )
    return current, historical


_MEASURE_SQL = f"""
    WITH current_rows AS (
        SELECT user_id, 'user ' || CAST(user_id AS VARCHAR) AS sensor_name, event_type AS parameter_name, 'ug' AS units, value,
               CAST(ts AS DATE) AS day, CASE WHEN event_type = 'signup' THEN date_trunc('second', ts) ELSE ts END AS ts,
               'https://api.example/days' AS source, 1 AS priority
        FROM events WHERE event_type IN ('purchase', 'signup')
    ), readings AS (
        SELECT user_id, CASE WHEN event_type = 'view' THEN 'mg' ELSE 'ug' END AS units, value,
               date_trunc('second', ts) + CASE WHEN event_type = 'view' THEN INTERVAL 5 HOUR ELSE INTERVAL 0 HOUR END AS ts
        FROM events WHERE event_type IN ('view', 'click') AND value >= 1
    ), historical AS (
        SELECT user_id, 'pm25 ' || units AS sensor_name, 'pm25' AS parameter_name, units, avg(value) AS value,
               CAST(ts AS DATE) AS day, min(ts) AS ts, 'historical_openaq' AS source, 2 AS priority
        FROM readings GROUP BY user_id, units, CAST(ts AS DATE)
    )
    SELECT CAST(user_id AS VARCHAR) || '-' || strftime(day, '%Y-%m-%d') AS sys_unique_key, user_id AS sensor_id, sensor_name,
           parameter_name, units AS parameter_units, round(value, 8) AS parameter_value,
           strftime(day, '%Y-%m-%d') AS load_date, strftime(day, '%Y%m%d') AS date_id, {instant_sql("ts")} AS sys_load_ts,
           source AS sys_source_from
    FROM (SELECT * FROM current_rows UNION ALL SELECT * FROM historical)
    QUALIFY row_number() OVER (PARTITION BY user_id, day ORDER BY priority, ts DESC, sensor_name, parameter_name, units, value) = 1
"""


@query(_MEASURE_SQL)
def q_measure_fact(t: Tables) -> DataFrame:
    """Quote cleaning, daily averages, source priority and the versioned refresh."""
    root = scratch_path(t.spark, "measure-fact")
    jobs.sensor_measures(*measurement_sources(t), root)
    return printed_measures(versions.read_current(t.spark, root, FACT_SENSOR_MEASURE.ddl))


def printed_measures(stored: DataFrame) -> DataFrame:
    return stored.withColumns(
        {
            "parameter_value": F.round("parameter_value", 8),
            "load_date": day_text("load_date"),
            "sys_load_ts": instant_text("sys_load_ts"),
        }
    )


@query(_MEASURE_SQL)
def q_measure_merge(t: Tables) -> DataFrame:
    """The same fact from three batches: readings of all days come late, and the second batch comes twice."""
    root, late = scratch_path(t.spark, "measure-merge"), F.col("event_id") % 3
    for number in (0, 1, 1, 2):
        batch = SimpleNamespace(events=t.events.filter(late == number))
        jobs.merge_measures(*measurement_sources(batch), root, f"batch-{number}")
    return printed_measures(jobs.measures(t.spark, root))


def weather_rows(t: Tables, day: Column | None = None) -> DataFrame:
    """Events as landed weather: the user gives the coordinate, the event type the status."""
    code = F.get_json_object("props", "$.k").cast("int")
    return t.events.select(
        F.col("user_id").alias("location_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("api_call_timestamp"),
        (F.col("user_id") * 0.5 - 40).alias("lat"),
        (F.col("user_id") * 0.25).alias("lon"),
        (day_text("ts") if day is None else day).alias("record_date"),
        code.alias("weather_code"),
        *[
            (F.col("value") * factor).alias(name)
            for factor, name in enumerate((n for n in WEATHER_METRICS if n != "weather_code"), start=1)
        ],
        F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"),
    )


@query(f"""
    WITH loads AS (
        SELECT *, 1 AS load FROM events WHERE ts < TIMESTAMP '{LATER}'
        UNION ALL SELECT *, 2 FROM events
    )
    SELECT CAST(user_id * 0.5 - 40 AS DOUBLE)::VARCHAR || '-' || CAST(user_id * 0.25 AS DOUBLE)::VARCHAR || '-'
               || strftime(ts, '%Y-%m-%d') AS dw_unique_key,
           CAST(user_id AS VARCHAR) AS sys_source_id, strftime(ts, '%Y%m%d') AS date_id,
           CAST(regexp_extract(props, ':\\s*(-?[0-9]+)', 1) AS INTEGER) AS weather_code,
           value AS precipitation_sum, value * 3 AS precipitation_hours, value * 2 AS rain_sum, value * 4 AS snowfall_sum,
           value * 5 AS wind_speed_10m_max, value * 6 AS wind_direction_10m_dominant, {instant_sql("ts")} AS sys_load_ts
    FROM loads WHERE event_type <> 'error'
    QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY load, ts DESC, event_id) = 1
""")
def q_weather_fact(t: Tables) -> DataFrame:
    """Two loads: newest successful row per coordinate and day, then only keys that are new."""
    path = scratch_path(t.spark, "weather-fact")
    raw = weather_rows(t)
    jobs.weather(raw.filter(F.col("record_date") < LATER), path)
    jobs.weather(raw, path)
    return scan(t.spark, path, FACT_WEATHER.ddl).withColumn("sys_load_ts", instant_text("sys_load_ts"))


@query("""
    SELECT CAST(user_id * 0.5 - 40 AS DOUBLE)::VARCHAR || '-' || CAST(user_id * 0.25 AS DOUBLE)::VARCHAR || '-'
               || strftime(ts, '%Y-%m-%d') AS dw_unique_key, strftime(ts, '%Y%m%d') AS date_id,
           CAST(regexp_extract(props, ':\\s*(-?[0-9]+)', 1) AS INTEGER) AS weather_code,
           (SELECT count(DISTINCT user_id) FROM events WHERE event_type <> 'error' AND event_id % 50 = 0) AS quarantined
    FROM events WHERE event_type <> 'error' AND event_id % 50 <> 0
    QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id) = 1
""")
def q_weather_quarantine(t: Tables) -> DataFrame:
    """Some rows have no readable day: they are kept beside the fact, once, and the rest is loaded, once."""
    path = scratch_path(t.spark, "weather-quarantine")
    raw = weather_rows(t, F.when(F.col("event_id") % 50 == 0, "no day").otherwise(day_text("ts")))
    for _ in range(2):
        jobs.weather(raw, path)
    aside = t.spark.read.parquet(increments.quarantine_path(path)).count()
    return scan(t.spark, path, FACT_WEATHER.ddl).select(
        "dw_unique_key", "date_id", "weather_code", F.lit(aside).cast("bigint").alias("quarantined")
    )


@query("""
    WITH features AS (
        SELECT c_custkey, count(o_orderkey) AS highways,
               CAST(floor(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 10000) AS BIGINT) AS buildings
        FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey HAVING count(o_orderkey) > 0
    ), scored AS (
        SELECT c_custkey, CAST(ntile(5) OVER (ORDER BY highways, c_custkey) AS INTEGER) AS h,
               CAST(buildings AS DOUBLE) / (pi() * 300 * 300 / 10000.0) AS density
        FROM features
    ), banded AS (
        SELECT *, CASE WHEN density < 6 THEN 1 WHEN density < 9 THEN 2 WHEN density < 12 THEN 3
                       WHEN density < 14 THEN 4 ELSE 5 END AS b
        FROM scored
    )
    SELECT CAST(c_custkey AS VARCHAR) AS location_id, CAST(round(0.7 * b + 0.3 * h) AS INTEGER) AS urbanity_score,
           CAST(b AS INTEGER) AS building_score, h AS highway_score
    FROM banded
""")
def q_urbanity(t: Tables) -> DataFrame:
    """Customers as sites: spending stands for buildings, orders for highways."""
    return silver.urbanity(scored_sites(t))


@query(SQL["q_urbanity"])
def q_scores_published(t: Tables) -> DataFrame:
    """The same scores through the job, refreshed twice and read through the pointer."""
    root = scratch_path(t.spark, "scores")
    for _ in range(2):
        jobs.urbanity_scores(scored_sites(t), root)
    return versions.read_current(t.spark, root, DIM_URBANITY_SCORE.ddl)


def scored_sites(t: Tables) -> DataFrame:
    joined = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    counted = joined.groupBy("c_custkey").agg(
        F.count("o_orderkey").alias("highway_count"),
        F.floor(money("o_totalprice") / 10000).alias("main_building_count"),
    )
    return counted.select(
        F.col("c_custkey").alias("sys_primary_key"),
        F.col("c_custkey").alias("location_id"),
        "main_building_count",
        "highway_count",
        F.lit(None).cast("int").alias("radius_m"),
        F.when(F.col("highway_count") > 0, "success").otherwise("error").alias("status"),
    )


@query(f"""
    WITH {LOCATIONS_SQL}
    SELECT sensor_id, sensor_name, id AS location_id, name AS location_name, locality, country_name,
           latitude AS location_latitude, longitude AS location_longitude
    FROM location_sensors WHERE parameter_id = '2'
    QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY id DESC, pos DESC) = 1
""")
def q_bronze_sensors(t: Tables) -> DataFrame:
    """The newest published locations in file order; the last entry of a sensor wins."""
    root = scratch_path(t.spark, "locations")
    nested = locations(t)
    versions.refresh(nested.filter(F.col("timezone") == "ASIA"), root)
    versions.refresh(nested.orderBy("id"), root)
    current = with_ordinal(versions.read_current(t.spark, root, nested.schema))
    return bronze.sensors(current).select(
        "sensor_id", "sensor_name", "location_id", "location_name", "locality", "country_name",
        "location_latitude", "location_longitude",
    )


_CALLED_AT = datetime(2026, 4, 30, 10, 15, 30, tzinfo=UTC)
_SITES_SQL = f"""
    {LOCATIONS_SQL}, sites AS (
        SELECT id AS location_id, country_name, locality AS city_or_locality, longitude, latitude FROM locations
        WHERE latitude IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY country_name, locality, longitude, latitude ORDER BY id) = 1
    ), answers AS (
        SELECT s.*, embedding, label, CASE WHEN vec_id IS NULL THEN 'no response' WHEN label = 3 THEN 'timeout' END AS failure
        FROM sites s LEFT JOIN embeddings ON vec_id = location_id
    )
"""


def sites(t: Tables) -> DataFrame:
    return bronze.sites(locations(t).withColumn("ordinal", F.col("id")), ["ordinal"])


def failure(label: Column) -> Column:
    return F.when(label == 3, "timeout")


_WEATHER_SQL = f"""
    WITH {_SITES_SQL}, days AS (
        SELECT a.*, i, strftime(DATE '2024-01-01' + CAST(i AS INTEGER), '%Y-%m-%d') AS record_date
        FROM answers a, unnest(range(0, len(embedding))) AS r(i) WHERE failure IS NULL AND label <> 4
    )
    SELECT location_id, latitude AS lat, longitude AS lon, country_name, record_date,
           CAST(floor(CAST(embedding[i + 1] AS DOUBLE) * 100) AS DOUBLE) AS weather_code,
           CAST(embedding[i + 1] AS DOUBLE) AS precipitation_sum,
           CASE WHEN i < 10 THEN CAST(embedding[i + 1] AS DOUBLE) END AS rain_sum, CAST(NULL AS DOUBLE) AS snowfall_sum,
           'success' AS status, 'none' AS error_message
    FROM days
    UNION ALL
    SELECT location_id, latitude, longitude, country_name, '2024-01-01', NULL, NULL, NULL, NULL, 'error', failure
    FROM answers WHERE failure IS NOT NULL
"""


def weather_payloads(t: Tables) -> DataFrame:
    """Vectors as daily arrays."""
    values = F.col("embedding").cast("array<double>")
    day = F.transform(
        F.sequence(F.lit(0), F.size("embedding") - 1),
        lambda i: F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), i), "yyyy-MM-dd"),
    )
    daily = F.struct(
        day.alias("time"),
        F.transform(values, lambda v: F.floor(v * 100).cast("int")).alias("weather_code"),
        values.alias("precipitation_sum"),
        F.slice(values, 1, 10).alias("rain_sum"),
        *[
            F.array().cast("array<double>").alias(name)
            for name in WEATHER_METRICS
            if name not in ("weather_code", "precipitation_sum", "rain_sum")
        ],
    )
    return t.embeddings.select(
        F.col("vec_id").alias("location_id"),
        F.when(F.col("label") != 4, daily).alias("daily"),
        failure(F.col("label")).alias("error"),
    )


def printed_weather(rows: DataFrame) -> DataFrame:
    return rows.select(
        "location_id", "lat", "lon", "country_name", "record_date", F.col("weather_code").cast("double").alias("weather_code"),
        "precipitation_sum", "rain_sum", "snowfall_sum", "status", F.coalesce("error_message", F.lit("none")).alias("error_message"),
    )


@query(_WEATHER_SQL)
def q_bronze_weather(t: Tables) -> DataFrame:
    """Vectors as daily arrays; sites without a vector and failed calls become error rows."""
    return printed_weather(bronze.weather(sites(t), weather_payloads(t), "2024-01-01", F.lit("2024-02-01T00:00:00+00:00")))


@query(_WEATHER_SQL)
def q_landed_weather(t: Tables) -> DataFrame:
    """The same through the job, which lands the days twice: the second run replaces those of the first."""
    path, now = scratch_path(t.spark, "weather"), datetime(2024, 2, 1, tzinfo=UTC)
    for _ in range(2):
        landing.weather_run(sites(t), weather_payloads(t), "2024-01-01", path, now)
    return printed_weather(scan(t.spark, path, f"{WEATHER}, year string, month string"))


@query(f"""
    WITH {LOCATIONS_SQL}, known AS (
        SELECT sensor_id, sensor_name, id AS location_id, upper(country_name) AS country_name FROM location_sensors WHERE parameter_id = '2'
        QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY id DESC, pos DESC) = 1
    )
    SELECT *, (SELECT count(*) FROM locations) AS n_locations, (SELECT count(*) FROM known) AS n_sensors,
           (SELECT count(*) FROM customer WHERE c_nationkey = 7) + 2 AS n_errors
    FROM known QUALIFY row_number() OVER (ORDER BY sensor_id) BETWEEN 6 AND 250
""")
def q_landed_sensors(t: Tables) -> DataFrame:
    """Landed answers, one per location, to the sensors of one batch; misshapen answers and elements become error rows."""
    path, root = scratch_path(t.spark, "responses"), scratch_path(t.spark, "locations")
    fields = ("id", "name", "locality", "timezone", "country", "coordinates", "sensors")
    named = locations(t).withColumn("country", F.col("country").withField("name", F.upper("country.name")))
    answers = named.select(F.to_json(F.struct(F.array(F.struct(*fields)).alias("results"), F.lit("u").alias("url"))).alias("value"))
    # One nation answers once more with an object instead of a list, and two elements are no locations.
    objects = t.customer.where("c_nationkey = 7").select(F.lit('{"results": {"id": 1}}').alias("value"))
    wrong = t.spark.range(2).select(F.lit('{"results": [{"id": "none", "sensors": []}]}').alias("value"))
    answers.union(objects).union(wrong).write.text(path)
    batch, log = landing.locations(t.spark, path, root, datetime(2024, 2, 1, tzinfo=UTC), (5, 250))
    # A location without a readable id is landed too, as it came.
    return batch.select("sensor_id", "sensor_name", "location_id", "country_name").withColumns(
        {"n_locations": F.lit(log["locations"] - 2), "n_sensors": F.lit(log["sensors"]), "n_errors": F.lit(log["errors"])}
    ).withColumns({name: F.col(name).cast("bigint") for name in ("n_locations", "n_sensors", "n_errors")})


@query(f"""
    WITH {_SITES_SQL}
    SELECT location_id, coalesce(failure, 'none') AS error_message, failure IS NULL AS succeeded FROM answers
""")
def q_error_rows(t: Tables) -> DataFrame:
    """Sites paired with their response, or with the reason why there is none."""
    payloads = t.embeddings.select(F.col("vec_id").alias("location_id"), failure(F.col("label")).alias("error"))
    joined = bronze.answers(sites(t), payloads, F.lit("2024-02-01"))
    reason = F.col("__failure")
    return joined.select(
        "location_id", F.coalesce(reason, F.lit("none")).alias("error_message"), reason.isNull().alias("succeeded")
    )


@query(f"""
    WITH {_SITES_SQL}, elements AS (
        SELECT location_id, i AS pos, CASE i % 3 WHEN 0 THEN 'node' WHEN 1 THEN 'way' ELSE 'relation' END AS kind,
               CAST(floor(abs(x) * 40) AS BIGINT) AS id, x,
               CASE WHEN x > 0.05 THEN CASE WHEN i % 2 = 0 THEN 'Garage' ELSE 'house' END END AS building
        FROM (SELECT location_id, i, CAST(embedding[i + 1] AS DOUBLE) AS x
              FROM answers a, unnest(range(0, len(embedding))) AS r(i) WHERE failure IS NULL)
    ), features AS (
        SELECT location_id,
               count(DISTINCT CASE WHEN building IS NOT NULL AND kind <> 'node' THEN kind || ':' || id END) AS building_count_all,
               count(DISTINCT CASE WHEN building = 'house' AND kind <> 'node' THEN kind || ':' || id END) AS main_building_count,
               count(DISTINCT CASE WHEN x < -0.05 AND kind = 'way' THEN kind || ':' || id END) AS highway_count,
               min(CASE WHEN x BETWEEN -0.05 AND 0.05 THEN pos END) AS area_pos
        FROM elements GROUP BY location_id
    )
    SELECT '20260430101530' || printf('%03d', row_number() OVER (ORDER BY a.location_id)) AS sys_primary_key,
           a.location_id, CAST(building_count_all AS DOUBLE) AS building_count_all,
           CAST(main_building_count AS DOUBLE) AS main_building_count, CAST(highway_count AS DOUBLE) AS highway_count,
           CASE WHEN failure IS NOT NULL THEN 'none' WHEN area_pos IS NULL THEN 'unknown'
                ELSE 'landuse=zone ' || CAST(area_pos AS VARCHAR) END AS area_tag,
           CASE WHEN failure IS NOT NULL THEN 'none' WHEN area_pos IS NULL THEN 'fallback' ELSE 'landuse' END AS area_tag_source,
           CAST(300 AS INTEGER) AS radius_m, CASE WHEN failure IS NULL THEN 'success' ELSE 'error' END AS status,
           coalesce(failure, '') AS error_message
    FROM answers a LEFT JOIN features f ON f.location_id = a.location_id
""")
def q_bronze_features(t: Tables) -> DataFrame:
    """Vector entries as tagged elements of a site; every site gets a run id."""
    return _shown(bronze.site_features(sites(t), element_payloads(t), F.lit(_CALLED_AT), ["ordinal"]))


@query(SQL["q_bronze_features"])
def q_site_features_landed(t: Tables) -> DataFrame:
    """The same through the job: published, and read through the pointer."""
    root = scratch_path(t.spark, "site-features")
    landing.site_features(sites(t), element_payloads(t), root, _CALLED_AT, ["ordinal"])
    return _shown(versions.read_current(t.spark, root, SITE_FEATURES))


def element_payloads(t: Tables) -> DataFrame:
    """Vectors as responses: each entry is an element."""

    def element(x: Column, i: Column) -> Column:
        building = F.when(i % 2 == 0, "Garage").otherwise("house")
        zone = F.concat(F.lit("zone "), i.cast("string"))
        tags = (
            F.when(x > 0.05, F.create_map(F.lit("building"), building))
            .when(x < -0.05, F.create_map(F.lit("highway"), F.lit("yes")))
            .otherwise(F.create_map(F.lit("landuse"), zone))
        )
        return F.struct(
            F.when(i % 3 == 0, "node").when(i % 3 == 1, "way").otherwise("relation").alias("type"),
            F.floor(F.abs(x) * 40).alias("id"),
            tags.alias("tags"),
        )

    return t.embeddings.select(
        F.col("vec_id").alias("location_id"),
        F.transform(F.col("embedding").cast("array<double>"), element).alias("elements"),
        failure(F.col("label")).alias("error"),
    )


def _shown(rows: DataFrame) -> DataFrame:
    counts = [F.col(c).cast("double").alias(c) for c in ("building_count_all", "main_building_count", "highway_count")]
    return rows.select(
        F.col("sys_primary_key").cast("string").alias("sys_primary_key"),
        "location_id",
        *counts,
        F.coalesce("area_tag", F.lit("none")).alias("area_tag"),
        F.coalesce("area_tag_source", F.lit("none")).alias("area_tag_source"),
        "radius_m",
        "status",
        "error_message",
    )
