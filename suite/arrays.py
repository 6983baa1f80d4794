"""Nested locations, parallel arrays, tags and envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverair.functions.text import first_present
from silverair.operators.dedupe import distinct_sites
from silverair.operators.features import tag_features
from silverair.operators.nested import explode_where, stamp_source, unwrap_envelope, wrap_envelope, zip_explode
from silverair.operators.reach import reach
from silverair.plans import bronze
from silverair.plans.silver import is_pm25
from suite.base import LOCATIONS_SQL, Tables, instant_sql, instant_text, locations, query


@query(f"""
    WITH {LOCATIONS_SQL}
    SELECT id, country_id, country_name, sensor_id, sensor_name, parameter_id FROM location_sensors WHERE parameter_id = '2'
""")
def q_explode_nested(t: Tables) -> DataFrame:
    """Sensors of nested locations, tested before they become rows."""
    return explode_where(locations(t), "sensors", is_pm25, "sensor").select(
        "id",
        F.col("country.id").alias("country_id"),
        F.col("country.name").alias("country_name"),
        F.col("sensor.id").alias("sensor_id"),
        F.col("sensor.name").alias("sensor_name"),
        F.col("sensor.parameter.id").alias("parameter_id"),
    )


@query(f"""
    WITH {LOCATIONS_SQL}
    SELECT sensor_id, sensor_name, CAST(parameter_id AS INTEGER) AS parameter_id, 'PM 2' AS parameter_display_name,
           id AS location_id, locality, timezone, country_code, latitude, longitude
    FROM location_sensors WHERE parameter_id = '2'
    QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY id DESC, pos DESC) = 1
""")
def q_pm_sensors(t: Tables) -> DataFrame:
    """Neighbouring customers share sensor ids; the last one wins."""
    found = bronze.sensors(locations(t).withColumn("ordinal", F.col("id")), ["ordinal"])
    return found.select(
        "sensor_id",
        "sensor_name",
        "parameter_id",
        "parameter_display_name",
        "location_id",
        "locality",
        "timezone",
        "country_code",
        F.col("location_latitude").alias("latitude"),
        F.col("location_longitude").alias("longitude"),
    )


@query("""
    SELECT vec_id, CAST(i AS INTEGER) AS pos, CAST(embedding[i + 1] AS DOUBLE) AS value,
           CASE WHEN i < 10 THEN CAST(embedding[i + 1] AS DOUBLE) END AS short,
           CAST(embedding[i + 1] AS DOUBLE) AS long
    FROM embeddings, unnest(range(0, len(embedding))) AS s(i)
""")
def q_zip_explode(t: Tables) -> DataFrame:
    """Positions drive; a shorter array pads with NULL and a longer one is cut."""
    values = F.col("embedding").cast("array<double>")
    arrays = t.embeddings.select(
        "vec_id",
        F.sequence(F.lit(0), F.size("embedding") - 1).alias("positions"),
        values.alias("values"),
        F.slice(values, 1, 10).alias("first_ten"),
        F.concat(values, F.array(F.lit(1.0), F.lit(2.0))).alias("longer"),
    )
    others = {"value": "values", "short": "first_ten", "long": "longer"}
    return zip_explode(arrays, "positions", others, "pos", ["vec_id"])


@query("""
    SELECT event_id, CASE WHEN event_type = 'error' THEN NULL
                          ELSE event_type || ' ' || strftime(ts, '%Y-%m-%d') END AS ended
    FROM events
""")
def q_nested_first(t: Tables) -> DataFrame:
    """Records as JSON that carry their end under different paths, or not at all."""
    kind = F.col("event_type")
    text = F.concat(kind, F.lit(" "), F.date_format("ts", "yyyy-MM-dd"))

    def only(name: str) -> Column:
        return F.when(kind == name, text)

    record = F.struct(
        F.struct(only("click").alias("utc")).alias("date"),
        F.struct(F.coalesce(only("view"), F.lit("")).alias("utc")).alias("datetime"),
        F.struct(F.struct(only("purchase").alias("utc")).alias("datetimeTo")).alias("period"),
        only("signup").alias("datetimeTo"),
    )
    schema = (
        "date struct<utc: string>, datetime struct<utc: string>, "
        "period struct<datetimeTo: struct<utc: string>>, datetimeTo string"
    )
    parsed = t.events.select("event_id", F.from_json(F.to_json(record), schema).alias("r"))
    ended = first_present("r.date.utc", "r.datetime.utc", "r.period.datetimeTo.utc", "r.datetimeTo")
    return parsed.select("event_id", ended.alias("ended"))


_ELEMENTS_SQL = """
    elements AS (
        SELECT l_orderkey, CASE l_returnflag WHEN 'R' THEN 'node' WHEN 'A' THEN 'way' ELSE 'relation' END AS kind,
               l_partkey AS id, l_linenumber AS pos,
               CASE WHEN l_linestatus = 'O' THEN
                   CASE l_suppkey % 4 WHEN 0 THEN 'garage' WHEN 1 THEN 'House' WHEN 2 THEN 'SHED' ELSE 'apartments' END END AS building,
               l_discount > 0.05 AS highway, CASE WHEN l_tax > 0.04 THEN l_returnflag END AS landuse
        FROM lineitem
    )
"""


@query(f"""
    WITH {_ELEMENTS_SQL}, flagged AS (
        SELECT *, kind || ':' || CAST(id AS VARCHAR) AS ident,
               building IS NOT NULL AND kind IN ('way', 'relation') AS is_building,
               lower(building) NOT IN ('garage', 'shed') AS is_main,
               highway AND kind = 'way' AS is_highway,
               CASE WHEN landuse IS NOT NULL THEN printf('%03d', pos) || 'landuse=' || landuse END AS area
        FROM elements
    )
    SELECT l_orderkey,
           count(DISTINCT CASE WHEN is_building THEN ident END) AS building_count_all,
           count(DISTINCT CASE WHEN is_building AND is_main THEN ident END) AS main_building_count,
           count(DISTINCT CASE WHEN is_highway THEN ident END) AS highway_count,
           coalesce(substr(min(area), 4), 'unknown') AS area_tag,
           CASE WHEN min(area) IS NULL THEN 'fallback' ELSE 'landuse' END AS area_tag_source
    FROM flagged GROUP BY l_orderkey
""")
def q_tag_features(t: Tables) -> DataFrame:
    """Order = site, line = tagged element; a part may occur twice in an order."""
    flag = F.col("l_returnflag")
    kind = F.when(flag == "R", "node").when(flag == "A", "way").otherwise("relation")
    supplier = F.col("l_suppkey") % 4
    value = F.when(supplier == 0, "garage").when(supplier == 1, "House").when(supplier == 2, "SHED").otherwise("apartments")
    tags = F.map_from_entries(
        F.filter(
            F.array(
                F.when(F.col("l_linestatus") == "O", F.struct(F.lit("building").alias("k"), value.alias("v"))),
                F.when(F.col("l_discount") > 0.05, F.struct(F.lit("highway").alias("k"), F.lit("yes").alias("v"))),
                F.when(F.col("l_tax") > 0.04, F.struct(F.lit("landuse").alias("k"), flag.alias("v"))),
            ),
            lambda entry: entry.isNotNull(),
        )
    )
    # Line numbers repeat within an order, so the tag settles equal positions.
    elements = t.lineitem.select(
        "l_orderkey",
        kind.alias("type"),
        F.col("l_partkey").alias("id"),
        tags.alias("tags"),
        F.struct("l_linenumber", "l_returnflag").alias("pos"),
    )
    return tag_features(elements, "l_orderkey")


@query(f"""
    WITH {LOCATIONS_SQL}, firsts AS (
        SELECT id AS location_id, country_name, locality AS city_or_locality, longitude, latitude FROM locations
        WHERE latitude IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY country_name, locality, longitude, latitude ORDER BY id) = 1
    )
    SELECT * FROM firsts ORDER BY location_id LIMIT 200
""")
def q_dedupe_first(t: Tables) -> DataFrame:
    """First customer per country, segment and coordinate; the run is capped at 200 sites."""
    return bronze.sites(locations(t).withColumn("ordinal", F.col("id")), ["ordinal"], limit=200).drop("ordinal")


@query(f"""
    WITH {LOCATIONS_SQL}
    SELECT id AS location_id, country_name, locality AS city_or_locality, longitude, latitude FROM locations
    WHERE latitude IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY country_name, locality, longitude, latitude ORDER BY id) = 1
""")
def q_dedupe_first_all(t: Tables) -> DataFrame:
    """The same without a cap."""
    flat = bronze.sites(locations(t).withColumn("ordinal", F.col("id")), ["ordinal"])
    return distinct_sites(flat, ["ordinal"], ["latitude"]).drop("ordinal")


@query(f"""
    SELECT event_id, value, {instant_sql("ts")} AS loaded, user_id AS sensor_id, 'measurement' AS granularity,
           'fixture' AS source, '2024-02-01T00:00:00+00:00' AS load_date,
           'https://api.example/sensors/' || CAST(user_id AS VARCHAR) AS sys_source_from,
           strftime(ts, '%Y-%m-%d') AS api_call_timestamp
    FROM events
""")
def q_provenance(t: Tables) -> DataFrame:
    """Stamped rows wrapped into envelopes and read back flat."""
    rows = t.events.select("event_id", "value", instant_text("ts").alias("loaded"), F.col("user_id").alias("sensor_id"), "ts")
    url = F.concat(F.lit("https://api.example/sensors/"), F.col("sensor_id").cast("string"))
    stamped = stamp_source(rows, url, F.date_format("ts", "yyyy-MM-dd")).drop("ts")
    wrapped = wrap_envelope(stamped, F.lit("2024-02-01T00:00:00+00:00"), "fixture", "sensor_id", "measurement")
    return unwrap_envelope(wrapped)


@query("""
    WITH sites AS (
        SELECT c_custkey AS site_id, 45 + c_acctbal / 10000 AS lat, 7 + (c_custkey * 37 % 1009) / 1009.0 AS lon FROM customer
    ), elements AS (
        SELECT s_suppkey AS element_id, 45 + s_acctbal / 10000 AS lat, 7 + (s_suppkey * 61 % 1013) / 1013.0 AS lon FROM supplier
    ), pairs AS (
        SELECT site_id, element_id,
               2 * 6371008.8 * asin(least(1.0, sqrt(pow(sin(radians(e.lat - s.lat) / 2), 2)
                   + cos(radians(s.lat)) * cos(radians(e.lat)) * pow(sin(radians(e.lon - s.lon) / 2), 2)))) AS d
        FROM sites s, elements e
    )
    SELECT site_id, count(*) AS elements, round(min(d), 3) AS nearest_m, min(element_id) AS first_element
    FROM pairs WHERE d <= 5000 GROUP BY site_id
""")
def q_radius_join(t: Tables) -> DataFrame:
    """Suppliers within 5 km of customers, at made-up coordinates."""

    def place(df: DataFrame, key: str, balance: str, factor: int, prime: int, name: str) -> DataFrame:
        lon = F.lit(7) + (F.col(key) * factor % prime) / F.lit(float(prime))
        return df.select(F.col(key).alias(name), (F.lit(45) + F.col(balance) / 10000).alias("lat"), lon.alias("lon"))

    sites = place(t.customer, "c_custkey", "c_acctbal", 37, 1009, "site_id")
    elements = place(t.supplier, "s_suppkey", "s_acctbal", 61, 1013, "element_id")
    counted = elements.withColumn("elements", F.lit(1).cast("bigint"))
    found = reach(sites, counted, 5000, ["elements"], "site_id", least="element_id", nearest=[])
    return found.select(
        "site_id", "elements", F.round("nearest.distance_m", 3).alias("nearest_m"), F.col("element_id").alias("first_element")
    )


def _distance_sql(a: str, b: str) -> str:
    return f"""2 * 6371008.8 * asin(least(1.0, sqrt(pow(sin(radians({b}.lat - {a}.lat) / 2), 2)
        + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lon - {a}.lon) / 2), 2))))"""


@query(f"""
    WITH sites AS (
        SELECT c_custkey AS location_id, 45 + c_acctbal / 10000 AS lat, 7 + (c_custkey * 37 % 1009) / 1009.0 AS lon FROM customer
    ), elements AS (
        SELECT CASE p_partkey // 2 % 3 WHEN 0 THEN 'way' WHEN 1 THEN 'relation' ELSE 'node' END AS type,
               CASE WHEN p_partkey % 10 < 2 THEN p_partkey // 2 * 2 ELSE p_partkey END AS id,
               CASE WHEN p_size % 3 <> 0 THEN CASE WHEN p_size % 5 = 0 THEN 'Garage' ELSE p_type END END AS building,
               CASE WHEN p_size % 4 = 0 THEN p_brand END AS highway, CASE WHEN p_partkey % 17 = 0 THEN p_brand END AS landuse,
               45 + (p_partkey * 613 % 100003) / 100003.0 AS lat, 7 + (p_partkey * 61 % 1013) / 1013.0 AS lon
        FROM part
    ), pairs AS (
        SELECT * FROM (SELECT s.location_id, e.* EXCLUDE (lat, lon), {_distance_sql("s", "e")} AS d FROM sites s, elements e)
        WHERE d <= 5000
    ), counts AS (
        SELECT location_id,
               count(DISTINCT type || id) FILTER (building IS NOT NULL AND type <> 'node') AS building_count_all,
               count(DISTINCT type || id) FILTER (building <> 'Garage' AND type <> 'node') AS main_building_count,
               count(DISTINCT id) FILTER (highway IS NOT NULL AND type = 'way') AS highway_count,
               min_by('landuse=' || landuse, (d, type, id)) FILTER (landuse IS NOT NULL) AS area
        FROM pairs GROUP BY location_id
    )
    SELECT location_id, coalesce(building_count_all, 0) AS building_count_all,
           coalesce(main_building_count, 0) AS main_building_count, coalesce(highway_count, 0) AS highway_count,
           coalesce(area, 'unknown') AS area_tag, CASE WHEN area IS NULL THEN 'fallback' ELSE 'landuse' END AS area_tag_source
    FROM sites LEFT JOIN counts USING (location_id)
""")
def q_features_around(t: Tables) -> DataFrame:
    """Buildings, highways and the nearest area within 5 km of customers: parts as elements, some with two positions."""
    key = F.col("p_partkey")
    sites = t.customer.select(
        F.col("c_custkey").alias("location_id"),
        (F.lit(45) + F.col("c_acctbal") / 10000).alias("lat"),
        (F.lit(7) + F.col("c_custkey") * 37 % 1009 / F.lit(1009.0)).alias("lon"),
    )
    size = F.col("p_size")
    tags = F.create_map(
        F.lit("building"),
        F.when(size % 3 != 0, F.when(size % 5 == 0, "Garage").otherwise(F.col("p_type"))),
        F.lit("highway"),
        F.when(size % 4 == 0, F.col("p_brand")),
        F.lit("landuse"),
        F.when(key % 17 == 0, F.col("p_brand")),
    )
    kind = F.floor(key / 2) % 3
    elements = t.part.select(
        F.when(kind == 0, "way").when(kind == 1, "relation").otherwise("node").alias("type"),
        F.when(key % 10 < 2, (F.floor(key / 2) * 2).cast("bigint")).otherwise(key).alias("id"),
        F.map_filter(tags, lambda _, value: value.isNotNull()).alias("tags"),
        (F.lit(45) + key * 613 % 100003 / F.lit(100003.0)).alias("lat"),
        (F.lit(7) + key * 61 % 1013 / F.lit(1013.0)).alias("lon"),
    )
    return bronze.features_around(sites, elements, 5000).drop("lat", "lon")
