"""Silver tables: the sensor, date and urbanity dimensions and the two facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverair.functions import scoring, times
from silverair.functions.text import as_column, equals_unquoted, natural_key, strip_quotes
from silverair.operators.dedupe import latest_per_key
from silverair.operators.increment import insert_new, priority_union
from silverair.operators.nested import explode_where
from silverair.operators.ranking import quantile_bucket
from silverair.schemas import WEATHER_METRICS
from silverair.sources.tables import day_spine

# The fine-dust parameter, its label in raw readings, and the
# source name given to their daily averages.
PM25_ID = 2
PM25_LABEL = "pm25"
HISTORICAL_SOURCE = "historical_openaq"


def is_pm25(sensor: Column) -> Column:
    """Sensors measure one parameter; its id may be a number or text."""
    return sensor["parameter"]["id"].try_cast("int") == PM25_ID


def sensor_location(locations: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row per location and fine-dust sensor that ``existing`` does not hold yet."""
    sensors = explode_where(locations, "sensors", is_pm25, "sensor")
    rows = sensors.select(
        natural_key("_", "id", "sensor.id").alias("sys_unique_key"),
        F.col("id").cast("string").alias("location_id"),
        F.col("name").alias("location_name"),
        F.col("timezone"),
        F.coalesce("latitude", "coordinates.latitude").try_cast("double").alias("location_latitude"),
        F.coalesce("longitude", "coordinates.longitude").try_cast("double").alias("location_longitude"),
        F.col("country.id").try_cast("bigint").alias("country_id"),
        F.col("country.name").alias("country_name"),
        F.col("country.code").alias("country_code"),
        F.col("sensor.id").try_cast("bigint").alias("sensor_id"),
        times.load_instant("api_call_timestamp").alias("sys_load_ts"),
        F.col("sys_source_from").cast("string").alias("sys_source_from"),
    )
    newest = latest_per_key(rows, ["sys_unique_key"], "sys_load_ts")
    return insert_new(newest, existing, "sys_unique_key")


def _measure_columns(key: Column, sensor: Column, name: Column, parameter: Column, units: Column,
                     value: Column, day: Column, loaded: Column, source: Column) -> list[Column]:
    return [
        key.alias("sys_unique_key"),
        sensor.try_cast("bigint").alias("sensor_id"),
        name.cast("string").alias("sensor_name"),
        parameter.cast("string").alias("parameter_name"),
        units.cast("string").alias("parameter_units"),
        value.try_cast("double").alias("parameter_value"),
        day.alias("load_date"),
        times.date_id(day).alias("date_id"),
        loaded.alias("sys_load_ts"),
        source.cast("string").alias("sys_source_from"),
    ]


def current_measures(measurements: DataFrame, date_basis: str = "request") -> DataFrame:
    """Daily rows of the API, typed.

    A row belongs to the first day of its request. ``date_basis="record"`` uses
    the end of its own period instead, which keeps the days of a longer request
    apart.
    """
    if date_basis not in ("request", "record"):
        raise ValueError(f"unknown date basis: {date_basis}")
    day = F.col("load_date_from")
    if date_basis == "record":
        # A daily period ends at the midnight after its day.
        last = times.iso_instant("period.datetimeTo.utc") - F.expr("interval 1 second")
        day = F.coalesce(F.to_date(last).cast("string"), day)
    kept = measurements.filter(F.col("sensor_id").isNotNull() & F.col("load_date_from").isNotNull())
    return kept.select(
        *_measure_columns(
            natural_key("-", "sensor_id", day),
            F.col("sensor_id"),
            F.col("sensor_name"),
            F.col("parameter_display_name"),
            F.col("parameter_units"),
            F.col("value"),
            day.try_cast("date"),
            times.load_instant("api_call_timestamp"),
            F.col("sys_source_from"),
        )
    )


def clean_readings(historical: DataFrame, zone: Column | str | None = None) -> DataFrame:
    """Raw fine-dust readings without quotes, with their day; unusable text is NULL."""
    present = historical.filter(
        equals_unquoted("parameter", PM25_LABEL) & F.col("sensors_id").isNotNull() & F.col("datetime").isNotNull()
    )
    zones = [] if zone is None else [as_column(zone).alias("zone")]
    plain = present.select(
        strip_quotes(F.col("sensors_id").cast("string")).alias("sensor"),
        strip_quotes("parameter").alias("parameter"),
        strip_quotes("units").alias("units"),
        strip_quotes("value").try_cast("double").alias("value"),
        times.reading_instant(strip_quotes("datetime")).alias("read_at"),
        *zones,
    )
    return plain.withColumn("day", times.local_day("read_at", "zone" if zones else None))


def historical_measures(historical: DataFrame, zone: Column | str | None = None) -> DataFrame:
    """Daily averages of raw readings per sensor, parameter, unit and day.

    A day is a UTC day, or a day of the site when ``zone`` gives its time zone.
    """
    # Unusable readings are dropped by the aggregates: they have no time or no
    # value. A filter would move below the projection and parse all text twice.
    usable_at = F.when(F.col("value").isNotNull(), F.col("read_at"))
    daily = (
        clean_readings(historical, zone)
        .groupBy("sensor", "parameter", "units", "day")
        .agg(F.avg("value").alias("value"), F.min(usable_at).alias("read_at"))
        .filter(F.col("read_at").isNotNull())
    )
    return daily.select(
        *_measure_columns(
            natural_key("-", "sensor", "day"),
            F.col("sensor"),
            natural_key(" ", "parameter", "units"),
            F.col("parameter"),
            F.col("units"),
            F.col("value"),
            F.col("day"),
            F.col("read_at"),
            F.lit(HISTORICAL_SOURCE),
        )
    )


def sensor_measure(
    measurements: DataFrame, historical: DataFrame, date_basis: str = "request", zone: Column | str | None = None
) -> DataFrame:
    """One value per sensor and day: the API row if there is one, else the daily average.

    The key is made of sensor and day, so it is unique without a second pass.
    """
    sources = [current_measures(measurements, date_basis), historical_measures(historical, zone)]
    return priority_union(sources, ["sensor_id", "load_date"], "sys_load_ts")


# What a part of the measure fact has in common with the parts that it is merged with.
_PART_KEYS = (
    "sys_unique_key", "sensor_id", "sensor_name", "parameter_name", "parameter_units", "load_date", "date_id", "sys_source_from",
)


def measure_parts(
    measurements: DataFrame, historical: DataFrame, date_basis: str = "request", zone: Column | str | None = None
) -> DataFrame:
    """What a batch adds to the measure fact, in a form that merges with other batches.

    API rows: the one that wins per sensor and day. Readings: sum, count and first
    time per sensor, parameter, unit and day.
    """
    none = {"value_sum": F.lit(None).cast("double"), "value_count": F.lit(None).cast("bigint")}
    api = priority_union([current_measures(measurements, date_basis)], ["sensor_id", "load_date"], "sys_load_ts")
    usable_at = F.when(F.col("value").isNotNull(), F.col("read_at"))
    sums = (
        clean_readings(historical, zone)
        .groupBy("sensor", "parameter", "units", "day")
        .agg(F.sum("value").alias("value_sum"), F.count("value").alias("value_count"), F.min(usable_at).alias("read_at"))
        .filter(F.col("read_at").isNotNull())
    )
    readings = sums.select(
        *_measure_columns(
            natural_key("-", "sensor", "day"),
            F.col("sensor"),
            natural_key(" ", "parameter", "units"),
            F.col("parameter"),
            F.col("units"),
            F.lit(None),
            F.col("day"),
            F.col("read_at"),
            F.lit(HISTORICAL_SOURCE),
        ),
        "value_sum",
        "value_count",
    )
    return api.withColumns({**none, "source_priority": F.lit(1)}).unionByName(readings.withColumn("source_priority", F.lit(2)))


def merged_measures(parts: DataFrame) -> DataFrame:
    """The measure fact of all batches that ``parts`` come from, equal to ``sensor_measure`` over all their rows."""
    api = parts.filter(F.col("source_priority") == 1).drop("value_sum", "value_count", "source_priority")
    readings = (
        parts.filter(F.col("source_priority") == 2)
        .groupBy(*_PART_KEYS)
        .agg(
            (F.sum("value_sum") / F.sum("value_count")).alias("parameter_value"),
            F.min("sys_load_ts").alias("sys_load_ts"),
        )
    )
    return priority_union([api, readings.select(*api.columns)], ["sensor_id", "load_date"], "sys_load_ts")


def latest_weather(weather: DataFrame) -> DataFrame:
    """Newest successful load per coordinate and day."""
    usable = weather.filter(
        (F.col("status") == "success")
        & F.col("lat").isNotNull()
        & F.col("lon").isNotNull()
        & F.col("record_date").isNotNull()
        & F.col("location_id").isNotNull()
    )
    day = F.col("record_date").try_cast("date")
    rows = usable.select(
        natural_key("-", "lat", "lon", "record_date").alias("dw_unique_key"),
        F.col("location_id").try_cast("int").cast("string").alias("sys_source_id"),
        times.date_id(day).alias("date_id"),
        *[F.col(name).try_cast(kind).alias(name) for name, kind in WEATHER_METRICS.items()],
        times.iso_instant("api_call_timestamp").alias("sys_load_ts"),
        F.col("lat").alias("__lat"),
        F.col("lon").alias("__lon"),
        day.alias("__day"),
    )
    return latest_per_key(rows, ["__lat", "__lon", "__day"], "sys_load_ts").drop("__lat", "__lon", "__day")


def weather(raw: DataFrame, existing: DataFrame | None = None, prune_by: str | None = None) -> DataFrame:
    """Weather rows whose key ``existing`` does not hold yet."""
    return insert_new(latest_weather(raw), existing, "dw_unique_key", prune_by)


def urbanity(features: DataFrame) -> DataFrame:
    """Building, highway and urbanity score of every site with complete counts.

    Scores depend on the row and on its rank alone, so the table is scanned once
    and nothing is joined back. ``sys_primary_key`` settles equal counts.
    """
    counted = features.filter(
        (F.col("status") == "success")
        & F.col("main_building_count").isNotNull()
        & F.col("highway_count").isNotNull()
    )
    radius = F.coalesce(F.col("radius_m"), F.lit(scoring.DEFAULT_RADIUS_M))
    scored = counted.select(
        "sys_primary_key",
        F.col("location_id").cast("string").alias("location_id"),
        "highway_count",
        scoring.band(scoring.density_per_hectare("main_building_count", radius)).alias("building_score"),
    )
    ranked = quantile_bucket(
        scored, scoring.SCORE_BUCKETS, ["highway_count", "sys_primary_key"], "highway_score"
    )
    result = ranked.select(
        "location_id",
        scoring.weighted_score("building_score", "highway_score").alias("urbanity_score"),
        "building_score",
        "highway_score",
    )
    return result.na.drop("any")


def date_dimension(bounds: DataFrame, start: Column, end: Column) -> DataFrame:
    """Calendar rows for every day of the range, weeks by ISO, Sunday as day 1."""
    day = F.col("full_date")
    parts = [F.year(day).cast("string")]
    parts += [F.lpad(part(day).cast("string"), 2, "0") for part in (F.month, F.dayofmonth)]
    return day_spine(bounds, start, end).select(
        F.concat(*parts).alias("sys_unique_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )
