"""Landed responses to flat tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverair.functions import times
from silverair.functions.elements import NO_AREA, element_features
from silverair.functions.scoring import DEFAULT_RADIUS_M
from silverair.functions.text import first_present
from silverair.operators import state as st
from silverair.operators.dedupe import distinct_sites, last_per_key, latest_per_key, remaining_order, top_per_key
from silverair.operators.features import FEATURE_COUNTS, features_near
from silverair.operators.lookup import lookup_join
from silverair.operators.nested import explode_where, wrap_envelope, zip_rows
from silverair.operators.paging import concat_pages
from silverair.operators.ranking import run_ids
from silverair.plans.silver import is_pm25
from silverair.schemas import END_TIME_PATHS, WEATHER_METRICS

# Fixed value: the source name in landed envelopes.
ENVELOPE_SOURCE = "openaq_lambda"
ORDINAL = ("file_ordinal", "row_ordinal")


def sensors(locations: DataFrame, ordinal: Sequence[str] = ORDINAL) -> DataFrame:
    """Fine-dust sensors with the columns of their location; the last entry of a sensor wins."""
    rows = explode_where(locations, "sensors", lambda s: is_pm25(s) & s["id"].isNotNull(), "sensor").select(
        F.col("sensor.id").alias("sensor_id"),
        F.col("sensor.name").alias("sensor_name"),
        F.col("sensor.parameter.id").try_cast("int").alias("parameter_id"),
        F.col("sensor.parameter.name").alias("parameter_name"),
        F.col("sensor.parameter.units").alias("parameter_units"),
        F.col("sensor.parameter.displayName").alias("parameter_display_name"),
        F.col("id").alias("location_id"),
        F.col("name").alias("location_name"),
        "locality",
        "timezone",
        F.col("country.id").alias("country_id"),
        F.col("country.code").alias("country_code"),
        F.col("country.name").alias("country_name"),
        F.col("coordinates.latitude").alias("location_latitude"),
        F.col("coordinates.longitude").alias("location_longitude"),
        *ordinal,
        "sensor_pos",
    )
    return last_per_key(rows, ["sensor_id"], [*ordinal, "sensor_pos"]).drop(*ordinal, "sensor_pos")


def measurements(
    pages: DataFrame, sensors: DataFrame, window: tuple[str, str, str], max_records: int | None = None
) -> DataFrame:
    """Daily values of the landed pages with the columns of their sensor and request.

    ``window`` is ``(load type, first day, last day)``. Results are JSON text, or
    structs that hold ``value`` and ``period``; ``record`` keeps all of a result.
    """
    load_type, date_from, date_to = window
    rows = concat_pages(pages, "request_id", "page", "results", "record", max_records)
    if isinstance(rows.schema["record"].dataType, T.StringType):
        record = F.col("record")
        value = F.get_json_object("record", "$.value").try_cast("double")
        period = F.from_json(F.get_json_object("record", "$.period"), "datetimeTo struct<utc: string>")
    else:
        record, value, period = F.to_json("record"), F.col("record.value"), F.col("record.period")
    described = sensors.select(
        "sensor_id", "sensor_name", "parameter_id", "parameter_name", "parameter_units", "parameter_display_name"
    )
    described_rows = lookup_join(rows, described, ["sensor_id"], ["page", "record_pos"])
    return described_rows.select(
        *described.columns,
        value.alias("value"),
        F.lit(load_type == "historical").alias("historical_load"),
        F.lit(True).alias("daily_average_load"),
        F.lit(date_from).alias("load_date_from"),
        F.lit(date_to).alias("load_date_to"),
        F.col("called_at").alias("api_call_timestamp"),
        F.col("url").alias("sys_source_from"),
        period.alias("period"),
        record.alias("record"),
    )


def sites(
    locations: DataFrame,
    ordinal: Sequence[str] = ORDINAL,
    limit: int | None = None,
    required: Sequence[str] = ("location_id", "latitude", "longitude"),
) -> DataFrame:
    """Distinct sites to ask weather or map features for, all of them unless ``limit`` caps them."""
    flat = locations.select(
        F.col("id").alias("location_id"),
        F.col("country.name").alias("country_name"),
        F.col("locality").alias("city_or_locality"),
        F.col("coordinates.longitude").try_cast("double").alias("longitude"),
        F.col("coordinates.latitude").try_cast("double").alias("latitude"),
        *ordinal,
    )
    return distinct_sites(flat, ordinal, required, limit=limit)


def answers(sites: DataFrame, payloads: DataFrame, called_at: Column) -> DataFrame:
    """Sites with their response; ``__failure`` says why there is none.

    Of several responses for a site (a retry) the newest counts: that with the
    greatest ``landed_at``, where the landing has it, and one without error first.
    """
    landed = payloads if "landed_at" in payloads.columns else payloads.withColumn("landed_at", F.lit(0))
    tie = [F.col("error").asc_nulls_first(), *remaining_order(landed, ["location_id", "landed_at", "error"])]
    newest = latest_per_key(landed, ["location_id"], "landed_at", tie).drop("landed_at")
    joined = sites.join(newest.withColumn("__answered", F.lit(True)), "location_id", "left")
    failure = F.when(F.col("__answered").isNull(), F.lit("no response")).otherwise(F.col("error"))
    return joined.withColumns({"api_call_timestamp": called_at, "__failure": failure})


def weather(sites: DataFrame, payloads: DataFrame, start_date: str, called_at: Column) -> DataFrame:
    """One row per site and day; a failed site gives one error row on ``start_date``."""
    metrics = {name: F.col(f"daily.{name}") for name in WEATHER_METRICS}
    blank = F.array(
        F.struct(
            F.lit(start_date).alias("record_date"),
            *[F.lit(None).cast(kind).alias(name) for name, kind in WEATHER_METRICS.items()],
        )
    )
    days = F.when(F.col("__failure").isNotNull(), blank).otherwise(
        zip_rows(F.col("daily.time"), metrics, "record_date")
    )
    failed = F.col("error_message").isNotNull()
    return (
        answers(sites, payloads, called_at)
        .select(
            "location_id",
            "api_call_timestamp",
            "country_name",
            "city_or_locality",
            F.col("latitude").alias("lat"),
            F.col("longitude").alias("lon"),
            F.col("__failure").alias("error_message"),
            F.inline(days),
        )
        .select(
            "location_id",
            "api_call_timestamp",
            "country_name",
            "city_or_locality",
            "lat",
            "lon",
            "record_date",
            *WEATHER_METRICS,
            F.when(failed, F.lit("error")).otherwise(F.lit("success")).alias("status"),
            "error_message",
        )
    )


def site_features(
    sites: DataFrame,
    payloads: DataFrame,
    called_at: Column,
    ordinal: Sequence[str] = ORDINAL,
    radius_m: int = DEFAULT_RADIUS_M,
) -> DataFrame:
    """Element counts and area tag per site; failed sites keep their row without counts."""
    numbered = run_ids(sites, ordinal, times.run_number(called_at), "sys_primary_key")
    failed = F.col("__failure").isNotNull()
    text = F.date_format(called_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    answered = answers(numbered, payloads, text).withColumn(
        "__found", F.when(~failed, element_features("elements"))
    )
    return answered.select(
        "sys_primary_key",
        "location_id",
        "api_call_timestamp",
        "country_name",
        "city_or_locality",
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"),
        "__found.*",
        F.lit(radius_m).alias("radius_m"),
        F.when(failed, F.lit("error")).otherwise(F.lit("success")).alias("status"),
        F.coalesce("__failure", F.lit("")).alias("error_message"),
    )


def features_around(
    sites: DataFrame, elements: DataFrame, radius_m: float = DEFAULT_RADIUS_M, site: str = "location_id"
) -> DataFrame:
    """Features per site from a table of map elements instead of one response per site.

    ``sites`` and ``elements`` carry ``lat`` and ``lon``; sites without elements
    count none.
    """
    found = sites.join(features_near(sites, elements, radius_m, site), site, "left").na.fill(0, list(FEATURE_COUNTS))
    area = F.col("area")
    return found.select(
        *[c for c in found.columns if c != "area"],
        F.coalesce(area, F.lit(NO_AREA[0])).alias("area_tag"),
        F.when(area.isNotNull(), F.lit("landuse")).otherwise(F.lit(NO_AREA[1])).alias("area_tag_source"),
    )


def end_time(record: str) -> Column:
    """End of a reading (a column of JSON text): the first of its known end fields that is not empty."""
    return times.iso_instant(first_present(*[F.get_json_object(record, f"$.{path}") for path in END_TIME_PATHS]))


def incremental_measurements(
    sensors: DataFrame,
    readings: DataFrame,
    state: DataFrame,
    now: Column,
    at: str,
    lookback_days: int = 3,
    max_per_sensor: int | None = None,
    behind_since: Column | None = None,
) -> DataFrame:
    """Readings behind the watermark of their sensor; ``at`` is their end time.

    With ``behind_since``, no later than the oldest watermark, sensors that stopped
    before the lookback go on where they stopped. They are read in a pass of
    their own, so that they do not widen the scan for all others. Without it
    their windows begin at the lookback.
    """
    earliest = now - F.make_dt_interval(F.lit(lookback_days))
    requests = st.next_windows(sensors.select("sensor_id"), state, "sensor_id", now, lookback_days, behind_since is not None)
    rows = requested_readings(readings, requests, earliest, now, at, behind_since)
    return _capped(rows, ["sensor_id"], at, max_per_sensor)


def requested_readings(
    readings: DataFrame, requests: DataFrame, earliest: Column, now: Column, at: str, behind_since: Column | None = None
) -> DataFrame:
    """Readings inside the windows of their sensor.

    Bounds of all windows reach the scan; those of single sensors apply to what is
    left. Windows that begin before ``earliest`` have a pass of their own, from
    ``behind_since`` on.
    """
    passes = [(earliest, requests.where(F.col("date_from") >= earliest))]
    if behind_since is not None:
        passes.append((behind_since, requests.where(F.col("date_from") < earliest)))
    found = [
        st.within_window(readings.where(F.col(at).between(low, now)), asked, ["sensor_id"], at) for low, asked in passes
    ]
    return reduce(DataFrame.unionByName, found).drop("date_from", "date_to")


def capped(rows: DataFrame, at: str, n: int | None) -> DataFrame:
    """The first ``n`` readings of every sensor."""
    return _capped(rows, ["sensor_id"], at, n)


def backfill_measurements(
    sensors: DataFrame, readings: DataFrame, start: Column, end: Column, at: str, max_per_window: int | None = None
) -> DataFrame:
    """Readings between ``start`` and ``end``, asked for by month and sensor.

    All sensors are asked for the same months, so a reading tells the window of its
    request, and only sensors are joined, not the requests of all their months.
    """
    date_from, date_to = times.month_window("month", start, end)
    rows = readings.where(F.col(at).between(start, end)).withColumn("month", times.month_start(at))
    rows = rows.where(F.col(at).between(date_from, date_to)).join(sensors.select("sensor_id"), "sensor_id", "left_semi")
    return _capped(rows, ["sensor_id", "month"], at, max_per_window).drop("month")


def _capped(rows: DataFrame, keys: Sequence[str], at: str, n: int | None) -> DataFrame:
    if n is None:
        return rows
    return top_per_key(rows, keys, [F.col(at).asc(), *remaining_order(rows, [*keys, at])], n)


def landed(readings: DataFrame, loaded_at: Column, granularity: str) -> DataFrame:
    """Readings as landed envelopes."""
    return wrap_envelope(readings, loaded_at, ENVELOPE_SOURCE, "sensor_id", granularity)


def ended_readings(rows: DataFrame, at: str = "at") -> DataFrame:
    """Daily values with the end time of their record as ``at``; records without one are not readings."""
    timed = rows.withColumn(at, end_time("record"))
    return timed.select("sensor_id", "value", "record", at).where(F.col(at).isNotNull())
