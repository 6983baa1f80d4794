"""Declared tables: columns, keys and constraints.

Every read uses one of these schemas, so nothing is inferred from files.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverair.operators.quality import Rule, in_range, not_null, unique


@dataclass(frozen=True)
class Table:
    """A table of the warehouse: ``columns`` map names to (Spark type, SQL type)."""

    name: str
    columns: Mapping[str, tuple[str, str]]
    key: str
    required: tuple[str, ...] = ()
    distinct: tuple[str, ...] = ()
    ranges: Mapping[str, tuple[int, int]] = field(default_factory=dict)

    @property
    def ddl(self) -> str:
        return ", ".join(f"{name} {kind}" for name, (kind, _) in self.columns.items())

    @property
    def jdbc_types(self) -> str:
        """Bounded text types for the JDBC writer when it has to create the table."""
        bounded = {name: kind for name, (_, kind) in self.columns.items() if kind.startswith("VARCHAR")}
        return ", ".join(f"{name} {kind}" for name, kind in bounded.items())

    @property
    def rules(self) -> list[Rule]:
        """Constraints that parquet does not enforce, as quality rules."""
        rules = [not_null(c) for c in (self.key, *self.required)]
        rules += [unique(c) for c in (self.key, *self.distinct)]
        return rules + [in_range(c, low, high) for c, (low, high) in self.ranges.items()]

    def create_statement(self) -> str:
        """``CREATE TABLE`` text for the warehouse."""
        lines = []
        for name, (_, kind) in self.columns.items():
            suffix = " PRIMARY KEY" if name == self.key else ""
            suffix += " NOT NULL" if name in self.required else ""
            suffix += " UNIQUE" if name in self.distinct else ""
            lines.append(f"    {name} {kind}{suffix}")
        return f"CREATE TABLE IF NOT EXISTS {self.name} (\n" + ",\n".join(lines) + "\n)"

    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self.ddl)

    def conform(self, df: DataFrame) -> DataFrame:
        """Columns in declared order and type."""
        return df.select(*[F.col(c).cast(kind).alias(c) for c, (kind, _) in self.columns.items()])


_TEXT = ("string", "VARCHAR(255)")
_DOUBLE = ("double", "DOUBLE PRECISION")
_LONG = ("bigint", "BIGINT")
_INT = ("int", "INTEGER")
_TIME = ("timestamp", "TIMESTAMP")
_DAY = ("date", "DATE")
_DATE_ID = ("string", "VARCHAR(8)")

DIM_SENSOR_LOCATION = Table(
    name="dim_sensor_location",
    columns={
        "sys_unique_key": _TEXT,
        "location_id": ("string", "VARCHAR(100)"),
        "location_name": _TEXT,
        "timezone": ("string", "VARCHAR(100)"),
        "location_latitude": _DOUBLE,
        "location_longitude": _DOUBLE,
        "country_id": _LONG,
        "country_name": _TEXT,
        "country_code": ("string", "VARCHAR(20)"),
        "sensor_id": _LONG,
        "sys_load_ts": _TIME,
        "sys_source_from": _TEXT,
    },
    key="sys_unique_key",
)

FACT_SENSOR_MEASURE = Table(
    name="fact_sensor_measure",
    columns={
        "sys_unique_key": _TEXT,
        "sensor_id": _LONG,
        "sensor_name": _TEXT,
        "parameter_name": _TEXT,
        "parameter_units": ("string", "VARCHAR(100)"),
        "parameter_value": _DOUBLE,
        "load_date": _DAY,
        "date_id": _DATE_ID,
        "sys_load_ts": _TIME,
        "sys_source_from": _TEXT,
    },
    key="sys_unique_key",
)

FACT_WEATHER = Table(
    name="fact_weather",
    columns={
        "dw_unique_key": _TEXT,
        "sys_source_id": _TEXT,
        "date_id": _DATE_ID,
        "weather_code": _INT,
        "precipitation_sum": _DOUBLE,
        "precipitation_hours": _DOUBLE,
        "rain_sum": _DOUBLE,
        "snowfall_sum": _DOUBLE,
        "wind_speed_10m_max": _DOUBLE,
        "wind_direction_10m_dominant": _DOUBLE,
        "sys_load_ts": _TIME,
    },
    key="dw_unique_key",
    required=("sys_source_id", "date_id"),
)

DIM_DATE = Table(
    name="dim_date",
    columns={
        "sys_unique_key": _DATE_ID,
        "full_date": _DAY,
        "year": _INT,
        "quarter": _INT,
        "month": _INT,
        "month_name": ("string", "VARCHAR(20)"),
        "day_of_month": _INT,
        "day_of_week": _INT,
        "day_name": ("string", "VARCHAR(20)"),
        "week_of_year": _INT,
        "is_weekend": ("boolean", "BOOLEAN"),
    },
    key="sys_unique_key",
    required=(
        "full_date", "year", "quarter", "month", "month_name", "day_of_month",
        "day_of_week", "day_name", "week_of_year", "is_weekend",
    ),
    distinct=("full_date",),
    ranges={"quarter": (1, 4), "month": (1, 12), "day_of_week": (1, 7), "week_of_year": (1, 53)},
)

DIM_URBANITY_SCORE = Table(
    name="dim_urbanity_score",
    columns={
        "location_id": ("string", "VARCHAR(100)"),
        "urbanity_score": _INT,
        "building_score": _INT,
        "highway_score": _INT,
    },
    key="location_id",
    required=("urbanity_score", "building_score", "highway_score"),
    ranges={c: (1, 5) for c in ("urbanity_score", "building_score", "highway_score")},
)

WAREHOUSE = {
    t.name: t for t in (DIM_SENSOR_LOCATION, FACT_SENSOR_MEASURE, FACT_WEATHER, DIM_DATE, DIM_URBANITY_SCORE)
}

# Landed tables, as DDL text for ``spark.read.schema``.
LOCATIONS = """
    id bigint, name string, locality string, timezone string,
    country struct<id: bigint, name: string, code: string>,
    coordinates struct<latitude: double, longitude: double>,
    latitude double, longitude double,
    sensors array<struct<id: bigint, name: string,
        parameter: struct<id: string, name: string, units: string, displayName: string>>>,
    api_call_timestamp string, sys_source_from string
"""

MEASUREMENTS = """
    sensor_id bigint, sensor_name string, parameter_id int, parameter_name string, parameter_units string,
    parameter_display_name string, value string, historical_load boolean, daily_average_load boolean,
    load_date_from string, load_date_to string, api_call_timestamp string, sys_source_from string,
    period struct<datetimeTo: struct<utc: string>>
"""

MEASUREMENTS_HISTORICAL = "sensors_id string, parameter string, units string, value string, datetime string"

WEATHER_METRICS = {
    "weather_code": "int",
    "precipitation_sum": "double",
    "rain_sum": "double",
    "precipitation_hours": "double",
    "snowfall_sum": "double",
    "wind_speed_10m_max": "double",
    "wind_direction_10m_dominant": "double",
}

WEATHER = (
    "location_id bigint, api_call_timestamp string, country_name string, city_or_locality string, "
    "lat double, lon double, record_date string, "
    + ", ".join(f"{name} {kind}" for name, kind in WEATHER_METRICS.items())
    + ", status string, error_message string"
)

SITE_FEATURES = """
    sys_primary_key decimal(38,0), location_id bigint, api_call_timestamp string, country_name string,
    city_or_locality string, lat double, lon double, building_count_all bigint,
    main_building_count bigint, highway_count bigint, area_tag string, area_tag_source string,
    radius_m int, status string, error_message string
"""

WEATHER_PAYLOADS = (
    "location_id bigint, daily struct<time: array<string>, "
    + ", ".join(f"{name}: array<{kind}>" for name, kind in WEATHER_METRICS.items())
    + ">, error string"
)

ELEMENT_PAYLOADS = (
    "location_id bigint, elements array<struct<type: string, id: bigint, tags: map<string, string>>>, error string"
)

# End times of a reading, in the order in which they are tried.
END_TIME_PATHS = (
    "date.utc",
    "datetime.utc",
    "period.datetimeto.utc",
    "coverage.datetimeto.utc",
    "period.datetimeTo.utc",
    "coverage.datetimeTo.utc",
    "datetimeto.utc",
    "datetimeTo",
)

# A reading stays the JSON text that was landed: all fields are kept, and names that
# differ by case only are told apart in every session.
READING = "string"

MEASUREMENT_PAGES = f"request_id string, page int, sensor_id bigint, results array<{READING}>, url string, called_at string"

ENVELOPE = f"data {READING}, sys struct<load_date: string, source: string, sensor_id: bigint, granularity: string>"

# A location in a response.
LOCATION = (
    "struct<id: bigint, name: string, locality: string, timezone: string, "
    "country: struct<id: bigint, name: string, code: string>, coordinates: struct<latitude: double, longitude: double>, "
    "sensors: array<struct<id: bigint, name: string, "
    "parameter: struct<id: string, name: string, units: string, displayName: string>>>>"
)

# Sensors as the landing of locations finds them.
SENSORS = (
    "sensor_id bigint, sensor_name string, parameter_id int, parameter_name string, parameter_units string, "
    "parameter_display_name string, location_id bigint, location_name string, locality string, timezone string, "
    "country_id bigint, country_code string, country_name string, location_latitude double, location_longitude double"
)

# Aggregates of loaded batches, from which the measure fact is merged.
MEASURE_PARTS = f"{FACT_SENSOR_MEASURE.ddl}, value_sum double, value_count bigint, source_priority int, batch string"

SENSOR_STATE = "sensor_id bigint, last_timestamp timestamp, covered array<struct<start: timestamp, stop: timestamp>>"
