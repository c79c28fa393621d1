"""Column names, types, rename specs and value domains of the two grains."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T


class Field(NamedTuple):
    raw: str
    silver: str
    type: str


# Raw name, silver name and silver type, in silver column order.
HOUR_FIELDS = (
    Field("instant", "ride_id", "bigint"),
    Field("dteday", "ride_date", "date"),
    Field("hr", "ride_hour", "bigint"),
    Field("season", "season", "bigint"),
    Field("yr", "year_flag", "bigint"),
    Field("mnth", "month", "bigint"),
    Field("holiday", "holiday", "bigint"),
    Field("weekday", "weekday", "bigint"),
    Field("workingday", "workingday", "bigint"),
    Field("weathersit", "weather_situation", "bigint"),
    Field("temp", "temperature", "double"),
    Field("atemp", "feels_like_temperature", "double"),
    Field("hum", "humidity", "double"),
    Field("windspeed", "windspeed", "double"),
    Field("casual", "casual_users", "bigint"),
    Field("registered", "registered_users", "bigint"),
    Field("cnt", "total_rides", "bigint"),
)
DAY_FIELDS = tuple(f for f in HOUR_FIELDS if f.raw != "hr")
FIELDS = {"hour": HOUR_FIELDS, "day": DAY_FIELDS}

# Column order of the raw hourly file.
RAW_HOUR_COLUMNS = (
    "instant", "dteday", "season", "yr", "mnth", "hr", "holiday", "weekday", "workingday",
    "weathersit", "temp", "atemp", "hum", "windspeed", "casual", "registered", "cnt",
)
RAW_DAY_COLUMNS = tuple(c for c in RAW_HOUR_COLUMNS if c != "hr")
RAW_COLUMNS = {"hour": RAW_HOUR_COLUMNS, "day": RAW_DAY_COLUMNS}

# The contract of the cleaning and validation steps.
REQUIRED_COLUMNS = ("dteday", "cnt")
MIN_ROWS = 100
MIN_COLUMNS = 5

# The tokens pandas reads as missing by default.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Labels and domains of the data dictionary.
SEASON_LABELS = {1: "spring", 2: "summer", 3: "fall", 4: "winter"}
WEATHER_LABELS = {1: "good", 2: "cloudy", 3: "rain", 4: "storm"}
BASE_YEAR = 2011
TEMPERATURE_SCALE = 41.0

# (rule, column, lowest, highest) on silver names.
DOMAIN_RULES = (
    ("season_1_4", "season", 1, 4),
    ("year_flag_0_1", "year_flag", 0, 1),
    ("month_1_12", "month", 1, 12),
    ("hour_0_23", "ride_hour", 0, 23),
    ("holiday_0_1", "holiday", 0, 1),
    ("weekday_0_6", "weekday", 0, 6),
    ("workingday_0_1", "workingday", 0, 1),
    ("weather_1_4", "weather_situation", 1, 4),
)

_SPARK_TYPES = {"bigint": T.LongType(), "double": T.DoubleType(), "date": T.DateType()}


def bronze_schema(grain: str) -> T.StructType:
    """Every column as text, so that nothing fails at the scan and safe casts decide."""
    return T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[grain]])


def raw_schema(grain: str) -> T.StructType:
    """The typed schema of a trusted raw file."""
    kinds = {f.raw: _SPARK_TYPES[f.type] for f in FIELDS[grain]}
    return T.StructType([T.StructField(c, kinds[c]) for c in RAW_COLUMNS[grain]])


def silver_columns(grain: str) -> list[str]:
    return [f.silver for f in FIELDS[grain]]
