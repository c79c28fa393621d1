"""Gold layer: rentals by month and year, rental metrics, weather metrics.

Every gold figure is a ratio or a fold of sums, counts and extremes. ``partials`` computes
those once per key; ``fold`` re-aggregates them to coarser keys. A single gold table
aggregates silver directly; all four together read silver once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalstrata.functions.aggregates import row_count
from pedalstrata.functions.casting import round_half_even
from pedalstrata.sources.staging import stage

MONTH = ("year_flag", "month")
YEAR = ("year_flag",)
WEATHER = ("weather_situation",)
FINEST = ("year_flag", "month", "weather_situation")

_VALUES = (
    "total_rides",
    "casual_users",
    "registered_users",
    "temperature",
    "feels_like_temperature",
    "humidity",
    "windspeed",
)


def partials(silver: DataFrame, keys: Sequence[str]) -> DataFrame:
    sums = [F.sum(c).alias(f"{c}_sum") for c in _VALUES]
    counts = [F.count(c).alias(f"{c}_n") for c in _VALUES]
    extremes = [F.min("total_rides").alias("rides_min"), F.max("total_rides").alias("rides_max")]
    return silver.groupBy(*keys).agg(row_count().alias("n_records"), *sums, *counts, *extremes)


def fold(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partials of finer keys as partials of coarser ones."""
    summed = ["n_records", *[f"{c}_sum" for c in _VALUES], *[f"{c}_n" for c in _VALUES]]
    return parts.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in summed],
        F.min("rides_min").alias("rides_min"),
        F.max("rides_max").alias("rides_max"),
    )


def _mean(column: str) -> Column:
    return round_half_even(F.try_divide(F.col(f"{column}_sum"), F.col(f"{column}_n")).cast("double"))


def _rentals(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return parts.select(
        *keys,
        "n_records",
        F.col("total_rides_sum").alias("total_rides"),
        _mean("total_rides").alias("avg_rides"),
        F.col("casual_users_sum").alias("casual_users"),
        F.col("registered_users_sum").alias("registered_users"),
    )


def _rental_metrics(parts: DataFrame) -> DataFrame:
    share = F.try_divide(F.col("casual_users_sum"), F.col("total_rides_sum"))
    return parts.select(
        *MONTH,
        F.col("total_rides_sum").alias("total_rides"),
        _mean("total_rides").alias("avg_rides"),
        F.col("rides_min").alias("min_rides"),
        F.col("rides_max").alias("max_rides"),
        round_half_even(share.cast("double")).alias("casual_share"),
    )


def _weather_metrics(parts: DataFrame) -> DataFrame:
    return parts.select(
        *WEATHER,
        "n_records",
        _mean("temperature").alias("avg_temperature"),
        _mean("feels_like_temperature").alias("avg_feels_like_temperature"),
        _mean("humidity").alias("avg_humidity"),
        _mean("windspeed").alias("avg_windspeed"),
        _mean("total_rides").alias("avg_rides"),
    )


def monthly(silver: DataFrame) -> DataFrame:
    return _rentals(partials(silver, MONTH), MONTH)


def yearly(silver: DataFrame) -> DataFrame:
    return _rentals(partials(silver, YEAR), YEAR)


def rental_metrics(silver: DataFrame) -> DataFrame:
    return _rental_metrics(partials(silver, MONTH))


def weather_metrics(silver: DataFrame) -> DataFrame:
    return _weather_metrics(partials(silver, WEATHER))


def gold_tables(silver: DataFrame) -> dict[str, DataFrame]:
    """All four gold tables from one scan: the shared partials are stored once."""
    parts = stage(partials(silver, FINEST))
    by_month = fold(parts, MONTH)
    return {
        "monthly": _rentals(by_month, MONTH),
        "yearly": _rentals(fold(parts, YEAR), YEAR),
        "rental_metrics": _rental_metrics(by_month),
        "weather_metrics": _weather_metrics(fold(parts, WEATHER)),
    }
