"""Data-dictionary expressions: units, codes and calendar seasons."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from pedalstrata.schemas import BASE_YEAR, SEASON_LABELS, TEMPERATURE_SCALE, WEATHER_LABELS


def label(code: Column, labels: Mapping[int, str]) -> Column:
    """The label of a code, null for an unknown code."""
    branches = None
    for value, text in labels.items():
        branches = F.when(code == value, text) if branches is None else branches.when(code == value, text)
    return branches


def season_label(code: Column) -> Column:
    return label(code, SEASON_LABELS)


def weather_label(code: Column) -> Column:
    return label(code, WEATHER_LABELS)


def calendar_year(flag: Column, base: int = BASE_YEAR) -> Column:
    return flag + F.lit(base).cast("bigint")


def celsius(normalised: Column, scale: float = TEMPERATURE_SCALE) -> Column:
    return normalised * F.lit(scale)


def month_day(date: Column) -> Column:
    """The date as ``100 * month + day``: comparable, and a fixed-width aggregate buffer."""
    return F.month(date) * 100 + F.dayofmonth(date)


def calendar_season(date: Column) -> Column:
    """Season code by fixed boundaries: 21 March, 21 June, 23 September, 21 December."""
    md = month_day(date)
    return (
        F.when(md.isNull(), None)
        .when(md.between(321, 620), 1)
        .when(md.between(621, 922), 2)
        .when(md.between(923, 1220), 3)
        .otherwise(4)
        .cast("bigint")
    )


def meteorological_season(month: Column) -> Column:
    """Season name by whole months, for reading a monthly curve."""
    return (
        F.when(month.between(3, 5), "spring")
        .when(month.between(6, 8), "summer")
        .when(month.between(9, 11), "autumn")
        .when(month.isin(12, 1, 2), "winter")
    )
