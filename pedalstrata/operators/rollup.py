"""Roll-up to a coarser grain with a chosen aggregate per column."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pedalstrata.functions.aggregates import (
    first_non_null,
    half_up_mean,
    lowest_order,
    mean_rounded,
    missing_cells,
    position,
    row_count,
    sum_or_zero,
)
from pedalstrata.functions.casting import column, free_name, is_missing, parse_date, quoted, safe_int
from pedalstrata.operators.cleaning import drop_null_keys, status_counts
from pedalstrata.operators.numbering import sequence_id, sequence_id_distributed
from pedalstrata.schemas import RAW_DAY_COLUMNS
from pedalstrata.sources.staging import stage

# A kind by name, or any function from the column to a built-in aggregate expression.
Kind = str | Callable[[Column], Column]


class Measure(NamedTuple):
    column: str
    kind: Kind


# How each hourly column becomes a daily one.
DAY_MEASURES = (
    Measure("season", "first"),
    Measure("yr", "first"),
    Measure("mnth", "first"),
    Measure("holiday", "first"),
    Measure("weekday", "first"),
    Measure("workingday", "first"),
    Measure("weathersit", "half_up_mean"),
    Measure("temp", "mean"),
    Measure("atemp", "mean"),
    Measure("hum", "mean"),
    Measure("windspeed", "mean"),
    Measure("casual", "sum"),
    Measure("registered", "sum"),
    Measure("cnt", "sum"),
)


def _expression(df: DataFrame, measure: Measure, strict: bool, order: Column) -> Column:
    c, dtype = column(measure.column), df.schema[measure.column].dataType
    if callable(measure.kind):
        return measure.kind(c)
    if measure.kind == "first":
        return first_non_null(c, dtype, order, unique=True)
    if measure.kind == "half_up_mean":
        return half_up_mean(c, dtype, strict)
    if measure.kind == "mean":
        return mean_rounded(c, dtype)
    if measure.kind == "sum":
        return sum_or_zero(c, dtype)
    raise ValueError(f"unknown aggregate: {measure.kind}")


def _aggregated(
    df: DataFrame, key: str, measures: Sequence[Measure], more: Sequence[Column], order_by: str, strict: bool, unique: bool
) -> DataFrame:
    """One row per key, null keys too.

    Where orders may repeat, first values take two steps. The first finds the lowest order with a
    value, per group and column, next to the other aggregates: numbers, in one hash aggregate.
    Only rows that have one of these orders, a few per group, are then compared as a whole. The
    groups are stored in between, so that Spark knows their size when it joins them.
    """
    firsts = [m.column for m in measures if m.kind == "first"]
    order = F.lit(None).cast("bigint")
    taken = [*df.columns, *[m.column for m in measures]]
    rows = df
    if firsts:
        # Parsed once per row rather than once per first value.
        place = free_name(taken, "place")
        rows, order = df.withColumn(place, position(safe_int(column(order_by), df.schema[order_by].dataType))), F.col(place)
    if unique or not firsts:
        exprs = [_expression(df, m, strict, order).alias(m.column) for m in measures]
        return rows.groupBy(column(key)).agg(*exprs, *more)
    lows = {c: free_name(taken, f"low{i}") for i, c in enumerate(firsts)}
    others = [_expression(df, m, strict, order).alias(m.column) for m in measures if m.kind != "first"]
    lowest = [lowest_order(column(c), df.schema[c].dataType, order).alias(low) for c, low in lows.items()]
    groups = stage(rows.groupBy(column(key)).agg(*lowest, *others, *more))
    found = tied_firsts(rows, groups, key, lows, place)
    left, right = groups.alias("g"), found.alias("f")
    joined = left.join(right, F.col(f"g.{quoted(key)}").eqNullSafe(F.col(f"f.{quoted(key)}")), "left")
    names = [key, *[m.column for m in measures], *[c for c in groups.columns if c not in (key, *taken, *lows.values())]]
    return joined.select(*[F.col(f"{'f' if n in lows else 'g'}.{quoted(n)}") for n in names])


def tied_firsts(df: DataFrame, groups: DataFrame, key: str, lows: Mapping[str, str], place: str) -> DataFrame:
    """Per key the value of each column of ``lows`` at its lowest ``place``, which ``groups`` has.

    Rows of one place are told apart by all columns but the key, then by the value. Which places may
    be lowest is asked first, of as few columns as that takes.
    """
    of_key = free_name(df.columns, "key")
    at = {c: free_name([*df.columns, of_key], name) for c, name in lows.items()}
    named = groups.select(column(key).alias(of_key), *[column(lows[c]).alias(n) for c, n in at.items()])
    hit = {c: (F.col(place) == F.col(n)) & ~is_missing(column(c), df.schema[c].dataType) for c, n in at.items()}
    some = reduce(or_, [F.col(place) == F.col(n) for n in at.values()])
    joined = df.join(named, column(key).eqNullSafe(F.col(of_key)) & some)
    whole = [column(c).alias(f"r{i}") for i, c in enumerate(x for x in df.columns if x not in (key, place))]
    best = [F.min(F.when(hit[c], F.struct(*whole, column(c).alias("value"))))["value"].alias(c) for c in lows]
    return joined.groupBy(column(key)).agg(*best)


def first_values(df: DataFrame, key: str, names: Sequence[str], order_by: str) -> DataFrame:
    """Per key, null too, the value of each column in the row of lowest order that has one."""
    return _aggregated(df, key, [Measure(n, "first") for n in names], [], order_by, False, False)


def rollup(
    df: DataFrame,
    key: str,
    measures: Sequence[Measure],
    order_by: str = "instant",
    strict: bool = False,
    unique: bool = False,
) -> DataFrame:
    """One row per non-null key; partial aggregates reduce each group before the shuffle.

    ``unique`` states that no two rows of a key have the same ``order_by``, which saves first values
    the second look at the rows. Otherwise ties in it are broken by all other columns.
    """
    return _aggregated(drop_null_keys(df, key), key, measures, [], order_by, strict, unique)


#: Days that one window numbers; more, which only text that is no date can make, are numbered in parallel.
WINDOW_DAYS = 100_000


def number_days(days: DataFrame, key: str = "dteday") -> DataFrame:
    """Days numbered by date and in the daily column order.

    A date key has at most one row per calendar day, so one window is safe. A text key may
    hold any number of values: it is ordered by its parsed date, and numbered in parallel if there
    are many. Days are stored first, since ranges are drawn from a look at all of them.
    """
    if isinstance(days.schema[key].dataType, T.DateType):
        return sequence_id(days, [key]).select(*RAW_DAY_COLUMNS)
    date, undated = free_name(days.columns, "date"), free_name(days.columns, "undated")
    dated = days.withColumn(date, parse_date(column(key), days.schema[key].dataType))
    # Text that is no date goes last, as letters sort after digits.
    dated = stage(dated.withColumn(undated, F.col(date).isNull()))
    order = [undated, date, key]
    few = dated.count() <= WINDOW_DAYS
    numbered = sequence_id(dated, order) if few else sequence_id_distributed(dated, order, unique=True)
    return numbered.select(*RAW_DAY_COLUMNS)


def rollup_day(hours: DataFrame, strict: bool = False, unique: bool = False) -> DataFrame:
    """The daily table rebuilt from the hourly one."""
    return number_days(rollup(hours, "dteday", DAY_MEASURES, strict=strict, unique=unique))


def rollup_day_profiled(hours: DataFrame, strict: bool = False, unique: bool = False) -> DataFrame:
    """Daily aggregates plus, per group, the rows and missing cells behind it and what cleaning
    would do to the rows.

    The null-date group stays, so the extra columns add up to the profile of the whole
    hourly table: validation and the accounting of cleaning then need no scan of their own.
    """
    profile = [row_count().alias("_rows"), missing_cells(hours).alias("_missing"), *status_counts(hours, "_")]
    return _aggregated(hours, "dteday", DAY_MEASURES, profile, "instant", strict, unique)
