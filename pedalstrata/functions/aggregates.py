"""Aggregate expressions with the null, NaN and rounding rules of the daily roll-up.

Spark plans a partial and a final aggregate for each, so a group that holds a third of the rows
is reduced before the shuffle. All but ``first_non_null`` of an order that may repeat have
fixed-width buffers, which keeps the aggregates hash-based.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pedalstrata.errors import DatasetError
from pedalstrata.functions.casting import column, is_missing, null_if_missing, round_half_even

_LAST = 2**63 - 1


def position(order: Column) -> Column:
    """The order as a number; rows without one come last."""
    return F.coalesce(order, F.lit(_LAST))


def lowest_order(c: Column, dtype: T.DataType, order: Column) -> Column:
    """The lowest ``position`` among rows where the value is not missing; a number, so hash-aggregated."""
    return F.min(F.when(~is_missing(c, dtype), order))


def first_non_null(
    c: Column, dtype: T.DataType, order: Column, rest: Sequence[Column] = (), unique: bool = False
) -> Column:
    """The value of the lowest ``order`` among rows where it is not missing.

    Unlike ``first``, the answer does not depend on how rows arrive after a shuffle: equal
    orders are told apart by the columns ``rest``, then by the value, smallest first and null
    before any value. Rows without an order come last. Comparing whole rows takes a sort-based
    aggregate, for which ``rollup.first_values`` leaves only the rows that can be first; where the
    caller knows that a numeric ``order`` is ``unique`` in each group, the hash aggregate stays.
    """
    at = position(order)
    if unique:
        return F.min_by(c, F.when(~is_missing(c, dtype), at))
    row = F.struct(at.alias("order"), *[r.alias(f"r{i}") for i, r in enumerate(rest)], c.alias("value"))
    return F.min(F.when(~is_missing(c, dtype), row))["value"]


def mean_rounded(c: Column, dtype: T.DataType, digits: int = 6) -> Column:
    return round_half_even(F.avg(null_if_missing(c, dtype)), digits)


def half_up_mean(c: Column, dtype: T.DataType, strict: bool = False) -> Column:
    """``trunc(mean + 0.5)`` as an integer; null for a group without values, or an error if strict."""
    value = (F.avg(null_if_missing(c, dtype)) + F.lit(0.5)).try_cast("bigint")
    if strict:
        return F.coalesce(value, F.raise_error(F.lit("half-up mean of a group without values")).cast("bigint"))
    return value


def sum_or_zero(c: Column, dtype: T.DataType) -> Column:
    total = F.sum(null_if_missing(c, dtype))
    return F.coalesce(total, F.lit(0).cast("double" if isinstance(dtype, (T.DoubleType, T.FloatType)) else "bigint"))


def row_count() -> Column:
    return F.count(F.lit(1))


def missing_in_row(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Number of missing cells in a row, over all (or the given) columns."""
    if unknown := set(columns or ()) - set(df.columns):
        raise DatasetError(f"no such columns: {sorted(unknown)}; available: {df.columns}")
    flags = [
        is_missing(column(f.name), f.dataType).cast("bigint")
        for f in df.schema
        if columns is None or f.name in columns
    ]
    return reduce(add, flags, F.lit(0).cast("bigint"))


def missing_cells(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    return F.coalesce(F.sum(missing_in_row(df, columns)), F.lit(0).cast("bigint"))
