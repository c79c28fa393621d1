"""Global sorts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalstrata.functions.casting import column, free_name
from pedalstrata.sources.staging import stage


def newest_first(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Descending, nulls last, over the whole frame.

    A range-partitioned sort keeps equal keys in one range, and a null or default date, or copies
    of one row, may hold a large share of the rows. A hash of a row id as last order column lets
    the ranges cut through such a group. The ids are stored first: one computed on the fly could
    change when a task runs again, and send its row elsewhere.
    """
    row = free_name(df.columns, "row")
    numbered = stage(df.withColumn(row, F.monotonically_increasing_id()))
    order = [column(c).desc_nulls_last() for c in order_by]
    return numbered.orderBy(*order, F.xxhash64(row)).select(*[column(c) for c in df.columns])
