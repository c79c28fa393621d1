"""Dense 1..n numbers in a given order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pedalstrata.functions.casting import column, free_name
from pedalstrata.operators.projection import with_leading
from pedalstrata.sources.staging import stage

POSITION_BITS = 33  # monotonically_increasing_id: partition above, position in it below


def sequence_id(df: DataFrame, order_by: Sequence[str], name: str = "instant") -> DataFrame:
    """Numbers from one ordered window.

    The window gathers its input in one task: only for inputs of bounded size, such as one
    row per calendar day. Anything else goes through ``sequence_id_distributed``.
    """
    return with_leading(df, name, F.row_number().over(Window.orderBy(*[column(c) for c in order_by])).cast("bigint"))


def sequence_id_distributed(
    df: DataFrame, order_by: Sequence[str], name: str = "instant", unique: bool = False
) -> DataFrame:
    """The same numbers from a range-partitioned sort; no task sees more than its range.

    Range bounds come from a sample, so a second run may draw others. The sorted rows are
    therefore written once to shared storage with their (partition, position), and both the
    counts per partition and the final numbers read that copy. The counts are one row per
    partition, which bounds the broadcast.

    Unless the caller states that ``order_by`` is ``unique``, all remaining columns extend
    the order, so that equal keys spread over ranges. Whole-row copies would still meet in
    one range; a stored row id as last order column splits them too. It is written before the
    sort because an id computed on the fly could change when a task runs again.
    """
    row, at, part, n, before = (free_name([*df.columns, name], x) for x in ("row", "at", "part", "n", "before"))
    columns, order = [column(c) for c in df.columns], [column(c) for c in order_by]
    if not unique:
        order += [column(c) for c in df.columns if c not in order_by] + [F.col(row)]
        df = stage(df.withColumn(row, F.monotonically_increasing_id()))
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_rows = stage(ranged.select(*columns, F.monotonically_increasing_id().alias(at)))

    of_part = F.shiftright(at, POSITION_BITS)
    position = F.col(at).bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    counts = sorted_rows.groupBy(of_part.alias(part)).agg(F.count(F.lit(1)).alias(n))
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(part, F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(before))
    return (
        sorted_rows.withColumn(part, of_part)
        .join(F.broadcast(offsets), part)
        .select((F.col(before) + position + 1).alias(name), *columns)
    )
