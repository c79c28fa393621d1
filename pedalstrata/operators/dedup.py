"""One row per key: the latest, with a total tie-break."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pedalstrata.functions.casting import column, free_name, quoted
from pedalstrata.operators.numbering import POSITION_BITS
from pedalstrata.sources.staging import stage

NULL_KEYS = ("collapse", "keep", "drop")


def rank_latest(df: DataFrame, key: str, order_by: Sequence[str], name: str = "rn") -> DataFrame:
    """All rows with their rank within the key, newest first, nulls last.

    For a filter on the rank; to keep all ranks use ``rank_all``. Filtered to one rank, Spark keeps only each task's first row per key before the shuffle
    (``WindowGroupLimit``), so a hot key moves one row per task.
    """
    order = [column(c).desc_nulls_last() for c in _total_order(df, key, order_by)]
    window = Window.partitionBy(column(key)).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window))


def rank_all(df: DataFrame, key: str, order_by: Sequence[str], name: str = "rn") -> DataFrame:
    """The ranks of ``rank_latest`` for keeping all of them, with no task for a whole key.

    Rows are range-sorted by key and order, with a stored row id as last order column, so a hot
    key spans several ranges, and stored with their place. A rank is the place among the key's
    rows of the own range plus the key's rows in earlier ranges. Only the first key of a range
    has any there, so that takes at most one number per range.
    """
    row, at, part, n, same_key, before, local = (
        free_name([*df.columns, name], x) for x in ("row", "at", "part", "n", "key", "before", "local")
    )
    columns, of_key = [column(c) for c in df.columns], column(key)
    order = [of_key.asc_nulls_first(), *[column(c).desc_nulls_last() for c in _total_order(df, key, order_by)], F.col(row)]
    rows = stage(df.withColumn(row, F.monotonically_increasing_id()))
    # Fine ranges, so that however they are dealt out below, tasks get about as many rows.
    ranges = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    placed = stage(ordered.select(*columns, F.monotonically_increasing_id().alias(at)))
    placed = placed.withColumn(part, F.shiftright(at, POSITION_BITS))
    earlier = Window.partitionBy(same_key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    runs = placed.groupBy(part, of_key.alias(same_key)).agg(F.count(F.lit(1)).alias(n))
    carried = runs.select(part, same_key, F.sum(n).over(earlier).alias(before)).where(F.col(before) > 0)
    in_range = F.row_number().over(Window.partitionBy(F.col(part), of_key).orderBy(at))
    # Whole ranges, next to each other: a hash of them could bring many large ones together.
    apart = placed.repartitionByRange(part)
    ranked, first = apart.withColumn(local, in_range).alias("r"), F.broadcast(carried).alias("b")
    same = (F.col(f"r.{part}") == F.col(f"b.{part}")) & F.col(f"r.{quoted(key)}").eqNullSafe(F.col(f"b.{same_key}"))
    rank = F.col(local) + F.coalesce(before, F.lit(0))
    return ranked.join(first, same, "left").select(*[F.col(f"r.{quoted(c)}") for c in df.columns], rank.cast("int").alias(name))


def _total_order(df: DataFrame, key: str, order_by: Sequence[str]) -> list[str]:
    return [*order_by, *[c for c in df.columns if c != key and c not in order_by]]


def _by_window(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    rank = free_name(df.columns, "rank")
    ranked = rank_latest(df, key, order_by, rank).where(F.col(rank) == 1)
    return ranked.select(*[column(c) for c in df.columns])


def _by_aggregate(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    # A struct compares field by field, null lowest and NaN highest: its maximum is the row
    # that a descending, nulls-last order puts first.
    names, row = _total_order(df, key, order_by), free_name(df.columns, "row")
    latest = F.max(F.struct(*[column(c).alias(f"c{i}") for i, c in enumerate(names)]))
    parts = {name: F.col(row)[f"c{i}"].alias(name) for i, name in enumerate(names)}
    picked = df.groupBy(column(key)).agg(latest.alias(row))
    return picked.select(*[parts.get(c, column(c)) for c in df.columns])


def latest_per_key(
    df: DataFrame,
    key: str,
    order_by: Sequence[str],
    null_keys: str = "collapse",
    method: str = "aggregate",
) -> DataFrame:
    """The row with the highest ``order_by`` per key; all other columns break ties.

    ``aggregate`` (default) takes the maximum of the row as a struct: it sorts by the key
    alone and combines before the shuffle, so a hot key costs one row per task. ``window``
    ranks and filters, to the same result.

    Rows with a null key form one group (``collapse``), stay as they are (``keep``, which
    reads the input a second time rather than shuffle them) or go (``drop``).
    """
    if null_keys not in NULL_KEYS:
        raise ValueError(f"null_keys must be one of {NULL_KEYS}")
    pick = {"aggregate": _by_aggregate, "window": _by_window}[method]
    if null_keys == "collapse":
        return pick(df, key, order_by)
    keyed = pick(df.where(column(key).isNotNull()), key, order_by)
    return keyed if null_keys == "drop" else keyed.unionByName(df.where(column(key).isNull()))
