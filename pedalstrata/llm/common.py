"""What several operators of this package share."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pedalstrata.sources.staging import stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def offsets_before(totals: DataFrame, by: str, amount: str, out: str) -> DataFrame:
    """Sum of ``amount`` over all rows with a smaller ``by``.

    For one row per partition or bucket only: the window runs in one task.
    """
    before = Window.orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(by, F.coalesce(F.sum(amount).over(before), F.lit(0)).cast("bigint").alias(out))


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the document id as text, modulo ``n``."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))


#: A key is hot if it holds more than this part of all rows, so there are fewer hot keys than this.
HOT_KEYS = 1000
#: Of keys that exploded rows are joined to, so many are broadcast with their values.
BROADCAST_KEYS = 10_000
POSITION_BITS = 33  # monotonically_increasing_id: partition above, position in it below


def _same(a: str, b: str, on: Sequence[str]) -> Column:
    return reduce(and_, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in on])


def join_keyed(rows: DataFrame, keyed: DataFrame, on: Sequence[str], n: str, exploded: bool = False) -> DataFrame:
    """Inner join of ``rows`` to ``keyed``, which has one row per key and in ``n`` the rows of the key.

    Fewer than ``HOT_KEYS`` keys can hold more than that part of all rows. Their rows stay where
    they are and get the values by a broadcast of bounded length; only rows of other keys move.
    Null keys match. Both frames are read twice, so give stored ones. ``n`` is not returned.

    Spark takes ``exploded`` rows for as few as what they come from, and could choose to broadcast
    them. It is told what to do: broadcast ``keyed`` if it is short, else move both sides.
    """
    total, keys = keyed.agg(F.coalesce(F.sum(n), F.lit(0)), F.count(F.lit(1))).first()
    values = [c for c in keyed.columns if c not in on and c != n]
    columns = [*[F.col(f"r.{c}") for c in rows.columns], *[F.col(f"k.{c}") for c in values]]
    is_hot = F.col(n) * F.lit(HOT_KEYS) > F.lit(total)
    hot, cold = F.broadcast(keyed.where(is_hot)), keyed.where(~is_hot)
    if exploded:
        cold = cold.hint("broadcast" if keys <= BROADCAST_KEYS else "merge")
    hot, cold = hot.alias("k"), cold.alias("k")
    r, same = rows.alias("r"), _same("r", "k", on)
    moved = r.join(hot, same, "left_anti").alias("r").join(cold, same)
    return r.join(hot, same).select(*columns).unionByName(moved.select(*columns))


def running_totals(df: DataFrame, group: Sequence[str], order: Sequence[str], amount: str, out: str) -> DataFrame:
    """All columns, and in ``out`` the sum of ``amount`` over the group's rows before this one.

    Nulls come first. The rows are sorted in ranges and stored with their place; a total is that of
    the group's rows in earlier ranges plus that of those in the own one, so no task holds a group.
    """
    columns, at, part = df.columns, free_name(df, "at"), free_name(df, "part")
    ends = [F.asc_nulls_first(c) for c in [*group, *order]]
    ranged = df.repartitionByRange(*ends).sortWithinPartitions(*ends)
    stored = stage(ranged.withColumn(at, F.monotonically_increasing_id()))
    stored = stored.withColumn(part, F.shiftright(at, POSITION_BITS))
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    # At most one row per range and one per group.
    sums = stored.groupBy(*group, part).agg(F.sum(amount).alias("sum"))
    sums = sums.select(*group, part, F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("earlier")).alias("s")
    local = Window.partitionBy(part, *group).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    own = stored.withColumn(out, F.coalesce(F.sum(amount).over(local), F.lit(0))).alias("o")
    total = (F.col(f"o.{out}") + F.col("s.earlier")).cast("bigint").alias(out)
    return own.join(sums, _same("o", "s", [*group, part])).select(*[F.col(f"o.{c}") for c in columns], total)
