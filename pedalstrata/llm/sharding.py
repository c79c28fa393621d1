"""A uniform shuffle into shards of exact sizes, through a hypergeometric communication matrix.

Which shard gets how many rows of which partition is drawn first: partition by partition, the
counts are multivariate hypergeometric over the places still free in each shard, which is how
a uniform permutation deals rows to shards. Then every partition permutes its rows locally
and deals them out by its counts, the rows are exchanged, and inside the shards they are
permuted again: a random key per row picks one of many buckets and the order inside it, so that
no task has to hold a shard. The place of a row in its shard, ``slot``, is the rows of the
buckets before its own plus its rank there.

The matrix has one row per partition and one column per shard; it is all that passes the driver.
Rows are first written to shared storage with their partition and position, so a task that runs
again sees the same rows in the same places. Equal seeds over equal stored rows give equal
results.

Law: ``rows``; row counts of the shards differ by one at most, whatever the rows hold. Copies of
one text spread over shards like any other rows. Nulls, ties and repeated rows are rows
like others; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pedalstrata.llm.common import free_name, quoted
from pedalstrata.sources.staging import stage

SHARDS = 16
SEED = 20
BUCKET_ROWS = 2_000
_POSITION_BITS = 33  # monotonically_increasing_id: partition above, position in it below


def shard_sizes(n_rows: int, n_shards: int) -> np.ndarray:
    """The first shards take one row more where the rows don't divide evenly."""
    return n_rows // n_shards + (np.arange(n_shards) < n_rows % n_shards)


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` draws without replacement are good, by inversion; for numbers of any size.

    Probabilities follow from each other by their ratios, outward from the mode; what lies beyond
    fourteen standard deviations is left out, which no draw of a double would reach.
    """
    low, high = max(0, n - bad), min(n, good)
    mode = min(max((n + 1) * (good + 1) // (good + bad + 2), low), high)
    share = good / max(good + bad, 1)
    width = int(14 * (n * share * (1 - share)) ** 0.5) + 40
    low, high = max(low, mode - width), min(high, mode + width)
    up = np.arange(mode, high, dtype=float)
    down = np.arange(mode, low, -1, dtype=float)
    rising = np.cumprod((good - up) * (n - up) / ((up + 1) * (bad - n + up + 1)))
    falling = np.cumprod(down * (bad - n + down) / ((good - down + 1) * (n - down + 1)))
    weights = np.concatenate([falling[::-1], [1.0], rising])
    sums = np.cumsum(weights)
    return low + min(int(np.searchsorted(sums, rng.random() * sums[-1], side="right")), high - low)


def communication_matrix(part_rows: np.ndarray, n_shards: int, seed: int) -> np.ndarray:
    """Rows that each partition sends to each shard: exact margins, jointly hypergeometric."""
    rng = np.random.default_rng(seed)
    free = shard_sizes(int(part_rows.sum()), n_shards)
    matrix = np.zeros((len(part_rows), n_shards), np.int64)
    for i, rows in enumerate(part_rows.tolist()):
        left, rest = rows, int(free.sum())
        for s in range(n_shards):
            rest -= int(free[s])
            matrix[i, s] = hypergeometric(rng, int(free[s]), rest, left)
            left -= int(matrix[i, s])
        free = free - matrix[i]
    return matrix


def uniform_shards(
    df: DataFrame, n_shards: int = SHARDS, seed: int = SEED, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """All rows and columns of ``df`` with ``shard`` (int) and ``slot`` (long, from 0 in each shard).

    Columns of these names in ``df`` are replaced. ``bucket_rows`` is the mean size of a bucket,
    which one task sorts; it does not change which rows go to which shard.
    """
    df = df.drop("shard", "slot")
    spark, columns = df.sparkSession, [quoted(c) for c in df.columns]
    at, part, spot, key, bucket = (free_name(df, c) for c in ("at", "part", "spot", "key", "bucket"))
    stored = stage(df.withColumn(at, F.monotonically_increasing_id()))
    rows = stored.withColumn(part, F.shiftright(at, _POSITION_BITS)).withColumn(
        spot, F.col(at).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    )
    counts = sorted((r[0], r[1]) for r in rows.groupBy(part).count().collect())  # one row per partition
    parts = np.array([p for p, _ in counts], np.int64)
    ends = np.cumsum(communication_matrix(np.array([n for _, n in counts], np.int64), n_shards, seed), axis=1)
    sent = spark.sparkContext.broadcast((parts, ends))

    @F.pandas_udf("int")
    def deal(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known, matrix = sent.value
        held, order = None, None
        for parts_in, spots_in in batches:
            p, s = parts_in.to_numpy(), spots_in.to_numpy()
            out = np.empty(len(p), np.int32)
            for one in np.unique(p):
                i = int(np.searchsorted(known, one))
                if held != i:
                    # The local permutation: where the row at each position stands when dealt out.
                    held, order = i, np.random.default_rng([seed, int(one)]).permutation(int(matrix[i, -1]))
                own = p == one
                out[own] = np.searchsorted(matrix[i], order[s[own]], side="right")
            yield pd.Series(out)

    total = int(ends[:, -1].sum()) if len(ends) else 0
    buckets = max(1, total // (n_shards * bucket_rows))
    placed = rows.withColumn("shard", deal(part, spot)).withColumn(key, F.xxhash64(F.lit(seed), part, spot))
    placed = placed.withColumn(bucket, F.pmod(F.shiftrightunsigned(key, 1), F.lit(buckets)))
    # The sizes of the buckets need only the row's place, not its columns; shards x buckets rows.
    sizes = placed.select("shard", bucket).groupBy("shard", bucket).count()
    before = Window.partitionBy("shard").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    first = free_name(df, "first")
    offsets = sizes.select("shard", bucket, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(first))
    inside = Window.partitionBy("shard", bucket).orderBy(key, at)
    rank = free_name(df, "rank")
    return (
        placed.withColumn(rank, F.row_number().over(inside))
        .join(offsets, ["shard", bucket])
        .select(*columns, "shard", (F.col(first) + F.col(rank) - 1).cast("bigint").alias("slot"))
    )
