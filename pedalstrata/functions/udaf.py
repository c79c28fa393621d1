"""User-defined aggregates written in pandas, reduced before the shuffle.

A grouped-aggregate pandas UDF moves every row of a group into one Python worker, which
breaks as soon as one group holds a large share of the data. Here the user's callable sees
the slice of a group that lies in one Arrow batch and returns a fixed-width state; Spark
merges states with its own partial and final aggregation, and a column expression finishes.
Any aggregate that can be merged from partial states (mean, variance, histogram counts,
extremes) fits, whatever the group size.

A callable that needs the whole group, in order, takes ``aggregate_slices``: the rows of a group reach
it as a stream of Arrow batches, sorted in the shuffle, after their number. No frame of a group
exists, so memory is that of a batch and of what the callable keeps; time is not shared, though: one
task reads a group from end to end. For a hot group prefer a mergeable aggregate where there is one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import chain
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pedalstrata.functions.casting import column as column_of

_MERGES: dict[str, Callable[[Column], Column]] = {"sum": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class MergeableUdaf:
    """``reduce`` maps a pandas ``SeriesGroupBy`` to one state row per group. No state is called ``key``.

    ``state`` gives, per state column, its Spark type and how two states merge
    (``sum``, ``min`` or ``max``). ``finish`` builds the result from the merged columns.
    """

    state: Mapping[str, tuple[str, str]]
    reduce: Callable[[pd.core.groupby.SeriesGroupBy], pd.DataFrame]
    finish: Callable[[Mapping[str, Column]], Column]


def aggregate_with(df: DataFrame, key: str, column: str, udaf: MergeableUdaf, name: str | None = None) -> DataFrame:
    """One row per non-null ``key`` with the user aggregate of ``column``."""
    names = list(udaf.state)
    reduce = udaf.reduce

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                states = reduce(batch.groupby("key", dropna=True)["value"])
                yield states[names].rename_axis("key").reset_index()

    key_type = df.schema[key].dataType.simpleString()
    schema = ", ".join([f"`key` {key_type}", *[f"`{n}` {t}" for n, (t, _) in udaf.state.items()]])
    rows = df.where(column_of(key).isNotNull()).select(column_of(key).alias("key"), column_of(column).alias("value"))
    merges = [_MERGES[how](F.col(n)).alias(n) for n, (_, how) in udaf.state.items()]
    merged = rows.mapInPandas(partial, schema).groupBy("key").agg(*merges)
    return merged.select(F.col("key").alias(key), udaf.finish({n: F.col(n) for n in names}).alias(name or column))


HALF_UP_MEAN = MergeableUdaf(
    state={"total": ("double", "sum"), "n": ("bigint", "sum")},
    reduce=lambda g: g.agg(total="sum", n="count").astype({"total": "float64"}),
    finish=lambda s: (F.try_divide(s["total"], s["n"]) + F.lit(0.5)).try_cast("bigint"),
)


#: From the rows of a group, as batches in order, and their number to one value.
SliceAggregate = Callable[[Iterator[pa.RecordBatch], int], Any]


def aggregate_slices(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    reduce: SliceAggregate,
    result: T.DataType,
    name: str,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """One row per non-null ``key`` with ``reduce(batches, n)`` over the whole group.

    ``batches`` has ``columns``, in the order of ``order_by`` (some of them; nulls first), and ``n`` is the
    number of rows, known before the first: it comes from a partial aggregate and travels ahead of the
    group through the same shuffle. A callable need not read to the end.
    """
    if unknown := [c for c in order_by if c not in columns]:
        raise ValueError(f"order_by must be among the columns: {unknown}")
    names = {c: f"c{i}" for i, c in enumerate(columns)}
    rows = df.where(column_of(key).isNotNull()).select(column_of(key).alias("key"), *[column_of(c).alias(n) for c, n in names.items()])
    body = rows.select("key", F.lit(1).alias("place"), F.lit(None).cast("bigint").alias("n"), *names.values())
    nothing = [F.lit(None).cast(df.schema[c].dataType).alias(n) for c, n in names.items()]
    head = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).select("key", F.lit(0).alias("place"), "n", *nothing)
    # Grouping needs the key's hash and its order, which both are there: no further shuffle or sort.
    ordered = head.unionByName(body).repartition("key").sortWithinPartitions("key", "place", *[names[c] for c in order_by])
    schema = T.StructType([T.StructField("key", df.schema[key].dataType), T.StructField("value", result)])
    out = to_arrow_schema(schema)

    def whole(of: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches)
        n = first.column("n")[0].as_py()
        own = (b.select(list(names.values())).rename_columns(list(names)) for b in chain([first.slice(1)], batches))
        value = reduce((b for b in own if b.num_rows), n)
        for _ in own:  # the rest of the group, if the callable stopped early
            pass
        yield pa.RecordBatch.from_arrays([pa.array([of[0].as_py()], out.field(0).type), pa.array([value], out.field(1).type)], schema=out)

    found = ordered.groupBy("key").applyInArrow(whole, schema)
    return found.select(F.col("key").alias(key), F.col("value").alias(name))


def exact_median(batches: Iterator[pa.RecordBatch], n: int) -> float:
    """Middle value of an ordered column without missing values, mean of the two middle ones if even."""
    wanted, passed, found = [(n - 1) // 2, n // 2], 0, []
    for batch in batches:
        found += [float(batch.column(0)[w - passed].as_py()) for w in wanted if passed <= w < passed + batch.num_rows]
        passed += batch.num_rows
        if len(found) == 2:
            break
    return sum(found) / 2
