"""Token ids in ORC: integer run-length encoding, row indexes and Bloom filters on document ids.

A file set holds one row per document, in ascending ``doc_id`` order within and across files:

``doc_id`` long, ``part`` int (the task that wrote the row), ``local_start`` long (ids of the
documents before it in that part), ``n_tokens`` long, ``ids`` array of int.

The ids are one integer column to ORC, so each stripe holds them run-length encoded and can be
read by a task of its own. Row indexes (smallest and largest id of every ``index_stride`` rows)
prune ranges, Bloom filters prune single documents, both before any id is decoded.

Edge cases: a null or empty text is one ``END`` id. Rows with equal ``doc_id`` follow each
other, ordered by a hash of their text; a null ``doc_id`` sorts first. An empty table gives an
empty file set. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pedalstrata.llm.common import offsets_before, shuffle_partitions
from pedalstrata.llm.encoding import TEXT_BYTES, crc32s, ids_array, list_values, slices, worker_encoder

SCHEMA = "doc_id bigint, part int, local_start bigint, n_tokens bigint, ids array<int>"
STRIPE_BYTES = 32 << 20
INDEX_STRIDE = 1000


def encoded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``SCHEMA`` rows of the ``doc_id`` and ``text`` of each task, in the task's order."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, at = worker_encoder(tokenizer), TaskContext.get().partitionId(), 0
        for whole in batches:
            for batch in slices(whole, "text", TEXT_BYTES):
                ids, lengths = encoder.encode(batch.column("text"))
                ends = at + np.cumsum(lengths)
                columns = {
                    "doc_id": batch.column("doc_id").cast(pa.int64()),
                    "part": pa.array(np.full(len(lengths), part, np.int32)),
                    "local_start": pa.array(ends - lengths),
                    "n_tokens": pa.array(lengths.astype(np.int64)),
                    "ids": ids_array(ids, lengths),
                }
                at = int(ends[-1])
                yield pa.RecordBatch.from_pydict(columns)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(encode, SCHEMA)


def orc_options(stripe_bytes: int = STRIPE_BYTES, index_stride: int = INDEX_STRIDE) -> dict[str, str]:
    return {
        "orc.compress": "ZSTD",
        "orc.stripe.size": str(stripe_bytes),
        "orc.row.index.stride": str(index_stride),
        "orc.bloom.filter.columns": "doc_id",
        "orc.bloom.filter.fpp": "0.01",
    }


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    partitions: int | None = None,
    stripe_bytes: int = STRIPE_BYTES,
    index_stride: int = INDEX_STRIDE,
) -> None:
    """Encode every document and write the file set to ``path``, which must not exist.

    One shuffle, of the texts, by ranges of ``doc_id``; the range bounds come from a sample
    and only decide which file a document lands in.
    """
    n = partitions or shuffle_partitions(docs.sparkSession)
    tie = F.xxhash64("text")
    ordered = docs.select("doc_id", "text").repartitionByRange(n, "doc_id", tie).sortWithinPartitions("doc_id", tie)
    encoded(ordered, tokenizer).write.format("orc").options(**orc_options(stripe_bytes, index_stride)).save(path)


def read_token_files(
    spark: SparkSession, path: str, doc_ids: Sequence[int] | None = None, between: tuple[int, int] | None = None
) -> DataFrame:
    """The rows of a file set, or those of some documents or of a closed range of them.

    Both conditions reach the ORC reader, which skips stripes and row groups by their statistics
    and Bloom filters.
    """
    rows = spark.read.schema(SCHEMA).orc(path)
    if doc_ids is not None:
        rows = rows.where(F.col("doc_id").isin(list(doc_ids)))
    if between is not None:
        rows = rows.where(F.col("doc_id").between(*between))
    return rows


def part_offsets(rows: DataFrame) -> DataFrame:
    """``part`` and the ids in all parts before it: one row per writing task."""
    return offsets_before(rows.groupBy("part").agg(F.sum("n_tokens").alias("n")), "part", "n", "part_start")


def document_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the ids in the files."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, starts, lengths = list_values(batch.column("ids"))
            columns = {k: batch.column(k) for k in ("doc_id", "part", "local_start")}
            columns |= {"n_tokens": pa.array(lengths), "ids_crc32": pa.array(crc32s(ids, starts, lengths))}
            yield pa.RecordBatch.from_pydict(columns)

    rows = read_token_files(spark, path)
    schema = "doc_id bigint, part int, local_start bigint, n_tokens bigint, ids_crc32 bigint"
    return (
        rows.mapInArrow(digest, schema)
        .join(F.broadcast(part_offsets(rows)), "part")
        .select("doc_id", (F.col("part_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
    )
