"""Concatenate and cut: documents in a row, cut into windows of a fixed number of tokens.

First pass: each task encodes its documents, numbers their ids from its own start and stores
them; prefix sums over the tasks' token totals (one row per task) turn local starts into global
offsets. Second pass: every document is cut where its global offsets cross a multiple of the
window, without a shuffle. Windows that no single task holds whole are put together from
boundary records, of which there are at most two per task. Sequences are written with
their ids and a list of the pieces that lie in them; ``pieces_of`` tells the pieces, and their
checksums, from the files.

Only the last sequence is not full; it is padded. The order of documents is that of the
input files. Edge cases: a null or empty text is one ``END`` id; equal and null ``doc_id`` are
separate documents; an empty table gives no piece. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalstrata.llm.encoding import crc32s, forget_encoders, ids_array, list_values
from pedalstrata.llm.token_files import SCHEMA, encoded, part_offsets
from pedalstrata.sources.staging import shared_dir

WINDOW = 1024
RECORDS = 200  # given out at a time: executors hold whole batches outside their heap
FAST = {"orc.compress": "LZ4"}
PIECES = "array<struct<doc_id:bigint,start:bigint,length:bigint,doc_tokens:bigint>>"


@dataclass(frozen=True)
class Packed:
    """Stored ids with the global offset ``start`` of each document, and the window length.

    With ``lean``, workers free the encoders of the first pass before the second; the next table learns anew.
    """

    rows: DataFrame
    window: int
    lean: bool = False

    def records(self) -> DataFrame:
        """Windows, or the parts of them that a task holds: ``sequence_id``, ``offset``, ``n_tokens``, ``ids``, ``pieces``.

        A part is a boundary record; a task has at most two, its first and its last. ``pieces`` are in their
        order, each with ``doc_id``, ``start`` (the document's ids before it), ``length`` and ``doc_tokens``.
        """
        window, lean = self.window, self.lean
        members = pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64())])

        def rows(sequence, offset, ids, sizes, pieces, counts) -> pa.RecordBatch:
            ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            columns = {
                "sequence_id": pa.array(np.asarray(sequence, np.int64)),
                "offset": pa.array(np.asarray(offset, np.int64)),
                "n_tokens": pa.array(np.asarray(sizes, np.int64)),
                "ids": ids_array(ids, np.asarray(sizes)),
                "pieces": pa.ListArray.from_arrays(ends, pieces),
            }
            return pa.RecordBatch.from_pydict(columns)

        def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if lean:
                forget_encoders()
            held: _Part | None = None
            for batch in batches:
                ids, at, lengths = list_values(batch.column("ids"))
                begin = batch.column("start").to_numpy()
                row, sequence, left, n = _cut(begin, lengths, window)
                if not len(row):
                    continue
                fields = [batch.column("doc_id").take(pa.array(row)), *map(pa.array, (left - begin[row], n, lengths[row]))]
                pieces = pa.StructArray.from_arrays(fields, fields=list(members))
                # Neighbouring pieces of one window become one record.
                joined = np.concatenate([[False], (sequence[1:] == sequence[:-1]) & (left[1:] == left[:-1] + n[:-1])])
                heads = np.append(np.flatnonzero(~joined), len(row))
                flat = ids[at[0] : at[0] + int(lengths.sum())]
                ends = np.concatenate([[0], np.cumsum(n)])
                low, high = 0, len(heads) - 1
                if held is not None:
                    if held.goes_on(int(sequence[0]), int(left[0])):
                        held.add(flat[: ends[heads[1]]], pieces[: heads[1]])
                        low = 1
                    if low < high or held.size == window:
                        yield rows(*held.row(window))
                        held = None
                if low < high and left[-1] + n[-1] < (sequence[-1] + 1) * window:
                    high -= 1
                    a, b = heads[high], heads[high + 1]
                    held = _Part(int(sequence[a]), int(left[a]), [flat[ends[a] : ends[b]].copy()], [pieces[a:b]])
                for a in range(low, high, RECORDS):
                    some = heads[a : min(a + RECORDS, high) + 1]
                    first = some[:-1]
                    yield rows(
                        sequence[first],
                        (left - sequence * window)[first],
                        flat[ends[some[0]] : ends[some[-1]]],
                        ends[some[1:]] - ends[first],
                        pieces[some[0] : some[-1]],
                        np.diff(some),
                    )
            if held is not None:
                yield rows(*held.row(window))

        schema = f"sequence_id bigint, offset bigint, n_tokens bigint, ids array<int>, pieces {PIECES}"
        return self.rows.select("doc_id", "start", "ids").mapInArrow(gather, schema)

    def write(self, path: str, pad: int = 0) -> DataFrame:
        """Write all sequences to ORC files, and return them as read from there.

        Columns: ``sequence_id``, ``n_tokens``, the padded ``ids`` and the ``pieces``. Boundary records go to
        files of their own, from which they are put together.
        """
        found = self.records().withColumn("whole", F.col("n_tokens") == self.window)
        found.write.format("orc").options(**FAST).partitionBy("whole").save(f"{path}/records")
        stored = found.sparkSession.read.schema(found.schema).orc(f"{path}/records")
        whole = stored.where("whole").select("sequence_id", "n_tokens", "ids", "pieces")
        put = stored.where("NOT whole").groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids", "pieces"))).alias("records"))
        ids, n = F.flatten("records.ids"), F.size(F.flatten("records.ids"))
        filled = F.concat(ids, F.array_repeat(F.lit(pad), F.lit(self.window) - n))
        joined = put.select("sequence_id", n.cast("bigint").alias("n_tokens"), filled.alias("ids"), F.flatten("records.pieces").alias("pieces"))
        joined.write.format("orc").options(**FAST).save(f"{path}/joined")
        return whole.unionByName(found.sparkSession.read.schema(whole.schema).orc(f"{path}/joined"))


@dataclass
class _Part:
    """The last window of a batch, as far as it goes."""

    sequence: int
    left: int
    ids: list[np.ndarray]
    pieces: list[pa.StructArray]

    @property
    def size(self) -> int:
        return sum(map(len, self.ids))

    def goes_on(self, sequence: int, left: int) -> bool:
        return self.sequence == sequence and self.left + self.size == left

    def add(self, ids: np.ndarray, pieces: pa.StructArray) -> None:
        self.ids.append(ids.copy())
        self.pieces.append(pieces)

    def row(self, window: int) -> tuple:
        pieces = pa.concat_arrays(self.pieces)
        ids = np.concatenate(self.ids)
        return [self.sequence], [self.left - self.sequence * window], ids, [len(ids)], pieces, [len(pieces)]


def pieces_of(sequences: DataFrame) -> DataFrame:
    """One row per piece, from the sequences: where it lies in its document and its sequence, and its checksum."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, at, _ = list_values(batch.column("ids"))
            pieces = batch.column("pieces")
            ends = pieces.offsets.to_numpy()
            counts = np.diff(ends)
            inner = pieces.values.slice(int(ends[0]), int(ends[-1] - ends[0]))
            doc_id, start, length, doc_tokens = inner.flatten()
            n = length.to_numpy()
            row = np.repeat(np.arange(len(counts)), counts)
            before = np.cumsum(n) - n
            offset = before - before[np.cumsum(counts) - counts][row] if len(n) else before
            columns = {
                "doc_id": doc_id,
                "start": start,
                "length": length,
                "ids_crc32": pa.array(crc32s(ids, at[row] + offset, n)),
                "doc_tokens": doc_tokens,
                "sequence_id": batch.column("sequence_id").take(pa.array(row)),
                "offset": pa.array(offset),
            }
            yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return sequences.select("sequence_id", "ids", "pieces").mapInArrow(opened, schema)


def _cut(begin: np.ndarray, lengths: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Pieces of runs [begin, begin + length): row, window, global start and length of each."""
    first = begin // window
    count = (begin + lengths - 1) // window - first + 1
    row = np.repeat(np.arange(len(begin)), count)
    sequence = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    left = np.maximum(begin[row], sequence * window)
    right = np.minimum((begin + lengths)[row], (sequence + 1) * window)
    return row, sequence, left, right - left


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, lean: bool = False) -> Packed:
    """Encode ``doc_id`` and ``text``, store the ids on shared storage and lay out the windows."""
    spark = docs.sparkSession
    path = shared_dir(spark)
    # Read once and in full: no Bloom filters, and what compresses fastest.
    encoded(docs, tokenizer).write.format("orc").options(**FAST).save(path)
    rows = spark.read.schema(SCHEMA).orc(path)
    start = (F.col("part_start") + F.col("local_start")).alias("start")
    return Packed(rows.join(F.broadcast(part_offsets(rows)), "part").select("doc_id", start, "ids"), window, lean)
