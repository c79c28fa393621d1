"""Near-duplicates by SimHash: fingerprints that differ in few bits, found by deletion variants of segments.

1. A text is the sequence of its words, in ASCII lower case; every run of three words has a 64-bit
   hash. A bit of the fingerprint is set if it is set in over half of the hashes, repeats included.
2. Equal fingerprints are one node. Fingerprints that differ in two bits are cut into two segments:
   one of these differs in one bit at most. Each segment is indexed under its variants, in each of
   which one bit is a wildcard: two segments that differ in no other bit have a variant in common.
3. Nodes that share a variant are compared in full.
4. Linked nodes form components, named by their smallest ``doc_id``.

A variant that more than ``BUCKET`` nodes share is not paired. Its nodes get, instead, the variants
of their whole fingerprint with two wildcards: whichever two of them differ in two bits or fewer
share one, and a variant has four fingerprints at most. That is exact, and it costs a node no more
than pairing in full buckets would. Which of the four are there is one number, so an aggregate of
fixed width tells the links.

Edge cases: a null text is an empty one; a text without words has fingerprint zero and is linked like
any other; a text of one or two words is one run. Rows of equal ``doc_id`` are kept as rows. A null
``doc_id`` gets a component like any row; it names one only if all ids in it are null. Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from pedalstrata.llm.common import join_keyed
from pedalstrata.llm.components import components
from pedalstrata.llm.encoding import slices
from pedalstrata.sources.staging import discard, stage

SHINGLE = 3
SEED = 42
BITS = 64
SEGMENT = 32
DISTANCE = 2
BUCKET = 64
BATCH_BYTES = 1_000_000
BLOCK = 16_384  # hashes whose bits are counted at once


def _hashes(text: str | None) -> Iterator[np.ndarray]:
    """Hashes of all runs of words, in blocks."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII white space cuts
    if not words:
        return
    whole, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]) - 1
    first = np.concatenate([[0], ends[:-1] + 1])
    last = ends[SHINGLE - 1 :] if len(words) >= SHINGLE else ends[-1:]
    spans = zip(first.tolist(), last.tolist(), strict=False)
    for _ in range(0, len(last), BLOCK):
        yield np.fromiter((xxh64_intdigest(whole[i:j], SEED) for _, (i, j) in zip(range(BLOCK), spans)), np.uint64)


def fingerprint(text: str | None) -> int:
    ones, n = np.zeros(BITS, np.int64), 0
    for block in _hashes(text):
        ones += np.unpackbits(block.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        n += len(block)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``print``, the fingerprint as a signed number, of every row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", BATCH_BYTES):
                found = np.array([fingerprint(t.as_py()) for t in batch.column("text")], np.uint64)
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "print": pa.array(found.view(np.int64))})

    given = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(sign, "doc_id bigint, print bigint")


def _variants(prints: DataFrame) -> DataFrame:
    """``key`` and ``print`` for each segment and place of the wildcard in it."""
    place = F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("place")
    segment = f"(shiftrightunsigned(print, place div {SEGMENT} * {SEGMENT}) & 4294967295L)"
    wiped = f"shiftleft(cast(place AS bigint), {SEGMENT}) | ({segment} & ~shiftleft(1L, place % {SEGMENT}))"
    return prints.select("print", place).select(F.expr(wiped).alias("key"), "print")


def _double_variants(prints: DataFrame) -> DataFrame:
    """``one``, ``two`` and ``key`` for each two places of wildcards in the whole fingerprint.

    Of the four fingerprints that have a variant, ``own`` marks the print by a bit of four.
    """
    one = F.explode(F.sequence(F.lit(0), F.lit(BITS - 2))).alias("one")
    both = prints.select("print", one).select("print", "one", F.explode(F.sequence(F.col("one") + 1, F.lit(BITS - 1))).alias("two"))
    key = F.expr("print & ~shiftleft(1L, one) & ~shiftleft(1L, two)").alias("key")
    return both.select("one", "two", key, F.expr("shiftleft(1, getbit(print, one) + 2 * getbit(print, two))").alias("own"))


def _near(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= DISTANCE


def _met(members: DataFrame) -> DataFrame:
    """Pairs of nodes that share a key and differ in few enough bits."""
    a, b = members.alias("a"), members.alias("b")
    found = a.join(b, (F.col("a.print") < F.col("b.print")) & (F.col("a.key") == F.col("b.key")))
    found = found.where(_near(F.col("a.print"), F.col("b.print")))
    return found.select(F.col("a.print").alias("u"), F.col("b.print").alias("v"))


def _met_in_doubles(prints: DataFrame) -> DataFrame:
    """The same for all double variants of ``prints``; whichever share one are near."""
    shared = _double_variants(prints).groupBy("one", "two", "key").agg(F.bit_or("own").alias("there")).where("bit_count(there) > 1")
    node = [F.expr(f"key | shiftleft({i & 1}L, one) | shiftleft({i >> 1}L, two)") for i in range(4)]
    listed = []
    for i, j in combinations(range(4), 2):
        pair = F.struct(F.least(node[i], node[j]).alias("u"), F.greatest(node[i], node[j]).alias("v"))
        listed.append(F.when(F.expr(f"getbit(there, {i}) + getbit(there, {j}) = 2"), pair))
    return shared.select(F.inline(F.filter(F.array(*listed), lambda p: p.isNotNull())))


def _met_in_small(shared: DataFrame) -> DataFrame:
    """The same for keys of two or three nodes, which their least, their largest and the XOR of all tell."""
    low, high = F.col("low"), F.col("high")
    between = low.bitwiseXOR(high).bitwiseXOR(F.col("all"))
    pairs = [(low, high, F.lit(True)), *[(a, b, F.col("n") == 3) for a, b in ((low, between), (between, high))]]
    listed = F.array(*[F.when(given, F.struct(a.alias("u"), b.alias("v"))) for a, b, given in pairs])
    opened = shared.where("n <= 3").select(F.inline(F.filter(listed, lambda p: p.isNotNull() & _near(p["u"], p["v"]))))
    return opened.select("u", "v")


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """All pairs ``u``, ``v`` of different values of ``print`` that differ in two bits or fewer, once each.

    Most variants that are shared at all are shared by two or three nodes. One aggregate tells which;
    only those of more nodes take a second look at the variants.
    """
    variants = _variants(prints)
    sums = [F.count(F.lit(1)).alias("n"), F.min("print").alias("low"), F.max("print").alias("high"), F.bit_xor("print").alias("all")]
    shared = stage(variants.groupBy("key").agg(*sums).where("n > 1"))
    larger = stage(shared.where("n > 3").select("key", "n", (F.col("n") > bucket).alias("crowd")))
    members = stage(join_keyed(variants, larger, ["key"], "n", exploded=True))
    crowded = members.where("crowd").select("print").distinct()
    found = _met(members.where("NOT crowd")).unionByName(_met_in_doubles(crowded))
    out = stage(found.unionByName(_met_in_small(shared)).distinct())
    for used in (shared, larger, members):
        discard(used)
    return out


def linked(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``doc_id``, ``print``, ``component_id`` and ``links``, the other fingerprints linked to the row's, per row."""
    rows = stage(fingerprints(docs))
    prints = stage(rows.groupBy("print").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least")))
    pairs = links(prints.select("print"), bucket)
    ends = pairs.select("u").unionByName(pairs.select(F.col("v").alias("u"))).groupBy("u").agg(F.count(F.lit(1)).alias("links"))
    named = prints.join(components(pairs).withColumnRenamed("node", "print"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    named = stage(named.join(ends.withColumnRenamed("u", "print"), "print", "left"))
    groups = stage(named.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("size")))
    known = stage(join_keyed(named, groups, ["root"], "size"))
    values = known.select("print", "n", "component_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("links"))
    return join_keyed(rows, values, ["print"], "n")


def as_hex(print_: Column) -> Column:
    return F.lower(F.lpad(F.hex(print_), BITS // 4, "0"))
