"""Near-duplicates by ProbMinHash of weighted shingles, banding and verification.

A text is the set of its runs of five words, each weighted by one plus the logarithm of how often
it occurs, so that a line repeated all over a text counts more than once but does not drown the
rest. Every shingle is the source of a Poisson process whose rate is its weight; each arrival falls
into one of ``registers`` at random, and a register keeps the shingle of its earliest arrival.
Shingles are followed only until their next arrival comes after the latest register's, which ends
the process early. Two texts agree in a register with their probability Jaccard similarity, which is
plain Jaccard where no shingle repeats. A second signature, with unit weights, agrees with plain
Jaccard in every text; a text in which no shingle repeats has the same signature twice.

1. Texts with the same words are one node, known by a 64-bit hash of its words. Equal bands
   (``BAND_ROWS`` registers) of different nodes form a bucket, whichever of their signatures they
   are from.
2. Stars: in every bucket two nodes, picked by a hash that differs per bucket, are compared with
   all others. That is linear in the bucket, and joins groups of copies at once.
3. What the stars leave apart: members of one bucket in different components are compared by
   their unit-weight signatures, in blocks of bounded size; pairs whose estimate is above ``SIGMAS`` standard
   errors below the threshold are verified too, where they are compared.
4. Verification is exact, on the whole texts: a link needs a plain Jaccard similarity of the
   shingles of at least the threshold, as is usual. Linked texts form a class.

At plain Jaccard 0.8, a pair misses all unit-weight bands with probability 1.3e-5; the estimate loses
it with probability 3e-7. How often shingles repeat makes no difference to either.

Edge cases: a null text is an empty one; texts without words are one class; a text of one to
four words is a single shingle. Rows of equal ``doc_id`` are kept as rows. A null ``doc_id`` gets a
class like any row; classes are named by their smallest ``doc_id``, null if all are null. Other
columns are ignored by ``classes`` and kept by ``representatives``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pedalstrata.llm import textcodes
from pedalstrata.llm.common import free_name, join_keyed, quoted
from pedalstrata.llm.components import components
from pedalstrata.llm.encoding import slices
from pedalstrata.sources.staging import discard, stage

SHINGLE = 5
THRESHOLD = 0.8
BAND_ROWS = 7
BANDS = 48
REGISTERS = BAND_ROWS * BANDS
BLOCK = 1000
SIGMAS = 5
BATCH_BYTES = 400_000  # short texts have as many registers as long ones


def weighted(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text (as 48-bit numbers), their text and weight."""
    keys = (text.astype(np.uint64) << np.uint64(48)) | (hashes >> np.uint64(16))
    keys.sort()
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    weights = 1.0 + np.log(np.diff(heads, append=len(keys)))
    return keys[heads] & np.uint64((1 << 48) - 1), (keys[heads] >> np.uint64(48)).astype(np.int64), weights


def signatures(
    ids: np.ndarray, text: np.ndarray, weights: np.ndarray, n_texts: int, registers: int = REGISTERS
) -> np.ndarray:
    """The shingle of the earliest arrival in each register; 0 where a text has no shingle.

    ``text`` is ascending. Arrivals of a shingle depend on the shingle alone, whichever text it is
    in, and times scale with its weight.
    """
    earliest = np.full(n_texts * registers, np.inf)
    owner = np.zeros(n_texts * registers, np.uint64)
    time, done = np.zeros(len(ids)), np.zeros(len(ids), np.int64)
    alive = np.arange(len(ids))
    while len(alive):
        # About one arrival per register and round, so short texts take no more rounds than long ones.
        per_text = np.bincount(text[alive], minlength=n_texts)
        count = np.maximum(1, registers // np.maximum(per_text, 1))[text[alive]]
        first = np.cumsum(count) - count
        source = np.repeat(alive, count)
        number = (np.arange(len(source)) - np.repeat(first, count) + done[source]).astype(np.uint64)
        drawn = textcodes.mix(ids[source] * np.uint64(0x9E3779B97F4A7C15) + textcodes.mix(number + np.uint64(1)))
        uniform = ((drawn >> np.uint64(12)).astype(float) + 0.5) * 2.0**-52
        gaps = -np.log(uniform) / weights[source]
        # Running sums within each source.
        sums = np.cumsum(gaps)
        at = time[source] + sums - np.repeat(sums[first] - gaps[first], count)
        register = ((textcodes.mix(drawn) >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
        cell = text[source] * registers + register
        np.minimum.at(earliest, cell, at)
        won = at == earliest[cell]
        owner[cell[won]] = ids[source[won]] + np.uint64(1)
        last = first + count - 1
        time[alive], done[alive] = at[last], done[alive] + count
        latest = earliest.reshape(n_texts, registers).max(axis=1)
        alive = alive[time[alive] < latest[text[alive]]]
    return owner.reshape(n_texts, registers)


def bands(signature: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """One 64-bit key per band, which holds the number of the band too."""
    n, registers = signature.shape
    parts = signature.reshape(n, registers // rows, rows)
    key = np.broadcast_to(np.arange(registers // rows, dtype=np.uint64), parts.shape[:2]).copy()
    for r in range(rows):
        key = textcodes.mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key


def _nodes(w: textcodes.Words) -> np.ndarray:
    """A 64-bit number of each text's words in their order."""
    h, bounds = w.hashes(), w.bounds()
    at = (np.arange(len(h)) - np.repeat(bounds[:-1], np.diff(bounds))).astype(np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(textcodes.mix(h + textcodes.mix(at)), dtype=np.uint64)])
    return textcodes.mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64)).view(np.int64)


def signed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``node``, band keys and an 8-bit sketch of the unit-weight signature of every document.

    The keys are those of unit weights, then, where a shingle repeats, those of the weighted
    signature. Texts without words have no bands.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", BATCH_BYTES):
                w = textcodes.words(batch.column("text").to_pylist())
                ids, text, weights = weighted(*textcodes.shingles(w, SHINGLE))
                found = signatures(ids, text, np.ones(len(ids)), w.n_texts)
                wordless = np.diff(w.bounds()) == 0
                repeats = np.unique(text[weights > 1])
                own = np.isin(text, repeats)
                again = signatures(ids[own], np.searchsorted(repeats, text[own]), weights[own], len(repeats))
                # Both key rows of a text stay together.
                keys = np.concatenate([bands(found)[~wordless], bands(again)]).view(np.int64)
                keys = keys[np.argsort(np.concatenate([np.flatnonzero(~wordless), repeats]), kind="stable")]
                rows = np.where(wordless, 0, 1)
                rows[repeats] = 2
                ends = np.concatenate([[0], np.cumsum(rows * BANDS)]).astype(np.int32)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id").cast(pa.int64()),
                        "text_key": batch.column("text_key"),
                        "node": pa.array(_nodes(w)),
                        "bands": pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel())),
                        "sketch": pa.array([r.tobytes() for r in textcodes.mix(found).astype(np.uint8)], pa.binary()),
                    }
                )

    return _keyed(docs).mapInArrow(sign, "doc_id bigint, text_key bigint, node bigint, bands array<bigint>, sketch binary")


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("bigint"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Plain Jaccard of two sorted sets; 1 for two empty ones."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    either = len(a) + len(b) - both
    return both / either if either else 1.0


def _sets(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted distinct shingles of each text."""
    w = textcodes.words(texts)
    ids, text, _ = weighted(*textcodes.shingles(w, SHINGLE))
    at = np.searchsorted(text, np.arange(w.n_texts + 1))
    return [ids[i:j] for i, j in zip(at[:-1], at[1:], strict=True)]


def verified(pairs: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs ``u``, ``v`` whose texts are similar enough. ``texts`` has ``node`` and ``text``."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text_u", BATCH_BYTES):
                sides = [_sets(batch.column(name).to_pylist()) for name in ("text_u", "text_v")]
                good = [jaccard(a, b) >= threshold for a, b in zip(*sides, strict=True)]
                yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in ("u", "v")}).filter(pa.array(good, pa.bool_()))

    u, v = (texts.select(F.col("node").alias(n), F.col("text").alias(f"text_{n}")) for n in "uv")
    return pairs.join(u, "u").join(v, "v").select("u", "v", "text_u", "text_v").mapInArrow(check, "u bigint, v bigint")


def _pairs(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("u"), F.greatest(a, b).alias("v")]


def linked_in_blocks(members: DataFrame, payload: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Links between members of one bucket that lie in different components.

    ``members`` has ``key``, ``node`` and ``root``; ``payload`` has ``node``, ``bands``, ``sketch`` and
    ``text``. A large bucket is cut into blocks by a hash of the node, and every two blocks meet in a
    task. There, pairs whose sketches nearly agree often enough are verified on their texts, in
    the bucket of the smallest key that they share, so each pair is looked at once. A task returns only links that
    join what its earlier links have not joined: fewer than it has members.
    """
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    sizes = stage(sizes.withColumn("blocks", F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (
        join_keyed(members, sizes, ["key"], "n")
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "node", "root")
        .join(payload, "node")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            groups = _groups(held)
            if len(groups) > 1:
                yield _joined(held.slice(0, groups[-1]), groups[:-1], threshold)
                held = held.slice(groups[-1])
        if held is not None:
            yield _joined(held, _groups(held), threshold)

    order = ["key", "i", "j"]
    return dealt.repartition(*order).sortWithinPartitions(*order).mapInArrow(compare, "u bigint, v bigint").distinct()


def _groups(rows: pa.Table) -> np.ndarray:
    """Where a new bucket or pair of blocks begins."""
    if not rows.num_rows:
        return np.empty(0, np.int64)
    key, i, j = (rows[c].to_numpy() for c in ("key", "i", "j"))
    new = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
    return np.flatnonzero(np.concatenate([[True], new]))


def _band_keys(column: pa.ChunkedArray) -> np.ndarray:
    """The band keys of each row: of unit weights and weighted (the same where there is one list)."""
    keys = np.concatenate([c.flatten().to_numpy() for c in column.chunks])
    ends = np.cumsum(np.concatenate([c.value_lengths().to_numpy() for c in column.chunks]))
    band = np.arange(BANDS)
    unit = np.concatenate([[0], ends[:-1]])[:, None] + band
    return np.stack([keys[unit], keys[ends[:, None] - BANDS + band]])


def _smallest_shared(keys: np.ndarray, one: int, others: np.ndarray) -> np.ndarray:
    """The smallest key that a row shares with each of others, the largest number if none."""
    shared = [np.where((k == keys[0, one]) | (k == keys[1, one]), k, np.iinfo(np.int64).max) for k in keys[:, others]]
    return np.minimum(*shared).min(axis=1)


def _joined(rows: pa.Table, starts: np.ndarray, threshold: float) -> pa.RecordBatch:
    """Links in each group, across its two blocks or within its one."""
    least = threshold - SIGMAS * (threshold * (1 - threshold) / REGISTERS) ** 0.5
    node, root, mine, i, j, key = (rows[c].to_numpy() for c in ("node", "root", "mine", "i", "j", "key"))
    sketch = np.frombuffer(b"".join(rows["sketch"].to_pylist()), np.uint8).reshape(rows.num_rows, REGISTERS)
    keys = _band_keys(rows["bands"])
    u, v = [], []
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), rows.num_rows], strict=True):
        within, at = i[a] == j[a], np.arange(a, b)
        left, right = (at, at) if within else (at[mine[a:b] == i[a]], at[mine[a:b] == j[a]])
        component = root[a:b].copy()
        sets: dict[int, np.ndarray] = {}
        texts = rows["text"].slice(a, b - a)
        for one in left.tolist():
            rest = right[right > one] if within else right
            rest = rest[component[rest - a] != component[one - a]]
            if not len(rest):
                continue
            agreement = (sketch[rest] == sketch[one]).mean(axis=1)
            near = np.flatnonzero(agreement >= least)
            near = near[_smallest_shared(keys, one, rest[near]) == key[a]]
            for two in rest[near[np.argsort(-agreement[near])]].tolist():
                if component[one - a] == component[two - a]:
                    continue
                for x in (one, two):
                    if x not in sets:
                        sets[x] = _sets([texts[x - a].as_py()])[0]
                if jaccard(sets[one], sets[two]) >= threshold:
                    component[component == component[two - a]] = component[one - a]
                    u.append(node[one])
                    v.append(node[two])
    pair = np.array([u, v], np.int64).reshape(2, -1)
    return pa.RecordBatch.from_pydict({"u": pa.array(pair.min(axis=0)), "v": pa.array(pair.max(axis=0))})


def links(docs: DataFrame, rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Enough links between nodes to join whatever is similar; ``rows`` is the stored ``signed(docs)``."""
    spread = rows.select("node", F.explode(F.array_distinct("bands")).alias("key"))
    # A key is different per band, so the smallest and largest node by this hash differ per bucket.
    mixed = F.col("node").bitwiseXOR(F.col("key"))
    buckets = spread.groupBy("key").agg(F.min(mixed).alias("low"), F.max(mixed).alias("high")).where("low <> high")
    members = stage(spread.join(buckets, "key").distinct())
    one, two = (F.col(c).bitwiseXOR(F.col("key")) for c in ("low", "high"))
    star = members.select(*_pairs(F.col("node"), one)).unionByName(members.select(*_pairs(F.col("node"), two)))
    star = star.where("u <> v").distinct()

    # One row of each node that shares a bucket, and its text.
    some = members.select("node").distinct()
    first = Window.partitionBy("node").orderBy("doc_id", "text_key")
    # The first row of a node is picked before rows move: each task sends one, however many copies there are.
    # Not a semi-join, which the optimizer would move below the window.
    known = rows.select("node", "doc_id", "text_key", "bands", "sketch").withColumn("n", F.row_number().over(first))
    known = stage(known.where("n = 1").drop("n").join(some, "node"))
    d, k = _keyed(docs).alias("d"), known.select("node", "doc_id", "text_key").alias("k")
    own = (F.col("d.text_key") == F.col("k.text_key")) & F.col("d.doc_id").eqNullSafe(F.col("k.doc_id"))
    texts = stage(d.join(k, own).groupBy("node").agg(F.first("text").alias("text")))
    found = stage(verified(star, texts, threshold))

    apart = members.where((F.col("node") != one) & (F.col("node") != two)).select("key", "node")
    roots = components(found)
    labelled = apart.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    split = labelled.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("key")
    rest = stage(labelled.join(split, "key", "left_semi"))
    payload = known.select("node", "bands", "sketch").join(texts, "node")
    out = stage(found.unionByName(linked_in_blocks(rest, payload, threshold)))
    for used in (members, known, texts, rest, found):
        discard(used)
    return out


def _labelled(rows: DataFrame, roots: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``rows``, among them ``node``, with the ``root`` of the component."""
    sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    keyed = stage(sizes.join(roots, "node", "left").select("node", "n", F.coalesce("root", "node").alias("root")))
    return join_keyed(rows.select(*columns), keyed, ["node"], "n")


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``class_id`` (smallest id of the class) and ``node`` of every row."""
    rows = stage(signed(docs))
    labelled = _labelled(rows, components(links(docs, rows, threshold)), ["doc_id", "node"])
    labelled = stage(labelled)
    named = stage(labelled.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("n")))
    return join_keyed(labelled, named, ["root"], "n").select("doc_id", "class_id", "node")


def representatives(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of ``docs`` per class, with all its columns: that of the smallest ``doc_id``.

    Null ids come last; rows of equal ids are told apart by a hash of their text, and of rows equal
    in both any one stays.
    """
    rows = stage(signed(docs))
    labelled = _labelled(rows, components(links(docs, rows, threshold)), ["doc_id", "text_key", "node"])
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_key")
    best = labelled.groupBy("root").agg(F.min(order).alias("k")).select("k.doc_id", "k.text_key")
    key, own_id = free_name(docs, "text_key"), free_name(docs, "own_id")
    first = stage(best.select(F.col("text_key").alias(key), F.col("doc_id").alias(own_id)))
    keyed = docs.withColumn(key, F.xxhash64(F.col("text").cast("string"))).withColumn(own_id, F.col("doc_id").cast("bigint"))
    d, k = keyed.alias("d"), first.alias("k")
    same = (F.col(f"d.{key}") == F.col(f"k.{key}")) & F.col(f"d.{own_id}").eqNullSafe(F.col(f"k.{own_id}"))
    kept = d.join(k, same, "left_semi")
    copies = rows.groupBy("doc_id", "text_key").count().where("count > 1")
    if not copies.isEmpty():
        kept = kept.dropDuplicates([own_id, key])
    return kept.select(*[quoted(c) for c in docs.columns])
