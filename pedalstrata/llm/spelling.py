"""Spelling variants: words that differ by one edit, found by pivotal grams, and the form each goes to.

1. Words are counted over all texts. Their bigrams are ranked, rare first; there are some eight
   thousand possible ones, so ranks travel with the tasks.
2. A word's prefix are its three rarest bigrams, with their places, and further places of the
   third. Its pivots are two of them that don't overlap, of least total frequency, chosen by
   dynamic programming. Some two of any three bigrams don't overlap.
3. One edit can hit one pivot only. Of two near words, let r be the one whose prefix ends at the rarer
   bigram, or any at a tie. A pivot of r that the edit leaves alone is in the prefix of the other.
   What lies on one side of it is the same in both words, so its place is the same from one end. Pivots
   therefore meet the other words' prefixes at equal bigrams, in equal places from that end, with an
   equal rest of the word on that side: one key. Lengths differ by one at most.
4. Pairs that meet are verified by edit distance.

A bucket of more than ``BUCKET`` words, of a common bigram near the end that it is placed from, is not
paired as a whole. It is split, exactly: the edit lies in the rest of the word, on the pivot's other
side, and the rests are equal on both sides of it. Each word of the bucket gets a key for every place
of its rest where a code point may be left out or let in, and only pivots and prefixes that are equal
around one place meet: at most one per letter. Words of more than ``LONG`` code points, which can be in
as many crowded buckets as they have letters, get such keys once, for the whole word.

The form of a word is its near word of largest count, if that is ``RATIO`` times its own or more. Forms
are followed to the last by doubling; counts grow at each step, so there are no circles.

Words are runs of ASCII letters and U+00C0 to U+00FF (with the two signs among them), with A-Z in lower
case. Edge cases: null and empty texts have no words; repeated rows count as often as they occur; a
null ``doc_id`` is written as an empty text where it is hashed; words may be of any length. Other columns
are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from xxhash import xxh64

from pedalstrata.llm.common import join_keyed
from pedalstrata.llm.encoding import slices
from pedalstrata.sources.staging import discard, stage

LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
DROP = 31  # one in so many runs loses a letter, by hash
GRAM = 2
PREFIX = GRAM + 1
BUCKET = 64  # more pairs a word than that cost more than its keys
LONG = 64
BATCH_BYTES = 1_000_000
HELD = 200_000  # counts that a task holds before it gives them out

_RUN = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}")


def counted(docs: DataFrame, drop: int = DROP) -> DataFrame:
    """``word`` and ``n``: all words of enough letters and occurrences, one in ``drop`` runs damaged."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for whole in batches:
            for batch in slices(whole, "text", BATCH_BYTES):
                for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                    # Lower-casing bytes leaves all but A-Z alone.
                    for run in _RUN.findall((text or "").encode().lower().decode()):
                        h = zlib.crc32(run.encode(), start)
                        if h % drop == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1 :]
                            if len(run) < LEAST_LENGTH:
                                continue
                        counts[run] += 1
                if len(counts) > HELD:
                    yield _rows(counts)
                    counts.clear()
        yield _rows(counts)

    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    parts = texts.mapInArrow(count, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _rows(counts: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"word": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})


def gram_counts(words: DataFrame) -> dict[str, int]:
    """How often each bigram is in ``words``. There are no more bigrams than pairs of letters."""
    places = F.sequence(F.lit(1), F.length("word") - (GRAM - 1))
    grams = F.transform(places, lambda i: F.substring(F.col("word"), i, F.lit(GRAM)))
    return {r.gram: r["count"] for r in words.where(F.length("word") >= GRAM).select(F.explode(grams).alias("gram")).groupBy("gram").count().collect()}


def cheapest_disjoint(places: Sequence[int], costs: Sequence[int], count: int = 2) -> list[int]:
    """Which of the ascending ``places`` to take for ``count`` grams that don't overlap, at least cost."""
    # best[k]: cost and choice of k grams among those that end before the place in hand.
    best: list[list[tuple[float, list[int]]]] = [[(0, [])] + [(float("inf"), [])] * count]
    for i, place in enumerate(places):
        before = max((j + 1 for j in range(i) if places[j] + GRAM <= place), default=0)
        row = best[-1][:]
        for k in range(1, count + 1):
            cost, chosen = best[before][k - 1]
            row[k] = min(row[k], (cost + costs[i], [*chosen, i]))
        best.append(row)
    return best[-1][count][1]


def _side_hashes(word: str, places: Sequence[int], step: int) -> list[int]:
    """A hash of the part of the word before each of the ascending places; ``step`` -1 reads it from its end."""
    h, at, out = xxh64(seed=step + 2), 0, []
    whole = word[::step]
    for place in places:
        h.update(whole[at:place].encode())
        at = place
        out.append(h.intdigest())
    return out


def _signed(h: int) -> int:
    return h - 2**64 if h >= 2**63 else h


def prefix(word: str, ranks: dict[str, int]) -> list[int]:
    """Ascending places of the three rarest bigrams, and of all others like the third."""
    order = [ranks[word[i : i + GRAM]] for i in range(len(word) - GRAM + 1)]
    last = sorted(order)[PREFIX - 1]
    return [i for i, r in enumerate(order) if r <= last]


def pivots(word: str, places: Sequence[int], ranks: dict[str, int], counts: dict[str, int]) -> set[int]:
    """Places of the two pivots, among the three rarest bigrams."""
    first = sorted(sorted(places, key=lambda i: (ranks[word[i : i + GRAM]], i))[:PREFIX])
    chosen = cheapest_disjoint(first, [counts[word[i : i + GRAM]] for i in first])
    return {first[i] for i in chosen}


def _keyed(words: DataFrame) -> DataFrame:
    """Per bigram of a prefix and side of it: ``key``, ``id``, ``length``, ``last``, ``pivot``, and where the
    rest of the word is: its first ``cut`` code points, or what follows the first -``cut``."""
    counts = gram_counts(words)
    ranks = {g: i for i, (g, _) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0])))}

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "word", BATCH_BYTES // 10):
                out: tuple[list, ...] = ([], [], [], [], [], [])
                for id_, word in zip(batch.column("id").to_pylist(), batch.column("word").to_pylist(), strict=True):
                    places = prefix(word, ranks)
                    chosen = pivots(word, places, ranks, counts)
                    last = max(ranks[word[i : i + GRAM]] for i in places)
                    left = _side_hashes(word, [i + GRAM for i in places], 1)
                    right = _side_hashes(word, [len(word) - i for i in reversed(places)], -1)[::-1]
                    for i, a, b in zip(places, left, right, strict=True):
                        for h, cut in ((a, -i - GRAM), (b, i)):
                            for column, value in zip(out, (_signed(h), id_, len(word), last, i in chosen, cut), strict=True):
                                column.append(value)
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int32())
                names = ("key", "id", "length", "last", "pivot", "cut")
                yield pa.RecordBatch.from_pydict({n: pa.array(c, t) for n, c, t in zip(names, out, types, strict=True)})

    return words.select("id", "word").mapInArrow(keys, "key bigint, id bigint, length int, last int, pivot boolean, cut int")


def _around(rests: DataFrame) -> DataFrame:
    """``key``, ``id`` and ``pivot`` for every place of a ``rest`` where a code point may be left out or let in.

    Keys of rests in different buckets (the ``key`` of ``rests``) differ.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "rest", BATCH_BYTES // 10):
                counts, out = [], []
                for bucket, rest in zip(batch.column("key").to_pylist(), batch.column("rest").to_pylist(), strict=True):
                    n = len(rest)
                    left = _side_hashes(rest, range(n + 1), 1)
                    right = _side_hashes(rest, range(n + 1), -1)  # of the last so many letters
                    for i in range(n + 1):
                        out.append(_signed(xxh64(f"{bucket} {left[i]} {right[n - i]}").intdigest()))
                        if i < n:
                            out.append(_signed(xxh64(f"{bucket} {left[i]} {right[n - i - 1]}").intdigest()))
                    counts.append(2 * n + 1)
                row = pa.array(np.repeat(np.arange(len(counts)), counts))
                kept = {c: batch.column(c).take(row) for c in ("id", "pivot")}
                yield pa.RecordBatch.from_pydict({"key": pa.array(out, pa.int64())} | kept)

    return rests.select("key", "id", "pivot", "rest").mapInArrow(keys, "key bigint, id bigint, pivot boolean")


def _pair(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _shared(keyed: DataFrame) -> DataFrame:
    """Keys of several rows, a pivot among them, and their number ``n``."""
    counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count_if("pivot").alias("pivots"))
    return counts.where("n > 1 AND pivots > 0").select("key", "n")


def _met(members: DataFrame, alike: Column) -> DataFrame:
    """Pairs of a pivot and a prefix that share a key."""
    x, y = members.where("pivot").alias("x"), members.alias("y")
    meet = (F.col("x.key") == F.col("y.key")) & (F.col("x.id") != F.col("y.id")) & alike
    return x.join(y, meet).select(*_pair(F.col("x.id"), F.col("y.id")))


def near_pairs(words: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``a`` and ``b``: ids of all words one edit apart, once each. ``words`` has ``id`` and ``word``; stored.

    Words need ``LEAST_LENGTH`` code points (four would do for the method).
    """
    keyed = stage(_keyed(words))
    sizes = _shared(keyed)
    sizes = stage(sizes.select("key", "n", (F.col("n") > bucket).alias("crowd")))
    members = stage(join_keyed(keyed, sizes, ["key"], "n"))
    alike = (F.col("x.last") <= F.col("y.last")) & (F.abs(F.col("x.length") - F.col("y.length")) <= 1)
    found = _met(members.where("NOT crowd"), alike)

    crowded = members.where("crowd")
    rest = F.when(F.col("cut") < 0, F.expr("substr(word, 1 - cut)")).otherwise(F.expr("substr(word, 1, cut)"))
    rests = crowded.where(F.col("length") <= LONG + 1).join(words, "id").select("key", "id", "pivot", rest.alias("rest"))
    long = crowded.where(F.col("length") >= LONG).select("id").distinct().join(words, "id")
    whole = long.select(F.lit(0).cast("bigint").alias("key"), "id", F.lit(True).alias("pivot"), F.col("word").alias("rest"))
    # At most one word per letter and bucket has a key, so a window over it is small.
    of_key = Window.partitionBy("key")
    counted = _around(rests.unionByName(whole)).select("*", F.count(F.lit(1)).over(of_key).alias("n"), F.count_if("pivot").over(of_key).alias("pivots"))
    split = stage(counted.where("n > 1 AND pivots > 0").select("key", "id", "pivot"))
    candidates = found.unionByName(_met(split, F.lit(True))).distinct()

    one, two = (words.select(F.col("id").alias(c), F.col("word").alias(f"word_{c}")) for c in "ab")
    met = candidates.join(one, "a").join(two, "b")
    out = stage(met.where(F.levenshtein("word_a", "word_b", 1) == 1).select("a", "b"))
    for used in (keyed, sizes, members, split):
        discard(used)
    return out


def forms(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """``words`` (``id``, ``word``, ``n``) with ``form``, ``form_n``, ``n_near`` and ``root``."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    other = words.select(F.col("id").alias("b"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = both.join(other, "b").groupBy("a").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other", "b")).alias("best")
    )
    found = words.join(best.withColumnRenamed("a", "id"), "id", "left").withColumn("n_near", F.coalesce("n_near", F.lit(0)).cast("bigint"))
    has = -F.col("best.less") >= RATIO * F.col("n")
    picked = [F.when(has, c).alias(n) for c, n in ((F.col("best.other"), "form"), (-F.col("best.less"), "form_n"), (F.col("best.b"), "next"))]
    formed = stage(found.select("id", "word", "n", "n_near", *picked))
    # Each step follows as many forms as all steps before it.
    ways = stage(formed.where("next IS NOT NULL").select("id", "next", F.col("form").alias("last")))
    while True:
        on = ways.select(F.col("id").alias("via"), F.col("next").alias("to"), F.col("last").alias("end"))
        longer = ways.join(on, F.col("next") == F.col("via"), "left")
        followed = stage(longer.select("id", F.coalesce("to", "next").alias("next"), F.coalesce("end", "last").alias("last"), F.col("to").isNotNull().alias("moved")))
        if followed.where("moved").isEmpty():
            break
        ways = followed.drop("moved")
    return formed.join(ways.select("id", "last"), "id", "left").select(
        "word", "form", F.coalesce("last", "word").alias("root"), "n", "n_near", "form_n"
    )


def numbered(words: DataFrame) -> DataFrame:
    """``words`` with a stored ``id``."""
    return stage(words.withColumn("id", F.monotonically_increasing_id()))
