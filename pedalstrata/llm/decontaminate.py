"""Benchmark decontamination by spaced-seed hashing, in DataFrame operations only.

Words are the runs of letters and digits of the lower-cased text. A mask names the positions of
a short window that count; the other positions are ignored, so a word replaced there does not
change the hash. Every window of a benchmark item and of a document is hashed under each
mask, equal hashes are joined, and each hit is verified in place: the item is laid over the
document at the hit's offset, and the hit stands if some run of ``window`` words agrees in all
but ``tolerance`` places. What is verified is the words' 64-bit hashes.

The two masks find every such run: for 2 differing words in 12 or 13, or 1 in 8 to 11,
wherever they lie, one mask at one place misses none of its positions. Items of fewer than
``EXACT_BELOW`` words must occur exactly; windows of their own length are hashed for that.

Documents are only scanned: hashes meet the benchmark's, which are broadcast in blocks of a
bounded number of words (a larger benchmark takes more blocks, each one pass over the documents).
A hash travels with the number of its item and its place in it; the words of an item, which a
hit is verified on, travel once per block. One row per (document, item) pair is shuffled from each task.

Edge cases: null, empty or wordless texts and items match nothing. Items with the same words are
looked for once and reported under each of their ids, a null one too. Rows of equal ``doc_id`` are one
document as to pairs; a null ``doc_id`` is reported as null. ``clean`` judges each row by its own
text. Extra columns are ignored in pairs and kept by ``clean``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalstrata.llm.common import free_name, quoted, running_totals
from pedalstrata.sources.staging import stage

MASKS = ((0, 1, 2, 3, 5), (0, 1, 4, 5, 6))
WINDOW = 13
EXACT_BELOW = 8
#: Words of the items broadcast at a time, or one longer item: two hashes a word at about 100 bytes
#: each in the executors' join table, and the word itself.
BLOCK_WORDS = 100_000


def tolerance(words: Column) -> Column:
    """Words that may differ in a run of so many."""
    return F.when(words >= 12, 2).when(words >= EXACT_BELOW, 1).otherwise(0)


def word_hashes(text: Column) -> Column:
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _windows(h: Column, number: int, mask: tuple[int, ...]) -> Column:
    """Hash of every window under one mask, in order of position."""
    n = F.size(h) - F.lit(mask[-1])
    starts = F.slice(h, F.lit(1), F.greatest(n, F.lit(0)))
    return F.transform(starts, lambda w, i: F.xxhash64(F.lit(number), w, *[F.get(h, i + p) for p in mask[1:]]))


def benchmark_items(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """Distinct items that have words, and their ids.

    The first has ``item_no``, word hashes ``item`` and the ``block`` it is broadcast in, the second ``item_no`` and
    ``item_id``. Both are stored.
    """
    given = benchmark.select(F.col("item_id").cast("bigint"), word_hashes(F.col("text")).alias("item"))
    given = stage(given.where(F.size("item") > 0).distinct())
    items = stage(given.select("item").distinct().withColumn("item_no", F.monotonically_increasing_id()))
    sized = running_totals(items.withColumn("words", F.size("item")), [], ["item_no"], "words", "before")
    blocked = stage(sized.select("item_no", "item", F.expr(f"before div {block_words}").alias("block")))
    return blocked, stage(given.join(items, "item").select("item_no", "item_id"))


def item_seeds(items: DataFrame, masks: dict[int, tuple[int, ...]]) -> DataFrame:
    """``seed`` of every window of every item, with ``item_no``, ``item_at`` and ``block``."""
    n = F.size("item")
    return reduce(
        DataFrame.unionByName,
        [
            items.where(n >= EXACT_BELOW if number < len(MASKS) else n == len(mask)).select(
                "item_no", "block", F.posexplode(_windows(F.col("item"), number, mask)).alias("item_at", "seed")
            )
            for number, mask in masks.items()
        ],
    )


def _verified(h: Column, item: Column, shift: Column) -> tuple[Column, Column, Column]:
    """Words that agree where the item lies ``shift`` words into the document; those of the best
    run; and the length of a run."""
    low, high = F.greatest(F.lit(0), -shift), F.least(F.size(item), F.size(h) - shift)
    same = F.transform(
        F.slice(item, low + 1, F.greatest(high - low, F.lit(0))),
        lambda w, i: (w == F.get(h, shift + low + i)).cast("int"),
    )
    run = F.least(F.size(item), F.lit(WINDOW))
    # Running sums, so that a run's agreements are one difference.
    sums = F.aggregate(same, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    best = F.transform(
        F.array(sums),
        lambda s: F.array_max(
            F.transform(
                F.slice(s, run + 1, F.greatest(F.size(s) - run, F.lit(0))), lambda x, i: x - F.get(s, i)
            )
        ),
    )
    return F.aggregate(same, F.lit(0), lambda a, x: a + x), F.coalesce(best[0], F.lit(0)), run


def _hits(docs: DataFrame, items: DataFrame, keys: list[str]) -> DataFrame:
    """Every verified hit: ``keys`` of ``docs``, ``item_no``, and what was found."""
    short = [r[0] for r in items.where(F.size("item") < EXACT_BELOW).select(F.size("item")).distinct().collect()]
    masks = dict(enumerate([*MASKS, *(tuple(range(n)) for n in sorted(short))]))
    seeds = item_seeds(items, masks)
    blocks = (items.agg(F.max("block")).first()[0] or 0) + 1
    h = free_name(docs, "h")
    hashed = docs.select(*keys, word_hashes(F.col("text")).alias(h))
    every = F.concat(*[_windows(F.col(h), number, mask) for number, mask in masks.items()])
    windows = hashed.select(*keys, h, F.posexplode(every).alias("at", "seed"))
    # Windows of all masks lie in one list: the position under its own mask.
    sizes = [F.greatest(F.size(h) - F.lit(m[-1]), F.lit(0)) for m in masks.values()]
    found = []
    for block in range(blocks):
        own = seeds.where(F.col("block") == block).drop("block")
        texts = items.where(F.col("block") == block).select("item_no", "item")
        found.append(windows.join(F.broadcast(own), "seed").join(F.broadcast(texts), "item_no"))
    hit = reduce(DataFrame.unionByName, found)
    place, before = F.lit(0), F.lit(0)
    for size in sizes:
        place = F.when(F.col("at") >= before, F.col("at") - before).otherwise(place)
        before = before + size
    hit = hit.withColumn("shift", place - F.col("item_at"))
    agree, best, run = _verified(F.col(h), F.col("item"), F.col("shift"))
    out = hit.select(
        *keys,
        "item_no",
        F.size("item").cast("bigint").alias("item_words"),
        agree.cast("bigint").alias("agreeing_words"),
        best.alias("best"),
        run.alias("run"),
        F.col("shift").cast("bigint").alias("shift"),
    )
    return out.where(F.col("best") >= F.col("run") - tolerance(F.col("run")))


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id``, ``item_id``, ``item_words``, and of the best place ``agreeing_words`` and ``first_word``.

    ``first_word`` is the word of the document that the item's first word lies on (negative if
    the document has only a later part of the item).
    """
    items, ids = benchmark_items(benchmark, block_words)
    hits = _hits(docs.select(F.col("doc_id").cast("bigint"), "text"), items, ["doc_id"])
    best = F.max(F.struct("agreeing_words", (-F.col("shift")).alias("back"))).alias("b")
    placed = hits.groupBy("doc_id", "item_no", "item_words").agg(best)
    return placed.join(ids, "item_no").select(
        "doc_id", "item_id", "item_words", F.col("b.agreeing_words").alias("agreeing_words"), (-F.col("b.back")).alias("first_word")
    )


def clean(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark passage, with all their columns.

    Rows are recognised by a hash of their text, which is all that the verdict depends on.
    """
    key = free_name(docs, "text_key")
    keyed = docs.withColumn(key, F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    bad = _hits(keyed.select(key, "text"), benchmark_items(benchmark, block_words)[0], [key]).select(key).distinct()
    return keyed.join(bad, key, "left_anti").select(*[quoted(c) for c in docs.columns])
