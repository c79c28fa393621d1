"""Toxicity from class-conditional Kneser-Ney models of words with shared backoff counts.

A word is its letters, lower-cased, and a closing blank; a model gives each character a probability
after up to ``ORDER`` - 1 characters of the same word. Three tables count runs of ``ORDER``
characters: one over all documents, one over labelled toxic and one over labelled ordinary
documents. The first, with its continuation counts, is an interpolated Kneser-Ney model; it is
what both class models back off to, so an expression that is rare in both classes says nothing
either way. A word scores the difference of its log-likelihoods under the two class models. A
text's mean per character, its highest word scores and its length go through a logistic curve.

Bounds, all documented parameters: class counts and curve are fitted on ``SAMPLE`` labelled rows
per class, picked by a hash; three of four folds are counted, the fourth fits the curve. Counts
over the corpus cover all documents and grow with it; all of them enter every order's continuation
counts, totals and kinds, which Spark aggregates. Only what the class tables ask for comes to the
driver, and these are as large as the sample makes them.

Edge cases: a null or wordless text has score features of zero. Several labels of a document count
as toxic if one is; null labels are ignored. A null ``doc_id`` counts as an empty one for the fold
and has no label. Without rows of both classes every score is 0. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalstrata.llm import textcodes
from pedalstrata.llm.common import fold
from pedalstrata.llm.encoding import Store, slices
from pedalstrata.sources.staging import stage

ORDER = 6
BITS = 10  # per character in a packed run
SAMPLE = 20_000
DISCOUNT = 0.75  # of the corpus model
CLASS_DISCOUNT = 3.0  # what a class must show beyond chance before it departs from the corpus
BATCH_BYTES = 1_000_000
HELD_ROWS = 3_000_000
FEATURES = ("mean", "top", "top2", "top4", "log_words")


def _stream(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, textcodes.Words]:
    """Packed runs that end at each character, the characters' words, each word's first character,
    and the words. Runs reach back no further than their word; blanks fill what is missing."""
    w = textcodes.words(texts, least=2)
    size = w.lengths + 1
    first = np.cumsum(size) - size
    word = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(word)) - np.repeat(first, size)
    codes = w.codes[np.minimum(place + np.repeat(w.starts, size), len(w.codes) - 1)].astype(np.int64)
    # Latin letters as they are, all others into as many codes again.
    half = 1 << (BITS - 1)
    codes = np.where(codes < half, codes, half + codes * 40503 % half)
    codes[place == np.repeat(w.lengths, size)] = 32
    runs = np.zeros(len(codes), np.int64)
    for back in range(ORDER - 1, -1, -1):
        before = np.concatenate([np.full(min(back, len(codes)), 32), codes[: len(codes) - back]])
        runs = (runs << BITS) | np.where(place >= back, before, 32)
    return runs, word, first, w


def _tally(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    runs = np.concatenate([r for r, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    order = np.argsort(runs)
    runs = runs[order]
    heads = np.flatnonzero(np.concatenate([[True], runs[1:] != runs[:-1]])) if len(runs) else np.empty(0, np.int64)
    return runs[heads], np.add.reduceat(counts[order], heads) if len(heads) else counts


def _unique(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    runs = np.sort(runs)
    heads = np.flatnonzero(np.concatenate([[True], runs[1:] != runs[:-1]])) if len(runs) else np.empty(0, np.int64)
    return runs[heads], np.diff(heads, append=len(runs))


def counted(docs: DataFrame) -> DataFrame:
    """``model``, ``run``, ``n``: runs of all documents (model -1) and of those with ``toxic`` 0 or 1."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {-1: [], 0: [], 1: []}

        def give(model: int) -> pa.RecordBatch:
            runs, n = _tally(held[model])
            held[model] = []
            return pa.RecordBatch.from_pydict({"model": pa.array(np.full(len(runs), model, np.int32)), "run": pa.array(runs), "n": pa.array(n)})

        for whole in batches:
            for batch in slices(whole, "text", BATCH_BYTES):
                runs, word, _, w = _stream(batch.column("text").to_pylist())
                toxic = np.array(batch.column("toxic").fill_null(-1).to_pylist(), np.int64)[w.text][word]
                held[-1].append(_unique(runs))
                for model in (0, 1):
                    if (own := toxic == model).any():
                        held[model].append(_unique(runs[own]))
                for model, parts in held.items():
                    if sum(len(r) for r, _ in parts) > HELD_ROWS:
                        held[model] = [_tally(parts)]
                        if len(held[model][0][0]) > HELD_ROWS // 2:
                            yield give(model)
        for model, parts in held.items():
            if parts:
                yield give(model)

    pieces = docs.select("text", "toxic").mapInArrow(count, "model int, run bigint, n bigint")
    return pieces.groupBy("model", "run").agg(F.sum("n").alias("n"))


def _at(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(known):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return at, known[at] == wanted


@dataclass
class ClassCounts:
    """Kept runs of a class, ascending, with their counts and the totals of their contexts."""

    runs: np.ndarray
    counts: np.ndarray
    totals: np.ndarray

    def __post_init__(self) -> None:
        self.own = np.maximum(self.counts - CLASS_DISCOUNT, 0.0) / np.maximum(self.totals, 1.0)
        context = self.runs >> BITS
        heads = np.flatnonzero(np.diff(context, prepend=-1))
        self.contexts = context[heads]
        self.left = 1.0 - np.add.reduceat(self.own, heads) if len(heads) else self.own

    def weight_left(self, contexts: np.ndarray) -> np.ndarray:
        """What a context leaves to the shared model: all, if the class kept no run of it."""
        at, seen = _at(self.contexts, contexts)
        return np.where(seen, self.left[at], 1.0) if len(self.contexts) else np.ones(len(contexts))

    def backed_off(self, runs: np.ndarray, shared: np.ndarray) -> np.ndarray:
        at, seen = _at(self.runs, runs)
        own = np.where(seen, self.own[at], 0.0) if len(self.runs) else 0.0
        return own + self.weight_left(runs >> BITS) * shared


@dataclass
class Counts:
    """Runs of one order, ascending, with their counts, and their contexts' totals and kinds.

    ``distinct`` is the number of all runs of the order, of which these may be a part.
    """

    runs: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    totals: np.ndarray
    kinds: np.ndarray
    distinct: int

    @classmethod
    def of(cls, runs: np.ndarray, counts: np.ndarray) -> Counts:
        """From all runs of the order."""
        context = runs >> BITS
        heads = np.flatnonzero(np.diff(context, prepend=-1))
        totals = np.add.reduceat(counts, heads) if len(heads) else counts
        return cls(runs, counts, context[heads], totals, np.diff(heads, append=len(runs)), len(runs))

    def backed_off(self, runs: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Interpolated probability of each run's last character, given that of the lower order."""
        share, kept = self.kept(runs >> BITS)
        at, seen = _at(self.runs, runs)
        own = np.where(seen, np.maximum(self.counts[at] - DISCOUNT, 0.0), 0.0) if len(self.runs) else 0.0
        return own * share + kept * lower

    def kept(self, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One over the total of each context (0 if unseen), and the weight left to the lower order."""
        at, seen = _at(self.contexts, contexts)
        if not len(self.contexts):
            return np.zeros(len(contexts)), np.ones(len(contexts))
        share = np.where(seen, 1.0 / self.totals[at], 0.0)
        return share, np.where(seen, DISCOUNT * self.kinds[at] * share, 1.0)


def shared_levels(runs: np.ndarray, counts: np.ndarray) -> list[Counts]:
    """The corpus model by order, lowest first; lower orders hold continuation counts."""
    levels = [Counts.of(runs, counts.astype(float))]
    for n in range(ORDER - 1, 0, -1):
        shorter, kinds = _unique(levels[0].runs & ((1 << (BITS * n)) - 1))
        levels.insert(0, Counts.of(shorter, kinds.astype(float)))
    return levels


def wanted_levels(corpus: DataFrame, wanted: DataFrame) -> list[Counts]:
    """The levels of ``corpus`` (``run``, ``n``; all of it), with the entries that ``wanted`` runs need."""
    context = F.shiftright("run", BITS).alias("context")
    levels: list[Counts] = []
    level = corpus
    for n in range(ORDER, 0, -1):
        if n < ORDER:
            level = stage(level.groupBy(F.col("run").bitwiseAND(F.lit((1 << (BITS * n)) - 1)).alias("run")).agg(F.count(F.lit(1)).alias("n")))
        own = wanted.select(F.col("run").bitwiseAND(F.lit((1 << (BITS * n)) - 1)).alias("run")).distinct()
        runs = level.join(own, "run", "left_semi").select("run", "n").toArrow().sort_by("run")
        sums = level.groupBy(context).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        sums = sums.join(own.select(context).distinct(), "context", "left_semi").select("context", "total", "kinds")
        sums = sums.toArrow().sort_by("context")
        levels.insert(
            0,
            Counts(
                runs["run"].to_numpy(),
                runs["n"].to_numpy().astype(float),
                sums["context"].to_numpy(),
                sums["total"].to_numpy().astype(float),
                sums["kinds"].to_numpy(),
                level.count(),
            ),
        )
    return levels


def shared_probability(levels: list[Counts], runs: np.ndarray) -> np.ndarray:
    p = np.full(len(runs), 1.0 / (levels[0].distinct + 1))
    for n, level in enumerate(levels, start=1):
        p = level.backed_off(runs & ((1 << (BITS * n)) - 1), p)
    return p


@dataclass
class Model:
    """What a run, or failing that its context, adds to toxic minus ordinary log-likelihood."""

    runs: np.ndarray
    run_scores: np.ndarray
    contexts: np.ndarray
    context_scores: np.ndarray

    def lookup(self) -> Lookup:
        return Lookup(self)


class Lookup:
    def __init__(self, model: Model) -> None:
        self.tables = []
        for keys, scores in ((model.runs, model.run_scores), (model.contexts, model.context_scores)):
            store = Store(max(10, int(2 * len(keys)).bit_length()))
            store.add(self._hash(keys), np.arange(len(keys), dtype=np.int32))
            # The last entry is what an unknown key gets.
            self.tables.append((store, np.append(scores, 0.0)))

    @staticmethod
    def _hash(keys: np.ndarray) -> np.ndarray:
        return np.maximum(textcodes.mix(keys.astype(np.uint64) + np.uint64(1)), np.uint64(1))

    def scores(self, runs: np.ndarray) -> np.ndarray:
        store, scores = self.tables[0]
        number = store.find(self._hash(runs))
        out = scores[number]
        unknown = np.flatnonzero(number < 0)
        store, scores = self.tables[1]
        out[unknown] = scores[store.find(self._hash(runs[unknown] >> BITS))]
        return out


def build(shared: tuple[np.ndarray, np.ndarray], ordinary: ClassCounts, toxic: ClassCounts) -> Model:
    """A model from the corpus's (ascending runs, counts) and both classes."""
    return compared(shared_levels(*shared), ordinary, toxic)


def compared(levels: list[Counts], ordinary: ClassCounts, toxic: ClassCounts) -> Model:
    """A model from the corpus's levels and both classes."""
    runs = np.union1d(ordinary.runs, toxic.runs)
    contexts = np.union1d(ordinary.contexts, toxic.contexts)
    below = shared_probability(levels, runs)
    of_run = [np.log(np.maximum(c.backed_off(runs, below), 1e-12)) for c in (ordinary, toxic)]
    of_context = [np.log(np.maximum(c.weight_left(contexts), 1e-9)) for c in (ordinary, toxic)]
    return Model(runs, of_run[1] - of_run[0], contexts, of_context[1] - of_context[0])


def features(texts: list[str | None], lookup: Lookup) -> np.ndarray:
    """Columns ``FEATURES`` of each text."""
    runs, _, first, w = _stream(texts)
    out = np.zeros((w.n_texts, len(FEATURES)))
    if not len(runs):
        return out
    score = np.add.reduceat(lookup.scores(runs), first)
    bounds = w.bounds()
    n = np.diff(bounds)
    has = n > 0
    begin = bounds[:-1][has]
    out[has, 0] = np.add.reduceat(score, begin) / np.add.reduceat(w.lengths + 1, begin)
    ranked = score[np.lexsort((-score, w.text))]
    for i, shares in enumerate(((1.0, 0.5, 0.25), (0.0, 0.5, 0.25), (0.0, 0.0, 0.25), (0.0, 0.0, 0.25))):
        enough = n > i
        out[enough, 1:4] += ranked[bounds[:-1][enough] + i][:, None] * np.array(shares)
    out[:, 4] = np.log1p(n)
    return out


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Logistic regression with an intercept, by damped Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    weights = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ weights)
        weights += step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
    return weights


def labelled_sample(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id`` and ``toxic`` of at most ``sample`` rows per class, never of held-out documents."""
    one = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    known = one.agg(F.max("toxic").cast("int").alias("toxic")).where(fold(F.col("doc_id"), 5) != 0)
    pick = lambda c: known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    return pick(0).unionByName(pick(1))


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document."""
    picked = F.broadcast(stage(labelled_sample(labels, sample)))  # at most 2 x sample rows
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string").alias("text")).join(picked, "doc_id", "left")
    for_curve = fold(F.col("doc_id"), 5) == 4
    counts = stage(counted(rows.withColumn("toxic", F.when(~for_curve, F.col("toxic")))))
    context = F.shiftright("run", BITS).alias("context")
    of_class = counts.where("model >= 0")
    contexts = of_class.groupBy("model", context).agg(F.sum("n").alias("context_total"))
    # Bounded by the sample.
    own = stage(of_class.where(F.col("n") > CLASS_DISCOUNT).select("*", context).join(contexts, ["model", "context"]))
    levels = wanted_levels(counts.where("model = -1").select("run", "n"), own.select("run").distinct())
    tables = [own.where(F.col("model") == c).select("run", "n", "context_total").toArrow().sort_by("run") for c in (0, 1)]
    model = compared(
        levels,
        *[ClassCounts(t["run"].to_numpy(), *(t[c].to_numpy().astype(float) for c in ("n", "context_total"))) for t in tables],
    )
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = None
        for whole in batches:
            for batch in slices(whole, "text", BATCH_BYTES):
                lookup = lookup or sent.value.lookup()
                x = features(batch.column("text").to_pylist(), lookup)
                columns = {"doc_id": batch.column("doc_id"), "toxic": batch.column("toxic")}
                yield pa.RecordBatch.from_pydict(columns | {f: pa.array(x[:, i]) for i, f in enumerate(FEATURES)})

    schema = "doc_id bigint, toxic int, " + ", ".join(f"{f} double" for f in FEATURES)
    measured = stage(rows.mapInArrow(score, schema))
    known = measured.where(F.col("toxic").isNotNull() & for_curve).dropDuplicates(["doc_id"]).toPandas()  # part of the sample
    if known.toxic.nunique() == 2 and all(t.num_rows for t in tables):
        weights = fit_curve(known[list(FEATURES)].to_numpy(), known.toxic.to_numpy(float)).tolist()
        logit = F.lit(weights[0])
        for f, weight in zip(FEATURES, weights[1:], strict=True):
            logit = logit + F.lit(weight) * F.col(f)
        value = 1 / (1 + F.exp(-logit))
    else:
        value = F.lit(0.0)
    return measured.select(
        "doc_id",
        (fold(F.col("doc_id"), 5) == 0).alias("held_out"),
        value.cast("double").alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
