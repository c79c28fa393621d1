"""Language identification by a linear-chain conditional random field over words.

A word is a run of letters. Its emission score for a language sums learned weights of its character
runs of one to four characters, start and end of the word included (so prefixes and suffixes are
runs of their own), and of the word itself if it was learned (lexicon). Learned transition weights
tie each word's language to the one before in the same line, so a line may switch languages.
Forward-backward gives every word its distribution over languages; a text's language is the one
with most expected words, and its score the share of these. Its evidence is the mean, over words, of
the emission score of that language less the mean of the others': a share says which language is
likeliest, the evidence whether it is any. With a single learned language all evidence is 0.

Weights are fitted on whole texts of at most ``SAMPLE`` labelled documents per language, picked by
a hash of the document id, with the document's language on every word. Lines of different documents
are spliced at random, so that transitions between languages are seen too.

Edge cases: a text that is null or has no letter is ``und`` with score 0. Rows with a null language
or document id are not learned from. Equal document ids count once for learning. Without any
labelled row every text is ``und``. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pedalstrata.llm import textcodes
from pedalstrata.llm.encoding import slices
from pedalstrata.operators.numbering import sequence_id_distributed
from pedalstrata.sources.staging import stage

SAMPLE = 200
LONGEST = 4
BUCKET_BITS = 18
SPLICED = 0.3
EPOCHS = 4
LEARNING_RATE = 0.3
SEED = 6
BATCH_BYTES = 250_000
UNKNOWN = "und"

_START, _STOP = 2, 3  # stand for the edges of a word
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


@dataclass
class Observed:
    """Feature buckets of the characters of all words (words back to back), and where lines begin."""

    buckets: list[np.ndarray]  # per run length, 0 where the run would leave the word
    lexicon: np.ndarray  # per word
    first: np.ndarray  # first character of each word
    scale: np.ndarray  # per word, one over the root of its number of features
    lines: np.ndarray  # first word of each line
    words: textcodes.Words


def observe(texts: list[str | None]) -> Observed:
    w = textcodes.words(texts, least=2)
    n = len(w.starts)
    size = w.lengths + 2
    first = np.cumsum(size) - size
    place = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(first, size)
    codes = w.codes[np.minimum(place + np.repeat(w.starts - 1, size), len(w.codes) - 1)].astype(np.uint32)
    codes[first] = _START
    codes[first + size - 1] = _STOP
    left = np.repeat(size, size) - place
    mixed, buckets = np.zeros(len(codes), np.uint32), []
    for k in range(LONGEST):
        ahead = np.concatenate([codes[k:], np.zeros(min(k, len(codes)), np.uint32)])
        mixed = (mixed ^ ahead) * _FACTORS[k]
        mixed ^= mixed >> np.uint32(15)
        bucket = (mixed * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - BUCKET_BITS)
        buckets.append(np.where(left > k, np.maximum(bucket, 1), 0).astype(np.int32))
    lexicon = (w.hashes() >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
    features = np.sum([np.maximum(size - k, 0) for k in range(LONGEST)], axis=0) + 1 if n else np.empty(0)
    # A line begins with a text or after a line break.
    breaks = np.cumsum(w.codes == 10)
    line = breaks[w.starts] if n else np.empty(0, np.int64)
    lines = np.flatnonzero(np.diff(line, prepend=-1))
    return Observed(buckets, lexicon, first, 1.0 / np.sqrt(features), lines, w)


@dataclass
class Model:
    languages: list[str]
    runs: np.ndarray  # buckets x languages
    lexicon: np.ndarray  # buckets x languages
    transitions: np.ndarray  # from x to
    start: np.ndarray

    def emissions(self, o: Observed) -> np.ndarray:
        if not len(o.first):
            return np.empty((0, len(self.languages)), np.float32)
        total = self.runs[o.buckets[0]]
        for b in o.buckets[1:]:
            total += self.runs[b]
        return (np.add.reduceat(total, o.first, axis=0) + self.lexicon[o.lexicon]) * o.scale[:, None].astype(np.float32)


def _steps(lines: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each place in a line: the words there, of the lines that are so long; longest lines first."""
    lengths = np.diff(lines, append=n)
    order = np.argsort(-lengths, kind="stable")
    begins, lengths = lines[order], lengths[order]
    longer = len(lengths) - np.searchsorted(lengths[::-1], np.arange(1, (lengths[0] if len(lengths) else 0) + 1))
    for t, many in enumerate(longer.tolist()):
        yield begins[:many] + t


def forward_backward(
    emission: np.ndarray, lines: np.ndarray, transitions: np.ndarray, start: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Each word's distribution over languages, and the expected transitions."""
    n = len(emission)
    near = np.exp(emission - emission.max(axis=1, keepdims=True)) + 1e-30
    step, begin = np.exp(transitions - transitions.max()), np.exp(start - start.max())
    steps = list(_steps(lines, n))
    alpha, beta = np.empty_like(near), np.empty_like(near)
    for t, at in enumerate(steps):
        a = (begin if t == 0 else alpha[at - 1] @ step) * near[at]
        alpha[at] = a / a.sum(axis=1, keepdims=True)
    for t in range(len(steps) - 1, -1, -1):
        at = steps[t]
        beta[at] = 1.0
        if t + 1 < len(steps):
            after = steps[t + 1]  # the words behind the first so many of these
            b = (near[after] * beta[after]) @ step.T
            beta[after - 1] = b / b.sum(axis=1, keepdims=True)
    marginal = alpha * beta
    marginal /= marginal.sum(axis=1, keepdims=True)
    inner = np.ones(n, bool)
    inner[lines] = False
    to = np.flatnonzero(inner)
    ahead = near[to] * beta[to]
    # Each transition's joint distribution sums to one.
    norm = ((alpha[to - 1] @ step) * ahead).sum(axis=1, keepdims=True)
    return marginal, step * (alpha[to - 1].T @ (ahead / norm))


def fit(
    texts: list[str], languages: list[str], epochs: int = EPOCHS, rate: float = LEARNING_RATE, seed: int = SEED
) -> Model:
    """Weights by stochastic gradient steps (AdaGrad) on the log-likelihood of the labels."""
    names = sorted(set(languages))
    k = len(names)
    model = Model(names, np.zeros((1 << BUCKET_BITS, k), np.float32), np.zeros((1 << BUCKET_BITS, k), np.float32), np.zeros((k, k)), np.zeros(k))
    squares = [np.full_like(x, 1e-2) for x in (model.runs, model.lexicon, model.transitions)]
    label = np.array([names.index(x) for x in languages])
    rng = np.random.default_rng(seed)
    chunk = 40
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), chunk):
            own = order[at : at + chunk]
            o = observe([texts[i] for i in own])
            if not len(o.first):
                continue
            truth = label[own][o.words.text]
            perm, lines = _spliced(o.lines, len(truth), rng)
            emission = model.emissions(o)
            marginal, expected = forward_backward(emission[perm].astype(float), lines, model.transitions, model.start)
            error = np.empty_like(marginal)
            error[perm] = marginal
            error[np.arange(len(truth)), truth] -= 1.0
            error = (error * o.scale[:, None]).astype(np.float32)
            seen = np.zeros((k, k))
            inner = np.ones(len(perm), bool)
            inner[lines] = False
            to = np.flatnonzero(inner)
            np.add.at(seen, (truth[perm[to - 1]], truth[perm[to]]), 1.0)
            per_char = np.repeat(error, np.diff(o.first, append=len(o.buckets[0])), axis=0)
            for weights, square, gradient in (
                (model.runs, squares[0], sum(_scatter(b, per_char) for b in o.buckets)),
                (model.lexicon, squares[1], _scatter(o.lexicon, error)),
                (model.transitions, squares[2], expected - seen + 0.1 * model.transitions),
            ):
                if weights is model.runs:
                    gradient[0] = 0.0  # stands for no run
                square += gradient * gradient
                weights -= rate * gradient / np.sqrt(square)
    return model


def _scatter(buckets: np.ndarray, errors: np.ndarray) -> np.ndarray:
    return np.stack(
        [np.bincount(buckets, errors[:, c], minlength=1 << BUCKET_BITS) for c in range(errors.shape[1])], axis=1
    ).astype(np.float32)


def _spliced(lines: np.ndarray, n: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """The words in an order in which some lines follow another line without a break."""
    lengths = np.diff(lines, append=n)
    order = rng.permutation(len(lines))
    size = lengths[order]
    begins = np.cumsum(size) - size
    perm = np.arange(n) + np.repeat(lines[order] - begins, size)
    kept = rng.random(len(order)) >= SPLICED
    kept[:1] = True
    return perm, begins[kept]


def labelled_sample(docs: DataFrame, held_out: Column, sample: int = SAMPLE) -> DataFrame:
    """``doc_id`` and ``lang`` of at most ``sample`` documents per language."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out).select(
        F.col("doc_id").cast("bigint"), "lang"
    )
    # A threshold on the hash leaves about twice the sample, so that few rows are ranked, whatever the input.
    share = F.lit(2.0 * sample) / F.col("of_lang")
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / F.lit(2.0**53)
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("of_lang"))  # one row per language
    few = known.join(F.broadcast(sizes), "lang").where(place < share).select("doc_id", "lang")
    order = Window.partitionBy("lang").orderBy(place, "doc_id")
    return few.withColumn("n", F.row_number().over(order)).where(F.col("n") <= sample).drop("n").dropDuplicates(["doc_id"])


def train(docs: DataFrame, held_out: Column, sample: int = SAMPLE) -> Model | None:
    """Fit on the driver: at most ``sample`` documents per language are brought there."""
    picked = F.broadcast(stage(labelled_sample(docs, held_out, sample)))
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string").alias("text"))
    rows = texts.join(picked, "doc_id").dropDuplicates(["doc_id"]).orderBy("doc_id").toPandas()
    return fit(rows["text"].fillna("").tolist(), rows["lang"].tolist()) if len(rows) else None


def told(texts: list[str | None], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each text that has words: its number, main language, that one's share of words, and evidence."""
    o = observe(texts)
    if not len(o.first):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0)
    emission = model.emissions(o)
    marginal, _ = forward_backward(emission, o.lines, model.transitions, model.start)
    bounds = o.words.bounds()
    has = np.flatnonzero(np.diff(bounds))
    at = np.arange(len(has))
    expected = np.add.reduceat(marginal, bounds[has], axis=0)
    best = expected.argmax(axis=1)
    share = np.clip(expected[at, best] / expected.sum(axis=1), 0.0, 1.0)
    mean = np.add.reduceat(emission.astype(float), bounds[has], axis=0) / np.diff(bounds)[has][:, None]
    own = mean[at, best]
    return has, best, share, own - (mean.sum(axis=1) - own) / max(1, len(model.languages) - 1)


def least_evidence(docs: DataFrame, held_out: Column, model: Model) -> float:
    """Half of what all but one in a hundred of the held-out labelled texts reach; 0 if there are none.

    All of them count. Their evidence is sorted in ranges, and two numbers come to the driver.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & held_out)
    found = evidence(known, model)
    ranked = sequence_id_distributed(found, ["evidence"], "n")
    place = 0.01 * (ranked.count() - 1)
    if place < 0:
        return 0.0
    near = ranked.where(F.col("n").isin(math.floor(place) + 1, math.ceil(place) + 1)).orderBy("n").collect()
    return max(0.0, 0.5 * float(np.interp(place, [r.n - 1 for r in near], [r.evidence for r in near])))


def evidence(docs: DataFrame, model: Model) -> DataFrame:
    """The ``evidence`` of each text that has words."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", BATCH_BYTES):
                found = told(batch.column("text").to_pylist(), sent.value)[3]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.float64())], names=["evidence"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(tell, "evidence double")


def predicted(docs: DataFrame, model: Model | None, keep: list[str], least: float | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` with ``lang_pred`` and ``score``, which replace columns so named.

    With ``least``, only the texts with words whose evidence is at least so much.
    """
    added = "lang_pred", "score"
    keep = [c for c in keep if c.lower() not in added]
    if model is None:
        return docs.select(*keep, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    # A text that is kept is sent once.
    text = "text" if "text" in keep and isinstance(docs.schema["text"].dataType, T.StringType) else "_text"
    given = docs.select(*keep) if text in keep else docs.select(*keep, F.col("text").cast("string").alias(text))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for whole in batches:
            for batch in slices(whole, text, BATCH_BYTES):
                names, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
                has, best, share, evidence = told(batch.column(text).to_pylist(), model)
                scores[has] = share
                for i, b in zip(has.tolist(), best.tolist(), strict=True):
                    names[i] = model.languages[b]
                kept = [batch.column(i) for i in range(len(keep))]
                out = pa.RecordBatch.from_arrays(
                    [*kept, pa.array(names, pa.string()), pa.array(scores)], names=[*keep, *added]
                )
                yield out if least is None else out.take(pa.array(has[evidence >= least]))

    fields = [docs.schema[c] for c in keep]
    schema = given.select(*keep).schema.__class__(fields).add("lang_pred", "string").add("score", "double")
    return given.mapInArrow(predict, schema)
