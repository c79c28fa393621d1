"""Secret scans: fixed patterns, and formats inferred from what they find.

Base spans are those of three patterns (``assign``, ``access``, ``hex``), leftmost and not overlapping
within a kind. Their values are labelled credentials: per kind, the prefix tree of a sample is folded
into a probabilistic automaton by merging states whose symbol frequencies are statistically
compatible (ALERGIA: a Hoeffding bound on every outgoing frequency, recursively). Symbols are classes
of characters, since credentials are random within their alphabet. Credentials of other formats can be
given with their kinds; each kind is one more automaton. The ordinary automaton stands for candidates:
maximal runs of ``MIN_RUN`` or more characters that occur in credentials and touch no base span. Its
states are the last ``MEMORY`` symbols (a language testable by its factors), its counts those of all
runs of all documents, and each state falls back to that of one symbol less. All runs are scored, and what no automaton claims is cut at ever
more separators and its parts are scored: whole, at ``=``, ``.``, ``/``, ``-``, ``_`` and ``+``, without
punctuation at the edges. Of a run that touches base spans, what is left beside them is scored so,
and parts without a separator that reach over a span. A part becomes a span ``inferred`` if the best
credential automaton gives it at least ``MARGIN`` more log-likelihood per character than the ordinary
one.

Bounds, as parameters: ``SAMPLE`` distinct labelled values per kind, picked by a hash. The ordinary
counts cover all rows; there are as many as states and symbols allow, whatever the input. Every text is
scanned whole, twice: once for values and counts, once for the spans.

Edge cases: a null text is an empty one. Without labelled credentials nothing is inferred. Repeated
rows are scanned alike. ``redacted`` keeps all columns; where there is a column ``n_chars`` it
becomes the new length of changed texts.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalstrata.llm.common import free_name, quoted
from pedalstrata.llm.encoding import slices
from pedalstrata.sources.staging import stage

KINDS = ("assign", "access", "hex", "inferred")
SAMPLE = 1500
MIN_RUN = 12
MARGIN = 1.0
MEMORY = 3
ALPHA = 0.05
MASK = "[secret]"

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # the same maximal runs as of one or more, then of 16 or more
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % MIN_RUN)
_SEPARATORS = "=./-_+"
_GLUED = re.compile(r"[A-Za-z0-9]+")
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

Span = tuple[int, int, int]  # start, number of the kind, end


def base_spans(text: str) -> list[Span]:
    out = []
    if (":" in text or "=" in text) and any(n in low for low in [text.lower()] for n in _NAMES):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def _runs(text: str, base: Sequence[Span]) -> Iterator[tuple[int, int, list[list[int]]]]:
    """All runs, with the merged base spans that each touches; ``base`` is sorted by start."""
    taken: list[list[int]] = []
    for start, _, end in base:
        if taken and start <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], end)
        else:
            taken.append([start, end])
    at = 0
    for m in _RUN.finditer(text):
        while at < len(taken) and taken[at][1] <= m.start():
            at += 1
        last = at
        while last < len(taken) and taken[last][0] < m.end():
            last += 1
        yield m.start(), m.end(), taken[at:last]


def candidates(text: str, base: Sequence[Span]) -> Iterator[tuple[int, int]]:
    """Runs that touch no base span."""
    return ((a, b) for a, b, touched in _runs(text, base) if not touched)


def _parts(text: str, start: int, end: int, formats: Formats, level: int = 0) -> Iterator[tuple[int, int]]:
    """Parts of a run that are secret, the longest first: whole, else between ever more separators."""
    # Padding at the end may belong to a credential.
    while start < end and text[start] in _SEPARATORS:
        start += 1
    while start < end and text[end - 1] in "./-_":
        end -= 1
    if end - start < MIN_RUN:
        return
    if formats.is_secret(text[start:end]):
        yield start, end
        return
    while level < len(_SEPARATORS) and text.find(_SEPARATORS[level], start, end) < 0:
        level += 1
    if level == len(_SEPARATORS):
        return
    at = start
    for part in text[start:end].split(_SEPARATORS[level]):
        yield from _parts(text, at, at + len(part), formats, level + 1)
        at += len(part) + 1


def inferred(text: str, base: Sequence[Span], formats: Formats) -> Iterator[tuple[int, int]]:
    """What the formats claim beside the base spans."""
    if not formats.credentials or formats.ordinary is None:
        return
    for start, end, touched in _runs(text, base):
        at = start
        for a, b in [*touched, [end, end]]:
            if a - at >= MIN_RUN:
                yield from _parts(text, at, a, formats)
            at = max(at, b)
        for m in _GLUED.finditer(text, start, end) if touched else ():
            a, b = m.span()
            over = [t for t in touched if t[0] < b and a < t[1]]
            if over and any(t[0] > a or t[1] < b for t in over) and not any(t[0] <= a and b <= t[1] for t in over):
                if b - a >= MIN_RUN and formats.is_secret(m[0]):
                    yield a, b


def _classes() -> dict[str, int]:
    out = {}
    for number, chars in enumerate(("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "+", "/", "_", ".", "=", "-")):
        out |= dict.fromkeys(chars, number)
    return out


_CLASS = _classes()
N_CLASSES = max(_CLASS.values()) + 1


def symbols(text: str) -> list[int]:
    return [_CLASS[c] for c in text]


@dataclass
class Automaton:
    """Per state the successor and log-probability of each symbol, and the log-probability to end."""

    successors: list[list[int]]
    steps: list[list[float]]
    ends: list[float]

    def log_likelihood(self, word: Sequence[int]) -> float:
        total, state = 0.0, 0
        for s in word:
            total += self.steps[state][s]
            state = self.successors[state][s]
        return total + self.ends[state]


def infer(words: Sequence[Sequence[int]], alpha: float = ALPHA) -> Automaton:
    """A probabilistic automaton from a sample of words, by merging prefix-tree states."""
    children: list[dict[int, int]] = [{}]
    passed, ended = [0], [0]
    counts: list[dict[int, int]] = [{}]
    for word in words:
        state = 0
        passed[0] += 1
        for s in word:
            counts[state][s] = counts[state].get(s, 0) + 1
            if s not in children[state]:
                children[state][s] = len(children)
                children.append({})
                counts.append({})
                passed.append(0)
                ended.append(0)
            state = children[state][s]
            passed[state] += 1
        ended[state] += 1
    bound = math.sqrt(0.5 * math.log(2 / alpha))

    def differ(x: int, n: int, y: int, m: int) -> bool:
        return abs(x / n - y / m) > bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def compatible(a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = passed[a], passed[b]
            if not n or not m:
                continue
            if differ(ended[a], n, ended[b], m):
                return False
            for s in counts[a].keys() | counts[b].keys():
                if differ(counts[a].get(s, 0), n, counts[b].get(s, 0), m):
                    return False
                if s in children[a] and s in children[b]:
                    todo.append((children[a][s], children[b][s]))
        return True

    def fold(a: int, b: int) -> None:
        """Add the tree below ``b`` to what lies below ``a``."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            passed[a] += passed[b]
            ended[a] += ended[b]
            for s, n in counts[b].items():
                counts[a][s] = counts[a].get(s, 0) + n
                if s in children[a]:
                    todo.append((children[a][s], children[b][s]))
                else:
                    children[a][s] = children[b][s]

    kept = [0]
    border = [(0, s) for s in sorted(children[0])]
    while border:
        # The most travelled state first: its frequencies are the surest.
        border.sort(key=lambda x: -passed[children[x[0]][x[1]]])
        parent, s = border.pop(0)
        state = children[parent][s]
        if state in kept:
            continue
        for red in kept:
            if compatible(red, state):
                children[parent][s] = red
                fold(red, state)
                break
        else:
            kept.append(state)
        border = [(r, s) for r in kept for s in sorted(children[r]) if children[r][s] not in kept]
    number = {state: i for i, state in enumerate(kept)}
    out = Automaton([], [], [])
    for state in kept:
        n = passed[state] + 0.1 * (N_CLASSES + 1)  # additive smoothing
        out.successors.append([number[children[state].get(s, state)] for s in range(N_CLASSES)])
        out.steps.append([math.log((counts[state].get(s, 0) + 0.1) / n) for s in range(N_CLASSES)])
        out.ends.append(math.log((ended[state] + 0.1) / n))
    return out


END_SYMBOL = N_CLASSES


def factors(word: Sequence[int], memory: int = MEMORY) -> Iterator[tuple[int, ...]]:
    """Each symbol of a word and its end, behind the symbols before it, at most ``memory`` of them."""
    padded = [*word, END_SYMBOL]
    return (tuple(padded[max(0, i - memory) : i + 1]) for i in range(len(padded)))


def testable(counts: Mapping[tuple[int, ...], int], memory: int = MEMORY) -> Automaton:
    """The automaton whose states are the last symbols, from the counts of all factors.

    A state's frequencies are smoothed by those of the state without its first symbol, whose counts
    are summed over all its extensions, and in the end by equal ones.
    """
    states: dict[tuple[int, ...], dict[int, int]] = {}
    for factor, n in counts.items():
        # Every shorter context has the counts of the longer ones, for words that begin otherwise.
        for cut in range(len(factor)):
            row = states.setdefault(factor[cut:-1], {})
            row[factor[-1]] = row.get(factor[-1], 0) + n
    smoothed: dict[tuple[int, ...], list[float]] = {}
    for state in sorted(states, key=len):
        below = smoothed[state[1:]] if state else [1 / (N_CLASSES + 1)] * (N_CLASSES + 1)
        row, total = states[state], sum(states[state].values())
        smoothed[state] = [(row.get(s, 0) + below[s]) / (total + 1) for s in range(N_CLASSES + 1)]
    number = {state: i for i, state in enumerate(sorted(smoothed, key=lambda s: (len(s), s)))}

    def after(state: tuple[int, ...], s: int) -> int:
        following = (*state, s)[-memory:] if memory else ()
        while following not in number:
            following = following[1:]
        return number[following]

    out = Automaton([], [], [])
    for state in number:
        out.successors.append([after(state, s) for s in range(N_CLASSES)])
        out.steps.append([math.log(p) for p in smoothed[state][:N_CLASSES]])
        out.ends.append(math.log(smoothed[state][END_SYMBOL]))
    return out


@dataclass
class Formats:
    """Automata of the labelled kinds, and of ordinary candidates."""

    credentials: list[Automaton]
    ordinary: Automaton | None

    def is_secret(self, text: str, margin: float = MARGIN) -> bool:
        if not self.credentials or self.ordinary is None:
            return False
        word = symbols(text)
        own = max(a.log_likelihood(word) for a in self.credentials)
        return own - self.ordinary.log_likelihood(word) >= margin * len(word)


def learned(docs: DataFrame, labelled: DataFrame | None = None, sample: int = SAMPLE) -> Formats:
    """Infer the formats: of the values of base spans, of credentials with ``kind`` and ``value`` in
    ``labelled``, and of ordinary candidates. Values with other characters than candidates have are ignored."""

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                rows, ordinary = set(), Counter()
                for text in batch.column("text").to_pylist():
                    text = text or ""
                    base = base_spans(text)
                    for start, kind, end in base:
                        value = _ASSIGN.match(text, start)[2] if kind == 0 else text[start:end]
                        rows.add((KINDS[kind], value))
                    for a, b in candidates(text, base):
                        ordinary.update(factors(symbols(text[a:b])))
                # A factor as letters: one per symbol.
                told = [(k, v, 1) for k, v in rows] + [(None, "".join(chr(65 + s) for s in f), n) for f, n in ordinary.items()]
                kinds, found, n = zip(*told, strict=True) if told else ((), (), ())
                columns = (pa.array(kinds, pa.string()), pa.array(found, pa.string()), pa.array(n, pa.int64()))
                yield pa.RecordBatch.from_arrays(list(columns), names=["kind", "value", "n"])

    told = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(values, "kind string, value string, n bigint")
    seen = stage(told.groupBy("kind", "value").agg(F.sum("n").alias("n")))
    known = seen.where("kind IS NOT NULL").select("kind", "value")
    if labelled is not None:
        fits = F.col("value").rlike(f"^{_RUN.pattern}$")
        known = stage(known.unionByName(labelled.select("kind", "value").where(fits & F.col("kind").isNotNull())).distinct())
    kinds = sorted(r[0] for r in known.select("kind").distinct().collect())  # one per format
    picked = [
        [symbols(r[0]) for r in known.where(F.col("kind") == k).select("value").orderBy(F.xxhash64("value"), "value").limit(sample).collect()]
        for k in kinds
    ]
    counts = {tuple(ord(c) - 65 for c in r.value): r.n for r in seen.where("kind IS NULL").collect()}
    return Formats([infer(words) for words in picked], testable(counts) if counts else None)


def spans(text: str, formats: Formats) -> list[Span]:
    base = base_spans(text)
    return sorted([*base, *{(a, 3, b) for a, b in inferred(text, base, formats)}])


def written(found: Sequence[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in found)


def scanned(docs: DataFrame, formats: Formats) -> DataFrame:
    """``doc_id``, counts per base kind, a digest of the base spans and all spans of every document."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                counts, digest, every = [], [], []
                for text in batch.column("text").to_pylist():
                    found = spans(text or "", formats)
                    base = [s for s in found if s[1] < 3]
                    counts.append([sum(s[1] == k for s in base) for k in range(3)])
                    digest.append(hashlib.sha256(written(base).encode()).hexdigest())
                    every.append(written(found))
                columns = {f"n_{KINDS[k]}": pa.array([c[k] for c in counts], pa.int64()) for k in range(3)}
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": batch.column("doc_id"), **columns, "base_sha256": pa.array(digest), "spans": pa.array(every)}
                )

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        scan, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    )


def _masked(text: str, found: Sequence[Span], mask: str) -> str:
    out, at = [], 0
    for start, _, end in found:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join(out) + text[at:]


def redacted(docs: DataFrame, formats: Formats, mask: str = MASK) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by ``mask``."""

    @F.pandas_udf("string")
    def hide(texts):
        return texts.map(lambda t: _masked(t, found, mask) if t and (found := spans(t, formats)) else t)

    new = free_name(docs, "new_text")
    out = docs.withColumn(new, hide(F.col("text").cast("string")))
    if "n_chars" in docs.columns:
        changed = F.col(new) != F.col("text")
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(changed, F.length(new).cast(kind)).otherwise(F.col("n_chars")))
    return out.withColumn("text", F.col(new)).select(*[quoted(c) for c in docs.columns])
