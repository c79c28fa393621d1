"""Quality rules by distribution divergence, in DataFrame operations only.

Base rules count, per text, words, symbols, repeated lines and repeated three-word windows.
The method then compares two histograms of the text with references of each language: character
classes (upper-case letters, other letters, digits, white space, symbols, the rest) and common
words (each listed word, and all other words). The references are the summed histograms of all
documents of a language that pass the base rules. A text that is far, by Jensen-Shannon distance
(square root of the divergence in bits, 0 to 1), from the nearest language's reference in
either histogram is rejected. Short texts have noisy histograms, so each comparison has a
minimum length; below it that comparison is not made.

One pass over the texts; its numbers are stored, about a hundred bytes a document, and both the
references and the verdicts read those. References are one row per language.

Edge cases: a null text is an empty one: no words, failed by the base rules. Null ``lang`` takes
no part in the references. Without any reference only the base rules decide. Repeated rows are
judged alike. ``judged`` keeps all columns but those named like one that it adds.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalstrata.llm.common import quoted
from pedalstrata.sources.staging import stage

SPACE = r"[\x20\x09-\x0D]+"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Frequent function words of four languages, as in public stop-word lists.
COMMON_WORDS = {
    "en": "the of and to in a is that it was for on are with as his they at be this from have or by one had not but what all were when we there can an",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec ou son mais comme on lui nous cette",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si sin sobre este ya entre cuando todo esta",
}

MIN_CHARS = 200
MIN_HISTOGRAM_WORDS = 100
MAX_CLASS_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.45

CLASSES = ("upper", "letter", "digit", "space", "symbol", "other")
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def common_words(lists: dict[str, str] = COMMON_WORDS) -> list[str]:
    return sorted({w for words in lists.values() for w in words.split()})


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, not once per use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _length_without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, "")).cast("bigint")


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more; every occurrence counts.

    Windows are known by a 64-bit hash of their words. Sorting (hash, position) puts equal
    windows side by side; the words covered are counted from the sorted positions.
    """
    n = F.size(words) - 2
    heads = F.slice(words, F.lit(1), F.greatest(n, F.lit(0)))
    grams = F.transform(heads, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))

    def covered(g: Column) -> Column:
        placed = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = _let(
            placed,
            lambda s: F.filter(
                s,
                lambda x, j: (x["h"] == F.get(s, j + 1)["h"]) | ((j > 0) & (x["h"] == F.get(s, F.greatest(j - 1, F.lit(0)))["h"])),
            ),
        )
        at = F.sort_array(F.transform(again, lambda x: x["i"]))
        gaps = _let(at, lambda p: F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3)))))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    return _let(grams, lambda g: F.when(F.size(F.array_distinct(g)) < F.size(g), covered(g)).otherwise(F.lit(0)))


def _word_counts(words: Column, listed: Sequence[str]) -> Column:
    """(word's number in the list, occurrences) of the listed words that occur."""
    names = F.array(*[F.lit(w) for w in listed])
    found = F.filter(words, lambda w: w.isin(list(listed)))
    codes = F.sort_array(F.transform(found, lambda w: F.array_position(names, w).cast("int")))

    def runs(s: Column) -> Column:
        heads = F.filter(F.transform(s, lambda c, i: F.struct(c.alias("code"), i.alias("i"))), lambda x: (x["i"] == 0) | (x["code"] != F.get(s, F.greatest(x["i"] - 1, F.lit(0)))))
        return _let(
            heads,
            lambda h: F.transform(
                h, lambda x, j: F.struct(x["code"].alias("code"), (F.coalesce(F.get(h, j + 1)["i"], F.size(s)) - x["i"]).alias("n"))
            ),
        )

    return _let(codes, runs)


def measured(docs: DataFrame, listed: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Columns ``keep``, the base counts, the class counts and the common-word counts."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    bare = docs.select(*keep, text.alias("_text"), F.array_remove(F.split(text, SPACE), "").alias("_words"))
    t, words = F.col("_text"), F.col("_words")
    # What is left without letters is short, and holds all that the other counts need.
    rest = bare.select(
        "*",
        F.regexp_replace(t, r"\p{L}+", "").alias("_rest"),
        F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
        F.filter(F.split(t, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
    )
    r = F.col("_rest")
    symbols = _length_without(r, r"[^#*$%&|<>]+")
    return rest.select(
        *keep,
        F.size(words).cast("bigint").alias("n_words"),
        "word_chars",
        symbols.alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        repeated_words(words).cast("bigint").alias("n_repeat_words"),
        F.length(t).cast("bigint").alias("n_chars"),
        _length_without(t, r"[^\p{Lu}]+").alias("upper"),
        (F.length(t) - F.length(r)).cast("bigint").alias("letters"),
        _length_without(r, r"[^\p{N}]+").alias("digit"),
        (F.length(t) - F.col("word_chars")).cast("bigint").alias("space"),
        _word_counts(words, listed).alias("common"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _class_counts() -> list[Column]:
    c = {name: F.col(name) for name in ("upper", "digit", "space")}
    c["letter"] = F.col("letters") - F.col("upper")
    c["symbol"] = F.col("n_symbols")
    c["other"] = F.col("n_chars") - F.col("letters") - F.col("digit") - F.col("space") - F.col("n_symbols")
    return [c[name] for name in CLASSES]


def references(features: DataFrame, listed: Sequence[str]) -> list[tuple[str, list[float], list[float]]]:
    """Per language the class shares and the shares of each listed word and of all others.

    Two partial aggregates over all documents that pass the base rules; one row per language,
    and one per language and listed word, reach the driver.
    """
    good = features.where(F.col("lang").isNotNull() & ~base_failed())
    sums = [F.sum(c).alias(name) for name, c in zip(CLASSES, _class_counts(), strict=True)]
    classes = {r["lang"]: r for r in good.groupBy("lang").agg(F.sum("n_words").alias("words"), *sums).collect()}
    one = good.select("lang", F.explode("common").alias("c")).groupBy("lang", "c.code").agg(F.sum("c.n").alias("n"))
    counts: dict[str, list[int]] = {lang: [0] * len(listed) for lang in classes}
    for r in one.collect():
        counts[r["lang"]][r["code"] - 1] = r["n"]
    out = []
    for lang, r in sorted(classes.items()):
        n = [r[name] for name in CLASSES]
        w = [*counts[lang], r["words"] - sum(counts[lang])]
        if sum(n) and sum(w):
            out.append((lang, [x / sum(n) for x in n], [x / sum(w) for x in w]))
    return out


def _part(p: Column, q: Column) -> Column:
    """What one class adds to twice the divergence, in bits."""
    half = (p + q) / 2
    return F.when(p > 0, p * F.log2(p / half)).otherwise(F.lit(0.0)) + F.when(q > 0, q * F.log2(q / half)).otherwise(F.lit(0.0))


def class_distance(shares: Sequence[float]) -> Column:
    n = F.col("n_chars").cast("double")
    parts = [_part(c / n, F.lit(float(q))) for c, q in zip(_class_counts(), shares, strict=True)]
    return F.sqrt(F.greatest(reduce(add, parts) / 2, F.lit(0.0)))


def word_distance(shares: Sequence[float]) -> Column:
    """Listed words that do not occur add half their share each; only those that do are visited."""
    n = F.col("n_words").cast("double")
    q = F.array(*[F.lit(float(x)) for x in shares[:-1]])
    zero = F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("q"), F.lit(0).alias("n"))

    def visit(a: Column, x: Column) -> Column:
        own = F.element_at(q, x["code"])
        return F.struct(
            (a["d"] + _part(x["n"] / n, own)).alias("d"), (a["q"] + own).alias("q"), (a["n"] + x["n"]).alias("n")
        )

    total = F.aggregate("common", zero, visit)
    listed = float(sum(shares[:-1]))
    both = _let(
        total, lambda s: s["d"] + (F.lit(listed) - s["q"]) + _part((n - s["n"]) / n, F.lit(float(shares[-1])))
    )
    return F.sqrt(F.greatest(both / 2, F.lit(0.0)))


def distances(features: DataFrame, refs: Sequence[tuple[str, list[float], list[float]]]) -> DataFrame:
    """``features`` with the distances to the nearest reference, null below the minimum length."""
    nearest = lambda columns: columns[0] if len(columns) == 1 else F.least(*columns)
    if not refs:
        none = F.lit(None).cast("double")
        return features.select("*", none.alias("class_distance"), none.alias("word_distance"))
    return features.select(
        "*",
        F.when(F.col("n_chars") >= MIN_CHARS, nearest([class_distance(c) for _, c, _ in refs])).alias("class_distance"),
        F.when(F.col("n_words") >= MIN_HISTOGRAM_WORDS, nearest([word_distance(w) for _, _, w in refs])).alias("word_distance"),
    )


def judged(docs: DataFrame, keep: Sequence[str] | None = None, lists: dict[str, str] = COMMON_WORDS) -> DataFrame:
    """Columns ``keep`` (default: all) with the counts, distances, ``base_failed`` and ``kept``.

    Columns of ``docs`` with the name of an added one are replaced.
    """
    listed = common_words(lists)
    added = {*BASE, "class_distance", "word_distance", "base_failed", "kept"}
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in added]
    kept_names = [f"_in_{i}" for i in range(len(keep))]
    inner = docs.select(*[quoted(c).alias(k) for c, k in zip(keep, kept_names, strict=True)], "text", "lang")
    features = stage(measured(inner, listed, [*kept_names, "lang"]))
    out = distances(features, references(features, listed))
    far = (F.coalesce(F.col("class_distance"), F.lit(0.0)) > MAX_CLASS_DISTANCE) | (
        F.coalesce(F.col("word_distance"), F.lit(0.0)) > MAX_WORD_DISTANCE
    )
    return out.select(
        *[F.col(k).alias(c) for c, k in zip(keep, kept_names, strict=True)],
        *BASE,
        "class_distance",
        "word_distance",
        base_failed().alias("base_failed"),
        (~base_failed() & ~far).alias("kept"),
    )
