from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from pedalstrata.llm import divergence

WORD = re.compile("[^\x20\x09-\x0d]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    grams = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)
    )


@pytest.mark.parametrize("table", ["documents", "odd_documents"])
def test_base_counts(request, table):
    docs = request.getfixturevalue(table)
    rows = divergence.judged(docs, ["doc_id", "text"]).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in docs.collect())
    for r in rows:
        assert tuple(r[c] for c in divergence.BASE) == base(r.text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_repeats_and_ties(spark):
    texts = ["a a a a", "a b c a b c", "a b c d a b c", "a b", "x\ny\nx\n \n\n", "é é é é", "a\x0bb\x0cc d", "a b c " * 400]
    rows = divergence.judged(spark.createDataFrame([(t, "en") for t in texts], "text string, lang string"), ["text"]).collect()
    assert [tuple(r[c] for c in divergence.BASE) for r in sorted(rows, key=lambda r: texts.index(r.text))] == [base(t) for t in texts]


def distance(p, q):
    total = 0.0
    for a, b in zip(p, q, strict=True):
        for x in (a, b):
            if x:
                total += x * math.log2(2 * x / (a + b)) / 2
    return math.sqrt(max(total, 0.0))


def test_distances_by_definition(spark):
    docs = spark.createDataFrame(
        [
            (1, "the cat and the dog " * 4 + " ".join(f"one{i}" for i in range(90)), "en"),
            (2, "of all that is " + " ".join(f"Two{i}!" for i in range(110)), "en"),
            (3, "der hund und die katze " + " ".join(f"ja{i}" for i in range(120)), "de"),
            (4, " ".join(f"###{i}%%%" for i in range(130)), None),
        ],
        "doc_id long, text string, lang string",
    )
    texts = {r.doc_id: (r.text, r.lang) for r in docs.collect()}
    listed = divergence.common_words()

    def histograms(text):
        w = WORD.findall(text)
        n = Counter(w)
        words = [n[x] for x in listed]
        letters = sum(c.isalpha() for c in text)
        upper = sum(c.isupper() for c in text)
        digits, symbols = sum(c.isdigit() for c in text), sum(c in "#*$%&|<>" for c in text)
        space = len(text) - sum(map(len, w))
        rest = len(text) - letters - digits - symbols - space
        return [upper, letters - upper, digits, space, symbols, rest], [*words, len(w) - sum(words)]

    share = lambda h: [x / sum(h) for x in h]
    add = lambda hs: [sum(x) for x in zip(*hs, strict=True)]
    own = {d: histograms(t) for d, (t, _) in texts.items()}
    refs = {
        lang: [share(add([own[d][k] for d, (_, x) in texts.items() if x == lang])) for k in (0, 1)] for lang in ("en", "de")
    }
    for r in divergence.judged(docs).collect():
        for k, got in enumerate((r.class_distance, r.word_distance)):
            assert got == pytest.approx(min(distance(share(own[r.doc_id][k]), ref[k]) for ref in refs.values()), abs=1e-9)
        assert r.kept == (r.doc_id != 4)


def test_short_texts_and_no_reference(spark, odd_documents, no_documents):
    rows = divergence.judged(odd_documents).collect()
    assert all(r.class_distance is None for r in rows if len(r.text or "") < 200)
    assert all(r.word_distance is None for r in rows if r.n_words < 100)
    assert divergence.judged(no_documents).count() == 0
    unnamed = spark.createDataFrame([("word " * 20 + " ".join(map(str, range(60))), None)], "text string, lang string")
    assert [(r.class_distance, r.kept) for r in divergence.judged(unnamed).collect()] == [(None, True)]
    assert "kept" in divergence.judged(odd_documents).columns and "key" in divergence.judged(odd_documents).columns


def test_plan_stays_in_the_jvm(documents):
    plan = divergence.measured(documents, divergence.common_words(), ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
