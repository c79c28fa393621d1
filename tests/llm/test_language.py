from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest

from pedalstrata.llm import language_crf as crf
from pedalstrata.llm.queries import QUERIES


def test_op6_on_held_out_documents(spark, sf_dir, documents):
    given = {r.doc_id: r for r in documents.collect()}
    rows = QUERIES["op6_language"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(given)
    langs = {r.lang for r in given.values()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        assert r.lang_pred in langs or r.lang_pred == "und" and not any(c.isalpha() for c in given[r.doc_id].text)
    out = [r.lang_pred == given[r.doc_id].lang for r in rows if r.held_out]
    assert len(out) > 30 and np.mean(out) >= 0.95


@pytest.fixture(scope="module")
def model(documents):
    rows = documents.collect()
    return crf.fit([r.text for r in rows], [r.lang for r in rows], epochs=2)


def test_code_switching(model):
    """Words of a mixed line get their own languages."""
    text = "the outing and that there was on the inside, und die einheit der verschiebung ist nicht ein"
    o = crf.observe([text])
    marginal, _ = crf.forward_backward(model.emissions(o), o.lines, model.transitions, model.start)
    names = [model.languages[i] for i in marginal.argmax(axis=1)]
    assert names[:8] == ["en"] * 8 and names[-7:] == ["de"] * 7


def test_word_labels_of_spliced_texts(spark):
    """Held-out documents of two languages, spliced inside lines: every word has a known language."""
    import random

    rng = random.Random(4)
    rows = [r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect() if r.text and r.lang]
    fold = lambda r: zlib.crc32(str(r.doc_id).encode()) % 4
    learned = crf.fit([r.text for r in rows if fold(r) != 2], [r.lang for r in rows if fold(r) != 2])
    held = {}
    for r in rows:
        if fold(r) == 2:
            held.setdefault(r.lang, []).extend([r.text.replace("\n", " ").split()])
    right = total = 0
    for _ in range(150):
        parts = [(lang, rng.choice(held[lang])) for lang in rng.sample(sorted(held), 2)]
        pieces = [(lang, w[(at := rng.randrange(max(1, len(w) - 12))) : at + 12]) for lang, w in parts]
        o = crf.observe([" ".join(" ".join(w) for _, w in pieces)])
        if not len(o.first):
            continue
        marginal, _ = crf.forward_backward(learned.emissions(o), o.lines, learned.transitions, learned.start)
        truth = [lang for lang, w in pieces for _ in crf.observe([" ".join(w)]).first]
        got = [learned.languages[i] for i in marginal.argmax(axis=1)]
        right += sum(a == b for a, b in zip(got, truth, strict=True))
        total += len(truth)
    print(f"word accuracy {right / total:.4f} of {total}")
    assert right / total >= 0.9


def test_the_sample_is_bounded_and_covers_every_language(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "case when id % 3 = 0 then 'en' when id % 500 = 1 then 'xx' else 'de' end as lang")
    picked = crf.labelled_sample(docs, docs.doc_id % 4 == 2, 50).collect()
    sizes = {lang: sum(r.lang == lang for r in picked) for lang in ("en", "de", "xx")}
    assert sizes["xx"] == docs.where("lang = 'xx' and doc_id % 4 <> 2").count() and 40 <= sizes["en"] <= 50 and 40 <= sizes["de"] <= 50
    assert not [r for r in picked if r.doc_id % 4 == 2]
    # Few rows reach the ranking, whatever the input.
    plan = crf.labelled_sample(docs, docs.doc_id % 4 == 2, 50)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window") < plan.index("BroadcastHashJoin")


def test_forward_backward_by_enumeration():
    rng = np.random.default_rng(0)
    lines, n, k = np.array([0, 3, 4]), 8, 3
    emission, transitions, start = rng.normal(size=(n, k)), rng.normal(size=(k, k)), rng.normal(size=k)
    marginal, expected = crf.forward_backward(emission, lines, transitions, start)
    want, moves = np.zeros((n, k)), np.zeros((k, k))
    for a, b in ((0, 3), (3, 4), (4, 8)):
        total, own, pairs = 0.0, np.zeros((b - a, k)), np.zeros((k, k))
        for path in itertools.product(range(k), repeat=b - a):
            weight = np.exp(
                start[path[0]]
                + sum(emission[a + i, y] for i, y in enumerate(path))
                + sum(transitions[x, y] for x, y in itertools.pairwise(path))
            )
            total += weight
            for i, y in enumerate(path):
                own[i, y] += weight
            for x, y in itertools.pairwise(path):
                pairs[x, y] += weight
        want[a:b] = own / total
        moves += pairs / total
    assert np.allclose(marginal, want) and np.allclose(expected, moves)


def test_words_are_scored_alike_in_any_batch(model):
    texts = ["the and\nof this", "", None, "été naïve", "die und"]
    o = crf.observe(texts)
    whole = model.emissions(o)
    alone = np.concatenate([model.emissions(crf.observe([t])) for t in texts])
    assert np.allclose(whole, alone) and o.lines.tolist() == [0, 2, 4, 6]


def test_odd_documents(odd_documents, no_documents, model):
    from pyspark.sql import functions as F

    never = F.lit(False)
    learned = crf.train(odd_documents, never)
    assert learned.languages == ["de", "en"]
    out = crf.predicted(odd_documents, learned, ["doc_id", "text", "score"])
    assert out.columns == ["doc_id", "text", "lang_pred", "score"]
    for r in out.collect():
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) and 0 <= r.score <= 1
    assert crf.train(no_documents, never) is None
    assert crf.predicted(odd_documents, None, ["doc_id"]).where("lang_pred = 'und'").count() == odd_documents.count()
    assert crf.predicted(no_documents, model, ["doc_id"]).count() == 0


def test_the_least_evidence_is_of_all_held_out_texts(spark, model):
    """More texts of one language than a sample would hold, the worst of them few; texts repeat, one is null."""
    from pyspark.sql import functions as F

    good, bad = "the outing and that there was on the inside", "zq xw vkj"
    n = 3 * crf.SAMPLE
    rows = [(i, bad if i % 75 == 0 else f"{good} {'of the ' * (i % 7)}", "en") for i in range(n)]
    rows += [(n, None, "en"), (n + 1, bad, None), (None, bad, "en"), (n + 2, bad, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    held_out = F.coalesce(F.col("doc_id"), F.lit(0)) != n + 2
    texts = [t for i, t, lang in rows if lang and i is not None and i != n + 2]
    want = 0.5 * np.quantile(crf.told(texts, model)[3], 0.01)
    assert crf.least_evidence(docs, held_out, model) == pytest.approx(max(0.0, float(want)), rel=1e-5, abs=1e-6)
    assert crf.least_evidence(docs, F.lit(False), model) == 0.0


def test_evidence_of_every_held_out_text(spark, model):
    docs = spark.range(3 * crf.SAMPLE).selectExpr("id as doc_id", "concat('the outing and that ', repeat('of ', int(id % 9))) as text", "'en' as lang")
    assert crf.evidence(docs, model).count() == 3 * crf.SAMPLE


def test_a_kept_text_is_sent_once(documents, model):
    plan = crf.predicted(documents, model, ["doc_id", "text"])._jdf.queryExecution().optimizedPlan().toString()
    assert "_text" not in plan
    out = crf.predicted(documents, model, ["doc_id", "text"]).collect()
    apart = {r.doc_id: (r.lang_pred, r.score) for r in crf.predicted(documents, model, ["doc_id"]).collect()}
    assert len(out) == len(apart) and all(apart[r.doc_id] == (r.lang_pred, r.score) for r in out)
