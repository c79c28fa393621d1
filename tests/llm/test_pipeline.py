"""The pipeline: each stage on its own input, the run as a whole, and the registered queries."""

from __future__ import annotations

import importlib
import sys
from collections import Counter

import pytest
from compare import connect, differences
from test_decontaminate import brute_force as leaked
from test_near_duplicates import bag, linked
from test_tokens import check_pieces
from tokenizers import Tokenizer

import __spark_entry__ as entry_point
import corpus_pipeline
from pedalstrata.llm import secret_automata
from pedalstrata.llm.common import tokenizer_path
from pedalstrata.llm.packing import pieces_of
from pedalstrata.llm.queries import ORACLE, QUERIES
from pedalstrata.sources.staging import stage


def test_all_are_registered():
    names = sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert entry_point.queries().items() >= {**QUERIES, "pipeline": corpus_pipeline.run}.items()
    assert entry_point.oracle_sql().items() >= ORACLE.items()


def test_a_broken_import_is_not_hidden(monkeypatch):
    monkeypatch.delattr("pedalstrata.llm.queries")
    monkeypatch.setitem(sys.modules, "pedalstrata.llm.queries", None)
    with pytest.raises(ImportError):
        importlib.reload(entry_point)
    monkeypatch.undo()
    importlib.reload(entry_point)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE[name]) == []


@pytest.fixture(scope="module")
def steps(spark, sf_dir, documents):
    """What every stage was given and gave."""
    out, docs = {}, documents
    for name, stage_of in corpus_pipeline.STAGES:
        given, docs = docs, stage(stage_of(spark, docs, sf_dir))
        out[name] = (given, docs)
    return out


def test_columns_stay(documents, steps):
    assert list(steps) == ["language ID", "near-dedup", "decontamination", "secret scans", "packing"]
    for name, (given, gave) in list(steps.items())[:-1]:
        assert gave.schema == documents.schema, name
        assert given.count() >= gave.count() > 0


def test_language_stage_keeps_texts_in_a_language(steps):
    given, gave = steps["language ID"]
    dropped = given.join(gave.select("doc_id"), "doc_id", "left_anti").collect()
    assert len(dropped) <= 2 and all(len(r.text) < 200 for r in dropped)


def test_one_document_of_each_class_stays(steps):
    given, gave = ([(r.doc_id, bag(r.text)) for r in df.collect()] for df in steps["near-dedup"])
    kept = dict(gave)
    for i, (d, a) in enumerate(gave):
        assert not any(linked(a, b) for _, b in gave[:i])
    # Whatever went is linked, directly or over others that went, to something smaller.
    for d, a in given:
        if d not in kept:
            assert any(linked(a, b) for e, b in given if e != d)


def test_contaminated_documents_go(spark, sf_dir, steps):
    given, gave = ([(r.doc_id, r.text) for r in df.collect()] for df in steps["decontamination"])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    bad = {d for d, _ in leaked(given, items)}
    assert sorted(gave) == sorted((d, t) for d, t in given if d not in bad)


def test_secrets_are_masked(steps):
    given, gave = ({r.doc_id: r for r in df.collect()} for df in steps["secret scans"])
    assert given.keys() == gave.keys()
    changed = 0
    for d, r in gave.items():
        before = given[d].text
        assert not secret_automata.base_spans(r.text) and r.n_chars == (len(r.text) if r.text != before else given[d].n_chars)
        if not secret_automata.base_spans(before):
            assert r.text == before
        changed += r.text != before
    assert changed > 0


def test_packing_holds_what_is_left(steps):
    given, gave = steps["packing"]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    tokenizer.encode_special_tokens = True
    stream = check_pieces(pieces_of(gave).collect(), [(r.doc_id, r.text) for r in given.collect()], tokenizer, 1024)
    sequences = gave.orderBy("sequence_id").collect()
    assert [i for r in sequences for i in r.ids[: r.n_tokens]] == stream and {len(r.ids) for r in sequences} == {1024}
    assert all(r.doc_ids == [p.doc_id for p in r.pieces] for r in sequences)


def test_run_gives_the_last_stage(spark, sf_dir, steps):
    key = lambda r: (r.doc_id, r.doc_tokens)
    wholes = [Counter(map(key, pieces_of(df).where("start = 0").collect())) for df in (corpus_pipeline.run(spark, sf_dir), steps["packing"][1])]
    assert wholes[0] == wholes[1]


def test_odd_and_no_documents(spark, sf_dir, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        for name, stage_of in corpus_pipeline.STAGES:
            given, docs = docs, stage(stage_of(spark, docs, sf_dir))
            if name != "packing":
                assert docs.columns == given.columns
    # Also when only texts are left that no stage can use.
    blank = odd_documents.where("text is null or trim(text) = ''")
    for _, stage_of in corpus_pipeline.STAGES:
        blank = stage(stage_of(spark, blank, sf_dir))


def test_language_stage_rejects_what_is_in_no_language(spark):
    """Noise made of letters and texts in languages that no label names go; others stay."""
    import random

    rng = random.Random(3)
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    odd = [
        " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(2, 10))) for _ in range(n)) for n in (20, 60, 300) for _ in range(10)
    ]
    odd.append("Wczoraj wieczorem poszliśmy do kina, ponieważ padał deszcz i nie chcieliśmy siedzieć w domu. Film był długi, ale ciekawy.")
    odd.append("Вчера вечером мы пошли в кино, потому что шёл дождь и мы не хотели сидеть дома.")
    odd.append("12 34 !")
    planted = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(odd)], docs.schema)
    kept = [r.doc_id for r in corpus_pipeline.identify_language(spark, docs.unionByName(planted), sf_dir).select("doc_id").collect()]
    assert min(kept) >= 0 and len(kept) >= 0.995 * docs.count()


def test_letterless_texts_go_without_labels(spark, sf_dir):
    rows = [(1, "some words", None), (2, "12 34", None), (3, None, None), (4, "é", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in corpus_pipeline.identify_language(spark, docs, sf_dir).collect()) == [1, 4]
