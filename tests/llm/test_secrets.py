from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pedalstrata.llm import secret_automata as secrets
from pedalstrata.llm.queries import QUERIES

PATTERNS = (
    (re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12),
    (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    (re.compile(r"[0-9a-f]+"), 0, 16),
)


def base(text):
    out = []
    for kind, (pattern, group, least) in enumerate(PATTERNS):
        out += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if len(m[group]) >= least]
    return sorted(out)


PARTS = ["password", "PassWd", "secret", "TOKEN", "api_key", "APIKEY", "ſecret", "toKen", "=", ":", " ", '"', "'", "\t", "abc123", "deadbeef", "0123456789abcdef", "AKIA", "ABCDEFGH12345678", "x" * 12, "é", "👍", "\n", "-", "."]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PATTERNS and PARTS), max_size=14).map("".join))
def test_base_spans(text):
    assert secrets.base_spans(text) == base(text)


def test_op4(spark, sf_dir, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = QUERIES["op4_secrets"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        want = base(texts[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for _, x, _ in want) for k in range(3))
        joined = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        spans = [s.split(":") for s in r.spans.split(",") if s]
        assert [s for s in spans if s[0] != "inferred"] == [s.split(":") for s in joined.split(",") if s]
        # Ordinary words, addresses and numbers are left alone.
        assert not [s for s in spans if s[0] == "inferred"]


@pytest.fixture(scope="module")
def words():
    rng = random.Random(8)
    credentials = ["".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=32)) for _ in range(300)]
    syllables = ["the", "ing", "on", "er", "ation", "st", "re"]
    ordinary = ["".join(rng.choices(syllables, k=6)).ljust(12, "s") for _ in range(300)]
    return credentials, ordinary


def test_inferred_formats(spark, words):
    credentials, ordinary = words
    rng = random.Random(2)
    rows = [f"some {rng.choice(ordinary)} here token = {c}\nand more {rng.choice(ordinary)}." for c in credentials[:200]]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string")
    formats = secrets.learned(docs)
    found = [formats.is_secret(c) for c in credentials[200:]]
    wrong = [formats.is_secret(w) for w in ordinary]
    assert sum(found) >= 95 and sum(wrong) == 0
    bare = f"loose {credentials[250]} in text, {ordinary[0]} too"
    assert secrets.spans(bare, formats) == [(6, 3, 38)]
    masked = secrets.redacted(spark.createDataFrame([(1, bare, 5, "x")], "doc_id long, text string, n_chars int, new_text string"), formats)
    row = masked.first()
    assert row.text == f"loose [secret] in text, {ordinary[0]} too" and row.n_chars == len(row.text) and row.new_text == "x"


ALPHABETS = {
    "mixed": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 40),
    "base32": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 32),
    "lower": ("abcdefghijklmnopqrstuvwxyz0123456789", 30),
    "url": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", 43),
}


def test_held_out_credentials_of_several_alphabets(spark):
    """Formats that no pattern knows, learned from labelled values; others of them stand in real texts."""
    rng = random.Random(21)
    drawn = {k: ["".join(rng.choices(chars, k=n)) for _ in range(300)] for k, (chars, n) in ALPHABETS.items()}
    labelled = spark.createDataFrame([(k, v) for k, values in drawn.items() for v in values[:200]], "kind string, value string")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    formats = secrets.learned(docs, labelled)
    assert len(formats.credentials) == 4 + 2  # with those of the assign and hex spans
    texts = [r.text or "" for r in docs.collect()]
    hidden = [(rng.choice(texts)[:200], v) for values in drawn.values() for v in values[200:]]
    found = 0
    for text, value in hidden:
        whole = f"{text} {value} and on"
        at = len(text) + 1
        found += any(k == 3 and a <= at and b >= at + len(value) for a, k, b in secrets.spans(whole, formats))
    runs = sum(1 for t in texts for _ in secrets.candidates(t, secrets.base_spans(t)))
    false = sum(k == 3 for t in texts for _, k, _ in secrets.spans(t, formats))
    print(f"recall {found / len(hidden):.3f}, false {false} of {runs} runs")
    assert found >= 0.9 * len(hidden) and runs > 3000 and false <= 0.002 * runs


def test_the_ordinary_automaton_counts_all_runs(spark):
    """Its probabilities sum to one in every state, and a run that occurs more often is likelier."""
    rare, common = "abcdefghijkl", "MNOPQRSTUVWX"
    docs = spark.createDataFrame([(i, f"{common} {common} {rare if i == 3 else ''}") for i in range(50)], "doc_id long, text string")
    ordinary = secrets.learned(docs.repartition(4)).ordinary
    for steps, end in zip(ordinary.steps, ordinary.ends, strict=True):
        assert math.isclose(sum(map(math.exp, steps)) + math.exp(end), 1.0)
    score = {w: ordinary.log_likelihood(secrets.symbols(w)) for w in (rare, common)}
    assert score[common] > score[rare] + 3
    # Of a hundred and one runs the first symbol of a hundred is upper case.
    first = [math.exp(x) for x in ordinary.steps[0]]
    every = {w: secrets.symbols(w) for w in (rare, common)}
    want = Counter(f for w, n in ((rare, 1), (common, 100)) for f in list(secrets.factors(every[w])) * n)
    assert np.allclose(secrets.testable(want).steps, ordinary.steps) and first[every[common][0]] > 0.5


def test_automaton_is_a_distribution_and_learns_length():
    rng = random.Random(0)
    sample = [[rng.randrange(2) for _ in range(4)] for _ in range(2000)]
    a = secrets.infer(sample)
    for steps, end in zip(a.steps, a.ends, strict=True):
        assert math.isclose(sum(map(math.exp, steps)) + math.exp(end), 1.0)
    assert a.log_likelihood([0, 1, 0, 1]) > a.log_likelihood([0, 1, 0]) + 3 and a.log_likelihood([0, 1, 0, 1]) > a.log_likelihood([0, 1, 0, 1, 1]) + 3
    assert len(a.ends) < 12


def test_odd_documents(odd_documents, no_documents):
    formats = secrets.learned(odd_documents)
    assert formats.credentials == []
    assert secrets.scanned(odd_documents, formats).where("spans = ''").count() == odd_documents.count()
    same = secrets.redacted(odd_documents, formats)
    assert same.columns == odd_documents.columns
    assert sorted(map(str, same.collect())) == sorted(map(str, odd_documents.collect()))
    assert secrets.scanned(no_documents, secrets.learned(no_documents)).count() == 0


def test_overlapping_spans_are_masked_once():
    assert secrets._masked("ab token=0123 cd", [(3, 0, 13), (9, 2, 13)], "#") == "ab # cd"
    assert secrets._masked("abcdef", [(1, 0, 3), (2, 1, 5)], "#") == "a#f"


def test_glued_credentials_are_found(spark, words):
    """At a sentence end, behind a name or in a path, and on both sides of a run of hex digits."""
    credentials, ordinary = words
    rng = random.Random(2)
    rows = [(i, f"some {rng.choice(ordinary)} here token = {c}\nand more {rng.choice(ordinary)}.") for i, c in enumerate(credentials[:200])]
    formats = secrets.learned(spark.createDataFrame(rows, "doc_id long, text string"))
    for c in [c for c in credentials[200:] if formats.is_secret(c)][:50]:
        for before, after in (("the end ", "."), ("auth=", ""), ("see /path/", "/x"), (f"{ordinary[0]}/", "-")):
            text = f"{before}{c}{after}"
            at = text.index(c)
            assert any(a <= at and at + len(c) <= b for a, k, b in secrets.spans(text, formats) if k == 3), text
        text = f"a {c}0123456789abcdef{c} b"
        assert secrets._masked(text, secrets.spans(text, formats), "#") == "a # b"
    for text in (f"{ordinary[0]}/{ordinary[1]}.", f"/{ordinary[2]}/0123456789abcdef0.{ordinary[3]}", "=" * 40, "/".join(ordinary[:4])):
        assert not [s for s in secrets.spans(text, formats) if s[1] == 3], text
