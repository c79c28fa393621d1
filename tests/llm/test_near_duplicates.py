"""ProbMinHash classes against all pairs, and its parts against their definitions."""

from __future__ import annotations

import itertools
import random
from collections import Counter

import numpy as np

from pedalstrata.llm import probminhash, textcodes
from pedalstrata.llm.components import components
from pedalstrata.llm.queries import QUERIES


def tokens(text):
    return "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()


def bag(text):
    w = tokens(text)
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def probability_jaccard(a, b):
    p, q = ({k: v / sum(x.values()) for k, v in x.items()} for x in (a, b))
    every = p.keys() | q.keys()
    return sum(
        1 / sum(max(p.get(e, 0) / p[d], q.get(e, 0) / q[d]) for e in every) for d in p.keys() & q.keys()
    )


def linked(a, b):
    if not a or not b:
        return not a and not b
    return len(a.keys() & b.keys()) / len(a.keys() | b.keys()) >= 0.8


def brute_force(rows):
    """Partition of row numbers by links over all pairs."""
    bags, parent = [bag(t) for _, t in rows], list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if root(i) != root(j) and linked(bags[i], bags[j]):
            parent[root(i)] = root(j)
    return [root(i) for i in range(len(rows))]


def partition(labels, ids):
    groups = {}
    for label, i in zip(labels, ids, strict=True):
        groups.setdefault(label, []).append(i)
    return sorted(sorted(g, key=str) for g in groups.values())


def edited(words, n, rng):
    words = list(words)
    for i in rng.sample(range(len(words)), n):
        words[i] = f"new{rng.random()}"
    return " ".join(words)


def family(rng, size=150):
    """An original, copies with ever more words replaced, and chains of edits."""
    base = [f"w{rng.randrange(5000)}" for _ in range(size)]
    chain, texts = base, [" ".join(base)]
    for n in (1, 1, 2, 2, 3, 3, 4, 5, 6, 9):
        texts.append(edited(base, n, rng))
        chain = edited(chain, 2, rng).split()
        texts.append(" ".join(chain))
    return texts


def test_op2_against_all_pairs(spark, sf_dir, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = QUERIES["op2_probminhash"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == sorted(d for d, _ in rows)
    want = partition(brute_force(rows), [d for d, _ in rows])
    assert partition([r.class_id for r in got], [r.doc_id for r in got]) == want
    assert all(r.class_id <= r.doc_id for r in got)


def test_families_of_copies(spark):
    rng = random.Random(3)
    texts = [t for _ in range(8) for t in family(rng)]
    texts += [texts[0]] * 30 + ["short one"] * 3 + ["Short, one!"]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = probminhash.classes(docs).collect()
    want = partition(brute_force(rows), [i for i, _ in rows])
    assert partition([r.class_id for r in got], [r.doc_id for r in got]) == want
    kept = probminhash.representatives(docs).collect()
    assert sorted(r.doc_id for r in kept) == sorted(min(g) for g in want)


def test_blocks_of_a_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(probminhash, "BLOCK", 5)
    test_families_of_copies(spark)


def test_odd_documents(odd_documents, no_documents):
    rows = odd_documents.collect()
    got = probminhash.classes(odd_documents).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in rows)
    classes = {}
    for r in got:
        classes.setdefault(r.class_id, []).append(r.doc_id)
    # The two equal rows with id 1 are one class, named like the other text with id 1; wordless texts are one.
    assert sorted(classes[1], key=str) == [1, 1, 1]
    assert sorted(classes[2], key=str) == [2, 3, 4, None, None]
    kept = probminhash.representatives(odd_documents)
    assert kept.columns == odd_documents.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 1, 2, None, 5, 6, -7])
    assert probminhash.classes(no_documents).count() == 0 and probminhash.representatives(no_documents).count() == 0


def test_jaccard():
    rng = random.Random(1)
    for _ in range(50):
        a, b = ({rng.randrange(12) for _ in range(rng.randrange(1, 12))} for _ in range(2))
        assert probminhash.jaccard(*(np.array(sorted(x)) for x in (a, b))) == len(a & b) / len(a | b)
    assert probminhash.jaccard(np.empty(0), np.empty(0)) == 1.0


def test_a_common_line_does_not_join_texts(spark):
    """A line repeated all over two texts weighs more than its words, but the texts still differ."""
    rng = random.Random(6)
    line = "all rights are reserved by the owner of this page\n"
    rows = [(i, line * 30 + " ".join(f"w{rng.randrange(10**6)}" for _ in range(40))) for i in range(12)]
    got = probminhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.class_id == r.doc_id for r in got)
    ids, text, weights = probminhash.weighted(*textcodes.shingles(textcodes.words([line * 30]), 5))
    assert len(ids) == 10 and abs(weights.max() - (1 + np.log(30))) < 1e-9 and set(text) == {0}


def test_registers_agree_with_probability_jaccard():
    """Also between texts of very different length: arrivals depend on the shingle alone."""
    rng = np.random.default_rng(2)
    for n, shared in ((3, 2), (40, 30), (900, 500)):
        ids = np.unique(rng.integers(1, 2**47, 2 * n).astype(np.uint64))
        a, b = ids[:n], ids[n - shared : 2 * n - shared]
        p, q = (rng.integers(1, 4, len(x)).astype(float) for x in (a, b))
        text = np.repeat([0, 1], [len(a), len(b)])
        s = probminhash.signatures(np.concatenate([a, b]), text, np.concatenate([p, q]), 2, registers=4096)
        want = probability_jaccard(dict(zip(a.tolist(), p)), dict(zip(b.tolist(), q)))
        assert abs((s[0] == s[1]).mean() - want) < 5 * (0.25 / 4096) ** 0.5
        alone = probminhash.signatures(b, np.zeros(len(b), int), q, 1, registers=4096)
        assert (alone[0] == s[1]).all()


def test_shingles_and_nodes():
    texts = ["A b, c d e f", "a b c d e f!", "", None, "one two"]
    w = textcodes.words(texts)
    h, text = textcodes.shingles(w, 5)
    assert Counter(text.tolist()) == {0: 2, 1: 2, 4: 1} and h[:2].tolist() == h[2:4].tolist()
    nodes = probminhash._nodes(w)
    assert nodes[0] == nodes[1] and nodes[2] == nodes[3] and len(set(nodes.tolist())) == 3


def test_components(spark):
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(300, 340)]
    loose = [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(70)]
    edges = chain + star + loose + [(5, 5), (2, None)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in chain + star + loose:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    nodes = {x for e in chain + star + loose if e[0] != e[1] for x in e}
    assert got == {n: root(n) for n in nodes}


def test_a_sketch_collision_does_not_lose_a_pair():
    """An earlier band agrees in the sketch by chance only; the pair is compared in the band that it shares."""
    import pyarrow as pa

    n = probminhash.BANDS
    keys = [list(range(100, 100 + n)), list(range(1000, 1000 + n))]
    keys[1][30] = keys[0][30]
    sketch = [bytes(probminhash.REGISTERS)] * 2
    text = " ".join(f"w{i}" for i in range(60))
    columns = {"node": [1, 2], "root": [1, 2], "mine": [0, 0], "i": [0, 0], "j": [0, 0], "band": [30, 30], "key": [keys[0][30]] * 2}
    rows = pa.table(columns | {"sketch": pa.array(sketch, pa.binary()), "bands": pa.array(keys, pa.list_(pa.int64())), "text": [text, f"{text} more"]})
    assert probminhash._joined(rows, np.array([0]), 0.8).to_pylist() == [{"u": 1, "v": 2}]
    # In any other bucket of theirs they are left to that one.
    both = [[*keys[0]], [*keys[1]]]
    both[0][40] = both[1][40] = 7
    rows = rows.set_column(rows.column_names.index("bands"), "bands", pa.array(both, pa.list_(pa.int64())))
    assert probminhash._joined(rows, np.array([0]), 0.8).num_rows == 0


def test_repeats_do_not_hide_a_link(spark):
    """Plain Jaccard 0.96, probability Jaccard 0.6: one text repeats a line a thousand times."""
    rng = random.Random(12)
    rows = []
    for i in range(30):
        words = " ".join(f"w{rng.randrange(10**9)}" for _ in range(100))
        line = "\n" + " ".join(f"v{rng.randrange(10**9)}" for _ in range(10))
        rows += [(2 * i, words + line), (2 * i + 1, words + line * 1000)]
    assert all(linked(bag(a[1]), bag(b[1])) for a, b in zip(rows[::2], rows[1::2], strict=True))
    got = probminhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == {d: d - d % 2 for d, _ in rows}


def test_bands_of_both_weights(spark):
    """Texts with a repeat have both band lists, in their own row; the sketch is that of unit weights."""
    texts = ["a b c d e f", "a b c d e a b c d e a b c d e f", "", "x " * 40, "one"]
    rows = probminhash.signed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)).collect()
    assert [len(r.bands) // probminhash.BANDS for r in rows] == [1, 2, 0, 2, 1]
    for r in rows:
        alone = textcodes.words([texts[r.doc_id]])
        ids, text, weights = probminhash.weighted(*textcodes.shingles(alone, 5))
        for n, w in enumerate([np.ones(len(ids)), weights][: len(r.bands) // probminhash.BANDS]):
            s = probminhash.signatures(ids, text, w, 1)
            assert r.bands[n * probminhash.BANDS : (n + 1) * probminhash.BANDS] == probminhash.bands(s).view(np.int64)[0].tolist()
