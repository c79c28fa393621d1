from __future__ import annotations

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from pedalstrata.llm import decontaminate


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute_force(docs, items):
    """(doc, item) by laying every item over every place."""
    found = set()
    for (d, text), (i, item) in itertools.product(docs, items):
        w, v = words(text), words(item)
        run = min(len(v), 13)
        allowed = 2 if run >= 12 else 1 if run >= 8 else 0
        for shift in range(-len(v) + 1, len(w)) if v else ():
            same = [0 <= shift + j < len(w) and w[shift + j] == x for j, x in enumerate(v)]
            if any(sum(same[a : a + run]) >= run - allowed for a in range(len(v) - run + 1)):
                found.add((d, i))
                break
    return found


@pytest.mark.parametrize("run,differ", [(13, 2), (12, 2), *[(n, 1) for n in range(8, 12)]])
def test_masks_miss_no_run(run, differ):
    for places in itertools.combinations(range(run), differ):
        assert any(
            all(at + p not in places for p in mask) for mask in decontaminate.MASKS for at in range(run - mask[-1])
        )


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(9)
    vocabulary = ["the", "of", "and", *[f"w{i}" for i in range(60)]]
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, say(n)) for i, n in enumerate([40, 30, 20, 14, 13, 12, 11, 9, 8, 7, 5, 3, 1])]
    docs = [(100 + k, say(60)) for k in range(20)]
    for k in range(160):
        i, item = rng.choice(items[:11])
        part = list(item)
        if len(part) > 20 and rng.random() < 0.5:
            at = rng.randrange(len(part) - 14)
            part = part[at : at + rng.randrange(10, 15)]
        for j in rng.sample(range(len(part)), min(len(part), rng.randrange(5))):
            part[j] = "other"
        docs.append((1000 + k, say(rng.randrange(30)) + part + say(rng.randrange(30))))
    items += [(50, items[0][1]), (51, []), (None, items[1][1])]
    shown = lambda rows: [(i, ", ".join(w).upper() + ".") for i, w in rows]
    return shown(docs), [*shown(items), (60, None), (61, "...")]


@pytest.mark.parametrize("block", [200_000, 40])
def test_pairs_are_those_of_brute_force(spark, planted, block):
    docs, items = planted
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated_pairs(d, b, block).collect()}
    # Item 50 repeats item 0; the unnamed item repeats item 1: both are told.
    want = brute_force(docs, items)
    assert got == want and len(want) > 60 and {i for _, i in want} >= {None, 0, 50}
    kept = sorted(r.doc_id for r in decontaminate.clean(d, b, block).collect())
    assert kept == sorted(x for x, _ in docs if x not in {a for a, _ in want})


def test_odd_documents(spark, odd_documents, no_documents):
    b = spark.createDataFrame([(1, "a text whose document id is null stays in the table", "x")], "item_id long, text string, seed string")
    pairs = decontaminate.contaminated_pairs(odd_documents, b).collect()
    assert [(r.doc_id, r.item_id, r.agreeing_words, r.first_word) for r in pairs] == [(None, 1, 11, 0)]
    kept = decontaminate.clean(odd_documents, b)
    assert kept.columns == odd_documents.columns and kept.count() == odd_documents.count() - 1
    none = b.limit(0)
    assert decontaminate.clean(odd_documents, none).count() == odd_documents.count()
    assert decontaminate.contaminated_pairs(no_documents, b).count() == 0


def test_a_long_item_is_broadcast_once(spark):
    """Hashes travel without the words of their item: 4,000 words are not sent 8,000 times."""
    rng = random.Random(3)
    item = [f"w{rng.randrange(10**6)}" for _ in range(4000)]
    items = [(1, " ".join(item)), (2, "one two three four five six seven eight nine"), (3, " ".join(item))]
    docs = [(10, "so " + " ".join(item[2000:2040])), (11, "one two three four five six seven eight nine"), (12, "nothing")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    stored, ids = decontaminate.benchmark_items(b, 1000)
    assert stored.count() == 2 and ids.count() == 3
    # A block begins where so many words lie before it: the long item is alone in its block or last in it.
    words_of = {r.block: r.n for r in stored.selectExpr("block", "size(item) n").groupBy("block").agg(F.sum("n").alias("n")).collect()}
    assert max(words_of.values()) <= 1000 + 4000
    seeds = decontaminate.item_seeds(stored, dict(enumerate(decontaminate.MASKS)))
    assert set(seeds.columns) == {"item_no", "block", "item_at", "seed"}
    got = {(r.doc_id, r.item_id, r.item_words) for r in decontaminate.contaminated_pairs(d, b, 1000).collect()}
    assert got == {(10, 1, 4000), (10, 3, 4000), (11, 2, 9)}


def test_plan_stays_in_the_jvm(spark, planted):
    docs, items = planted
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    plan = decontaminate.contaminated_pairs(d, b)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
