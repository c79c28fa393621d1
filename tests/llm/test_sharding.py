"""The uniform shuffle: exact sizes, every row once, and places that look uniform."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from pedalstrata.llm import sharding
from pedalstrata.llm.queries import QUERIES


def check_places(rows, n_shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    sizes = [len(slots.get(s, [])) for s in range(n_shards)]
    assert max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(n_shards))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_op7(spark, sf_dir, documents):
    rows = QUERIES["op7_shard"](spark, sf_dir).collect()
    check_places(rows, 16)
    given = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in documents.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == given
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}


@pytest.mark.parametrize("bucket_rows", [1, 7, 10_000])
def test_odd_rows_stay_whole(odd_documents, bucket_rows):
    out = sharding.uniform_shards(odd_documents.repartition(4), 5, bucket_rows=bucket_rows)
    rows = out.collect()
    check_places(rows, 5)
    assert [f.name for f in out.schema] == [c for c in odd_documents.columns if c != "shard"] + ["shard", "slot"]
    key = lambda r: (r.doc_id, r.text, r.lang, r.part)
    assert Counter(map(key, rows)) == Counter(map(key, odd_documents.collect()))


def test_nothing_and_fewer_rows_than_shards(spark, no_documents):
    assert sharding.uniform_shards(no_documents).count() == 0
    rows = sharding.uniform_shards(spark.range(3)).collect()
    check_places(rows, 16)


def test_matrix_has_exact_margins_and_hypergeometric_cells():
    parts, shards = np.array([30, 0, 50, 21]), 4
    cells = []
    for seed in range(2000):
        m = sharding.communication_matrix(parts, shards, seed)
        assert (m.sum(axis=1) == parts).all() and (m.sum(axis=0) == sharding.shard_sizes(101, shards)).all()
        cells.append(m[2, 1])
    # Row of 50, shard of 25, out of 101.
    mean, var = 50 * 25 / 101, 50 * 25 / 101 * (76 / 101) * (51 / 100)
    assert abs(np.mean(cells) - mean) < 4 * (var / 2000) ** 0.5 and abs(np.var(cells) / var - 1) < 0.15


def test_hypergeometric_draws():
    rng = np.random.default_rng(3)
    for good, bad, n in ((5, 7, 6), (0, 9, 4), (9, 0, 4), (3, 2, 5), (40, 1, 30)):
        draws = [sharding.hypergeometric(rng, good, bad, n) for _ in range(4000)]
        ways = [math.comb(good, k) * math.comb(bad, n - k) if n - k <= bad else 0 for k in range(min(n, good) + 1)]
        for k, w in enumerate(ways):
            p = w / math.comb(good + bad, n)
            assert abs(draws.count(k) / 4000 - p) < 5 * (p * (1 - p) / 4000) ** 0.5 + 1e-9
    large = [sharding.hypergeometric(rng, 3 * 10**9, 45 * 10**9, 10**6) for _ in range(500)]
    assert abs(np.mean(large) - 62_500) < 5 * 242 / 500**0.5 and 210 < np.std(large) < 275


def test_places_are_uniform_over_seeds(spark):
    """Chi-square over all places of a few rows; the bound is far beyond chance."""
    df = spark.range(12, numPartitions=3)
    seen = np.zeros((12, 12))
    for seed in range(60):
        for r in sharding.uniform_shards(df, 3, seed=seed, bucket_rows=2).collect():
            seen[r.id, r.shard * 4 + r.slot] += 1
    assert ((seen - 5) ** 2 / 5).sum() < 220  # 121 degrees of freedom


def test_equal_seeds_give_equal_places(spark):
    df = spark.range(100, numPartitions=4)
    one, two = (sorted(map(tuple, sharding.uniform_shards(df, 3, seed=4).collect())) for _ in range(2))
    assert one == two != sorted(map(tuple, sharding.uniform_shards(df, 3, seed=5).collect()))
