"""The Merkle manifest against a plain tree built in Python."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pedalstrata.llm import merkle
from pedalstrata.llm.queries import QUERIES

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    """Root and, per node, its sibling strings (left, right) from the bottom up."""
    paths, places, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        runs = [level[i : i + 16] for i in range(0, len(level), 16)]
        for n, at in enumerate(places):
            run = runs[at // 16]
            paths[n].append(("".join(run[: at % 16]), "".join(run[at % 16 + 1 :])))
        places, level = [at // 16 for at in places], [digest(*run) for run in runs]
    return (level[0] if level else None), paths


def expected(rows):
    """(doc_id, leaf, subroot, root, proof digest, folded root) of every row."""
    groups = defaultdict(list)
    for r in rows:
        values = [r[c] for c in FIELDS]
        low = None if r.text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text)
        leaf, other = digest(*map(field, values)), digest(*map(field, [*values[:-1], low]))
        tampered = zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 5 == 0
        groups[r.source].append((r.doc_id is not None, r.doc_id or 0, leaf, r.doc_id, other if tampered else leaf))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        groups[s].sort(key=lambda x: x[:3])
    trees = {s: tree([x[2] for x in groups[s]]) for s in order}
    root, above = tree([trees[s][0] for s in order])
    out = []
    for s, high in zip(order, above, strict=True):
        for (_, _, leaf, doc_id, claimed), low in zip(groups[s], trees[s][1], strict=True):
            path, node = low + high, claimed
            for left, right in path:
                node = digest(left, node, right)
            out.append((doc_id, leaf, trees[s][0], root, digest(*[a + b for a, b in path]), node, node == root))
    return Counter(out)


def found(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    return Counter(map(tuple, QUERIES["op13_merkle"](spark, str(tmp_path)).collect()))


def test_op13(spark, sf_dir, documents):
    rows = QUERIES["op13_merkle"](spark, sf_dir).collect()
    assert Counter(map(tuple, rows)) == expected(documents.collect())
    assert 0 < sum(not r.verified for r in rows) < len(rows) / 4


def test_odd_documents(spark, odd_documents, no_documents, tmp_path):
    """Null ids and groups, repeated rows, one id with several texts, negative ids."""
    assert found(spark, odd_documents, tmp_path) == expected(odd_documents.collect())
    assert QUERIES["op13_merkle"](spark, str(tmp_path)).count() == odd_documents.count()
    no_documents.write.mode("overwrite").parquet(str(tmp_path / "none" / "documents.parquet"))
    assert QUERIES["op13_merkle"](spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("sizes", [[1], [16], [17], [1, 16, 17, 256, 257, 300], [1] * 40])
def test_tree_shapes(spark, sizes, tmp_path):
    """Group sizes at and around the powers of the fan-out; sparse, large and negative ids."""
    rows = [
        ((i * 7919 - 500) * (3**20 if g % 2 else 1), f"Text {g} {i}", "en", f"s{g}", i)
        for g, n in enumerate(sizes)
        for i in range(n)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    assert found(spark, docs, tmp_path) == expected(docs.collect())


def test_hot_ids(spark, tmp_path):
    """A third of all rows have one id, in one group; others have no id."""
    docs = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 77).when(F.col("id") % 10 == 1, None).otherwise(F.col("id")).alias("doc_id"),
        F.concat(F.lit("Body "), (F.col("id") % 500).cast("string")).alias("text"),
        F.lit("en").alias("lang"),
        F.when(F.col("id") % 7 < 6, "big").alias("source"),
        F.lit(5).cast("long").alias("n_chars"),
    )
    assert found(spark, docs, tmp_path) == expected(docs.collect())


def test_proofs_are_bound_to_their_row(spark):
    rows = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.col("id").cast("string").alias("text"))
    proofs = merkle.manifest(rows.select("doc_id", "source", merkle.leaf([F.col("text")]).alias("leaf"), "text"))
    path = F.col("path")
    right = merkle.folded(merkle.leaf([F.col("text")]), path) == F.col("root")
    wrong = merkle.folded(merkle.leaf([F.concat("text", F.lit(" "))]), path) == F.col("root")
    assert proofs.agg(F.count_if(right), F.count_if(wrong)).first() == (300, 0)
