"""Encoding, token files and packing against the tokenizer itself."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from pedalstrata.llm import encoding, packing, token_files
from pedalstrata.llm.common import tokenizer_path
from pedalstrata.llm.encoding import Encoder, Store
from pedalstrata.llm.queries import QUERIES
from pedalstrata.sources.staging import shared_dir

PARTS = [" ", "  ", "\n", "\t", "a", "bc", "'s", "'re", ",", ".", "é", "ß", " ", "　", "\x1c", "\x85", "1", "日本", "👍", "x" * 300, "\r\n"]


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def encoder():
    return Encoder(tokenizer_path(), store_bits=8)  # small: it is emptied again and again


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(PARTS)).map("".join), st.text()), max_size=6))
def test_encoder_gives_the_tokenizers_ids(encoder, tokenizer, texts):
    clean = [None if t is None else t.encode("utf-8", "ignore").decode() for t in texts]
    ids, lengths = encoder.encode(pa.array(clean, pa.string()))
    want = [ids_of(tokenizer, t) for t in clean]
    assert ids.tolist() == [i for x in want for i in x]
    assert lengths.tolist() == [len(x) for x in want]


def test_store_finds_what_was_added():
    rng = np.random.default_rng(0)
    hashes = np.unique(rng.integers(1, 2**64, 3000, np.uint64))
    store = Store(13)
    store.add(hashes[:2000], np.arange(2000, dtype=np.int32))
    assert (store.find(hashes[:2000]) == np.arange(2000)).all() and (store.find(hashes[2000:]) == -1).all()


class Task:
    """Stands for a frame and gives out what a task runs."""

    def select(self, *columns):
        return self

    def mapInArrow(self, task, schema):
        return task


def test_texts_are_encoded_in_small_steps(monkeypatch, tokenizer):
    """However large Spark's batches are, a worker holds the arrays of little text and few encodings at a time."""
    asked, given_texts = [], []

    class Spy:
        def encode_batch_fast(self, pieces, **options):
            asked.append(len(pieces))
            return tokenizer.encode_batch_fast(pieces, **options)

    class Watched(Encoder):
        def encode(self, texts):
            given_texts.append(texts.nbytes)
            return super().encode(texts)

    encoder = Watched(tokenizer_path())
    encoder.tokenizer = Spy()
    monkeypatch.setattr(token_files, "worker_encoder", lambda path: encoder)
    monkeypatch.setattr(token_files, "TaskContext", type("Context", (), {"get": classmethod(lambda c: c), "partitionId": lambda: 3}))
    texts = [" ".join(f"w{i}x{j}" for j in range(400)) for i in range(400)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(400)), "text": pa.array(texts)})
    rows = [r for b in token_files.encoded(Task(), "unused")(iter([batch])) for r in b.to_pylist()]
    assert [r["ids"] for r in rows] == [ids_of(tokenizer, t) for t in texts]
    assert [r["local_start"] for r in rows] == [sum(r["n_tokens"] for r in rows[:i]) for i in range(400)]
    assert sum(map(len, texts)) > 1_000_000 and max(given_texts) < 150_000 and max(asked) <= 1000


@pytest.mark.parametrize("lean", [False, True])
def test_lean_packing_frees_the_encoders(encoder, tokenizer, monkeypatch, lean):
    """Workers of the first pass serve the second one too, and whatever follows it."""
    monkeypatch.setattr(encoding, "_ENCODERS", held := {"path": encoder})
    ids = [ids_of(tokenizer, t) for t in ("one text", "another text of a few more words")]
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "start": [0, len(ids[0])], "ids": pa.array(ids, pa.list_(pa.int32()))})
    gather = packing.Packed(Task(), 4, lean).records()
    records = [r for b in gather(iter([batch])) for r in b.to_pylist()]
    assert [i for r in records for i in r["ids"]] == ids[0] + ids[1]
    assert bool(held) is not lean


def test_the_pipeline_packs_lean(spark, sf_dir, documents, monkeypatch):
    asked, real = [], packing.pack
    monkeypatch.setattr(packing, "pack", lambda *a, **b: asked.append(b) or real(*a, **b))
    corpus_pipeline.pack(spark, documents.limit(5), sf_dir)
    assert asked == [{"lean": True}]


def expected_index(rows, tokenizer):
    out, at = [], 0
    for doc_id, text in rows:
        ids = ids_of(tokenizer, text)
        out.append((doc_id, at, len(ids), crc(ids)))
        at += len(ids)
    return out


def test_op1_against_the_tokenizer(spark, sf_dir, documents, tokenizer):
    got = sorted(map(tuple, QUERIES["op1_token_orc"](spark, sf_dir).collect()))
    rows = sorted((r.doc_id, r.text) for r in documents.collect())
    assert got == expected_index(rows, tokenizer)


def test_token_files_of_odd_documents(spark, odd_documents, no_documents, tokenizer):
    path = shared_dir(spark)
    token_files.write_token_files(odd_documents, path, tokenizer_path(), partitions=3)
    got = sorted(token_files.document_index(spark, path).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x))
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:i]) for i in range(len(got))]
    want = sorted(crc(ids_of(tokenizer, r.text)) for r in odd_documents.collect())
    assert sorted(r.ids_crc32 for r in got) == want
    empty = shared_dir(spark)
    token_files.write_token_files(no_documents, empty, tokenizer_path())
    assert token_files.document_index(spark, empty).count() == 0


def test_conditions_reach_the_orc_reader(spark, documents):
    path = shared_dir(spark)
    token_files.write_token_files(documents, path, tokenizer_path(), partitions=2, index_stride=1000)
    some = token_files.read_token_files(spark, path, doc_ids=[3, 150])
    assert sorted(r.doc_id for r in some.collect()) == [3, 150]
    assert "In(doc_id, [150,3])" in (plan := some._jdf.queryExecution().executedPlan().toString()) or "In(doc_id, [3,150])" in plan
    few = token_files.read_token_files(spark, path, between=(10, 19))
    assert few.count() == 10 and "GreaterThanOrEqual(doc_id,10)" in few._jdf.queryExecution().executedPlan().toString()
    files = [f for f in spark.read.format("binaryFile").load(path).select("content").collect() if f]
    assert all(bytes(f.content[:3]) == b"ORC" for f in files)


def rows_scanned(df):
    """Rows that the scan gave out, after the reader skipped what it could."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def test_stripes_and_row_groups_are_skipped(spark, documents):
    """One file of several stripes; a condition on ids leaves most of its rows unread."""
    docs = documents.crossJoin(spark.range(40)).selectExpr("doc_id * 40 + id as doc_id", "left(text, 400) as text")
    path = shared_dir(spark)
    token_files.write_token_files(docs, path, tokenizer_path(), partitions=1, stripe_bytes=1 << 16, index_stride=1000)
    total = docs.count()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        whole = token_files.read_token_files(spark, path)
        assert rows_scanned(whole) == total and whole.rdd.getNumPartitions() > 1  # several tasks read the one file
        spread = sorted(r.n for r in whole.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())
        assert len(spread) > 1 and spread[-1] < total
        one = token_files.read_token_files(spark, path, doc_ids=[total // 2])
        assert one.count() == 1 and rows_scanned(one) <= 1000
        few = token_files.read_token_files(spark, path, between=(100, 1099))
        assert few.count() == 1000 and rows_scanned(few) <= 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def check_pieces(rows, texts, tokenizer, window):
    """Every id in one piece; sequences gapless and full but for the last."""
    by_place = sorted(rows, key=lambda r: (r.sequence_id, r.offset))
    at, stream = 0, []
    for r in by_place:
        assert r.sequence_id * window + r.offset == at and 0 < r.length <= window - r.offset
        at += r.length
    documents, held = [], []
    for r in by_place:
        if r.start == 0:
            held = []
        held.append(r)
        if r.start + r.length == r.doc_tokens:
            documents.append(held)
    assert sum(len(d) for d in documents) == len(by_place)
    want = {}
    for doc_id, text in texts:
        ids = ids_of(tokenizer, text)
        want.setdefault((doc_id, len(ids)), []).append(ids)
    for pieces in documents:
        options = want[pieces[0].doc_id, pieces[0].doc_tokens]
        cut = [(p.start, p.length, p.ids_crc32) for p in pieces]
        match = next(ids for ids in options if cut == [(a, n, crc(ids[a : a + n])) for a, n, _ in cut])
        options.remove(match)
        stream += match
    assert not any(want.values())
    return stream


@pytest.mark.parametrize("batch_rows", [1, 7, 10_000])
def test_packing_in_small_batches(spark, documents, tokenizer, batch_rows):
    """Windows that go on over many batches of a task, and over tasks."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch_rows))
    try:
        docs = documents.selectExpr("doc_id", "left(text, 120) as text").repartition(3)
        written = packing.pack(docs, tokenizer_path(), 512).write(shared_dir(spark))
        check_pieces(packing.pieces_of(written).collect(), [(r.doc_id, r.text) for r in docs.collect()], tokenizer, 512)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


@pytest.mark.parametrize("window", [16, 1024])
def test_packing(spark, documents, odd_documents, tokenizer, window):
    for docs in (documents.repartition(5), odd_documents.repartition(3)):
        packed = packing.pack(docs, tokenizer_path(), window)
        written = packed.write(shared_dir(spark), pad=50256)
        stream = check_pieces(packing.pieces_of(written).collect(), [(r.doc_id, r.text) for r in docs.collect()], tokenizer, window)
        sequences = written.orderBy("sequence_id").collect()
        assert [r.sequence_id for r in sequences] == list(range(-(-len(stream) // window)))
        flat = [i for r in sequences for i in r.ids]
        assert flat[: len(stream)] == stream and set(flat[len(stream) :]) <= {50256} and len(flat) % window == 0
        assert sum(r.n_tokens for r in sequences) == len(stream)
        assert all(r.n_tokens == sum(p.length for p in r.pieces) for r in sequences)
        parts = [r for r in packed.records().select("sequence_id", "n_tokens", F.spark_partition_id().alias("task")).collect() if r.n_tokens < window]
        assert all(n <= 2 for n in Counter(r.task for r in parts).values())
        # Windows that two tasks share exist, and come from boundary records.
        bounds = token_files.part_offsets(spark.read.orc(*{f.rsplit("/", 1)[0] for f in packed.rows.inputFiles()}))
        assert any(r.part_start % window for r in bounds.collect())


def test_packing_nothing(spark, no_documents):
    packed = packing.pack(no_documents, tokenizer_path())
    written = packed.write(shared_dir(spark))
    assert written.count() == 0 and packing.pieces_of(written).count() == 0


def test_op3_covers_the_table(spark, sf_dir, documents, tokenizer):
    rows = QUERIES["op3_pack"](spark, sf_dir).collect()
    check_pieces(rows, [(r.doc_id, r.text) for r in documents.collect()], tokenizer, 1024)
