from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use inside or add.
        *[T.StructField(c, T.StringType()) for c in ("shard", "key", "node", "score", "kept", "part", "at", "text_key")],
    ]
)
LONG = " ".join(f"word{i % 977} of{i}" for i in range(15_000))


def _row(doc_id, text, lang="en"):
    return (doc_id, text, lang, None, None if text is None else len(text), *["x"] * 8)


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and blank texts, a very long one, repeated rows, clashing names."""
    rows = [
        _row(1, "The cat sat on the mat and then the dog sat on the cat."),
        _row(1, "The cat sat on the mat and then the dog sat on the cat."),
        _row(1, "another text with the same id as the first ones has here"),
        _row(2, None),
        _row(3, ""),
        _row(4, " \n\t \n"),
        _row(None, "a text whose document id is null stays in the table"),
        _row(None, None, None),
        _row(5, LONG),
        _row(6, "1234 5678 !!! ???", None),
        _row(-7, "der hund und die katze und das haus", "de"),
        (None,) * 13,
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
