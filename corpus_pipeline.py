"""Documents to packed training sequences: the stages, and a run of all of them.

Every stage takes ``(spark, docs, sf_dir)``; what it returns is written as Parquet and read again
as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pedalstrata.llm import decontaminate, language_crf, packing, probminhash, secret_automata
from pedalstrata.llm.common import fold, table, tokenizer_path
from pedalstrata.sources.staging import shared_dir, stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without letters and texts without a main language.

    The model learns from the labelled documents of three of four folds; the evidence that a text
    needs is set on those of the fourth. Without any label only texts without letters go.
    """
    held_out = fold(F.col("doc_id"), 4) == 2
    model = language_crf.train(docs, held_out)
    if model is None:
        return docs.where(F.col("text").cast("string").rlike(r"\p{L}"))
    names = {c: "text" if c.lower() == "text" else f"_{i}" for i, c in enumerate(docs.columns)}
    given = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    least = language_crf.least_evidence(docs, held_out, model)
    told = language_crf.predicted(given, model, list(names.values()), least)
    return told.select(*[F.col(n).alias(c) for c, n in names.items()])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near-duplicates."""
    return probminhash.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark passage."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret in the texts with a mark; no document is dropped."""
    return secret_automata.redacted(docs, secret_automata.learned(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut what is left into sequences of 1024 token ids; one row per sequence, with its documents."""
    # The workers of earlier stages serve this one too, so they are to hold little.
    sequences = packing.pack(docs, tokenizer_path(), lean=True).write(shared_dir(spark))
    return sequences.withColumn("doc_ids", F.col("pieces.doc_id"))


STAGES = [
    ("language ID", identify_language),
    ("near-dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret scans", mask_secrets),
    ("packing", pack),
]

# Tokenizers and trained models are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage_of in STAGES[:-1]:
        docs = stage(stage_of(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
