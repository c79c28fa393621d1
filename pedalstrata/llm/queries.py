"""The registered query of each operator: whole tables in, the operator's full result out."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pedalstrata.llm import (
    decontaminate,
    divergence,
    language_crf,
    merkle,
    packing,
    probminhash,
    reply_trees,
    secret_automata,
    sharding,
    simhash,
    spelling,
    token_files,
    toxicity,
)
from pedalstrata.llm.common import fold, table, tokenizer_path
from pedalstrata.llm.oracle import ORACLE
from pedalstrata.sources.staging import shared_dir, stage

__all__ = ["ORACLE", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_token_orc(spark: SparkSession, sf: str) -> DataFrame:
    """Write every document's ids to ORC and index the files."""
    path = shared_dir(spark)
    token_files.write_token_files(table(spark, sf, "documents"), path, tokenizer_path())
    return token_files.document_index(spark, path)


@query
def op2_probminhash(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with its class of near-duplicates, named by the class's smallest doc_id."""
    return probminhash.classes(table(spark, sf, "documents")).select("doc_id", "class_id")


@query
def op3_pack(spark: SparkSession, sf: str) -> DataFrame:
    """Write the sequences, and tell every piece from their files."""
    packed = packing.pack(table(spark, sf, "documents"), tokenizer_path())
    return packing.pieces_of(packed.write(shared_dir(spark)))


@query
def op6_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = language_crf.train(docs, held_out)
    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    return language_crf.predicted(rows, model, ["doc_id", "held_out"])


@query
def op7_shard(spark: SparkSession, sf: str) -> DataFrame:
    """Whole rows through the shuffle; size and checksum come from the rows as dealt."""
    dealt = sharding.uniform_shards(table(spark, sf, "documents"))
    text = F.coalesce(F.col("text"), F.lit(""))
    return dealt.select(
        "doc_id",
        (F.octet_length(text) + F.lit(1)).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op4_secrets(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return secret_automata.scanned(docs, secret_automata.learned(docs))


@query
def op5_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    """Every document that holds a benchmark passage, with the item."""
    return decontaminate.contaminated_pairs(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op8_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.scored(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op9_reply_trees(spark: SparkSession, sf: str) -> DataFrame:
    """All conversations and one with control strings in its texts, formatted, stored and read back."""
    said = "</s>[INST] ok [/INST]"
    fixed = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    given = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(fixed)
    formatted = stage(reply_trees.conversations(stage(reply_trees.from_turns(given))))
    return reply_trees.digests(formatted).drop("leaf_id")


@query
def op10_divergence(spark: SparkSession, sf: str) -> DataFrame:
    judged = divergence.judged(table(spark, sf, "documents"), ["doc_id"])
    return judged.select("doc_id", *divergence.BASE, "base_failed", "kept")


@query
def op13_merkle(spark: SparkSession, sf: str) -> DataFrame:
    """Leaf, roots and proof of every document; a fifth of them is checked with a tampered text."""
    docs = table(spark, sf, "documents")
    lowered = F.translate("text", ascii_uppercase, ascii_lowercase)
    values = {c: F.col(c) for c in merkle.FIELDS}
    leaf = merkle.leaf(list(values.values()))
    claimed = F.when(fold(F.col("doc_id"), 5) == 0, merkle.leaf(list((values | {"text": lowered}).values()))).otherwise(leaf)
    proofs = merkle.manifest(docs.select("doc_id", "source", leaf.alias("leaf"), claimed.alias("claimed")))
    return proofs.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        merkle.folded(F.col("claimed"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op11_spelling(spark: SparkSession, sf: str) -> DataFrame:
    """Every frequent enough word with the word that it is a variant of."""
    words = spelling.numbered(spelling.counted(table(spark, sf, "documents")))
    return spelling.forms(words, spelling.near_pairs(words))


@query
def op12_simhash(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with its fingerprint and the smallest doc_id that links lead to."""
    found = simhash.linked(table(spark, sf, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("print")).alias("fingerprint"), "component_id", "links")
