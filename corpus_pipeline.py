"""The corpus pipeline: documents through the stages below, each over all that is left.

Defined results of every stage. Null, empty and blank texts fail the base rules, so only the first
stage meets them in ``run``; by themselves the later stages take them as texts without words: near
copies of each other, without a repeat or a leak, and of one token each in packing. Documents
with a null id are kept like others, and never preferred where one of a group stays. Repeated rows
are judged one by one, and one of them stays. Of equals the smallest id stays. Texts of any length
are worked on whole. An empty table gives an empty one. All but the last stage return the
columns they got, whatever their names; packing returns its own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderlake.llm import simhash, substring
from ladderlake.llm.decontaminate import remove_leaks
from ladderlake.llm.packing import pack
from ladderlake.llm.quality import keep_good
from ladderlake.llm.queries import reachable, table
from ladderlake.session import materialize

# Texts that a task holds at once, smaller than the operators' own: between stages, the JVM's heap
# stays as large as the largest of them made it.
CHUNK = 2 << 20
BLOCK = 5 << 20


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the thresholds of their language."""
    reachable(spark)
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    reachable(spark)
    return simhash.keep_one(docs, shingle=4, max_bits=4, chunk_bytes=CHUNK)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without words of 20-word windows that also start earlier."""
    reachable(spark)
    left = substring.remove_repeats(docs, block_bytes=BLOCK).select(docs.columns)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of the benchmark."""
    reachable(spark)
    return remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 1024 tokens."""
    reachable(spark)
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

# Fingerprints, exact binomial bounds and token ids have no SQL; tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what each returns is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
