"""The registered queries of this package and their SQL."""

from __future__ import annotations

import functools
import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderlake.llm import lexical, minhash, suffix, variants
from ladderlake.llm.chat import format_turns, read_back
from ladderlake.llm.decontaminate import find_leaks
from ladderlake.llm.oracle import SQL
from ladderlake.llm.packing import pack
from ladderlake.llm.quality import base_failed, rate
from ladderlake.llm.sharding import shard_of, shard_records
from ladderlake.llm.simhash import near_duplicates
from ladderlake.llm.substring import remove_repeats
from ladderlake.llm.token_counts import count_tokens
from ladderlake.llm.warc import read_warc, write_warc
from ladderlake.session import staging_path

REGISTRY = {}


__all__ = ["REGISTRY", "SQL", "reachable", "table"]

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def reachable(spark: SparkSession) -> None:
    """Let Python workers find this package where only the driver's own path names it.

    On a cluster the package is shipped with the job (``--py-files``).
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def query(f):
    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reachable(spark)
        return f(spark, sf_dir)

    REGISTRY[f.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    return shard_records(docs, 24).select(
        "doc_id",
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        shard_of(F.col("doc_id"), 25).alias("grown_shard"),
    )


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), "[ \\x09-\\x0D]+", " "))
    return remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(words, 256).alias("kept_sha256")
    )


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    # Filters on headers reach the source: blocks of other records are passed over, and only
    # responses have a payload to verify.
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    responses = read_warc(own, path).filter("record_type = 'response'")
    revisits = read_warc(own, path, verify=False).filter("record_type = 'revisit'")
    return responses.unionByName(revisits).select(
        F.element_at("headers", "warc-page-id").cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.element_at("headers", "warc-refers-to-page-id").cast("bigint").alias("refers_to"),
    )


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = find_leaks(docs, items, carry=["doc_id"], with_matches=False)
    return found.select(
        "doc_id",
        "leaks.n_words",
        "leaks.n_hit",
        F.size("leaks.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("leaks.items", ","), 256).alias("items_sha256"),
        (F.col("leaks.n_hit") > 0).alias("contaminated"),
    )


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return count_tokens(table(spark, sf_dir, "documents"), path, carry=["doc_id"])


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return rate(docs, labels).select(
        "doc_id",
        "counts.n_words",
        "counts.word_chars",
        "counts.n_symbols",
        "counts.n_dup_lines",
        "counts.n_repeat_words",
        base_failed("counts").alias("base_failed"),
        "kept",
    )


@query
def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame(
        [(-1, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(("user", "assistant"))],
        turns.schema,
    )
    return read_back(format_turns(turns.unionByName(own)))


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix.remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return pack(table(spark, sf_dir, "documents"), path)


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(table(spark, sf_dir, "documents"), noise=199)


@query
def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=5, percent=85)
