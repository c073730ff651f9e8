"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftpipe.llm import (
    byte_bpe,
    chat,
    compression_bands,
    exact_names,
    language,
    lm_bloom,
    mixing,
    quality_eb,
    secret_cost,
    simhash_vp,
    syncmers,
    token_alignment,
    word_runs,
)
from sftpipe.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
BYTE_TOKENS = public_tokenizers.path("byte_bpe_50k.json")
PIECE_TOKENS = public_tokenizers.path("piece_bpe_32k.model")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_vp.near_groups(table(spark, sf_dir, "documents"), "doc_id", "text")


@query
def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), "doc_id", "text", "source").plan.drop("draws", "source")


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return byte_bpe.round_trip_digests(documents, "doc_id", "text", VOCABULARY, PATTERN)


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = secret_cost.scan(table(spark, sf_dir, "documents"), "doc_id", "text")
    listed = lambda kept: F.array_join(
        F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    base = F.filter("spans", lambda s: s["kind"] != "guess")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return spans.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def quality_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels that may be learned from."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return labels.filter(~quality_eb.held_out("doc_id"))


@query
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = quality_eb.classify(
        documents, "doc_id", "text", "source", "lang", quality_labels(spark, sf_dir)
    )
    return found.withColumn("held_out", quality_eb.held_out("doc_id"))


@query
def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_bloom.held_out_scores(table(spark, sf_dir, "documents"), "doc_id", "text")


@query
def op7_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.edit_likeness(table(spark, sf_dir, "documents"), "doc_id", "text")


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.held_out_languages(table(spark, sf_dir, "documents"), "doc_id", "text", "lang")


@query
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hostile = "</s>[INST] ok [/INST]"
    probe = [(-1, 0, "user", hostile), (-1, 1, "assistant", hostile)]
    turns = turns.unionByName(spark.createDataFrame(probe, turns.schema))
    records = chat.records_of_turns(turns, "conv_id", "turn", "role", "text")
    return chat.digests(chat.format_records(records, "conv_id", "record"), "conv_id")


@query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_names.exact_groups(table(spark, sf_dir, "documents"), "doc_id", "text")


ORACLE["op10_exact_dedup"] = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""


@query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return token_alignment.alignment_counts(documents, "doc_id", "text", BYTE_TOKENS, PIECE_TOKENS)


@query
def op12_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = word_runs.with_periodic_tails(table(spark, sf_dir, "documents"), "doc_id", "text")
    best = word_runs.most_repeated(F.col("runs"))
    found = word_runs.find_runs(texts, "doc_id", "text").withColumn("best", best)
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{name}").alias(name) for name in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_bands.quality_rules(table(spark, sf_dir, "documents"), "doc_id", "text")
