"""A training corpus from raw documents: filter, deduplicate, mix, tokenise.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. A stage's result is written and read again before the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sftpipe.llm import byte_bpe, exact_names, mixing, near_jaccard, quality_eb, simhash_vp
from sftpipe.llm.common import table
from sftpipe.llm.queries import PATTERN, VOCABULARY, quality_labels
from sftpipe.session import bound_batches, write_stage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    bound_batches(spark)
    labels = quality_labels(spark, sf_dir)
    return quality_eb.quality_filter(docs, "doc_id", "text", "source", "lang", labels)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id."""
    return exact_names.exact_dedup(docs, "doc_id", "text")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by a five-word similarity of 0.8 or more the one with the smallest id. Pairs
    to compare come from op1's fingerprints and from sketches."""
    bound_batches(spark)
    return near_jaccard.near_dedup(docs, "doc_id", "text", bits=simhash_vp.THRESHOLD)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as drawn, some twice and some not, shard by shard."""
    return mixing.mixed_rows(docs, "doc_id", "text", "source")


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes."""
    bound_batches(spark)
    return byte_bpe.round_trip_digests(docs, "doc_id", "text", VOCABULARY, PATTERN)


STAGES = [
    ("quality_classifier", keep_good),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("byte_bpe", encode_documents),
]
#: The classifier, the fingerprints, the draws and the merges cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_stage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
