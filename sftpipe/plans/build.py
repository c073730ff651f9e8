"""Raw pairs to training records: clean, dedup, filter, format."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftpipe.functions.minhash import band_keys, band_shape
from sftpipe.functions.text import clean_text, pair_fingerprint, script_ratio
from sftpipe.operators.columns import to_alpaca
from sftpipe.operators.dedup import bucket_rows, first_keys, near_dup_keys
from sftpipe.operators.joins import without_keys
from sftpipe.operators.quality import QualityRule, funnel, passes
from sftpipe.operators.split import head
from sftpipe.session import spread, write_counted
from sftpipe.sources.writers import write_jsonl, write_report


@dataclass(frozen=True)
class BuildConfig:
    quality: QualityRule = field(default_factory=QualityRule)
    sample: int = 0
    near_dedup: bool = True
    threshold: float = 0.8
    num_perm: int = 64
    source: str = "seed"


@dataclass(frozen=True)
class Build:
    """``stages`` is one narrow row per input row, ``records`` the kept ones."""

    stages: DataFrame
    records: DataFrame
    funnel: DataFrame


def clean_pairs(raw: DataFrame, key: str) -> DataFrame:
    return raw.select(
        key, clean_text("question").alias("question"), clean_text("answer").alias("answer")
    )


def with_bands(df: DataFrame, threshold: float = 0.8, num_perm: int = 64) -> DataFrame:
    """Add the LSH bucket keys of question plus answer."""
    return df.withColumn(
        "bands", band_keys(F.concat("question", "answer"), *band_shape(threshold, num_perm))
    )


def working_table(raw: DataFrame, key: str, config: BuildConfig) -> DataFrame:
    """Cleaned text with everything later steps need, in one pass and no shuffle."""
    ratio = script_ratio("answer", config.quality.script_class)
    rows = (
        clean_pairs(spread(head(raw, key, config.sample), key), key)
        .withColumn("question_chars", F.length("question"))
        .withColumn("answer_chars", F.length("answer"))
        .withColumn("is_empty", (F.col("question") == "") | (F.col("answer") == ""))
        .withColumn("fingerprint", F.unhex(pair_fingerprint("question", "answer")))
        .withColumn(
            "quality_ok",
            passes(F.col("question_chars"), F.col("answer_chars"), ratio, config.quality),
        )
    )
    if config.near_dedup:
        rows = with_bands(rows, config.threshold, config.num_perm)
    return rows


def drop_stages(working: DataFrame, rows: int, key: str, config: BuildConfig) -> DataFrame:
    """The stage that drops each of the ``rows`` rows, or ``kept``.

    All joins are on the unique key and carry no text. The quality rule comes last:
    a row that will fail it still knocks out a later near copy.
    """
    full = working.filter("NOT is_empty")
    first = first_keys(full, "fingerprint", key)
    staged = working.select(
        key, "question_chars", "answer_chars", "is_empty", "quality_ok"
    ).join(first.withColumn("is_first", F.lit(True)), key, "left")
    is_near = F.lit(False)
    if config.near_dedup:
        bands, _ = band_shape(config.threshold, config.num_perm)
        near = near_dup_keys(bucket_rows(full, key, "bands"), key, rows * bands)
        staged = staged.join(near.withColumn("is_near", F.lit(True)), key, "left")
        is_near = F.col("is_near").isNotNull()
    stage = (
        F.when(F.col("is_empty"), "empty")
        .when(F.col("is_first").isNull(), "exact_dup")
        .when(is_near, "near_dup")
        .when(~F.col("quality_ok"), "quality")
        .otherwise("kept")
    )
    return staged.select(key, stage.alias("drop_stage"), "question_chars", "answer_chars")


def build(raw: DataFrame, key: str, config: BuildConfig = BuildConfig()) -> Build:
    """``raw`` has ``question``, ``answer`` and the unique, ordered ``key``.

    The working table is written once to the shared scratch folder. Rows that fail
    on their own are filtered in its scan; the duplicates are then removed by key,
    which moves no text as long as their number is small enough to broadcast.
    """
    working, rows = write_counted(working_table(raw, key, config), "working")
    is_duplicate = F.col("drop_stage").isin("exact_dup", "near_dup")
    stages, duplicate_rows = write_counted(
        drop_stages(working, rows, key, config), "stages", F.count_if(is_duplicate)
    )
    duplicates = stages.filter(is_duplicate).select(key)
    candidates = working.filter("NOT is_empty AND quality_ok").select(key, "question", "answer")
    kept = without_keys(candidates, duplicates, key, duplicate_rows)
    return Build(stages, to_alpaca(kept, config.source, key), funnel(stages, config.near_dedup))


def build_to(raw: DataFrame, key: str, out: str, report: str, config: BuildConfig = BuildConfig()) -> Build:
    """Build, then write the JSON lines and the report."""
    result = build(raw, key, config)
    write_jsonl(result.records.drop(key), out)
    write_report(result.funnel, report)
    return result
