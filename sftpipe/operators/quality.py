"""Quality rule, drop stages and the funnel."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftpipe.functions.text import HAN_CLASS, script_ratio


@dataclass(frozen=True)
class QualityRule:
    """Bounds are inclusive; the script share is taken on the answer only."""

    min_question_chars: int = 5
    min_answer_chars: int = 10
    max_answer_chars: int = 2000
    min_script_ratio: float = 0.5
    script_class: str = HAN_CLASS


def passes(question_chars: Column, answer_chars: Column, ratio: Column, rule: QualityRule) -> Column:
    return (
        (question_chars >= rule.min_question_chars)
        & answer_chars.between(rule.min_answer_chars, rule.max_answer_chars)
        & (ratio >= rule.min_script_ratio)
    )


def quality_filter(df: DataFrame, rule: QualityRule = QualityRule()) -> DataFrame:
    return df.filter(
        passes(
            F.length("question"),
            F.length("answer"),
            script_ratio("answer", rule.script_class),
            rule,
        )
    )


def drop_empty_pairs(df: DataFrame) -> DataFrame:
    return df.filter((F.col("question") != "") & (F.col("answer") != ""))


def funnel(stages: DataFrame, near_dedup: bool = True) -> DataFrame:
    """One row of counts, rates in percent and mean lengths from the staged rows.

    ``stages`` has ``drop_stage``, ``question_chars`` and ``answer_chars``. A rate
    over an empty stage is 0, the overall yield of no rows is null.
    """

    def dropped(*names: str) -> Column:
        return F.count_if(F.col("drop_stage").isin(*names))

    kept = F.col("drop_stage") == "kept"
    counts = stages.agg(
        F.count("*").alias("raw_rows"),
        (F.count("*") - dropped("empty")).alias("after_clean"),
        (F.count("*") - dropped("empty", "exact_dup")).alias("after_exact"),
        (F.count("*") - dropped("empty", "exact_dup", "near_dup")).alias("after_near"),
        F.count_if(kept).alias("final_rows"),
        F.avg(F.when(kept, F.col("question_chars"))).alias("mean_question_chars"),
        F.avg(F.when(kept, F.col("answer_chars"))).alias("mean_answer_chars"),
    )

    def percent(part: str, whole: str) -> Column:
        return F.try_divide(F.expr(part), F.col(whole)) * 100

    near = F.coalesce(percent("after_exact - after_near", "after_exact"), F.lit(0.0))
    return counts.select(
        "raw_rows",
        "after_clean",
        "after_exact",
        "after_near",
        "final_rows",
        F.coalesce(percent("after_clean - after_exact", "after_clean"), F.lit(0.0)).alias(
            "exact_dup_pct"
        ),
        (near if near_dedup else F.lit(None).cast("double")).alias("near_dup_pct"),
        percent("final_rows", "raw_rows").alias("yield_pct"),
        "mean_question_chars",
        "mean_answer_chars",
    )
