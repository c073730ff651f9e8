"""Judge requests, responses and resume."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftpipe.functions.judge_json import (
    DIMENSIONS,
    PROMPT_ANSWER_CHARS,
    has_field,
    judge_prompt,
    numeric_field,
    parse_response,
    response_error,
    text_field,
)
from sftpipe.operators.joins import not_seen
from sftpipe.session import allow_repeated_keys

RECORD_FIELDS = ("instruction", "input", "output", "source")


def pending_records(records: DataFrame, scored: DataFrame, key: str) -> DataFrame:
    """Records whose instruction has no error-free score yet.

    The instruction decides, so records that share one are done together.
    """
    return not_seen(records, key, "instruction", scored.filter("_error IS NULL"))


def judge_requests(
    records: DataFrame, *keep: str, answer_chars: int = PROMPT_ANSWER_CHARS
) -> DataFrame:
    prompt = judge_prompt(F.col("instruction"), F.col("output"), answer_chars)
    return records.select(*keep, prompt.alias("prompt"))


def pick_responses(responses: DataFrame, key: str, retries: int | None = None) -> DataFrame:
    """Per record the first good response, or else the last error.

    ``responses`` has ``key``, ``attempt`` (from 1), ``content`` and ``error`` (a
    failed call, null otherwise). How often to ask is the client's business: all stored
    attempts count, unless ``retries`` leaves out later ones.
    """
    allow_repeated_keys(responses.sparkSession)
    tried = responses if retries is None else responses.filter(F.col("attempt") <= retries)
    checked = tried.select(
        key,
        "attempt",
        "content",
        F.coalesce(F.col("error"), response_error(F.col("content"))).alias("problem"),
    )
    good = F.col("problem").isNull()
    picked = checked.groupBy(key).agg(
        F.min_by(F.when(good, F.col("content")), F.when(good, F.col("attempt"))).alias("content"),
        F.max_by("problem", F.when(~good, F.col("attempt"))).alias("last_error"),
    )
    return picked.select(
        key, "content", F.when(F.col("content").isNull(), F.col("last_error")).alias("_error")
    )


def attach_scores(records: DataFrame, picked: DataFrame, key: str) -> DataFrame:
    """Records with scores, reason and error; a field the judge repeats wins, also as null.

    An error field makes an error row, whatever it holds.

    ``key`` is unique on both sides. Records without any response are left out:
    they are still to do.
    """
    allow_repeated_keys(records.sparkSession)
    joined = records.select(key, *RECORD_FIELDS).join(picked, key)
    parsed = joined.withColumn("v", parse_response(F.col("content")))
    v = F.col("v")
    return parsed.select(
        key,
        *[
            F.when(has_field(v, f), text_field(v, f)).otherwise(F.col(f)).alias(f)
            for f in RECORD_FIELDS
        ],
        *[numeric_field(v, d).alias(d) for d in DIMENSIONS],
        text_field(v, "reason").alias("reason"),
        F.coalesce(
            F.col("_error"),
            F.when(has_field(v, "_error"), F.coalesce(text_field(v, "_error"), F.lit("null"))),
        ).alias("_error"),
    )
