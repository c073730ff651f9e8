"""Column detection and projections to the record layouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sftpipe.functions.text import strip_unicode

# Fixed values, in priority order.
QUESTION_KEYS = ("question", "instruction", "input", "query", "prompt", "问", "title")
ANSWER_KEYS = ("answer", "output", "response", "completion", "content", "答", "text")
PUBLISH_FIELDS = {
    "instruction": "string",
    "input": "string",
    "output": "string",
    "source": "string",
    "complexity": "double",
    "clarity": "double",
    "informativeness": "double",
}


def detect_column(columns: Sequence[str], keywords: Sequence[str]) -> str | None:
    """First column that contains the earliest possible keyword, ignoring case."""
    hits = (c for k in keywords for c in columns if k in c.lower())
    return next(hits, None)


def normalize_columns(df: DataFrame, *keep: str) -> DataFrame:
    """Reduce any table to (question, answer), trimmed, without empty sides.

    ``keep`` names extra columns to carry, such as the order key. The table comes
    back unchanged when a side is not found or both are the same column. A null
    stays null here and is dropped by cleaning.
    """
    candidates = [c for c in df.columns if c not in keep]
    question = detect_column(candidates, QUESTION_KEYS)
    answer = detect_column(candidates, ANSWER_KEYS)
    if question is None or answer is None or question == answer:
        return df

    def side(name: str, alias: str):
        return strip_unicode(F.col(f"`{name}`").cast(StringType())).alias(alias)

    pairs = df.select(*keep, side(question, "question"), side(answer, "answer"))
    not_empty = [F.coalesce(F.col(c) != "", F.lit(True)) for c in ("question", "answer")]
    return pairs.filter(not_empty[0] & not_empty[1])


def to_alpaca(df: DataFrame, source: str, *keep: str) -> DataFrame:
    return df.select(
        *keep,
        F.col("question").alias("instruction"),
        F.lit("").alias("input"),
        F.col("answer").alias("output"),
        F.lit(source).alias("source"),
    )


def publish_fields(scored: DataFrame, *keep: str) -> DataFrame:
    """The seven published fields; an absent one is null, all others go."""
    present = set(scored.columns)
    return scored.select(
        *keep,
        *[
            (F.col(n) if n in present else F.lit(None).cast(t)).alias(n)
            for n, t in PUBLISH_FIELDS.items()
        ],
    )
