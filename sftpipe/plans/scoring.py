"""Score records with an outside judge, in resumable rounds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from sftpipe.operators.columns import publish_fields
from sftpipe.operators.judge import (
    attach_scores,
    judge_requests,
    pending_records,
    pick_responses,
)
from sftpipe.operators.split import head, seeded_shuffle, train_test_split
from sftpipe.operators.stats import (
    high_quality_share,
    length_histogram,
    mean_lengths,
    narrow_scores,
    overall_histogram,
    score_histogram,
    scored_ok,
)
from sftpipe.session import write_stage
from sftpipe.sources.rounds import append_round
from sftpipe.sources.writers import append_scored, write_splits


def score_requests(
    records: DataFrame, scored: DataFrame | None, key: str, sample: int = 0
) -> DataFrame:
    """(key, prompt) of what is still to score; ``scored`` None scores everything again."""
    todo = head(records, key, sample)
    if scored is not None:
        todo = pending_records(todo, scored, key)
    return judge_requests(todo, key)


def scored_round(records: DataFrame, responses: DataFrame, key: str) -> DataFrame:
    """The scored rows of one round of responses, written to scratch."""
    return write_stage(
        attach_scores(records, pick_responses(responses, key), key).drop(key), "scored-round"
    )


def apply_responses(
    records: DataFrame, responses: DataFrame, key: str, out: str, overwrite: bool = False
) -> DataFrame:
    """Parse the responses of one round and append the scored rows to ``out``.

    The round is written to scratch first, so ``records`` may read ``out`` itself. A round
    applied again is appended again; ``apply_round`` applies it once.
    """
    scored = scored_round(records, responses, key)
    append_scored(scored, out, overwrite)
    return scored


def apply_round(
    records: DataFrame, responses: DataFrame, key: str, out: str, name: str | None = None
) -> bool:
    """``apply_responses`` exactly once: False, and nothing changed, if the round is in ``out``.

    ``name`` names the round, else the scored rows do. ``out`` is read by ``read_rounds``.
    """
    return append_round(scored_round(records, responses, key), out, name)


@dataclass(frozen=True)
class Distributions:
    scores: DataFrame
    overall: DataFrame
    high_quality: DataFrame
    question_chars: DataFrame
    answer_chars: DataFrame
    mean_chars: DataFrame


def distributions(scored: DataFrame) -> Distributions:
    """All statistics of the scored rows. The wide rows are read once, for a narrow stage of
    scores and lengths that the statistics share."""
    narrow = write_stage(narrow_scores(scored), "scores-and-lengths")
    return Distributions(
        scores=score_histogram(narrow),
        overall=overall_histogram(narrow),
        high_quality=high_quality_share(narrow),
        question_chars=length_histogram(narrow, "instruction"),
        answer_chars=length_histogram(narrow, "output"),
        mean_chars=mean_lengths(narrow),
    )


def publish(scored: DataFrame, key: str, out: str, test_size: int = 500) -> None:
    """Error-free rows, published fields only, as train and test, in seeded random order."""
    rows = train_test_split(publish_fields(scored_ok(scored), key), key, test_size)
    write_splits(seeded_shuffle(rows, key).drop(key), out)
