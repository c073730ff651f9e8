"""Rounds appended once, through crashes and repetition."""

import os

import pytest
from pyspark.sql import functions as F

from sftpipe.plans.scoring import apply_round
from sftpipe.sources import rounds as R
from sftpipe.sources.readers import SCORED_SCHEMA

SCHEMA = "id bigint, text string"


@pytest.fixture()
def parts(spark):
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(30)], SCHEMA).repartition(3)
    return [rows.filter(F.col("id") % 3 == i) for i in range(3)]


def ids(spark, path):
    return sorted(r.id for r in R.read_rounds(spark, path, SCHEMA).collect())


def test_a_round_counts_once(spark, parts, tmp_path):
    path = str(tmp_path / "t")
    assert ids(spark, path) == [] and R.rounds(spark, path) == []
    assert R.append_round(parts[0], path, "first") and R.append_round(parts[1], path)
    assert not R.append_round(parts[2], path, "first")
    assert not R.append_round(parts[1].repartition(7), path)
    assert ids(spark, path) == sorted(i for i in range(30) if i % 3 < 2)
    assert len(R.rounds(spark, path)) == 2 and len(os.listdir(tmp_path / "t" / "data")) == 2


def test_crashed_attempts_are_not_read(spark, parts, tmp_path):
    path = str(tmp_path / "t")
    R.append_round(parts[0], path, "first")
    parts[1].write.json(f"{path}/data/second-attempt")  # no entry
    (tmp_path / "t" / "_log" / "second").write_text("")  # an entry without its text
    assert ids(spark, path) == list(range(0, 30, 3)) and R.rounds(spark, path) == ["first"]


def test_the_first_of_two_writers_counts(spark, parts, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    seen = R.rounds

    def late(spark, path):  # the other writer commits after this one has looked
        found = seen(spark, path)
        monkeypatch.setattr(R, "rounds", seen)
        assert R.append_round(parts[0], path, "same")
        return found

    monkeypatch.setattr(R, "rounds", late)
    assert not R.append_round(parts[1], path, "same")
    assert ids(spark, path) == list(range(0, 30, 3))
    assert len(os.listdir(tmp_path / "t" / "data")) == 1


def test_compaction_keeps_rows_and_names(spark, parts, tmp_path):
    path = str(tmp_path / "t")
    for i, part in enumerate(parts):
        R.append_round(part, path, f"r{i}")
    entries = {p: (tmp_path / "t" / "_log" / p).read_text() for p in ("r0", "r1")}
    folders = sorted(os.listdir(tmp_path / "t" / "data"))
    assert R.compact(spark, path, SCHEMA) == 3
    assert ids(spark, path) == list(range(30)) and len(os.listdir(tmp_path / "t" / "data")) == 1
    assert not R.append_round(parts[1], path, "r1")
    assert R.append_round(parts[1], path, "r9") and R.compact(spark, path, SCHEMA) == 2
    assert set(R.rounds(spark, path)) >= {"r0", "r1", "r2", "r9"} and len(ids(spark, path)) == 40
    assert R.compact(spark, path, SCHEMA) == 1 and folders
    # A crash between the new entry and the removal of the old ones.
    for name, text in entries.items():
        (tmp_path / "t" / "_log" / name).write_text(text)
    assert R.compact(spark, path, SCHEMA) == 1 and len(ids(spark, path)) == 40


def test_names(spark, parts, tmp_path):
    assert R.round_name(parts[0]) == R.round_name(parts[0].repartition(1)) != R.round_name(parts[1])
    assert R.round_name(parts[0].limit(0)).startswith("rows-0-")
    for name in ("", "../x", "a/b", "_x", ".x"):
        with pytest.raises(ValueError, match="cannot name"):
            R.append_round(parts[0], str(tmp_path / "t"), name)


def test_scored_round_is_applied_once(spark, tmp_path):
    records = spark.createDataFrame([(1, "q", "", "a", "s")], "k bigint, instruction string, input string, output string, source string")
    content = '{"complexity": 3, "clarity": 4, "informativeness": 5, "reason": "r"}'
    responses = spark.createDataFrame([(1, 1, content, None)], "k bigint, attempt int, content string, error string")
    out = str(tmp_path / "scored")
    assert apply_round(records, responses, "k", out) and not apply_round(records, responses, "k", out)
    (row,) = R.read_rounds(spark, out, SCORED_SCHEMA).collect()
    assert (row.instruction, row.complexity, row.reason) == ("q", 3.0, "r")
