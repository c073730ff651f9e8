import json

from sftpipe.functions.judge_json import PROMPT_HEAD, PROMPT_MIDDLE
from sftpipe.operators.judge import attach_scores, pending_records, pick_responses
from sftpipe.operators.stats import score_summary
from sftpipe.plans.scoring import apply_responses, distributions, publish, score_requests
from sftpipe.sources.readers import SCORED_SCHEMA, read_jsonl

RECORD = "k long, instruction string, input string, output string, source string"
RESPONSE = "k long, attempt int, content string, error string"


def records(spark, *instructions):
    rows = [(i, text, "", f"answer {i}", "s") for i, text in enumerate(instructions)]
    return spark.createDataFrame(rows, RECORD)


def scored(spark, *contents):
    rows = [(i, 1, c, None) for i, c in enumerate(contents)]
    picked = pick_responses(spark.createDataFrame(rows, RESPONSE), "k")
    out = attach_scores(records(spark, *[f"q{i}" for i in range(len(rows))]), picked, "k")
    return sorted(out.collect(), key=lambda r: r.k)


def test_typed_scores(spark):
    rows = scored(
        spark,
        '{"complexity": 4, "clarity": 4.5, "informativeness": "4", "reason": "好"}',
        ' {"complexity": true, "clarity": null, "informativeness": false}\n',
        '{"complexity": 3, "output": "new", "source": 7, "extra": [1]}',
        '{"complexity": 1e2, "clarity": -3}',
    )
    got = [(r.complexity, r.clarity, r.informativeness, r.reason, r._error) for r in rows]
    assert got == [
        (4.0, 4.5, None, "好", None),
        (1.0, None, 0.0, None, None),
        (3.0, None, None, None, None),
        (100.0, -3.0, None, None, None),
    ]
    assert (rows[2].output, rows[2].source, rows[1].output) == ("new", "7", "answer 1")


def test_bad_responses_become_error_rows(spark):
    bad = [
        "[1]", '"x"', "3", "2.5", "true", "null", "plain", "", None, '{"a": 1} {', '{"a": 1',
        '{"a":1}],[', '{"a":1},"b":2', '{"a": 1, "_error": "judge says no"}',
    ]
    rows = scored(spark, *bad)
    names = ["list", "str", "int", "float", "bool", "NoneType"]
    want = [f"TypeError: '{n}' object is not a mapping" for n in names]
    assert [r._error for r in rows[:6]] == want
    assert all(r._error.startswith(("JSONDecodeError: ", "TypeError: ")) for r in rows[6:13])
    assert rows[13]._error == "judge says no"
    assert all(r.complexity is None and r.output == f"answer {r.k}" for r in rows)


def test_retries_first_good_else_last_error(spark):
    rows = [
        (1, 1, None, "Timeout: 1"), (1, 2, '{"clarity": 2}', None), (1, 3, '{"clarity": 5}', None),
        (2, 1, "x", None), (2, 2, None, "Timeout: 2"), (2, 4, '{"clarity": 1}', None),
        (3, 4, '{"clarity": 4}', None), (4, 7, None, "Timeout: 7"),
    ]
    responses = spark.createDataFrame(rows, RESPONSE)
    got = sorted(pick_responses(responses, "k").collect())
    assert [tuple(r) for r in got] == [
        (1, '{"clarity": 2}', None), (2, '{"clarity": 1}', None), (3, '{"clarity": 4}', None), (4, None, "Timeout: 7"),
    ]
    got = sorted(pick_responses(responses, "k", retries=3).collect())
    assert [tuple(r) for r in got] == [(1, '{"clarity": 2}', None), (2, None, "Timeout: 2")]


def test_null_fields_win_and_a_null_error_is_an_error(spark):
    rows = scored(
        spark,
        '{"complexity": 3, "reason": null, "output": null}',
        '{"complexity": 3, "_error": null}',
        '{"complexity": 3}',
    )
    assert [(r.output, r.reason, r._error) for r in rows] == [
        (None, None, None), ("answer 1", None, "null"), ("answer 2", None, None),
    ]


def test_repeated_keys_are_read_in_any_session(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    (row,) = scored(other, '{"complexity": 1, "complexity": 4}')
    assert (row.complexity, row._error) == (4.0, None)


def test_pending_records(spark):
    todo = records(spark, "done", "failed", "new", "done", "both")
    past = spark.createDataFrame(
        [("done", None), ("failed", "E"), ("both", "E"), ("both", None)],
        "instruction string, _error string",
    )
    assert sorted(r.k for r in pending_records(todo, past, "k").collect()) == [1, 2]


def test_prompt(spark):
    df = spark.createDataFrame([(1, "{q}", "", "a" * 1600, "s")], RECORD)
    prompt = score_requests(df, None, "k").first().prompt
    assert prompt == PROMPT_HEAD + "{q}" + PROMPT_MIDDLE + "a" * 1500
    assert json.loads(PROMPT_HEAD.split("\n")[6].replace("整数", "1")).keys() >= {"clarity"}


def test_two_rounds_resume_and_report(spark, tmp_path):
    out = str(tmp_path / "scored")
    todo = records(spark, "a", "b")
    good = '{"complexity": 4, "clarity": 5, "informativeness": 3, "reason": "r"}'
    first = spark.createDataFrame([(0, 1, good, None), (1, 1, "oops", None)], RESPONSE)
    apply_responses(todo, first, "k", out)
    done = read_jsonl(spark, out, SCORED_SCHEMA)
    assert [r.k for r in score_requests(todo, done, "k").collect()] == [1]
    second = spark.createDataFrame([(1, 1, '{"complexity": 2}', None)], RESPONSE)
    apply_responses(todo, second, "k", out)
    done = read_jsonl(spark, out, SCORED_SCHEMA)
    assert score_requests(todo, done, "k").count() == 0
    summary = score_summary(done).first()
    assert (summary.ok_rows, summary.failed_rows) == (2, 1)
    assert (summary.mean_complexity, summary.mean_clarity) == (3.0, 2.5)
    shown = distributions(done)
    assert shown.high_quality.first().high_rows == 1
    assert shown.mean_chars.first().mean_question_chars == 1.0
    keyed = read_jsonl(spark, out, SCORED_SCHEMA, order_key="k")
    assert sorted(r.k for r in keyed.collect()) == [0, 1, 2]
    publish(keyed, "k", str(tmp_path / "hub"), test_size=1)
    splits = {r.split: r["count"] for r in spark.read.parquet(str(tmp_path / "hub")).groupBy("split").count().collect()}
    assert splits == {"train": 1, "test": 1}
    apply_responses(todo, first, "k", out, overwrite=True)
    assert read_jsonl(spark, out, SCORED_SCHEMA).count() == 2
