import json

import pytest
from pyspark.sql import functions as F

from sftpipe.operators.columns import detect_column, normalize_columns, publish_fields
from sftpipe.operators.columns import ANSWER_KEYS, QUESTION_KEYS
from sftpipe.sources.readers import expand_globs, profile_files, read_csv, read_jsonl
from sftpipe.sources.writers import write_csv, write_jsonl, write_splits

CSV = (
    "﻿question,answer\r\n"
    '"multi\nline","say ""hi"""\r\n'
    "NA,null\r\n"
    "None,nan\r\n"
    ',"  "\r\n'
    "法律,Ａ\r\n"
)


def test_read_csv(spark, tmp_path):
    path = tmp_path / "qa.csv"
    path.write_text(CSV, encoding="utf-8", newline="")
    df = read_csv(spark, str(path), order_key="k")
    assert df.columns == ["k", "question", "answer"]
    assert [tuple(r)[1:] for r in df.orderBy("k").collect()] == [
        ("multi\nline", 'say "hi"'), (None, None), (None, None), (None, "  "), ("法律", "Ａ"),
    ]


def test_read_csv_order_follows_files_then_rows(spark, tmp_path):
    for name, size in (("a", 3), ("b", 400), ("c", 2)):
        rows = "\n".join(f"{name}{i},x" for i in range(size))
        (tmp_path / f"{name}.csv").write_text("question,answer\n" + rows + "\n")
    df = read_csv(spark, str(tmp_path / "*.csv"), order_key="k")
    got = [r.question for r in df.orderBy("k").collect()]
    assert got == [f"{n}{i}" for n, s in (("a", 3), ("b", 400), ("c", 2)) for i in range(s)]
    assert df.select("k").distinct().count() == 405


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="none.csv"):
        read_csv(spark, str(tmp_path / "none.csv"))


def test_files_with_other_headers_are_joined_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("question,answer\nq1,a1\n")
    (tmp_path / "b.csv").write_text("\ufeffanswer,question\na2,q2\nonly\n")
    (tmp_path / "c.csv").write_text('"ques""tion",answer,question\nx,a3,q3\n')
    df = read_csv(spark, str(tmp_path / "*.csv"), order_key="k")
    got = df.orderBy("k").select("question", "answer", F.col('`ques"tion`')).collect()
    assert [tuple(r) for r in got] == [("q1", "a1", None), ("q2", "a2", None), (None, "only", None), ("q3", "a3", "x")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_a_row_with_more_cells_than_the_header_is_an_error(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("question,answer\nq1,a1\nq2,a2,EXTRA,MORE\n")
    for df in (read_csv(spark, str(tmp_path)), read_csv(spark, str(tmp_path / "bad.csv"), "k").select("k")):
        with pytest.raises(Exception, match="more cells than the header has.*bad.csv: q2,a2,EXTRA"):
            df.collect()


def test_jsonl_order_key_follows_files_and_lines(spark, tmp_path):
    for name, size in (("b", 300), ("a", 40), ("c", 1)):
        (tmp_path / f"{name}.json").write_text("".join(f'{{"v": "{name}{i}"}}\n' for i in range(size)))
    rows = read_jsonl(spark, str(tmp_path), "v string", order_key="k").orderBy("k").collect()
    want = [f"{n}{i}" for n, s in (("a", 40), ("b", 300), ("c", 1)) for i in range(s)]
    assert [(r.k, r.v) for r in rows] == list(enumerate(want))


def test_profile_counts_nan_and_skips_files_that_break_halfway(spark, tmp_path):
    import gzip

    from sftpipe.operators.stats import profile

    table = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert profile(table).first().nulls == 2
    (tmp_path / "good.csv").write_text("a,b\n1,\n")
    whole = gzip.compress(b"a,b\n" + b"".join(b"%d,x%d\n" % (i, i * 7919) for i in range(40_000)))
    (tmp_path / "cut.csv.gz").write_bytes(whole[: len(whole) // 2])
    profiles, skipped = profile_files(spark, [str(tmp_path / "*")])
    assert {(r.path[-8:], r.column, r.nulls) for r in profiles.collect()} == {("good.csv", "a", 0), ("good.csv", "b", 1)}
    assert [p[-10:] for p, _ in skipped] == ["cut.csv.gz"]


def test_profile_files(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b\n1,\n1,\n2,x\n")
    (tmp_path / "two.csv").write_text("c\nNA\n")
    patterns = [str(tmp_path / "*.csv"), str(tmp_path / "absent.csv")]
    assert len(expand_globs(spark, patterns)) == 3
    profiles, skipped = profile_files(spark, patterns)
    got = {(r.path[-7:], r.column): tuple(r)[2:] for r in profiles.collect()}
    assert got == {
        ("one.csv", "a"): (0, 3, 2, 2, 1),
        ("one.csv", "b"): (2, 3, 2, 2, 1),
        ("two.csv", "c"): (1, 1, 1, 1, 0),
    }
    assert [p for p, _ in skipped] == [patterns[1]]


def test_jsonl_round_trip(spark, tmp_path):
    rows = [("问\n😀", "", "答\"\\", "s")]
    schema = "instruction string, input string, output string, source string"
    path = str(tmp_path / "o")
    write_jsonl(spark.createDataFrame(rows, schema), path)
    write_jsonl(spark.createDataFrame(rows, schema), path, mode="append")
    assert [tuple(r) for r in read_jsonl(spark, path, schema).collect()] == rows * 2
    text = "".join(p.read_text("utf-8") for p in (tmp_path / "o").glob("part-*"))
    assert json.loads(text.splitlines()[0])["input"] == "" and "😀" in text


def test_csv_round_trip(spark, tmp_path):
    rows = [("a,b", 'q"q', " padded "), ("x\ny", "法", "1")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    write_csv(df, str(tmp_path / "c"))
    assert sorted(map(tuple, read_csv(spark, str(tmp_path / "c")).collect())) == sorted(rows)


def test_detect_column():
    assert detect_column(["id", "Input", "instruction"], QUESTION_KEYS) == "instruction"
    assert detect_column(["id", "input", "output"], QUESTION_KEYS) == "input"
    assert detect_column(["我的问题", "答案"], QUESTION_KEYS) == "我的问题"
    assert detect_column(["我的问题", "答案"], ANSWER_KEYS) == "答案"
    assert detect_column(["a", "b"], ANSWER_KEYS) is None


def test_normalize_columns(spark):
    df = spark.createDataFrame(
        [(1, " q　", "\x1fa"), (2, None, "a"), (3, " ", "a"), (4, "q", "")],
        "id long, input string, output string",
    )
    got = normalize_columns(df, "id")
    assert sorted(map(tuple, got.collect())) == [(1, "q", "a"), (2, None, "a")]
    for same in (df.select(F.col("input").alias("text_input")), df.select("id")):
        assert normalize_columns(same).columns == same.columns


def test_publish_fields_and_splits(spark, tmp_path):
    df = spark.createDataFrame([("i", "o", 4.0, "why")], "instruction string, output string, clarity double, reason string")
    got = publish_fields(df)
    assert got.columns[-3:] == ["complexity", "clarity", "informativeness"]
    assert tuple(got.first()) == ("i", None, "o", None, None, 4.0, None)
    write_splits(got.withColumn("split", F.lit("train")), str(tmp_path / "p"))
    assert (tmp_path / "p" / "split=train").is_dir()


def test_profile_of_folders(spark, tmp_path):
    rows = [(i, "x" if i % 4 else None, lang) for i in range(20) for lang in ("a", "b", None)]
    df = spark.createDataFrame(rows, "id int, text string, lang string").repartition(3)
    write_csv(df, str(tmp_path / "t"), by="lang")
    profiles, skipped = profile_files(spark, [str(tmp_path / "t" / "*")], folders=True)
    assert skipped == []
    found = {(r.path.rpartition("=")[2], r.column): (r.rows, r.nulls) for r in profiles.collect()}
    folders = ("a", "b", "__HIVE_DEFAULT_PARTITION__")
    assert found == {(f, c): (20, 5 * (c == "text")) for f in folders for c in ("id", "text")}
