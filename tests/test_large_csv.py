"""Block by block against the reader that gives a file to one task, and the csv module."""

import csv
import random

import pytest

from sftpipe.sources.large_csv import csv_rows, read_large_csv
from sftpipe.sources.readers import NA_STRINGS, read_csv


def make_file(path, seed, rows=120, end="\n"):
    draw = random.Random(seed)
    parts = ["a", "é漢", '"', ",", end, end * 2, " ", "word", "NA", "🙂", "'", "\\", ", \"x\"" + end]
    table = []
    for i in range(rows):
        cells = ["".join(draw.choices(parts, k=draw.choice((0, 1, 3, 8, 60)))) for _ in range(2)]
        table.append([str(i), *cells])
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, lineterminator=end)
        writer.writerow(["id", "text", "more"])
        writer.writerows(table)
    return [tuple(None if c in NA_STRINGS else c for c in row) for row in table]


@pytest.fixture()
def split_bytes(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    cost = spark.conf.get("spark.sql.files.openCostInBytes")

    def set_bytes(n):
        spark.conf.set(name, str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield set_bytes
    spark.conf.set(name, before)
    spark.conf.set("spark.sql.files.openCostInBytes", cost)


@pytest.mark.parametrize("size, broadcast_rows", [(1 << 27, 500_000), (3000, 500_000), (250, 500_000), (700, 0)])
def test_any_split_reads_the_same(spark, tmp_path, split_bytes, size, broadcast_rows):
    wanted = [*make_file(tmp_path / "a.csv", 1), *make_file(tmp_path / "b.csv", 2, 30)]
    split_bytes(size)
    found = read_large_csv(spark, str(tmp_path / "*.csv"), "row", broadcast_rows).orderBy("row").collect()
    assert [r.row for r in found] == list(range(len(wanted)))
    assert [tuple(r)[1:] for r in found] == wanted
    if size < 3000:
        assert len({r.start for r in csv_rows(spark, [str(tmp_path / "a.csv")]).collect()}) > 10


def test_equals_the_reader_of_whole_files(spark, tmp_path, split_bytes):
    make_file(tmp_path / "a.csv", 3)
    whole = read_csv(spark, str(tmp_path / "a.csv")).collect()
    split_bytes(500)
    assert sorted(map(tuple, read_large_csv(spark, str(tmp_path / "a.csv")).collect())) == sorted(map(tuple, whole))


def test_carriage_returns_and_a_mark(spark, tmp_path, split_bytes):
    wanted = make_file(tmp_path / "a.csv", 4, 80, "\r\n")
    data = (tmp_path / "a.csv").read_bytes()
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbf" + data)
    split_bytes(300)
    found = read_large_csv(spark, str(tmp_path / "a.csv"), "row").orderBy("row")
    assert found.columns == ["row", "id", "text", "more"]
    plain = lambda rows: [tuple((c or "").replace("\r\n", "\n") for c in r) for r in rows]
    assert plain(tuple(r)[1:] for r in found.collect()) == plain(wanted)


def test_a_cell_over_many_blocks(spark, tmp_path, split_bytes):
    long = "\n".join(f"line {i} of \"one\" cell" for i in range(500))
    with open(tmp_path / "a.csv", "w", newline="") as out:
        csv.writer(out, lineterminator="\n").writerows([["id", "text"], ["1", "x"], ["2", long], ["3", "y\nz"]])
    split_bytes(200)
    found = read_large_csv(spark, str(tmp_path / "a.csv"), "row").orderBy("row").collect()
    assert [tuple(r) for r in found] == [(0, "1", "x"), (1, "2", long), (2, "3", "y\nz")]


def test_short_rows_blank_lines_and_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text\n1\n\n2,"a\n\nb"\n')
    (tmp_path / "b.csv").write_text("id,text\n")
    found = read_large_csv(spark, str(tmp_path / "*.csv"), "row").orderBy("row").collect()
    assert [tuple(r) for r in found] == [(0, "1", None), (1, "2", "a\n\nb")]
    (tmp_path / "a.csv").write_text("id,text\n1,2,3\n")
    with pytest.raises(Exception, match="more cells than the header"):
        read_large_csv(spark, str(tmp_path / "a.csv")).collect()
    (tmp_path / "c.csv").write_text("other\n1\n")
    with pytest.raises(ValueError, match="another header"):
        read_large_csv(spark, str(tmp_path / "*.csv"))


def test_written_files_are_bounded(spark, tmp_path, monkeypatch):
    from sftpipe.plans import store_checks

    rows = [(i, "text of a row " * 20, "en") for i in range(400)] + [(7, "twice", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    whole = store_checks.large_csv_round_trip(spark, str(tmp_path)).collect()
    sizes = []
    write = store_checks.write_csv

    def counted(part, path):
        write(part, path)
        sizes.append(max(r.n for r in spark.read.text(path).groupBy("_metadata.file_path").agg({"value": "count"}).toDF("f", "n").collect()))

    monkeypatch.setattr(store_checks, "FILE_CHARS", 20000, raising=False)
    monkeypatch.setattr(store_checks, "write_csv", counted)
    cut = store_checks.large_csv_round_trip(spark, str(tmp_path)).collect()
    assert max(sizes) < 190  # rows of a file; a side has 200
    assert sorted(whole) == sorted(cut) and [r.position for r in sorted(cut)] == list(range(401))
