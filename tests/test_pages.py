from datetime import datetime
from hashlib import sha1

import pytest

from sftpipe.operators import ingest, joins
from sftpipe.operators.ingest import unseen_pages
from sftpipe.operators.pages import SITES, Pick, Site, book_rows, page_records, parse_books, parse_pages
from sftpipe.plans.ingest import ingest_pages, runs
from sftpipe.sources import tables
from sftpipe.streaming.ingest import stream_pages

PAGE = "page_key long, url string, html string"


def quote(text, author="A", tags=()):
    span = f'<span class="text"> {text} </span>' if text is not None else ""
    links = "".join(f'<a class="tag">{t}</a>\n' for t in tags)
    return f'<div class="quote" id=1>{span}<span>by <small class="author">{author}</small></span>{links}</div>'


PAGES = [
    (1, "u1", "<html>" + quote("“Be <b>bold</b> &amp; true”", "Ann", ["life", "x"]) + quote("two")),
    (2, "u2", "<p>no quotes<p>"),
    (3, "u3", quote("kept?") + quote(None)),
    (4, "u4", quote("two") + quote("", "B") + quote("four<script>x()</script><!-- c -->", "D")),
    (5, "u5", None),
]


def df(spark, rows=PAGES):
    return spark.createDataFrame(rows, PAGE)


def test_quote_pages(spark):
    parsed = parse_pages(df(spark), "quotes")
    rows = {r.page_key: r for r in parsed.collect()}
    assert [rows[k].ok for k in range(1, 6)] == [True, True, False, True, False]
    assert rows[3].error == "AttributeError: 'NoneType' object has no attribute 'get_text'"
    records = sorted(page_records(parsed).collect())
    assert [(r.page_key, r.position, r.question, r.answer) for r in records] == [
        (1, 0, "“Bebold& true”", "—— Ann(标签:life, x)"),
        (1, 1, "two", "—— A(标签:无)"),
        (4, 0, "two", "—— A(标签:无)"),
        (4, 2, "four", "—— D(标签:无)"),
    ]
    assert {r.source for r in records} == {"quotes_demo"}


def test_parser_by_column_and_unknown_site(spark):
    article = "<article><h1> T </h1><p>a <i>b</i></p> c</article>"
    pages = spark.createDataFrame(
        [(1, "u", article, "article"), (2, "v", quote("q"), "quotes")], PAGE + ", site string"
    )
    records = sorted(page_records(parse_pages(pages)).collect())
    assert [(r.question, r.answer) for r in records] == [("T", "abc"), ("q", "—— A(标签:无)")]
    with pytest.raises(ValueError, match="unknown site"):
        parse_pages(df(spark), "nowhere")


def test_article_without_parts_gives_no_record(spark):
    pages = df(spark, [(1, "u", "<h1>x</h1>"), (2, "v", "<article><h1>x</h1></article>")])
    parsed = parse_pages(pages, "article")
    assert parsed.filter("ok").count() == 2 and page_records(parsed).count() == 0


def test_registered_parser_and_long_error(spark):
    pick = Pick((("span",),), attribute="x" * 900)
    SITES["broken"] = Site("broken", {"question": pick, "answer": pick}, {"question": "{question}", "answer": "{answer}"})
    try:
        row = parse_pages(df(spark, PAGES[:1]), "broken").first()
    finally:
        del SITES["broken"]
    assert not row.ok and len(row.error) == 500 and row.error.startswith("KeyError: 'x")


def test_comments_end_a_piece_of_text(spark):
    html = '<div class="quote"><span class="text">a <!-- c --> b<?x?> c</span><small class="author">A</small></div>'
    rows = page_records(parse_pages(df(spark, [(1, "u", html)]), "quotes")).collect()
    assert [r.question for r in rows] == ["abc"]


def test_books(spark):
    pod = (
        '<article class="product_pod"><h3><a href="#" title="Title &amp; more">T</a></h3>'
        '<p class="price_color">£51.77</p><p class="instock availability">\n <i></i> In stock \n</p>'
        "</article>"
    )
    pages = df(spark, [(1, "u", f"<ol><li>{pod}<li>{pod}</ol>"), (2, "v", pod.replace("title=", "t="))])
    parsed = parse_books(pages)
    assert {r.page_key: r.error for r in parsed.collect()} == {1: None, 2: "KeyError: 'title'"}
    rows = [tuple(r)[1:] for r in book_rows(parsed).orderBy("position").collect()]
    assert rows == [(i, "Title & more", "£51.77", "In stock") for i in range(2)]


def test_unseen_pages(spark):
    seen = spark.createDataFrame([("u1",), ("u1",), ("u4",)], "url string")
    todo = unseen_pages(df(spark), seen)
    assert todo.columns == ["page_key", "url", "html"]
    assert sorted(r.page_key for r in todo.collect()) == [2, 3, 5]


@pytest.mark.parametrize("limit, stages", [(joins.BROADCAST_ROWS, ["firsts"]), (0, ["firsts", "fresh"])])
def test_new_records_read_no_more_than_they_need(spark, monkeypatch, limit, stages):
    found = [
        (1, 0, "a", "b"), (1, 1, "c", "d"), (2, 0, "ab", ""), (2, 1, "a", "b"), (4, 0, None, "x"), (5, 0, " c", "d "),
        (3, 0, "s", "t"), (3, 0, "s2", "t"), (None, 0, "n", "n"), (6, 0, "s", "t"), (1, 0, "a", "b"),
    ]
    hashed = lambda *pair: sha1("".join(pair).encode()).hexdigest()
    stored = spark.createDataFrame([(hashed("s", "t"),), (hashed("s", "t"),), (None,)], "content_hash string")
    written, plans, write, stage = [], [], ingest.write_counted, joins.write_stage
    monkeypatch.setattr(ingest, "BROADCAST_ROWS", limit)
    monkeypatch.setattr(ingest, "write_counted", lambda *a: written.append(a[1]) or write(*a))
    monkeypatch.setattr(joins, "write_stage", lambda *a: plans.append(plan(a[0])) or stage(*a))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    fresh = ingest.new_records(spark.createDataFrame(found, "page_key long, position int, question string, answer string"), stored)
    assert written == stages
    # A place that two texts share is kept or dropped whole; rows without a place are dropped.
    kept = [(1, 0, "a", "b"), (1, 0, "a", "b"), (1, 1, "c", "d"), (3, 0, "s", "t"), (3, 0, "s2", "t")]
    assert sorted(map(tuple, fresh.collect())) == [(*row, hashed(*row[2:])) for row in kept]
    assert plan(fresh).index("sha1") < plan(fresh).index("Join LeftSemi")  # hashed after the join
    assert [p.count("Aggregate") for p in plans] == [1] * (limit > 0)
    assert ingest.new_records(fresh.limit(0), stored).columns == ["page_key", "position", "question", "answer", "content_hash"]


def snapshot(spark, root):
    return {
        "records": sorted(
            (r.content_hash, r.question, r.answer, r.source, r.url)
            for r in tables.records(spark, root).collect()
        ),
        "visited": sorted((r.url, r.ok) for r in tables.visited(spark, root).collect()),
        "dead": sorted((r.url, r.error) for r in tables.dead_letters(spark, root).collect()),
    }


def test_ingest_twice_equals_once(spark, tmp_path):
    root = str(tmp_path / "store")
    first = ingest_pages(df(spark), root, "quotes", now=datetime(2024, 5, 1)).first()
    assert tuple(first) == (3, 2, 3)
    once = snapshot(spark, root)
    assert [v for v in once["visited"]] == [("u1", 1), ("u2", 1), ("u3", 0), ("u4", 1), ("u5", 0)]
    assert [r[4] for r in once["records"] if r[1] == "two"] == ["u1"]
    assert tuple(ingest_pages(df(spark), root, "quotes").first()) == (0, 0, 0)
    assert snapshot(spark, root) == once
    more = [*PAGES, (6, "u6", quote("two") + quote("new"))]
    assert tuple(ingest_pages(df(spark, more), root, "quotes").first()) == (1, 0, 1)
    totals = tables.store_totals(tables.records(spark, root), tables.dead_letters(spark, root))
    assert tuple(totals.first()) == (4, 2)
    assert runs(spark, root).count() == 3
    again = ingest_pages(df(spark, more), str(tmp_path / "other"), "quotes").first()
    (tmp_path / "other" / "visited").rename(tmp_path / "gone")
    assert tuple(ingest_pages(df(spark, more), str(tmp_path / "other"), "quotes").first())[2] == 0
    (row,) = runs(spark, str(tmp_path / "other")).collect()
    assert (row.ok_pages, row.dead_pages, row.new_records) == tuple(again)


def test_compaction_keeps_what_the_tables_say(spark, tmp_path):
    root = str(tmp_path / "store")
    for n in (1, 3, 5):
        ingest_pages(df(spark, PAGES[:n]), root, "quotes")
    before, done = snapshot(spark, root), sorted(map(tuple, runs(spark, root).collect()))
    for name in ("visited", "dead_letters", "runs"):
        tables.compact(spark, root, name)
        assert len(list((tmp_path / "store" / name).glob("part-*"))) == 1
    assert snapshot(spark, root) == before and sorted(map(tuple, runs(spark, root).collect())) == done
    assert tuple(ingest_pages(df(spark), root, "quotes").first()) == (0, 0, 0)
    tables.compact(spark, str(tmp_path / "none"), "visited")


def test_summary_is_counted_while_pages_and_records_are_written(spark, tmp_path):
    root = str(tmp_path / "store")
    # A key comes twice, a url and a text are null, two texts are equal.
    rows = [*PAGES, (1, "u1", PAGES[0][2]), (7, None, quote("q") + quote(None)), (8, None, quote("q"))]
    for batch, want in ((rows, (5, 3, 6)), ([(9, "u9", None)], (0, 1, 0)), ([], (0, 0, 0))):
        summary = ingest_pages(df(spark, batch), root, "quotes")
        assert "parquet" not in summary._jdf.queryExecution().optimizedPlan().toString().lower()
        assert summary.dtypes == [(n, "bigint") for n in ("ok_pages", "dead_pages", "new_records")]
        assert [tuple(r) for r in summary.collect()] == [want]
    stored = sorted((r.ok_pages, r.dead_pages, r.new_records) for r in runs(spark, root).collect())
    assert stored == [(0, 0, 0), (0, 1, 0), (5, 3, 6)]
    parsed = parse_pages(df(spark, rows), "quotes")
    found = page_records(parsed)
    read = ingest.run_summary(parsed, ingest.new_records(found, tables.records(spark, str(tmp_path / "none")))).first()
    assert tuple(read) == tuple(ingest.run_summary(parsed, found, (5, 3, 6)).first())


def test_ingest_limit_and_restart_after_lost_visited(spark, tmp_path):
    root = str(tmp_path / "store")
    assert tuple(ingest_pages(df(spark), root, "quotes", limit=2).first()) == (2, 0, 2)
    (tmp_path / "store" / "visited").rename(tmp_path / "lost")
    assert tuple(ingest_pages(df(spark), root, "quotes").first()) == (3, 2, 1)
    assert tables.records(spark, root).count() == 3


def test_same_url_twice_in_a_batch_keeps_last_outcome(spark, tmp_path):
    rows = [(1, "u", quote(None)), (2, "u", quote("fine"))]
    root = str(tmp_path / "store")
    assert tuple(ingest_pages(df(spark, rows), root, "quotes").first()) == (1, 1, 1)
    got = snapshot(spark, root)
    assert got["visited"] == [("u", 1)] and [u for u, _ in got["dead"]] == ["u"]


def test_stream_equals_batch(spark, tmp_path):
    batch, stream = str(tmp_path / "batch"), str(tmp_path / "stream")
    ingest_pages(df(spark), batch, "quotes")
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    for part in (PAGES[:2], PAGES[2:], PAGES[:1]):
        df(spark, part).coalesce(1).write.mode("append").parquet(source)
        stream_pages(spark, source, stream, checkpoint, "quotes", max_files=1).awaitTermination()
    assert snapshot(spark, stream) == snapshot(spark, batch)
    assert runs(spark, stream).count() == 3
