"""Template lines against counting in plain Python."""

import random
import re
from collections import Counter

import pytest

from sftpipe.operators import boilerplate as B

RULE = B.TemplateRule(min_pages=3, min_share=0.3)


def normal(line):
    return re.sub("[0-9]+", "0", re.sub("[ \t\n\r\x0b\x0c\xa0　]+", " ", line).strip(" ").lower())


def templates(pages):
    sites, counts = Counter(p[1] for p in pages), Counter()
    for _, site, text in pages:
        counts.update({(site, normal(line)) for line in (text or "").split("\n") if normal(line)})
    return {k: n for k, n in counts.items() if n >= RULE.min_pages and n >= RULE.min_share * sites[k[0]]}


def cleaned(pages):
    found = templates(pages)
    for key, site, text in pages:
        if text is None:
            yield key, site, None, ()
            continue
        lines = text.split("\n")
        gone = tuple(i for i, line in enumerate(lines) if (site, normal(line)) in found)
        yield key, site, "\n".join(line for i, line in enumerate(lines) if i not in gone), gone


def make_pages():
    draw, pages = random.Random(1), []
    for key in range(300):
        site = draw.choice(["a.example", "b.example", "c.example", "", None, "big"] + ["big"] * 6)
        lines = [f"Only on page {draw.choice('abcdefgh') * (key + 1)}"]
        lines += draw.sample(["Buy now: 12 offers", "BUY  now:\t7 offers", "call me", " call　me ", "rare line", "", "  "], k=draw.randint(0, 6))
        lines += ["Shared by sites"] * draw.randint(0, 2)
        draw.shuffle(lines)
        pages.append((key, site, "\n".join(lines)))
    return pages + [(1000, "a.example", None), (1001, None, ""), (1002, "big", "\n\n"), (1003, "one page", "call me")]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(make_pages(), "id bigint, site string, text string").repartition(4)


def test_templates(spark, pages):
    lines = B.page_lines(pages, "id", "site", "text")
    found = B.template_lines(lines, RULE)
    wanted = templates(make_pages())
    assert Counter((r.site, r.pages) for r in found.collect()) == Counter((k[0], n) for k, n in wanted.items())
    assert any(site is None for site, _ in wanted) and ("one page", "call me") not in wanted


@pytest.mark.parametrize("broadcast_rows", [B.BROADCAST_ROWS, 0])
def test_removal(pages, broadcast_rows):
    found = B.remove_templates(pages, "id", "site", "text", RULE, removed="gone", broadcast_rows=broadcast_rows)
    assert found.columns == ["id", "site", "text", "gone"]
    got = {(r.id, r.site, r.text, tuple(r.gone)) for r in found.collect()}
    assert got == set(cleaned(make_pages()))
    assert any(gone for *_, gone in got) and any(not gone for *_, gone in got)


def test_unique_lines_stay(pages):
    found = B.remove_templates(pages, "id", "site", "text", RULE)
    assert all("Only on page" in r.text for r in found.filter("id < 300").collect())


def test_names_that_clash(spark):
    rows = [(i, "s", f"ad {i}\n{'z' * i}x", 5) for i in range(6)]
    df = spark.createDataFrame(rows, "key bigint, site string, digests string, _numbers int")
    found = B.remove_templates(df, "key", "site", "digests", RULE)
    assert {tuple(r) for r in found.collect()} == {(i, "s", "z" * i + "x", 5) for i in range(6)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "id bigint, site string, text string")
    assert B.remove_templates(df, "id", "site", "text", RULE, removed="gone").collect() == []
