"""Hard cases of HTML residue, and properties on random texts."""

import html
import random
import time

import pytest
from pyspark.sql import functions as F

from sftpipe.functions import residue as R

CASES = [
    ("a < b and c > d", None),
    ("x<y>z", None),
    ("if (a<b && c>d) {}", None),
    ("<b and c> d", None),
    ("1 <2> 3", None),
    ("a <unknown> tag, <p q=> and <p =3>", None),
    ("AT&T &unknown; & &; &#; &#x; &amp", None),
    ("&#0; &#xD800; &#1114112; &#127;", None),
    ("a <!-- open", None),
    ("", None),
    ("<p>one<br/>two</p>", "\none\ntwo\n"),
    ("<em >5</em > <I>6</I>", "5 6"),
    ('<a href="x>y" class=z disabled>link</a>', "link"),
    ("<img src='a.png' alt=\"<b>\"/>", ""),
    ("<a\n href=x\t>y</a\n>", "y"),
    ("a <!-- c --> b<!----> <!-- - -- <p> -->", "a  b "),
    ("<!-- a <!-- b --> c -->", ""),
    ("<script type='x'>var a='<b>';</script>rest<STYLE>p{}</style >", "rest"),
    ("<!DOCTYPE html><html lang=en><body>t</body></html><![CDATA[x]]>", "\n\nt\n\nx"),
    ('<?xml version="1.0"?>x', "x"),
    ("&lt;b&gt;bold&lt;/b&gt;", "bold"),
    ("&amp;lt;br&amp;gt;x", "\nx"),
    ("&amp;amp;amp;lt; 3 &amp;lt 4", "< 3 &lt 4"),
    ("&#60;i&#62;x&#38;amp;", "x&"),
    ("&#3&#56;;lt;", "<"),
    ("<scr<b>ipt>a", "a"),
    ("&copy;&nbsp;&hellip;&#8212;&#x2014;&#150;&Eacute;&apos;&quot;", "©\xa0…———–É'\"".replace("———", "——")),
    ("\x01\x02&lt;\x01\x03", "\x01\x02<\x01\x03"),
    ("漢<b>字</b>&#x6f22;🙂&#128578;", "漢字漢🙂🙂"),
]


def stripped(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    found = {r.k: r for r in df.select("k", R.strip_residue("text").alias("out"), R.has_residue("text").alias("any")).collect()}
    return [found[i] for i in range(len(texts))]


def test_cases(spark):
    found = stripped(spark, [text for text, _ in CASES])
    for (text, wanted), r in zip(CASES, found):
        assert r.out == (text if wanted is None else wanted), text
        assert r.any == (r.out != text)


def test_null_stays_null(spark):
    (r,) = stripped(spark, [None])
    assert r.out is None and r.any is None


def test_references_are_the_standards(spark):
    names = sorted(R.named_references()) + [f"#{n}" for n in (9, 32, 65, 0x3BB, 0xFFFD, 0x10FFFD)] + ["#xe9", "#X1F642"]
    names = [n for n in names if n not in ("lt", "gt", "amp")]
    found = stripped(spark, [f"a&{n};b" for n in names])
    for n, r in zip(names, found):
        assert r.out == f"a{html.unescape(f'&{n};')}b", n
    numbers = [n for n in range(128, 160) if n in R.low_references()]
    for n, r in zip(numbers, stripped(spark, [f"&#{n};" for n in numbers])):
        assert r.out == html.unescape(f"&#{n};")


def test_result_is_a_fixpoint(spark):
    draw = random.Random(3)
    parts = ["<", ">", "&", "amp;", "lt;", "gt;", "#60;", "b", "/", "br", " ", "<b>", "</p>", "&lt;", "<!--", "-->", "x", '"', "=", "]]>"]
    texts = ["".join(draw.choices(parts, k=draw.randint(1, 25))) for _ in range(1500)]
    once = [r.out for r in stripped(spark, texts)]
    assert [r.out for r in stripped(spark, once)] == once
    assert any(a != b for a, b in zip(texts, once))


def test_escaping_any_number_of_times_is_undone(spark):
    plain = "one < two & three > four, \"five\" 'six' <seven>"
    texts, text = [], plain
    for _ in range(8):
        texts.append(text)
        text = html.escape(text)
    assert {r.out for r in stripped(spark, texts)} == {plain}


@pytest.mark.parametrize("part", ["<!--", "&amp;", "<a href=\"", "<a b='", "&lt;", "<", "&", "<script>", "amp;&", "-->", "<p "])
def test_long_texts_take_linear_time(spark, part):
    df = spark.createDataFrame([(part * 20_000,)], "text string")
    start = time.perf_counter()
    df.select(F.length(R.strip_residue("text"))).collect()
    assert time.perf_counter() - start < 20


def test_stays_in_the_jvm(spark):
    df = spark.createDataFrame([("x",)], "text string").select(R.strip_residue("text"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_a_round_names_its_text_once(spark):
    """A lambda evaluates an expression wherever it is named, so a round's removal is named once."""
    from pyspark.sql import functions as F

    from sftpipe.functions.residue import COMMENT, strip_residue

    df = spark.createDataFrame([("a<br>b",)], "t string")
    plan = df.select(strip_residue(F.col("t")).alias("o"))._jdf.queryExecution().analyzed().expressions().toString()
    assert plan.count(COMMENT) == 1
