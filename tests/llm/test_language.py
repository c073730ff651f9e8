"""Phrases against a greedy parse by substring search; accuracy on held-out texts."""

import random
import zlib

import numpy as np
import pytest

from sftpipe.llm import language


def greedy(text, sample):
    phrases, at = 0, 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at : end + 1] in sample:
            end += 1
        phrases, at = phrases + 1, end
    return phrases


def test_phrases_equal_a_greedy_parse_of_whole_texts():
    draw = random.Random(1)
    samples = {n: bytes(draw.choice(b"abc ") for _ in range(300)) for n in ("x", "y")}
    model = language.fit(samples)
    texts = [bytes(draw.choice(b"abcd ") for _ in range(n)) for n in (0, 1, 2, 50, 255, 256, 257, 1000, 5000)]
    found = language.phrase_counts(texts, model)
    for text, row in zip(texts, found):
        assert row.tolist() == [greedy(text, samples[n]) for n in ("x", "y")]


@pytest.mark.parametrize("rounds", [0, 1, 8])
def test_parses_that_meet_late_or_never(rounds, monkeypatch):
    monkeypatch.setattr(language, "ROUNDS", rounds)
    draw = random.Random(2)
    prose = bytes(draw.choice(b"abc ") for _ in range(12_000))
    samples = {"once": prose, "same": b"a" * 97, "long": b"a" * 1009, "half": prose[:3000] + b"a" * 300}
    model = language.fit(samples)
    texts = [prose, prose[1:5900], b"a" * 9000, b"z" * 600, prose[100:1500] + b"a" * 2000 + prose, b"", b"a" * 512]
    found = language.phrase_counts(texts, model)
    assert found[0, model[0].index("once")] == 1
    for text, row in zip(texts, found):
        assert row.tolist() == [greedy(text, samples[n]) for n in model[0]]


def test_reduced():
    assert language.reduced("Ab, 12 ÇD_e\n") == "ab çd e".encode()
    assert language.reduced("12 ½ ²!") == b"" == language.reduced("")


def test_no_language_and_one_language():
    assert language.classify([b"ab"], language.fit({})) == [("und", 0.0)]
    assert language.classify([b"ab", b""], language.fit({"q": b"abc"})) == [("q", 1.0), ("und", 0.0)]


def test_equal_languages_give_the_smallest_name():
    assert language.classify([b"abc"], language.fit({"b": b"abc", "a": b"abc"}))[0] == ("a", 0.0)


@pytest.fixture(scope="module")
def prose():
    draw = random.Random(5)
    parts = {"aa": ["ka", "to", "mi", "re"], "bb": ["sch", "ung", "ber", "en"], "cc": ["eau", "que", "ion", "re"]}
    rows = []
    for i in range(300):
        lang = draw.choice(list(parts))
        words = ["".join(draw.choice(parts[lang]) for _ in range(draw.randint(1, 3))) for _ in range(draw.randint(4, 60))]
        rows.append((i, " ".join(words), lang))
    return rows


def test_held_out_accuracy(spark, prose):
    docs = spark.createDataFrame(prose, "doc_id bigint, text string, lang string")
    found = {r.doc_id: r for r in language.held_out_languages(docs, "doc_id", "text", "lang").collect()}
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, *_ in prose)
    held = [found[i].lang_pred == lang for i, _, lang in prose if found[i].held_out]
    assert np.mean(held) > 0.95
    # Labels of held-out rows are not read.
    blind = [(i, t, None if found[i].held_out else lang) for i, t, lang in prose]
    again = language.held_out_languages(spark.createDataFrame(blind, docs.schema), "doc_id", "text", "lang")
    assert {r.doc_id: r.lang_pred for r in again.collect()} == {i: r.lang_pred for i, r in found.items()}


def test_odd_rows(odd_docs, odd_rows):
    found = language.held_out_languages(odd_docs, "doc_id", "text", "lang").collect()
    assert sorted(repr(r.doc_id) for r in found) == sorted(repr(r[0]) for r in odd_rows)
    names = {r.lang_pred for r in found}
    assert names <= {"en", "de", "zz", "und"}
    assert all(0 <= r.score <= 1 for r in found)
    for r in found:
        if r.doc_id in (120, 121, 122, 123):
            assert (r.lang_pred, r.score) == ("und", 0.0)


def test_empty_table(no_docs):
    assert language.held_out_languages(no_docs, "doc_id", "text", "lang").collect() == []


def test_more_languages_than_a_model_holds(spark, prose):
    docs = spark.createDataFrame(prose, "doc_id bigint, text string, lang string")
    held = docs.selectExpr("*", "false AS held_out")
    whole = language.learn(docs, "doc_id", "text", "lang")
    parts = language.learn(docs, "doc_id", "text", "lang", languages=2)
    assert [m[0] for m in whole] == [["aa", "bb", "cc"]] and [m[0] for m in parts] == [["aa", "bb"], ["cc"]]
    rows = [sorted(language.predict(held, "doc_id", "text", m).collect()) for m in (whole, parts)]
    assert rows[0] == rows[1]


def test_a_row_repeated_often_is_one_text_of_the_sample(spark):
    rows = [(1, "aba " * 50, "a")] * 3000 + [(i, "cd" * i, "a") for i in range(2, 40)] + [(None, "ef " * 9, "a")] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    [(names, codes, _, sizes)] = language.learn(docs, "doc_id", "text", "lang")
    # Every distinct text is in the sample once, the one with a null key too.
    assert names == ["a"] and sizes == [sum(len(t.strip()) + 1 for t in {r[1] for r in rows})]
