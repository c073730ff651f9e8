"""Counts against plain Python and SQL, bands against planted texts."""

import base64
import random
import re
from collections import Counter

import duckdb
import pytest
import zstandard

from conftest import prose
from sftpipe.llm import compression_bands as bands
from sftpipe.llm import queries

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    words = WORDS.findall(text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            again += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


def brute_verdict(text):
    """Each rule by itself."""
    data = (text or "").encode()
    compress = zstandard.ZstdCompressor(level=3, write_content_size=False).compress

    def out(part):
        if not part:
            return 0
        fit = [b for b in bands.BANDS if b[0] <= len(part)]
        ratio = len(compress(part)) / len(part)
        return 0 if not fit else -1 if ratio < fit[-1][1] else 1 if ratio > fit[-1][2] else 0

    chunks = [data[i : i + 4096] for i in range(0, len(data), 4096)]
    shares = {s: sum(len(c) for c in chunks if out(c) == s) for s in (-1, 1)}
    if out(data) < 0 or shares[-1] >= 0.34 * max(1, len(data)):
        return "repetitive"
    return "incompressible" if out(data) > 0 or shares[1] >= 0.34 * max(1, len(data)) else "in_band"


def noise(seed, size):
    return base64.b64encode(random.Random(seed).randbytes(size)).decode()


def long_prose(seed, words):
    """Words of many forms, as a language has them."""
    draw = random.Random(seed)
    parts = "an er in st or el ti ch ma ro de pli con ver ing ou qua ber lo sha fi".split()
    return " ".join("".join(draw.choices(parts, k=draw.randint(1, 4))) for _ in range(words))


MIXED = [
    "a b c a b c",
    "one\n\none\n \n \none\ntwo # $ <>\n",
    "x\x85y z x\x85y z x\x85y",
    "same line here\n" * 40,
    "é漢字🙂 " * 30,
    "a a",
    "a a a",
    "a a a a",
]


def test_counts_are_those_of_the_definition():
    draw = random.Random(2)
    texts = MIXED + [" ".join(draw.choices("abcd", k=draw.randint(0, 60))).replace("a b", "a\nb") for _ in range(200)]
    for text in texts:
        assert bands.counts(text) == brute_counts(text)


def test_windows_of_very_many_words(monkeypatch):
    words = [b"%d" % (i % 1_100_000) for i in range((1 << 21) + 5)]
    assert bands.repeated_words(words) == 2 * ((1 << 21) + 5 - 1_100_000)


def test_bands_have_all_lengths():
    assert bands.band(0) == (0.0, float("inf")) and bands.band(63)[0] == 0.0
    assert bands.band(64) == bands.BANDS[0][1:] and bands.band(10**9) == bands.BANDS[-1][1:]
    assert all(low < high for _, low, high in bands.BANDS)


@pytest.mark.parametrize("words", [60, 200, 900, 4000, 30000])
def test_prose_stays_and_planted_texts_go(words):
    judge = bands.Ratios().judge
    assert judge(long_prose(words, words).encode())[-1] == "in_band"
    assert judge(noise(words, 5 * words).encode())[-1] == "incompressible"
    sentence = long_prose(1, 12) + ". "
    assert judge((sentence * (words // 12)).encode())[-1] == "repetitive"


def test_chunks_see_what_the_whole_hides():
    own, judge = long_prose(5, 4000), bands.Ratios().judge
    half = own[: len(own) // 2]
    filler = ("again and again " * 2000)[: len(own) // 2]
    whole, low, _, verdict = judge((half + filler).encode())
    assert verdict == "repetitive" and low >= 0.34
    assert judge((own + noise(6, len(own) // 2)).encode())[-1] == "incompressible"


def test_odd_rows(odd_docs, odd_rows):
    found = bands.quality_rules(odd_docs, "doc_id", "text").collect()
    fields = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept verdict".split()
    got = Counter((r.doc_id, *(r[f] for f in fields)) for r in found)
    wanted = Counter()
    for key, text in ((r[0], r[1]) for r in odd_rows):
        own, verdict = brute_counts(text), brute_verdict(text)
        failed = own[0] < 50 or 2 * own[-1] > own[0]
        wanted[(key, *own, failed, not failed and verdict == "in_band", verdict)] += 1
    assert got == wanted
    assert all(r.ratio == 1.0 and not r.low_share for r in found if r.n_words == 0 and r.doc_id in (120, 121, 123))


def test_own_bands_and_empty_table(spark, no_docs):
    assert bands.quality_rules(no_docs, "doc_id", "text").collect() == []
    docs = spark.createDataFrame([(1, prose(1, 300))], "doc_id bigint, text string")
    (row,) = bands.quality_rules(docs, "doc_id", "text", bands=((0, 0.99, 1.0),)).collect()
    assert row.verdict == "repetitive" and not row.kept


def test_counts_against_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    found = queries.op13_quality_rules(spark, sf_dir)
    word = r"[^\x20\x09-\x0D]+"
    wanted = duckdb.sql(f"""
        SELECT doc_id, len(words), len(array_to_string(words, '')),
               len(regexp_extract_all(text, '[#*$%&|<>]')), len(lines) - len(list_distinct(lines))
        FROM (SELECT doc_id, text, regexp_extract_all(text, '{word}') AS words,
                     list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '{word}')) AS lines
              FROM (SELECT doc_id, coalesce(text, '') AS text FROM '{sf_dir}/documents.parquet'))""").fetchall()
    rows = found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines").collect()
    assert Counter(map(tuple, rows)) == Counter(wanted)
