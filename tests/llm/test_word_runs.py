"""Against the definition of runs in plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import pytest

from sftpipe.llm import queries, word_runs

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words):
    """Runs by every period and place; a period that a smaller one explains does not count."""
    found = []
    for period in range(1, len(words) // 3 + 1):
        at = 0
        while at + period < len(words):
            start = at
            while at + period < len(words) and words[at] == words[at + period]:
                at += 1
            n = at - start + period
            if at > start and n >= max(24, 3 * period):
                stretch = words[start : start + n]
                if all(stretch[q:] != stretch[:-q] for q in range(1, period)):
                    found.append((start, n, period))
            at += at == start
    return sorted(found, key=lambda run: (run[0], run[2]))


def planted(seed, n_texts=120):
    draw, texts = random.Random(seed), []
    for _ in range(n_texts):
        words = [f"w{draw.randrange(draw.choice((1, 2, 3, 60)))}" for _ in range(draw.randint(0, 150))]
        for _ in range(draw.randint(0, 4)):
            if words:
                at = draw.randrange(len(words))
                period = draw.randint(1, max(1, (len(words) - at) // 3))
                words[at:] = [words[at + i % period] for i in range(draw.randint(period, 4 * period + 30))] + words[at:]
        texts.append(words)
    return texts


def test_runs_are_those_of_the_definition():
    n_runs = 0
    for words in planted(1, 600):
        data = [w.encode() for w in words]
        assert word_runs.word_runs(data) == brute_runs(data)
        n_runs += len(brute_runs(data))
    assert n_runs > 500


def test_stretches_only_save_time():
    for words in planted(2):
        names = {w: i for i, w in enumerate(sorted(set(words)))}
        whole = word_runs.runs_of_ids([names[w] for w in words])
        assert whole == word_runs.word_runs([w.encode() for w in words])


def test_automaton_has_all_suffixes():
    draw = random.Random(3)
    for _ in range(60):
        ids = [draw.randrange(3) for _ in range(draw.randint(1, 30))]
        length, link, prefixes = word_runs.automaton(ids)
        for end, state in enumerate(prefixes):
            assert length[state] == end + 1
            while link[state] > 0:  # the next state holds shorter suffixes, which have more places
                short = ids[end + 1 - length[link[state]] : end + 1]
                places = [i for i in range(len(ids)) if ids[max(0, i + 1 - len(short)) : i + 1] == short]
                long = ids[end - length[link[state]] : end + 1]
                fewer = [i for i in range(len(ids)) if i + 1 >= len(long) and ids[i + 1 - len(long) : i + 1] == long]
                assert len(fewer) < len(places)
                state = link[state]


def test_paths_keep_the_last_colour():
    """Segments of a random tree against a walk from state to state."""
    draw = random.Random(4)
    for _ in range(40):
        link = [-1] + [draw.randrange(max(0, i - 4), i) for i in range(1, 60)]
        paths, colours = word_runs.Paths(link), [-1] * len(link)
        for new in range(80):
            state, walked = draw.randrange(len(link)), []
            at = state
            while at >= 0:
                if colours[at] >= 0 and (not walked or walked[-1][1] != colours[at]):
                    walked.append((at, colours[at]))
                colours[at], at = new, link[at]
            assert list(paths.recolour(state, new)) == walked


@pytest.mark.parametrize(
    "words, runs",
    [
        (["a"] * 23, []),
        (["a"] * 24, [(0, 24, 1)]),
        (["x"] + list("abcdefghi") * 3 + ["y"], [(1, 27, 9)]),
        ((list("abcdefghi") * 3)[:26], []),
        (list("abcdefgh") * 3, [(0, 24, 8)]),
        (["a"] * 30 + ["b"] * 30, [(0, 30, 1), (30, 30, 1)]),
        # Both ends of one run belong to the next.
        (list("abc") * 9 + list("dbc") * 9, [(0, 27, 3), (25, 29, 3)]),
    ],
)
def test_small_cases(words, runs):
    assert word_runs.word_runs([w.encode() for w in words]) == runs == brute_runs(words)


def edited(key, text):
    words = WORDS.findall(text or "")
    value, n = zlib.crc32(str("" if key is None else key).encode()), len(words)
    if value % 10 == 0 and n:
        g = value // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def wanted_row(key, text):
    words = edited(key, text)
    runs = brute_runs(words) if len(words) < 3000 else word_runs.word_runs([w.encode() for w in words])
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    milli = 1000 * best[1] // best[2] if runs else None
    return (key, len(runs), *best, milli, *(hashlib.sha256(t.encode()).hexdigest() for t in (listed, kept)))


def query_rows(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    return Counter(map(tuple, queries.op12_word_runs(spark, str(tmp_path)).collect()))


def test_query(spark, tmp_path):
    rows = [(i, " ".join(words)) for i, words in enumerate(planted(5, 300))]
    rows += [(1000, " \n".join(["a"] * 40) + "\x85b"), (1001, "é " * 60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert query_rows(spark, docs, tmp_path) == Counter(wanted_row(*r) for r in rows)


def test_odd_rows(spark, odd_docs, odd_rows, tmp_path):
    assert query_rows(spark, odd_docs, tmp_path) == Counter(wanted_row(r[0], r[1]) for r in odd_rows)


def test_collapsed_text_and_names(spark):
    text = "start " + "say it again " * 12 + "end"
    df = spark.createDataFrame([(text, "x")], "g string, hash string")
    (row,) = word_runs.find_runs(df, "hash", "g").collect()
    assert (row.hash, row.n_words, row.collapsed) == ("x", 38, "start say it again end")
    (row,) = word_runs.with_periodic_tails(df, "hash", "g").collect()
    assert row.hash == "x" and len(row.g.split()) == 38


def test_empty_table(spark, no_docs):
    assert word_runs.find_runs(no_docs, "doc_id", "text").collect() == []
    assert word_runs.with_periodic_tails(no_docs, "doc_id", "text").collect() == []
