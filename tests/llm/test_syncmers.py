"""Against closed syncmers over a plain list, and edits with a known effect."""

import hashlib
import random

from pyspark.sql import functions as F

from sftpipe.llm import syncmers


def units(text):
    out = []
    for w in _words(text):
        alone = len(w) - 16 if len(w) > 16 else 0
        out += [*w[:alone], w[alone:]]
    return out


def _words(text):
    words, current = [], ""
    for c in text or "":
        if c in " \t\n\v\f\r":
            words.append(current)
            current = ""
        else:
            current += c
    return [w for w in [*words, current] if w]


def hashed(spark, values):
    """Hashes of single units and of pairs of unit hashes, by the same functions, one row each."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.h for r in rows.select("i", F.xxhash64("v").alias("h")).orderBy("i").collect()]


def pairs(spark, h):
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(zip(h, h[1:]))], "i int, a bigint, b bigint")
    return [r.h for r in rows.select("i", F.xxhash64("a", "b").alias("h")).orderBy("i").collect()]


def test_positions_are_closed_syncmers(spark, odd_rows):
    for text in (odd_rows[19][1], odd_rows[12][1] * 3, "a b c d e f g h", "a b a b a b a b a b"):
        found = spark.createDataFrame([(text,)], "t string").select(syncmers.positioned_anchors("t").alias("a")).first().a
        h = hashed(spark, units(text))
        s = pairs(spark, h)
        wanted = []
        for i in range(len(h) - syncmers.K + 1):
            window = s[i : i + syncmers.K - syncmers.S + 1]
            if min(window) in (window[0], window[-1]):
                wanted.append(i + 1)
        assert [a.unit for a in found][: len(wanted)] == wanted
        assert all(b - a <= syncmers.K - syncmers.S for a, b in zip(wanted, wanted[1:]))
        # A short text also has its units.
        singles = [a.unit for a in found][len(wanted) :]
        assert singles == (list(range(1, len(h) + 1)) if len(h) < syncmers.SHORT_UNITS else [])


def test_selection_does_not_depend_on_what_is_around(spark, odd_rows):
    text = odd_rows[19][1]
    both = spark.createDataFrame([(text, "x y z " + text)], "a string, b string")
    a, b = both.select(syncmers.positioned_anchors("a"), syncmers.positioned_anchors("b")).first()
    inside = {(x.unit + 3, x.hash) for x in a}
    assert inside == {(x.unit, x.hash) for x in b if x.unit > 3 and (x.unit, x.hash) in inside}


def edited(docs):
    """Pairs of (row, edited text) by the contract, keys descending."""
    out = []
    for i, (key, text) in enumerate(docs):
        following = docs[(i + 1) % len(docs)][1] or ""
        cut = len(text or "") // 3
        out.append((key, (text or "")[: len(text or "") - cut] + following[:cut]))
    return out


def test_edited_texts_for_any_number_of_runs(spark, odd_rows, monkeypatch):
    unique = {}
    for i, t, *_ in odd_rows:
        if i is not None and len(t or "") < 10_000:
            unique[i] = t
    docs = sorted(unique.items(), reverse=True)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    wanted = {k: hashlib.sha256(e.encode()).hexdigest() for k, e in edited(docs)}
    results = []
    for rows in (500, 1, 5):
        monkeypatch.setattr(syncmers, "RUN_ROWS", rows)
        found = syncmers.edit_likeness(df, "doc_id", "text").collect()
        assert {r.doc_id: r.edited_sha256 for r in found} == wanted
        assert all(r.n_chars == len(unique[r.doc_id] or "") for r in found)
        results.append(sorted(map(tuple, found)))
    assert results[0] == results[1] == results[2]
    rows = {r[0]: r for r in results[0]}
    texts = {}
    for key, text in docs:
        texts.setdefault(text or "", set()).add(rows[key][3])
    assert all(len(f) == 1 for f in texts.values())
    assert rows[103][6] == 1.0  # the next document is a copy
    # Two thirds of a text of many words stay.
    assert all(0.2 < rows[k][5] <= 1 for k, t in docs if len((t or "").split()) > 20)


def test_odd_rows(odd_docs, odd_rows):
    found = syncmers.edit_likeness(odd_docs, "doc_id", "text").collect()
    assert sorted(r.n_chars for r in found) == sorted(len(t or "") for _, t, *_ in odd_rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    empty = [r for r in found if r.n_chars == 0]
    assert {(r.fingerprint, r.edited_fingerprint, r.near_edited) for r in empty} == {("", "", 1.0)}
    assert [f.name for f in syncmers.fingerprints(odd_docs, "doc_id", "text").schema] == ["doc_id", "fingerprint"]


def test_one_row_and_no_rows(spark, no_docs):
    one = spark.createDataFrame([(1, "abcdef")], "doc_id bigint, text string")
    found = syncmers.edit_likeness(one, "doc_id", "text").first()
    assert found.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and found.near_next == 1.0
    assert syncmers.edit_likeness(no_docs, "doc_id", "text").collect() == []


def test_no_python_in_the_plan(odd_docs):
    plan = syncmers.edit_likeness(odd_docs, "doc_id", "text")._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "ArrowEval", "mapInArrow"))


def alike(spark, *texts):
    """The likeness of each pair of texts."""
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(texts)], "i int, a string, b string")
    prints = rows.select("i", syncmers.anchors("a").alias("a"), syncmers.anchors("b").alias("b"))
    return [r.x for r in prints.select("i", syncmers.likeness("a", "b").alias("x")).orderBy("i").collect()]


def test_units_of_long_runs(spark):
    texts = ["ab " + "x" * 16, "x" * 17 + " ab", "x" * 40, "", " \t ", "\U0001f600" * 20 + "\n" + "漢字" * 30]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", syncmers._units(F.col("t")).alias("u"))
    assert {r.i: r.u for r in rows.collect()} == {i: units(t) for i, t in enumerate(texts)}


def test_one_character_more_in_a_text_without_blanks(spark):
    draw = random.Random(4)
    text, other = ("".join(chr(draw.randrange(0x4E00, 0x9FA5)) for _ in range(3000)) for _ in range(2))
    longer = [text[:at] + "字" + text[at:] for at in (0, 1, 1500, 2990)]
    *near, far = alike(spark, *[(text, t) for t in longer], (text, other))
    assert min(near) > 0.97 and far < 0.01


def test_texts_on_both_sides_of_the_short_ones(spark):
    draw = random.Random(3)
    words = ["".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(60)]
    texts = [" ".join(words[:n]) for n in range(60)]
    assert min(alike(spark, *zip(texts[syncmers.K :], texts[syncmers.K + 1 :]))) >= 0.6
    assert alike(spark, (texts[3], texts[50]), ("", texts[50]), ("", "a")) == [0.0, 0.0, 0.0]
