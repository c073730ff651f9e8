"""Overlap scores and bounds against plain Python."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest

from sftpipe.operators import relevance as R


def grams(text, size):
    plain = "".join(c for c in (text or "").lower() if c.isalnum())
    if 0 < len(plain) < size:
        return {plain}
    return {plain[i : i + size] for i in range(len(plain) - size + 1)}


def band(found):
    return len(found).bit_length() - 1 if found else -1


def expected(rows, rule):
    """key: (score, excess, bound, irrelevant), in millionths."""
    sets = {k: (of or "", grams(q, rule.gram), grams(a, rule.gram)) for k, of, q, a in rows}
    answers, held = Counter(), Counter()
    for of, _, a in sets.values():
        answers[of, band(a)] += 1
        held.update((of, g, band(a)) for g in a)
    total, whole_held = Counter(), Counter()
    for (of, _), n in answers.items():
        total[of] += n
    for (of, g, _), n in held.items():
        whole_held[of, g] += n
    order = sorted(sets, key=lambda k: (sets[k][0], hashlib.md5(f"42{k}".encode()).hexdigest(), k))
    after = {k: n for k, n in zip(order, order[1:]) if sets[k][0] == sets[n][0]}

    def excess(of, q, other):
        a = sets[other][2]
        weights = {g: round(math.log((total[of] + 1) / (whole_held[of, g] + 1)) * 10**6) for g in q}
        hit = sum(w for g, w in weights.items() if g in a)
        chance = sum(w * round(held[of, g, band(a)] / answers[of, band(a)] * 10**6) for g, w in weights.items())
        whole = sum(weights.values())
        return (hit * 10**6 // whole, (hit * 10**6 - chance) // whole) if whole else (None, None)

    own = {k: excess(of, q, k) for k, (of, q, _) in sets.items()}
    cells = defaultdict(list)
    for k, other in after.items():
        over = excess(*sets[k][:2], other)[1]
        if over is not None:
            cells[band(sets[other][2])].append(over // 1000)

    def quantile(values):
        values = sorted(values)
        return (values[max(0, math.ceil(rule.quantile * len(values)) - 1)] + 1) * 1000

    every = quantile([c for v in cells.values() for c in v])
    out = {}
    for k, (score, over) in own.items():
        found = cells[band(sets[k][2])]
        bound = quantile(found) if len(found) >= rule.min_pairs else every
        out[k] = score, over, bound, score is not None and over < bound and score < 10**6
    return out


def make_rows(seed=1, n=240):
    """Han-like pairs: an answer repeats terms of its question; every fourth answer is swapped."""
    draw = random.Random(seed)
    terms = ["".join(chr(0x4E00 + draw.randrange(600)) for _ in range(2)) for _ in range(300)]
    common = [chr(0x6000 + i) for i in range(12)]
    rows = []
    for k in range(n):
        own = draw.sample(terms, 6)
        fill = lambda m: "".join(draw.choices(common, k=m))
        question = fill(2).join(own) + "？"
        answer = fill(4).join(draw.sample(own, 5) + draw.sample(terms, draw.choice((4, 30)))) + "。"
        rows.append([k, draw.choice(["zh", "law", None]), question, answer])
    swapped = [k for k in range(n) if k % 4 == 0]
    answers = [rows[k][3] for k in swapped]
    for k, a in zip(swapped, answers[1:] + answers[:1]):
        rows[k][3] = a
    return [tuple(r) for r in rows], set(swapped)


@pytest.mark.parametrize("gram, min_pairs, broadcast_rows", [(2, 20, R.BROADCAST_ROWS), (3, 10**6, 0)])
def test_scores_and_bounds(spark, gram, min_pairs, broadcast_rows):
    rows, _ = make_rows()
    rows += [(500, "zh", "", "answer"), (501, "zh", None, None), (502, "law", "Ab", ""), (503, None, "a", "A!"), (504, "x", "one", "two")]
    rule = R.RelevanceRule(gram=gram, quantile=0.9, min_pairs=min_pairs)
    df = spark.createDataFrame(rows, "id bigint, lang string, q string, a string").repartition(4)
    found = R.relevance(df, "id", "q", "a", "lang", rule, broadcast_rows).collect()
    million = lambda x: None if x is None else round(x * 10**6)
    got = {r.id: (million(r.score), million(r.excess), million(r.bound), r.irrelevant) for r in found}
    assert got == expected(rows, rule)
    assert got[500][0] is None and not got[500][3]


def test_swapped_answers_are_found(spark):
    rows, swapped = make_rows(2, 400)
    df = spark.createDataFrame(rows, "id bigint, lang string, q string, a string")
    found = {r.id for r in R.relevance(df, "id", "q", "a", rule=R.RelevanceRule(quantile=0.95)).collect() if r.irrelevant}
    assert len(found & swapped) >= 0.9 * len(swapped) and len(found & swapped) >= 0.95 * len(found)


def test_does_not_depend_on_partitions(spark):
    rows, _ = make_rows(3, 60)
    df = spark.createDataFrame(rows, "id bigint, lang string, q string, a string")
    one, two = (sorted(map(tuple, R.relevance(d, "id", "q", "a").collect())) for d in (df.repartition(7), df.coalesce(1)))
    assert one == two


def test_empty_table(spark):
    df = spark.createDataFrame([], "id bigint, q string, a string")
    assert R.relevance(df, "id", "q", "a").collect() == []


def test_grams_of_answers_move_once(spark):
    """They are many times the text, so one shuffle carries them, from the answer to the question before."""
    from pyspark.sql import functions as F

    rows = [(i, "", [i, i + 1], [i, 7, 8]) for i in range(6)]
    sets = spark.createDataFrame(rows, "key long, of string, q array<long>, a array<long>")
    moved = R.with_other_answers(sets)
    plan = moved._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 3 and moved.columns == ["key", "of", "q", "band", "other_band", "own", "met"]
    found = {r.key: r for r in moved.collect()}
    order = [r.key for r in sets.orderBy(R.shuffle_rank("key"), "key").collect()]
    for k, after in zip(order, [*order[1:], None]):
        q, a = {k, k + 1}, {k, 7, 8}
        assert set(found[k].own) == q & a and found[k].band == 1
        assert found[k].met is None if after is None else set(found[k].met) == q & {after, 7, 8}
    assert sets.select(F.col("a")).count() == 6


def test_texts_are_kept_and_not_their_grams(spark):
    """An answer has a gram of eight bytes for each character: as arrays, stages were many times the texts."""
    import os

    from sftpipe.session import scratch_root

    def kept():
        top = f"{scratch_root(spark)}/{spark.sparkContext.applicationId}".removeprefix("file:")
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(top) for f in names if f.endswith(".parquet"))

    draw = random.Random(4)
    texts = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=20_000)) for _ in range(60)]
    df = spark.createDataFrame([(i, t[100:130], t) for i, t in enumerate(texts)], "id bigint, q string, a string")
    before = kept()
    assert R.relevance(df, "id", "q", "a", rule=R.RelevanceRule(gram=5)).count() == len(texts)
    assert kept() - before < 2 * sum(map(len, texts))


def test_codes_of_grams():
    for text in ("", "ab", "abcab", "abcababc漢字漢字🙂🙂"):
        for size in (1, 2, 3, 7):
            codes = R.gram_codes("zh", text, size)
            assert len(codes) == len(grams_of_plain(text, size)) and (codes[1:] > codes[:-1]).all()
    assert not set(R.gram_codes("zh", "abcdef", 2)) & set(R.gram_codes("law", "abcdef", 2))
    assert set(R.gram_codes("", "xabcx", 3)) & set(R.gram_codes("", "abc", 3)) and not set(R.gram_codes("", "ab", 3)) & set(R.gram_codes("", "ab", 1))


def grams_of_plain(text, size):
    if 0 < len(text) < size:
        return {text}
    return {text[i : i + size] for i in range(len(text) - size + 1)}


@pytest.mark.parametrize("chunk", [1, 7, 10**6])
def test_grams_are_counted_in_chunks(chunk):
    import pyarrow as pa

    texts = [("x", "abab"), ("y", "abab"), ("x", ""), ("x", "abcab"), ("y", "q")]
    batches = [pa.RecordBatch.from_pydict({"of": list(o), "a": list(t)}) for o, t in (zip(*texts[:2]), zip(*texts[2:]))]
    got = Counter()
    for batch in R._count_grams(2, chunk)(iter(batches)):
        for r in batch.to_pylist():
            got[r["of"], r["band"], r["code"]] += r["n"]
    wanted = Counter()
    for of, text in texts:
        codes = R.gram_codes(of, text, 2).tolist()
        wanted.update((of, len(codes).bit_length() - 1, c) for c in [None, *codes])
    assert got == wanted
