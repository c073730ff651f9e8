import json
import random

import pytest
from test_minhash import py_bands
from test_text import py_clean

from sftpipe.functions.minhash import band_shape
from sftpipe.operators.quality import QualityRule, funnel, quality_filter
from sftpipe.plans.build import BuildConfig, build, build_to

RULE = QualityRule()


def py_build(rows, threshold=0.8, near=True):
    """(key, stage) by the sequential rules."""
    shape = band_shape(threshold)
    seen, taken, stages = set(), set(), {}
    for k, q, a in sorted(rows, key=lambda r: r[0]):
        q, a = py_clean(q), py_clean(a)
        if not q or not a:
            stages[k] = "empty"
            continue
        if (q, a) in seen:
            stages[k] = "exact_dup"
            continue
        seen.add((q, a))
        if near:
            bands = set(py_bands(q + a, *shape))
            if bands & taken:
                stages[k] = "near_dup"
                continue
            taken |= bands
        ratio = sum("一" <= c <= "鿿" for c in a) / len(a)
        good = len(q) >= 5 and 10 <= len(a) <= 2000 and ratio >= 0.5
        stages[k] = "kept" if good else "quality"
    return stages


def corpus(n=150, seed=11):
    rng = random.Random(seed)
    han = [chr(c) for c in range(0x4E00, 0x4E00 + 600)]
    rows = []
    for k in range(n):
        pick = rng.random()
        if pick < 0.2 and rows:
            _, q, a = rng.choice(rows)
            a = a and a.replace("。", "，") if pick < 0.1 else a
        elif pick < 0.3 and rows:
            _, q, a = rng.choice(rows)
            a = a and a + rng.choice(["！", " 　", "补充"])
        else:
            q = "".join(rng.choices(han, k=rng.choice([3, 4, 5, 20])))
            a = "。".join("".join(rng.choices(han, k=rng.choice([9, 40, 60]))) for _ in range(3))
        if pick > 0.97:
            q = rng.choice([None, "", " \x07 "])
        if 0.9 < pick < 0.95:
            a = "english answer only, no han characters here"
        rows.append((k, q, a))
    return rows


@pytest.mark.parametrize("near", [True, False])
def test_build_equals_sequential_rules(spark, near):
    rows = corpus()
    raw = spark.createDataFrame(rows, "k long, question string, answer string").repartition(5)
    result = build(raw, "k", BuildConfig(near_dedup=near, source="s"))
    want = py_build(rows, near=near)
    assert {r.k: r.drop_stage for r in result.stages.collect()} == want
    assert set(want.values()) >= {"empty", "exact_dup", "quality", "kept"}
    kept = {k for k, stage in want.items() if stage == "kept"}
    records = {r.k: (r.instruction, r.input, r.output, r.source) for r in result.records.collect()}
    assert records == {
        k: (py_clean(q), "", py_clean(a), "s") for k, q, a in rows if k in kept
    }
    report = result.funnel.first()
    n = list(want.values())
    clean = len(n) - n.count("empty")
    exact = clean - n.count("exact_dup")
    assert report.raw_rows == len(n) and report.after_clean == clean
    assert report.exact_dup_pct == pytest.approx((clean - exact) / clean * 100)
    assert report.after_near == exact - n.count("near_dup")
    assert report.final_rows == len(kept)
    assert (report.near_dup_pct is None) == (not near)


def test_row_that_fails_quality_still_drops_its_near_copy(spark):
    answer = "".join(chr(0x4E00 + i) for i in range(300))
    rows = [(1, "问", answer), (2, "问题是什么", answer)]
    raw = spark.createDataFrame(rows, "k long, question string, answer string")
    stages = {r.k: r.drop_stage for r in build(raw, "k").stages.collect()}
    assert stages == {1: "quality", 2: "near_dup"}


def test_sample_takes_first_rows(spark):
    raw = spark.createDataFrame(corpus(), "k long, question string, answer string")
    assert build(raw, "k", BuildConfig(sample=20)).funnel.first().raw_rows == 20


def test_quality_bounds(spark):
    han = "法"
    cases = [
        (han * 4, han * 10, False), (han * 5, han * 10, True), (han * 5, han * 9, False),
        (han * 5, han * 2000, True), (han * 5, han * 2001, False),
        (han * 5, han * 5 + "a" * 5, True), (han * 5, han * 5 + "a" * 6, False),
        ("abcde", han * 10, True),
    ]
    df = spark.createDataFrame(
        [(i, q, a) for i, (q, a, _) in enumerate(cases)], "i int, question string, answer string"
    )
    got = {r.i for r in quality_filter(df).collect()}
    assert got == {i for i, c in enumerate(cases) if c[2]}


def test_funnel_of_nothing(spark):
    empty = spark.createDataFrame(
        [], "drop_stage string, question_chars int, answer_chars int"
    )
    row = funnel(empty).first()
    assert (row.raw_rows, row.exact_dup_pct, row.near_dup_pct, row.yield_pct) == (0, 0.0, 0.0, None)


def test_build_to_writes_json_lines_and_report(spark, tmp_path):
    rows = [(1, "什么是“合同”法?", "答案。" * 5), (2, None, "x")]
    raw = spark.createDataFrame(rows, "k long, question string, answer string")
    out, report = str(tmp_path / "out"), str(tmp_path / "report")
    build_to(raw, "k", out, report, BuildConfig(source="s"))
    lines = [
        line
        for p in (tmp_path / "out").glob("part-*")
        for line in p.read_text("utf-8").splitlines()
    ]
    assert [list(json.loads(x)) for x in lines] == [["instruction", "input", "output", "source"]]
    assert "什么是“合同”法?" in lines[0] and '"input":""' in lines[0]
    text = "".join(p.read_text("utf-8") for p in (tmp_path / "report").glob("part-*"))
    assert "- raw rows: 2" in text and "- overall yield: 50.0%" in text
