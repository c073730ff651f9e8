import random

import pytest
from pyspark.sql import functions as F

from sftpipe.operators import dedup
from sftpipe.operators.joins import join_hot, not_seen, with_keys, without_keys


def scan(entries):
    """The sequential rule: drop a row that shares a bucket with a kept one."""
    buckets, taken, dropped = {}, set(), set()
    for k, b in entries:
        buckets.setdefault(k, set()).add(b)
    for k in sorted(buckets):
        if buckets[k] & taken:
            dropped.add(k)
        else:
            taken |= buckets[k]
    return dropped


def near(spark, entries, **hot):
    df = spark.createDataFrame(entries, "k long, bucket string")
    return [r.k for r in dedup.near_dup_keys(df, "k", len(entries), **hot).collect()]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("hot", [{}, {"hot_share": 20, "hot_floor": 5}])
def test_near_dup_equals_sequential_scan(spark, seed, hot):
    rng = random.Random(seed)
    entries = {
        (k, f"{band}-{rng.randrange(25 + 40 * seed)}") for k in range(120) for band in range(3)
    }
    entries |= {(k, "hot") for k in range(120) if rng.random() < 0.3}
    entries = sorted(entries)
    got = near(spark, entries, **hot)
    assert len(got) == len(set(got))
    assert set(got) == scan(entries)


@pytest.mark.parametrize("scan_entries", [0, 12, 10**6])
def test_the_rest_is_scanned_by_component(spark, monkeypatch, scan_entries):
    monkeypatch.setattr(dedup, "ROUNDS", 1)
    monkeypatch.setattr(dedup, "SCAN_ENTRIES", scan_entries)
    rng = random.Random(7)
    entries = {(k, f"{band}-{rng.randrange(200)}") for k in range(150) for band in range(2)}
    entries |= {(1000 + k + d, f"chain {n}-{k}") for n, size in enumerate((3, 6, 30)) for k in range(100 * n, 100 * n + size) for d in (0, 1)}
    assert set(near(spark, sorted(entries))) == scan(entries)


def test_component_labels(spark):
    entries = [(k, f"{k // 50}-{j}") for k in range(200) for j in (k % 50, k % 50 + 1)] + [(500, "alone"), (501, "0-3")]
    live = spark.createDataFrame(entries, "k long, bucket string").groupBy("k").agg(F.collect_list("bucket").alias("buckets"))
    found = dict(dedup.component_labels(live, "k").collect())
    for first in (0, 50, 100, 150):
        assert {found.get(k, k) for k in range(first, first + 50)} == {first}
    assert found[501] == 0 and found.get(500, 500) == 500


def test_a_long_chain_takes_few_jobs(spark, monkeypatch):
    jobs, write = [], dedup.write_counted
    monkeypatch.setattr(dedup, "write_counted", lambda *a: jobs.append(a[1]) or write(*a))
    entries = [e for k in range(10_000) for e in ((k, f"{k:05}"), (k, f"{k + 1:05}"))]
    assert sorted(near(spark, entries)) == list(range(1, 10_000, 2))
    assert len(jobs) == dedup.ROUNDS + 2


def test_near_dup_chain_keeps_every_other_row(spark):
    entries = [e for k in range(9) for e in ((k, str(k)), (k, str(k + 1)))]
    assert sorted(near(spark, entries)) == [1, 3, 5, 7]


def test_near_dup_without_shared_buckets_or_rows(spark):
    assert near(spark, [(1, "a"), (2, "b")]) == []
    empty = spark.createDataFrame([], "k long, bucket string")
    assert dedup.near_dup_keys(empty, "k", 0).count() == 0


def test_exact_dedup_keeps_first(spark):
    rows = [(5, "x"), (1, "y"), (3, "x"), (2, "z"), (9, "y")]
    df = spark.createDataFrame(rows, "k long, f string").repartition(4)
    got = dedup.exact_dedup(df, "f", "k").collect()
    assert sorted((r.k, r.f) for r in got) == [(1, "y"), (2, "z"), (3, "x")]


def test_duplicate_rows_nulls_equal_and_encoding_unambiguous(spark):
    rows = [
        ("a", None, 0.0), ("a", None, -0.0), ("ab", "c", 1.0), ("a", "bc", 1.0),
        (None, "a", 1.0), ("-", "a", 1.0), ("-", "a", 1.0),
    ]
    df = spark.createDataFrame(rows, "a string, b string, d double")
    assert tuple(dedup.duplicate_rows(df).first()) == (7, 5, 2)
    assert df.distinct().count() == 5
    assert tuple(dedup.duplicate_rows(df.limit(0)).first()) == (0, 0, 0)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_hot_equals_plain_join(spark, how):
    rng = random.Random(1)
    keys = [0 if rng.random() < 0.5 else rng.choice([None, *range(1, 60)]) for _ in range(600)]
    left = spark.createDataFrame(list(enumerate(keys)), "i int, k int")
    right = spark.createDataFrame([(k, f"v{k}") for k in range(0, 60, 3)], "k int, v string")
    got = join_hot(left, right, "k", how, 600, share=10, floor=20)
    want = left.join(right, "k", how)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


@pytest.mark.parametrize("limit", [0, 1000])
def test_without_keys_broadcast_and_shuffle(spark, limit):
    df = spark.range(50).withColumnRenamed("id", "k")
    got = without_keys(df, df.filter("k % 3 = 0"), "k", broadcast_rows=limit)
    assert sorted(r.k for r in got.collect()) == [k for k in range(50) if k % 3]
    plan = got._jdf.queryExecution().toString()
    assert ("BroadcastHashJoin" in plan) == (limit > 0)
    assert got.select(F.max("k")).first()[0] == 49
    kept = with_keys(df, df.filter("k % 3 = 0"), "k", broadcast_rows=limit)
    assert sorted(r.k for r in kept.collect()) == list(range(0, 50, 3))


@pytest.mark.parametrize("limit", [0, 1000])
def test_not_seen(spark, limit):
    df = spark.createDataFrame([(k, f"u{k % 7}", "wide") for k in range(40)], "k int, u string, w string")
    seen = spark.createDataFrame([("u1",), ("u1",), ("u5",), (None,)], "u string")
    got = not_seen(df, "k", "u", seen, broadcast_rows=limit)
    assert got.columns == df.columns
    assert sorted(r.k for r in got.collect()) == [k for k in range(40) if k % 7 not in (1, 5)]
