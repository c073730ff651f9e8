import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sftpipe.operators import split, stats


@pytest.mark.parametrize("bins", [20, 50])
@pytest.mark.parametrize(
    "values",
    [
        [float(v) / 3 for v in range(3, 16)] * 3,
        [random.Random(2).uniform(-1e3, 1e3) for _ in range(500)],
        [float(v) for v in range(0, 51)],
        [0.1 * v for v in range(200)],
        [4.0, 4.0],
    ],
)
def test_histogram_equals_numpy(spark, values, bins):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    rows = stats.histogram(df, F.col("x"), bins).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=bins)
    assert [r.rows for r in rows] == counts.tolist()
    assert [r.lo for r in rows] + [rows[-1].hi] == edges.tolist()


def test_histogram_of_nothing_is_all_zero(spark):
    rows = stats.histogram(spark.createDataFrame([], "x double"), F.col("x"), 5).collect()
    assert [r.rows for r in rows] == [0] * 5


SCORED = "complexity double, clarity double, informativeness double, _error string"


def test_score_statistics(spark):
    rows = [
        (1.0, 5.0, 5.0, None), (4.5, 4.0, None, None), (5.0, 4.0, 3.0, None),
        (9.0, 4.0, 4.0, None), (5.0, 5.0, 5.0, "E"),
    ]
    df = spark.createDataFrame(rows, SCORED)
    cells = {(r.dimension, r.score): (r.rows, r["mean"]) for r in stats.score_histogram(df).collect()}
    assert len(cells) == 15
    assert cells["complexity", 1] == (1, 3.0) and cells["complexity", 4] == (0, 3.0)
    assert cells["clarity", 4] == (3, 4.25) and cells["informativeness", 5][0] == 1
    share = stats.high_quality_share(df).first()
    assert (share.rated_rows, share.high_rows) == (3, 2)
    assert stats.high_quality(df).count() == 2
    summary = stats.score_summary(df).first()
    assert (summary.ok_rows, summary.failed_rows, summary.mean_informativeness) == (4, 1, 3.0)
    none = stats.score_histogram(df.limit(0)).collect()
    assert len(none) == 15 and all(r.rows == 0 and r["mean"] is None for r in none)


def test_fetch_summary(spark):
    log = spark.createDataFrame(
        [("a", 200, 1.0), ("b", 404, 2.0), ("c", -1, 6.0), ("d", None, 3.0)],
        "url string, status int, elapsed_s double",
    )
    assert tuple(stats.fetch_summary(log).first()) == (1, 3, 4, 3.0, 12.0)


@pytest.mark.parametrize("n", [0, None, 1, 7, 100, 1000])
def test_head(spark, n):
    df = spark.range(100).withColumnRenamed("id", "k").repartition(7)
    assert sorted(r.k for r in split.head(df, "k", n).collect()) == list(range(n or 100))[:100]


@pytest.mark.parametrize("n", [1, 999, 5000, 9999, 10_000, 10_001])
def test_head_narrows_key_ranges(spark, monkeypatch, n):
    monkeypatch.setattr(split, "SORT_ROWS", 50)
    rng = random.Random(n)
    keys = [rng.randrange(7000, 2**62) * rng.choice([1, -1]) for _ in range(3000)] + list(range(7000))
    keys[0], keys[1] = 2**63 - 1, -(2**63)
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    assert sorted(r.k for r in split.head(df, "k", n).collect()) == sorted(keys)[:n]


def test_head_of_nothing_and_seed_rows(spark):
    assert split.head(spark.range(0), "id", 3).count() == 0
    assert split.seed_rows(spark.range(30_000), "id", 0).count() == 20_000
    assert split.seed_rows(spark.range(30_000), "id", 5).count() == 5


@pytest.mark.parametrize("size", [1, 50, 999])
def test_split_is_exact_and_ignores_partitioning(spark, size):
    def test_keys(partitions):
        df = split.train_test_split(spark.range(1000).repartition(partitions), "id", size)
        return {r.id for r in df.filter("split = 'test'").collect()}

    keys = test_keys(1)
    assert len(keys) == size and keys == test_keys(9)


@pytest.mark.parametrize("size", [0, 10, 11])
def test_split_needs_rows_on_both_sides(spark, size):
    with pytest.raises(ValueError):
        split.train_test_split(spark.range(10), "id", size)


def test_seeded_shuffle(spark):
    order = [r.id for r in split.seeded_shuffle(spark.range(50), "id").collect()]
    assert sorted(order) == list(range(50)) != order
    assert order == [r.id for r in split.seeded_shuffle(spark.range(50).repartition(6), "id").collect()]
