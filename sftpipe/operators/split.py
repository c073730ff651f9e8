"""Head samples, seeded order and exact-size splits without moving the rows.

A cutoff is found on keys alone and comes back as one driver-side value, so the
table itself is only filtered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftpipe.session import write_stage

SEED_ROWS = 20_000
SPLIT_SEED = 42
SORT_ROWS = 1_000_000
_RANGES = 4096
_PREFIX_CHARS = 4


def _nth_key(keys: DataFrame, key: str, n: int) -> int | None:
    """The ``n``-th smallest value of an integer key; None when there are fewer.

    Counts over equal key ranges (at most 4096 rows) show which range holds it. That
    range is split again until it has few enough rows to sort, so no task sees more
    than that, however large the table or ``n`` is.
    """
    low, high, rows = keys.agg(F.min(key), F.max(key), F.count("*")).first()
    if rows < n:
        return None
    while rows > SORT_ROWS and low < high:
        width = (high - low) // _RANGES + 1
        offset = F.col(key).cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")
        counts = keys.groupBy(F.floor(offset / width).cast("int").alias("range")).count()
        for index, rows in counts.orderBy("range").collect():
            if n <= rows:
                break
            n -= rows
        low, high = low + index * width, min(low + (index + 1) * width - 1, high)
        keys = keys.filter(F.col(key).between(low, high))
    return keys.orderBy(key).limit(n).agg(F.max(key)).first()[0]


def head(df: DataFrame, key: str, n: int | None) -> DataFrame:
    """The first ``n`` rows by the unique integer ``key``; 0 or None means all."""
    if not n:
        return df
    last = _nth_key(df.select(key), key, n)
    return df if last is None else df.filter(F.col(key) <= last)


def seed_rows(df: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Start-up sample: ``limit`` rows, 20,000 when it is 0 or not given."""
    return head(df, key, limit or SEED_ROWS)


def shuffle_rank(key: str, seed: int = SPLIT_SEED) -> Column:
    """Value that orders rows pseudo-randomly and does not depend on partitioning."""
    return F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string")))


def seeded_shuffle(df: DataFrame, key: str, seed: int = SPLIT_SEED) -> DataFrame:
    return df.orderBy(shuffle_rank(key, seed), key)


def numbered(ordered: DataFrame, name: str) -> DataFrame:
    """Rows of a sorted DataFrame with their position from 0 as ``name``.

    Rows are written with their number inside each partition; the driver adds up the
    partitions' counts.
    """
    inside = F.monotonically_increasing_id()
    staged = write_stage(ordered.withColumn(name, inside), "ordered")
    part = F.shiftright(name, 33).cast("int")
    counts = staged.groupBy(part.alias("_part")).count().orderBy("_part").collect()
    starts, total = [], 0
    for number, rows in counts:
        starts.append((number, total - (number << 33)))
        total += rows
    table = F.broadcast(staged.sparkSession.createDataFrame(starts, "_part int, _start bigint"))
    return (
        staged.withColumn("_part", part)
        .join(table, "_part")
        .withColumn(name, F.col(name) + F.col("_start"))
        .drop("_part", "_start")
    )


def _cutoff(ranked: DataFrame, n: int, sort_rows: int = SORT_ROWS) -> str | None:
    """The ``n``-th smallest rank.

    Ranks are digests of unique keys and hence uniform: counts per 4 more digits of the
    prefix (at most 65,536 rows) show which prefix holds it, until it has few enough rows
    to sort.
    """
    prefix = ""
    while True:
        digits = F.substring("rank", 1, len(prefix) + _PREFIX_CHARS)
        counts = ranked.groupBy(digits.alias("prefix")).count().orderBy("prefix").collect()
        for prefix, rows in counts:
            if n <= rows:
                break
            n -= rows
        else:
            return None
        ranked = ranked.filter(F.col("rank").startswith(prefix))
        if rows <= sort_rows or len(prefix) >= 32:
            return ranked.orderBy("rank").limit(n).agg(F.max("rank")).first()[0]


def train_test_split(
    df: DataFrame, key: str, test_size: int = 500, seed: int = SPLIT_SEED
) -> DataFrame:
    """Add ``split``: exactly ``test_size`` rows are ``test``, the rest ``train``.

    ``key`` is unique. Like the original, a test size that leaves no training row
    is an error.
    """
    rank = shuffle_rank(key, seed)
    cutoff = _cutoff(df.select(rank.alias("rank")), test_size + 1)
    if test_size < 1 or cutoff is None:
        raise ValueError(f"test_size={test_size} must be at least 1 and below the row count")
    return df.withColumn("split", F.when(rank < F.lit(cutoff), "test").otherwise("train"))
