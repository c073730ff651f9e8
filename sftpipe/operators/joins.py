"""Joins that hold when one key has a large share of the rows.

Two size rules are used. A set is broadcast only after counting that it has at
most ``BROADCAST_ROWS`` fixed-width keys. A hot key is one with more than
``1 / HOT_SHARE`` of all rows, so there can never be more than ``HOT_SHARE`` of
them, whatever the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftpipe.session import write_counted, write_stage

BROADCAST_ROWS = 500_000
HOT_SHARE = 4096
HOT_FLOOR = 200_000
#: No key with more rows than this is left to one task, however large the table.
HOT_MOST = 10_000_000


def at_most(df: DataFrame, rows: int) -> bool:
    """By a plain count: tasks send one number each, where a limit would send rows to one task."""
    return df.count() <= rows


def _by_key(df, keys, on, how, rows, broadcast_rows):
    small = at_most(keys, broadcast_rows) if rows is None else rows <= broadcast_rows
    return df.join(F.broadcast(keys) if small else keys.hint("shuffle_hash"), on, how)


def without_keys(
    df: DataFrame,
    keys: DataFrame,
    on: str,
    rows: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rows of ``df`` whose ``on`` is not in ``keys``; ``on`` is a short key, unique in ``df``.

    A small key set (``rows`` where the caller has counted it) is broadcast and
    ``df`` is not moved. A larger one is shuffled; the key side is hashed, so ``df``
    is never sorted.
    """
    return _by_key(df, keys, on, "left_anti", rows, broadcast_rows)


def with_keys(
    df: DataFrame,
    keys: DataFrame,
    on: str,
    rows: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rows of ``df`` whose ``on`` is in ``keys``, by the same rule."""
    return _by_key(df, keys, on, "left_semi", rows, broadcast_rows)


def not_seen(
    df: DataFrame,
    key: str,
    value: str,
    seen: DataFrame,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rows of ``df`` whose text ``value`` is not among those of ``seen``; ``key`` is unique.

    Values are matched as 16-byte digests. Seen values counted to be few are
    broadcast. A small batch against a large store goes the other way: its digests are
    broadcast to the store, and the few that are met there come back. Only when both are
    large are (key, digest) joined, with hot values handled, and the open rows fetched by
    their keys.
    """
    digest = F.unhex(F.md5(F.col(value))).alias("_digest")
    done = seen.select(digest)
    if at_most(done, broadcast_rows):
        keyed = df.select("*", digest)
        return keyed.join(F.broadcast(done), "_digest", "left_anti").drop("_digest")
    narrow, batch = write_counted(df.select(key, digest), "batch-digests")
    if batch <= broadcast_rows:
        met = met_in(done, narrow.select("_digest").distinct(), "_digest")
        keyed = df.select("*", digest)
        return keyed.join(F.broadcast(met), "_digest", "left_anti").drop("_digest")
    open_rows = join_hot(narrow, done.distinct(), "_digest", "left_anti", batch)
    todo, rows = write_counted(open_rows.select(key), "not-seen")
    return with_keys(df, todo, key, rows, broadcast_rows)


def met_in(store: DataFrame, few: DataFrame, on: str) -> DataFrame:
    """The values of ``few``, distinct and counted by the caller to fit a broadcast, that
    ``store`` has.

    The store is only scanned; what it sends on are values of ``few``.
    """
    hits = store.select(on).join(F.broadcast(few), on, "left_semi")
    return write_stage(hits.distinct(), "met")


def hot_keys(
    df: DataFrame,
    on: str,
    rows: int,
    share: int = HOT_SHARE,
    floor: int = HOT_FLOOR,
    counts: DataFrame | None = None,
) -> DataFrame | None:
    """Keys above the hot limit, or None. At most ``share`` rows reach the driver, or one for
    each ``HOT_MOST`` rows if that is more.

    ``counts`` (on, count) saves the counting where the caller has done it.
    """
    limit = min(max(rows // share, floor), max(HOT_MOST, floor))
    if rows <= limit:
        return None
    counts = df.groupBy(on).count() if counts is None else counts
    found = counts.filter(F.col("count") > limit).select(on).collect()
    if not found:
        return None
    return df.sparkSession.createDataFrame(found, df.select(on).schema)


def join_hot(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str,
    rows: int,
    share: int = HOT_SHARE,
    floor: int = HOT_FLOOR,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join where ``right`` has at most one row per key and ``left`` may be skewed.

    Rows of ``left`` with a hot key stay where they are and meet the few matching
    rows of ``right`` by broadcast; all others are shuffled, and none of their keys
    exceeds the hot limit. ``rows`` is the row count of ``left``.
    """
    hot = hot_keys(left, on, rows, share, floor, counts)
    if hot is None:
        return left.join(right, on, how)
    hot = F.broadcast(hot)
    right_hot = F.broadcast(right.join(hot, on, "left_semi"))
    cold = left.join(hot, on, "left_anti").join(right, on, how)
    return cold.unionByName(left.join(hot, on, "left_semi").join(right_hot, on, how))
