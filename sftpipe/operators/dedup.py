"""Exact and near duplicate removal, keeping the first row by an explicit key."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftpipe.operators.joins import HOT_FLOOR, HOT_SHARE, join_hot, without_keys
from sftpipe.session import append_stage, write_counted, write_stage

#: Rounds before the undecided rest is scanned, and entries of a rest or of a component of it
#: that one task scans: its memory is a set of as many digests, some 100 MB.
ROUNDS, SCAN_ENTRIES = 4, 1_000_000


def first_keys(df: DataFrame, group: str | Sequence[str], key: str) -> DataFrame:
    """The smallest ``key`` of each ``group``, combined before the shuffle."""
    group = [group] if isinstance(group, str) else list(group)
    return df.groupBy(*group).agg(F.min(key).alias(key)).select(key)


def exact_dedup(df: DataFrame, fingerprint: str, key: str) -> DataFrame:
    """First row of each fingerprint. ``key`` is unique.

    Only (fingerprint, key) is grouped, so a fingerprint shared by a third of the
    rows shrinks to one row per task; full rows then move once, by the unique key,
    and are not sorted. ``df`` is read twice: write it first if it is costly.
    """
    return df.join(
        first_keys(df, fingerprint, key).hint("shuffle_hash"), key, "left_semi"
    )


def bucket_rows(df: DataFrame, key: str, bands: str) -> DataFrame:
    return df.select(key, F.explode(bands).alias("bucket"))


def shared_buckets(entries: DataFrame, key: str) -> DataFrame:
    """Buckets that hold two rows or more: size and first key."""
    return (
        entries.groupBy("bucket")
        .agg(F.min(key).alias("first_key"), F.count("*").alias("size"))
        .filter("size > 1")
    )


def _first_wins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, key, buckets) in order to (key, kept): the scan within each label."""
    label, claimed = None, set()
    for batch in batches:
        kept = []
        for of, buckets in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if of != label:
                label, claimed = of, set()
            kept.append(claimed.isdisjoint(buckets))
            if kept[-1]:
                claimed.update(buckets)
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(kept, pa.bool_())], names=["key", "kept"])


def component_labels(live: DataFrame, key: str) -> DataFrame:
    """(key, label): the smallest key of each row's component over shared buckets.

    Every row is linked to the first one of each of its buckets. Then larger and smaller
    neighbours are pointed, in turn, at the smallest one known, until nothing changes; that takes
    a number of rounds that grows with the logarithm of the longest chain.
    """
    entries = live.select(F.col(key).alias("high"), F.explode("buckets").alias("bucket"))
    # Combined before it is shuffled; a bucket's rows are not brought together.
    firsts = entries.groupBy("bucket").agg(F.min("high").alias("low"), F.count(F.lit(1)).alias("count"))
    firsts, _ = write_counted(firsts.filter("count > 1"), "near-firsts")
    rows = entries.count()
    linked = join_hot(entries, firsts.select("bucket", "low"), "bucket", "inner", rows, counts=firsts.select("bucket", "count"))

    def state() -> Column:
        digest = F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))
        return F.concat_ws(":", F.count(F.lit(1)).cast("string"), digest.cast("string"))

    def least(edges: DataFrame) -> DataFrame:
        return edges.groupBy("high").agg(F.min("low").alias("least"))

    edges, now = write_counted(linked.select("high", "low").filter("high <> low").distinct(), "near-links", state())
    before = None
    while now != before:
        before = now
        both = edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
        root = least(both).withColumn("least", F.least("least", "high"))
        larger = both.filter("low > high").join(root, "high").select(F.col("low").alias("high"), F.col("least").alias("low")).distinct()
        mates = larger.join(least(larger), "high")
        smaller = mates.select("high", F.col("least").alias("low")).unionByName(
            mates.select(F.col("low").alias("high"), F.col("least").alias("low"))
        )
        edges, now = write_counted(smaller.filter("high <> low").distinct(), "near-stars", state())
    return edges.select(F.col("high").alias(key), F.col("low").alias("label"))


def scanned(live: DataFrame, key: str, entries: int) -> DataFrame:
    """``live`` (key, buckets) with ``kept``, null for rows of components too large for a task."""
    kind = live.schema[key].dataType
    schema = f"key {kind.simpleString()}, kept boolean"
    if entries <= SCAN_ENTRIES:
        labelled = live.select(F.lit(None).cast(kind).alias("label"), F.col(key).alias("key"), "buckets").repartition(1)
    else:
        labels = component_labels(live, key)
        own = live.join(labels, key, "left").select(
            F.coalesce("label", F.col(key)).alias("label"), F.col(key).alias("key"), "buckets"
        )
        own = write_stage(own, "near-components")
        large = own.groupBy("label").agg(F.sum(F.size("buckets")).alias("n")).filter(F.col("n") > SCAN_ENTRIES)
        # Each has more than the bound, so there are few of them.
        labelled = own.join(F.broadcast(large.select("label")), "label", "left_anti").repartition("label")
    found = labelled.sortWithinPartitions("label", "key").mapInArrow(_first_wins, schema)
    return live.join(found.withColumnRenamed("key", key), key, "left")


def near_dup_keys(
    entries: DataFrame,
    key: str,
    rows: int,
    hot_share: int = HOT_SHARE,
    hot_floor: int = HOT_FLOOR,
) -> DataFrame:
    """Keys a first-wins scan would drop, from one (key, bucket) row per band.

    The scan keeps a row unless it shares a bucket with an earlier kept row, so a
    bucket keeps at most one row. That is solved in rounds over the undecided rows:
    a row that comes first in all its buckets is kept, every other row in those
    buckets is dropped, and the rest go to the next round. The first undecided row
    is always decided, so the rounds end. Row pairs are never formed: each round is
    linear in the entries, minima are combined before they are shuffled, and
    buckets with a large share of the rows are joined without moving their rows. The
    only lists are the buckets of one row, at most one per band.

    Most rows are decided in a round or two. What ``ROUNDS`` rounds leave are chains of
    copies, which would take a round for every second link. Rows decide one another only
    within their component, so the rest is scanned in order, a component a task; a small
    rest is one. Only components of more than ``SCAN_ENTRIES`` entries go on in rounds.

    Exact copies need no removal beforehand: a copy shares all buckets of the first
    one and is dropped with it or because of it. ``rows`` bounds the entries.
    """

    def join(left: DataFrame, right: DataFrame, how: str, left_rows: int, counts=None):
        return join_hot(left, right, "bucket", how, left_rows, hot_share, hot_floor, counts)

    def size(condition: Column) -> Column:
        return F.sum(F.when(condition, F.size("buckets")))

    shared = shared_buckets(entries, key).select("bucket", F.col("size").alias("count"))
    if rows > hot_floor:
        shared = write_stage(shared, "shared-buckets")
    live, rows = write_counted(
        join(entries, shared.select("bucket"), "left_semi", rows, shared)
        .groupBy(key)
        .agg(F.collect_list("bucket").alias("buckets")),
        "near-live",
        size(F.lit(True)),
    )
    dropped_path = None
    undecided = F.col("kept").isNull()
    done = 0
    while rows:
        if done and done % ROUNDS == 0:
            state, rows = write_counted(scanned(live, key, rows), "near-scanned", size(undecided))
            dropped_path = append_stage(state.filter("NOT kept").select(key), dropped_path)
            live = state.filter(undecided).drop("kept")
            if not rows:
                break
        done += 1
        live_entries = live.select(key, F.size("buckets").alias("n"), F.explode("buckets").alias("bucket"))
        firsts = live_entries.groupBy("bucket").agg(
            F.min(key).alias(key), F.min_by("n", key).alias("n")
        )
        wins = firsts.groupBy(key).agg(F.collect_list("bucket").alias("won"), F.min("n").alias("n"))
        claimed = wins.filter(F.size("won") == F.col("n")).select(
            F.col(key).alias("kept_key"), F.explode("won").alias("bucket")
        )
        decided = (
            join(live_entries.drop("n"), claimed, "inner", rows)
            .groupBy(key)
            .agg(F.bool_or(F.col("kept_key") == F.col(key)).alias("kept"))
        )
        state, rows = write_counted(live.join(decided, key, "left"), "near-state", size(undecided))
        dropped_path = append_stage(state.filter("NOT kept").select(key), dropped_path)
        live = state.filter(undecided).drop("kept")
    if dropped_path is None:
        return live.select(key).limit(0)
    return live.sparkSession.read.schema(live.select(key).schema).parquet(dropped_path)


def near_dedup(df: DataFrame, key: str, bands: str = "bands") -> DataFrame:
    """Rows of ``df`` that survive the first-wins scan in ``key`` order.

    Rows are written once, so neither the signature nor what made the rows is computed
    again.
    """
    staged, entries = write_counted(df, "banded", F.sum(F.size(bands)))
    dropped, rows = write_counted(
        near_dup_keys(bucket_rows(staged, key, bands), key, entries), "near-dropped"
    )
    return without_keys(staged, dropped, key, rows)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Row count, distinct row count and their difference; nulls are equal."""
    return row_groups(df).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.count("*").alias("distinct_rows"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"),
    )


def row_groups(df: DataFrame, *aggregates) -> DataFrame:
    """One row per distinct row of ``df``, grouped by a 16-byte digest of the row.

    Every value is written with its length, so different rows have different
    texts, and only digests are shuffled.
    """

    def encoded(field):
        value = F.col(f"`{field.name}`")
        if field.dataType.typeName() in ("double", "float"):
            value = value + F.lit(0).cast(field.dataType)
        elif field.dataType.typeName() == "timestamp":
            value = F.unix_micros(value)
        elif field.dataType.typeName() == "binary":
            value = F.hex(value)
        elif field.dataType.typeName() in ("array", "struct", "map", "variant"):
            value = F.to_json(value)
        text = value.cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    digest = F.unhex(F.md5(F.concat_ws("", *[encoded(f) for f in df.schema.fields])))
    return df.groupBy(digest.alias("digest")).agg(F.count("*").alias("copies"), *aggregates)
