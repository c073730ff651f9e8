"""Near duplicates by SimHash, joined exactly with vantage-point trees.

Fingerprints are points under the Hamming distance. Over all 64 bits such a tree prunes
little: most distances to a vantage point are close to 32, so a search ball of radius 4
meets most shells. The bits are therefore dealt to ``trees`` groups, each with a tree over
the Hamming distance within its group. Two fingerprints within ``threshold`` differ in at
most ``threshold // trees`` bits of some group, so that is the radius there; with one tree
more than the threshold it is 0.

A tree's levels are vantage points; a fingerprint goes down the shell of its distance to
each. By the triangle inequality a point within radius r of it lies at a distance that
differs by at most r, so all other shells are pruned, and the fingerprint is also sent to
the shells that its ball overlaps. The path is the shard. Shards with more than
``leaf_rows`` fingerprints get trees over the other bits, and what is still larger is
compared tile by tile. In a shard every pair is compared exactly, and only a link from each
fingerprint to the smallest one of its local component leaves it, so output is linear.
Equal fingerprints are one point.

Defined cases: a null text is an empty one, with fingerprint zero, which links like any
other; a null key counts for no component id, so a component without keys has none; repeated
rows are one component; only the key and text columns are read.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftpipe.llm.common import filled, map_texts
from sftpipe.llm.components import components
from sftpipe.operators.joins import BROADCAST_ROWS, without_keys
from sftpipe.session import write_counted, write_stage

THRESHOLD = 4
SHINGLE_WORDS = 4
SEED = 42
BITS = 64
LEAF_ROWS = 2048
#: Vantage points of a tree with radius 0, and of one with a wider ball, whose
#: fingerprints may go to two shells on each level.
LEVELS, BALL_LEVELS = 8, 5


def fingerprint(text: str) -> int:
    """The SimHash of all word shingles, repeats included, as an unsigned number."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[-n:].tolist()
    digest = xxhash.xxh64_digest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[at : at + (1 << 16)], stops[at : at + (1 << 16)])])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def signed_fingerprint(text: str) -> int:
    """The fingerprint as a signed long."""
    return _signed(fingerprint(text))


def fingerprints(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key`` and ``fp``, the fingerprint as a signed long."""

    def rows(batches: Iterator[dict]) -> Iterator[list[tuple]]:
        for batch in batches:
            yield [(k, signed_fingerprint(t)) for k, t in zip(batch["key"], batch["text"])]

    kind = df.schema[key].dataType.simpleString()
    read = df.select(df[key].alias("key"), filled(df[text]).alias("text"))
    return map_texts(read, f"key {kind}, fp bigint", rows)


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def bit_groups(bits: list[int], groups: int) -> list[list[int]]:
    """The bits dealt to the groups in turn."""
    return [bits[g::groups] for g in range(groups)]


def _mask(bits: list[int]) -> int:
    return reduce(lambda mask, bit: mask | 1 << bit, bits, 0)


def _paths(bits: list[int], radius: int, seed: str) -> Column:
    """The shards of one tree that the ball around ``fp`` meets, its own among them."""
    draw = random.Random(seed)
    mask, width = _mask(bits), 2 * radius + 1
    levels = min(LEVELS if radius == 0 else BALL_LEVELS, len(bits))
    paths = F.array(F.lit(0).cast("long"))
    for _ in range(levels):
        vantage = draw.getrandbits(BITS) & mask
        distance = F.bit_count((F.col("fp").bitwiseXOR(F.lit(_signed(vantage)))).bitwiseAND(F.lit(_signed(mask))))
        if radius == 0:
            shells = F.array(distance)
        else:
            inner = F.floor(F.greatest(distance - radius, F.lit(0)) / width).cast("int")
            outer = F.floor(F.least(distance + radius, F.lit(len(bits))) / width).cast("int")
            shells = F.sequence(inner, outer)
        paths = F.flatten(
            F.transform(paths, lambda p: F.transform(shells, lambda s: F.shiftleft(p, 7) + s))
        )
    return paths


def _own_path(bits: list[int], seed: str) -> Column:
    """As ``_paths`` for radius 0: the one shard, without arrays."""
    draw = random.Random(seed)
    mask = _mask(bits)
    path = F.lit(0).cast("long")
    for _ in range(min(LEVELS, len(bits))):
        vantage = draw.getrandbits(BITS) & mask
        distance = F.bit_count((F.col("fp").bitwiseXOR(F.lit(_signed(vantage)))).bitwiseAND(F.lit(_signed(mask))))
        path = F.shiftleft(path, 7) + distance
    return path


def _shards(groups: list[list[int]], radius: int, seed: str) -> Column:
    """Shard ids of ``fp`` in all trees."""
    if radius == 0:
        return F.array(*[
            F.xxhash64(F.lit(f"{seed}.{g}"), _own_path(bits, f"{seed}.{g}")) for g, bits in enumerate(groups)
        ])
    return F.concat(*[
        F.transform(_paths(bits, radius, f"{seed}.{g}"), lambda p, g=g: F.xxhash64(F.lit(f"{seed}.{g}"), p))
        for g, bits in enumerate(groups)
    ])


def local_components(points: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the points that have a link, and of the smallest point of each one's
    component. ``points`` are sorted, distinct and unsigned."""
    n = len(points)
    near = np.empty((n, n), bool)
    for at in range(0, n, 512):
        near[at : at + 512] = np.bitwise_count(points[at : at + 512, None] ^ points[None, :]) <= threshold
    linked = np.flatnonzero(near.sum(axis=1) > 1)
    if not len(linked):
        return linked, linked
    near = near[np.ix_(linked, linked)]
    labels = np.arange(len(linked))
    while True:
        least = np.empty_like(labels)
        for at in range(0, len(labels), 512):
            least[at : at + 512] = np.where(near[at : at + 512], labels[None, :], len(labels)).min(axis=1)
        least = least[least]
        if (least == labels).all():
            return linked, linked[labels]
        labels = least


def _leaf_links(threshold: int):
    """Links within each leaf; batches are sorted by leaf and hold its fingerprints."""

    def links(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        points = np.unique(points).view(np.uint64)
        at, root = local_components(points, threshold)
        other = at != root
        return points[at[other]].view(np.int64), points[root[other]].view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaf, held = None, []

        def flush(found: list) -> None:
            if leaf is not None:
                points = np.concatenate(held)
                if len(points) > 1:
                    found.append(links(points))

        for batch in batches:
            found: list = []
            leaves, fps = (batch.column(i).to_numpy() for i in (0, 1))
            starts = [0, *(np.flatnonzero(leaves[1:] != leaves[:-1]) + 1).tolist(), len(leaves)]
            for a, b in zip(starts, starts[1:]):
                if a == b:
                    continue
                if leaves[a] != leaf:
                    flush(found)
                    leaf, held = leaves[a], []
                held.append(fps[a:b])
            yield from _link_batch(found)
        found = []
        flush(found)
        yield from _link_batch(found)

    return run


def _link_batch(found: list) -> Iterator[pa.RecordBatch]:
    if found:
        a, b = (np.concatenate(x) for x in zip(*found))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _sized(entries: DataFrame, leaf_rows: int, name: str) -> tuple[DataFrame, int]:
    """Leaves with more than ``leaf_rows`` entries, and how many there are."""
    return write_counted(
        entries.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > leaf_rows), name
    )


def _split(entries: DataFrame, large: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """Entries of other leaves, and those of the large ones with the leaf's size ``n``."""
    side = F.broadcast(large) if rows <= BROADCAST_ROWS else large
    return entries.join(side, "leaf", "left_anti"), entries.join(side, "leaf")


def links(
    points: DataFrame,
    threshold: int = THRESHOLD,
    trees: int | None = None,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """Links (a, b) that connect all fingerprints ``fp`` within ``threshold`` of each other.

    ``points`` are distinct. Every link is within the threshold or joins the ends of a
    chain of such within one shard; every pair within it has a chain. A leaf too large for
    one comparison, if it has radius 0, gets trees over the bits outside its group: the
    pair's bits in the group are equal, so all differing ones are among the others.
    """
    trees = trees or threshold + 1
    groups, radius = bit_groups(list(range(BITS)), trees), threshold // trees
    if radius == 0:
        tagged = F.posexplode(_shards(groups, 0, "1")).alias("tree", "leaf")
        entries = points.select("fp", tagged)
    else:
        entries = points.select("fp", F.lit(-1).alias("tree"), F.explode(_shards(groups, radius, "1")).alias("leaf"))
    large, rows = _sized(entries, leaf_rows, "large-leaves")
    if rows:
        small, crowded = _split(entries, large, rows)
        if radius == 0:
            nested = reduce(
                lambda rest, g: F.when(F.col("tree") == g[0], g[1]).otherwise(rest),
                [
                    (g, _shards(bit_groups([b for b in range(BITS) if b not in set(bits)], threshold + 1), 0, f"2.{g}"))
                    for g, bits in enumerate(groups)
                ],
                F.array().cast("array<bigint>"),
            )
            crowded = crowded.select("fp", F.col("leaf").alias("outer"), F.explode(nested).alias("leaf")).select(
                "fp", F.xxhash64("outer", "leaf").alias("leaf")
            )
            larger, larger_rows = _sized(crowded, leaf_rows, "larger-leaves")
            if larger_rows:
                middle, crowded = _split(crowded, larger, larger_rows)
                small = small.select("fp", "leaf").unionByName(middle)
            else:
                small, crowded = small.select("fp", "leaf").unionByName(crowded), None
        if crowded is not None:
            small = small.select("fp", "leaf").unionByName(_tiled(crowded, leaf_rows))
        entries = small
    leaves = entries.select("leaf", "fp").repartition("leaf").sortWithinPartitions("leaf")
    return leaves.mapInArrow(_leaf_links(threshold), "a bigint, b bigint")


def _tiled(crowded: DataFrame, leaf_rows: int) -> DataFrame:
    """Entries for all pairs of tiles of each leaf; a tile has about ``leaf_rows``."""
    tiles = F.ceil(F.col("n") / leaf_rows).cast("int")
    return (
        crowded.select("fp", "leaf", tiles.alias("tiles"))
        .withColumn("own", F.pmod(F.xxhash64("fp", F.lit("tile")), F.col("tiles")).cast("int"))
        .select("fp", "leaf", "own", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
        .select(
            "fp",
            F.xxhash64("leaf", F.lit("tiles"), F.least("own", "other"), F.greatest("own", "other")).alias("leaf"),
        )
    )


def near_groups(
    df: DataFrame,
    key: str,
    text: str,
    threshold: int = THRESHOLD,
    trees: int | None = None,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """Per row: ``key``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest
    key reachable over links of fingerprints that differ in at most ``threshold`` bits."""
    return fingerprint_groups(
        write_stage(fingerprints(df, key, text), "fingerprints"), threshold, trees, leaf_rows
    ).withColumnRenamed("key", key)


def fingerprint_groups(
    found: DataFrame, threshold: int = THRESHOLD, trees: int | None = None, leaf_rows: int = LEAF_ROWS
) -> DataFrame:
    """``near_groups`` of written rows of ``key`` and ``fp``."""
    points = write_stage(found.groupBy("fp").agg(F.min("key").alias("first")), "points")
    labels = components(links(points.select("fp"), threshold, trees, leaf_rows))
    classes = points.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("label", "fp").alias("label")
    )
    least = classes.groupBy("label").agg(F.min("first").alias("component_id"))
    named = classes.join(least, "label").select("fp", "component_id")
    return found.join(named, "fp").select(
        "key",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def near_dedup(df: DataFrame, key: str, text: str, threshold: int = THRESHOLD) -> DataFrame:
    """``df`` with one row of each group, the one with the smallest key.

    A row without a key stays, as no key names it; a repeated key stays or goes with all
    its rows.
    """
    groups = near_groups(df, key, text, threshold)
    gone, rows = write_counted(
        groups.groupBy(key)
        .agg(F.max(F.col(key) == F.col("component_id")).alias("stays"))
        .filter("NOT stays")
        .select(key),
        "near-gone",
    )
    return without_keys(df, gone, key, rows)
