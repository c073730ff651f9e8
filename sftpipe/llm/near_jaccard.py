"""Near copies by the Jaccard similarity of five-word shingles, at least 0.8.

The similarity of two texts is taken of their sets of word shingles, as 64-bit hashes; a
text with fewer words is one shingle. Three steps find all pairs that reach it:

1. A set is sketched by its lowest ``KEYS`` hashes. Sets of less than 0.8 ``KEYS`` hashes are
   whole in the sketch, and so is any set similar to them: all but a fifth of the smaller one
   is common. The sketches of larger similar sets have at least ``COMMON`` common hashes, but
   in one of 3 * 10^8 pairs at 0.8 and fewer above it. The hashes of a sketch are ordered by
   the number of sketches that hold them, rare ones first. Of two sketches of k hashes with c
   common ones, the first k - c + 1 of both have a hash in common, so only these are buckets.
   Passages that many unlike texts share come last and are no buckets for texts that are
   mostly their own; hashes of one sketch alone are no buckets at all.
2. In a bucket, SimHashes of 256 bits are compared, all pairs. At 0.8 they differ in 38 bits
   on average (48 for the smallest sets), with a deviation of 6; pairs within ``RADIUS``, 84,
   are linked. Components of these links are the groups in which similar pairs lie.
3. The sets are sent once to their group, and there compared exactly, in whole numbers.

With ``bits``, texts whose fingerprints of ``simhash_vp`` differ in at most so many bits lie in
one group as well, found by its trees over all texts. They take no part in the choice of hashes, so
what a sketch misses of the nearest copies is found there; whether they are similar is decided
by step 3 like for all others.

Buckets and groups too large for one comparison are compared tile by tile. Only a link from
each set to the smallest one of its local component leaves a task, so output is linear.
Equal sets are one point.

Defined cases: texts without words, null ones among them, are equal to each other and to
nothing else; texts of any length are read whole, one at a time; repeated rows are equal sets
and get equal groups; an empty table has no groups; keys are treated as in ``simhash_vp``;
only the key and text columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftpipe.llm import simhash_vp
from sftpipe.llm.common import filled, map_texts
from sftpipe.llm.components import components
from sftpipe.operators.joins import BROADCAST_ROWS, join_hot, with_keys, without_keys
from sftpipe.session import write_counted, write_stage

SHINGLE_WORDS = 5
#: The least similarity, as a fraction.
PART, WHOLE = 4, 5
SEED = 42
#: Hashes of a sketch, and how many of them similar sketches of that size have in common.
KEYS, COMMON = 128, 74
LANES = 4
RADIUS = 84
#: Sets in one tile of a bucket, and hashes in one tile of a group.
BUCKET_ROWS, GROUP_HASHES = 2048, 2 << 20
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)


def shingles(text: str) -> np.ndarray:
    """The distinct hashes of all word shingles, ascending."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    digest = xxhash.xxh64_intdigest
    spans = zip([0, *(ends[: n - 1] + 1).tolist()], ends[-n:].tolist())
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, n))


def simhash(hashes: np.ndarray) -> np.ndarray:
    """The SimHash of a set, as ``LANES`` numbers of 64 bits."""
    lanes = np.zeros(LANES, np.uint64)
    for lane in range(LANES):
        ones = np.zeros(64, np.int64)
        for at in range(0, len(hashes), 1 << 16):
            x = hashes[at : at + (1 << 16)] * np.uint64(_MIX[lane])
            x = (x ^ (x >> np.uint64(31))) * np.uint64(_MIX[(lane + 1) % len(_MIX)])
            x ^= x >> np.uint64(29)
            ones += np.unpackbits(x.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        lanes[lane] = np.packbits(2 * ones > len(hashes)).view(np.uint64)[0]
    return lanes


def _node(hashes: np.ndarray) -> int:
    """The name of a set: a digest, as a signed number."""
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).astype(np.int64))


def sketches(df: DataFrame, key: str, text: str, with_fp: bool = False) -> DataFrame:
    """``key``, ``node``, ``n``, ``sig`` and the ``low`` hashes of each row's set, and ``fp``, the
    fingerprint of its text, or null."""

    def rows(batches: Iterator[dict]) -> Iterator[list[tuple]]:
        for batch in batches:
            found = []
            for k, t in zip(batch["key"], batch["text"]):
                hashes = shingles(t)
                low = hashes[:KEYS].view(np.int64).tolist()
                fp = simhash_vp.signed_fingerprint(t) if with_fp else None
                found.append((k, _node(hashes), len(hashes), simhash(hashes).tobytes(), low, fp))
            yield found

    kind = df.schema[key].dataType.simpleString()
    read = df.select(df[key].alias("key"), filled(df[text]).alias("text"))
    return map_texts(read, f"key {kind}, node bigint, n int, sig binary, low array<bigint>, fp bigint", rows)


def prefix_size(n: Column) -> Column:
    """How many hashes of the sketch of a set of ``n`` meet one of every similar set."""
    whole = F.floor(n * (WHOLE - PART) / WHOLE) + 1
    return F.when(n * WHOLE < KEYS * PART, whole).otherwise(F.least(n, F.lit(KEYS)) - COMMON + 1).cast("int")


def bucket_entries(points: DataFrame, entries: int, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``leaf``, ``node`` and ``data``, the SimHash, of each bucket of the ``points`` (node, n,
    sig, low); ``entries`` is the number of their hashes.

    Hashes are counted before they are shuffled. One that many sketches hold meets its count by
    broadcast.
    """
    held = points.select(F.explode("low").alias("hash"), "node")
    counted = held.groupBy("hash").agg(F.count(F.lit(1)).alias("count")).filter("count > 1")
    sizes, shared = write_counted(counted, "shared-hashes")
    if shared <= broadcast_rows:
        met = held.join(F.broadcast(sizes), "hash")
    else:
        met = join_hot(held, sizes, "hash", "inner", entries, counts=sizes)
    # At most ``KEYS`` of a point.
    ranked = met.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("count", "hash"))).alias("shared"))
    own = points.select("node", "n", "sig", F.size("low").alias("k")).join(ranked, "node")
    taken = own.select("*", (prefix_size(F.col("n")) - F.col("k") + F.size("shared")).alias("taken"))
    first = F.slice("shared", F.lit(1), F.col("taken"))
    return taken.filter("taken > 0").select(F.explode(first["hash"]).alias("leaf"), "node", F.col("sig").alias("data"))


def sets(df: DataFrame, text: str) -> DataFrame:
    """``node`` and ``hashes`` of each row's set."""

    def rows(batches: Iterator[dict]) -> Iterator[list[tuple]]:
        for batch in batches:
            for t in batch["text"]:  # one at a time: a set may be larger than its text
                hashes = shingles(t)
                yield [(_node(hashes), hashes.tobytes())]

    return map_texts(df.select(filled(df[text]).alias("text")), "node bigint, hashes binary", rows)


def peeled(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> np.ndarray:
    """The first point of each point's component. ``near(i, rest)`` picks from the indices
    ``rest`` those linked to ``i``; a point that is reached is not looked at again."""
    root, rest = np.arange(n), np.arange(n)
    while len(rest):
        first, todo = rest[0], [rest[0]]
        rest = rest[1:]
        while todo and len(rest):
            found = near(todo.pop(), rest)
            if len(found):
                root[found] = first
                todo += found.tolist()
                rest = np.setdiff1d(rest, found, assume_unique=True)
    return root


def _near_bits(sigs: np.ndarray) -> Callable[[int, np.ndarray], np.ndarray]:
    return lambda i, rest: rest[np.bitwise_count(sigs[rest] ^ sigs[i]).sum(axis=1, dtype=np.int64) <= RADIUS]


def bucket_roots(sigs: list[bytes]) -> np.ndarray:
    points = np.frombuffer(b"".join(sigs), np.uint64).reshape(-1, LANES)
    return peeled(len(points), _near_bits(points))


def similar_roots(packed: list[bytes]) -> np.ndarray:
    """The first set of each one's component of exactly similar sets."""
    found = [np.frombuffer(p, np.uint64) for p in packed]
    sizes = np.array([len(f) for f in found])
    sigs = np.array([simhash(f) for f in found], np.uint64).reshape(-1, LANES)
    bits = _near_bits(sigs)

    def near(i: int, rest: np.ndarray) -> np.ndarray:
        small, large = np.minimum(sizes[rest], sizes[i]), np.maximum(sizes[rest], sizes[i])
        rest = bits(i, rest[WHOLE * small >= PART * large])
        own, passed = found[i], []
        for at in range(0, len(rest), 256):
            some = rest[at : at + 256]
            if not len(own):
                passed.append(some)
                continue
            values = np.concatenate([found[j] for j in some])
            met = own[np.minimum(np.searchsorted(own, values), len(own) - 1)] == values
            starts = np.cumsum(sizes[some]) - sizes[some]
            common = np.add.reduceat(met.astype(np.int64), starts)
            passed.append(some[WHOLE * common >= PART * (sizes[some] + len(own) - common)])
        return np.concatenate(passed) if passed else rest

    return peeled(len(found), near)


def _leaf_links(roots: Callable[[list[bytes]], np.ndarray]):
    """Links (a, b) within each leaf; batches of leaf, node and bytes are sorted by leaf."""

    def links(held: dict[int, bytes]) -> list[tuple[int, int]]:
        if len(held) < 2:
            return []
        nodes = sorted(held)
        return [(nodes[i], nodes[r]) for i, r in enumerate(roots([held[x] for x in nodes]).tolist()) if i != r]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaf, held = None, {}
        for batch in batches:
            found = []
            for at, node, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if at != leaf:
                    found += links(held)
                    leaf, held = at, {}
                held[node] = data
            yield _link_batch(found)
        yield _link_batch(links(held))

    return run


def _link_batch(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _tiled(entries: DataFrame, sizes: DataFrame, rows: int) -> DataFrame:
    """``leaf``, ``node`` and ``data``, with all pairs of tiles of the leaves in ``sizes``
    (leaf, tiles) as leaves of their own."""
    side = F.broadcast(sizes) if rows <= BROADCAST_ROWS else sizes
    own = F.pmod(F.xxhash64("node", F.lit("tile")), F.col("tiles")).cast("int")
    return (
        entries.join(side, "leaf", "left")
        .select("leaf", "node", "data", F.coalesce("tiles", F.lit(1)).alias("tiles"))
        .select("*", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
        .select(
            F.when(F.col("tiles") == 1, F.col("leaf"))
            .otherwise(F.xxhash64("leaf", F.lit("tiles"), F.least("own", "other"), F.greatest("own", "other")))
            .alias("leaf"),
            "node",
            "data",
        )
    )


def _links(entries: DataFrame, roots: Callable[[list[bytes]], np.ndarray]) -> DataFrame:
    # A number keeps leaves apart that are small in bytes: comparing them is what costs.
    tasks = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    leaves = entries.select("leaf", "node", "data").repartition(tasks, "leaf").sortWithinPartitions("leaf")
    return leaves.mapInArrow(_leaf_links(roots), "a bigint, b bigint")


def near_groups(
    df: DataFrame,
    key: str,
    text: str,
    bucket_rows: int = BUCKET_ROWS,
    group_hashes: int = GROUP_HASHES,
    broadcast_rows: int = BROADCAST_ROWS,
    bits: int | None = None,
) -> DataFrame:
    """Per row: ``key`` and ``component_id``, the smallest key reachable over pairs of texts
    whose similarity is 0.8 or more. ``bits`` adds pairs to compare, by fingerprints."""
    found = write_stage(sketches(df, key, text, bits is not None), "sketches")
    points, hashes = write_counted(
        found.groupBy("node").agg(
            F.min("key").alias("first"), *[F.any_value(c).alias(c) for c in ("n", "sig", "low")]
        ),
        "sets",
        F.sum(F.size("low")),
    )
    entries = write_stage(bucket_entries(points, hashes, broadcast_rows), "buckets")
    sizes = entries.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"))
    large, rows = write_counted(
        sizes.filter(F.col("n") > bucket_rows).select("leaf", F.ceil(F.col("n") / bucket_rows).cast("int").alias("tiles")),
        "large-buckets",
    )
    links = _links(_tiled(entries, large, rows) if rows else entries, bucket_roots)
    if bits is not None:
        # Sets are the keys here, so that rows without a key or with a repeated one link as texts.
        by_bits = simhash_vp.fingerprint_groups(found.select(F.col("node").alias("key"), "fp"), bits)
        links = links.unionByName(by_bits.select(F.col("key").alias("a"), F.col("component_id").alias("b")))
    groups = components(links)
    members = write_stage(groups.join(points, "node").select(F.col("label").alias("leaf"), "node", "first", "n"), "members")
    tiles, rows = write_counted(
        members.groupBy("leaf").agg(F.sum("n").alias("n")).filter(F.col("n") > group_hashes)
        .select("leaf", F.ceil(F.col("n") / group_hashes).cast("int").alias("tiles")),
        "large-groups",
    )
    wanted, count = write_counted(members.filter("first IS NOT NULL").select(F.col("first").alias(key)).distinct(), "wanted")
    read = df.select(key, text)
    texts = with_keys(read, wanted, key, count, broadcast_rows).unionByName(read.filter(F.col(key).isNull()))
    packed = write_stage(
        sets(texts, text).join(members.select("leaf", "node"), "node").dropDuplicates(["node"])
        .select("leaf", "node", F.col("hashes").alias("data")),
        "members-sets",
    )
    labels = components(_links(_tiled(packed, tiles, rows) if rows else packed, similar_roots))
    classes = points.join(labels, "node", "left").select("node", "first", F.coalesce("label", "node").alias("label"))
    least = classes.groupBy("label").agg(F.min("first").alias("component_id"))
    named = classes.join(least, "label").select("node", "component_id")
    return found.join(named, "node").select(F.col("key").alias(key), "component_id")


def near_dedup(df: DataFrame, key: str, text: str, bits: int | None = None) -> DataFrame:
    """``df`` with one row of each group, the one with the smallest key.

    A row without a key stays, as no key names it; a repeated key stays or goes with all
    its rows.
    """
    gone, rows = write_counted(
        near_groups(df, key, text, bits=bits)
        .groupBy(key)
        .agg(F.max(F.col(key) == F.col("component_id")).alias("stays"))
        .filter("NOT stays")
        .select(key),
        "near-gone",
    )
    return without_keys(df, gone, key, rows)
