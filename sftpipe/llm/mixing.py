"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Each source gets a target in words. Its documents are cut into blocks by a hash, which is a
random order, so a prefix of blocks is a random draw without replacement; a target above
the source's size takes all blocks once and then a prefix again. Where the target falls
inside a block, that block's documents are taken in hash order up to the exact word, so the
words taken equal the rounded target.

The output has a number of shards. The blocks to draw form one urn with an exact quota per
source. A tree splits the shards in halves and draws how many blocks of each source go to
the left half, multivariate-hypergeometrically, down to single shards: every shard is a
random draw from the whole mix and all have the same number of blocks, give or take one.
Each source's blocks are permuted and every shard takes its own range of places, so the
draws are disjoint. Within a shard rows are ordered by another hash. No step sorts all rows.

The sources are those of a mixture, a table of weights: it is counted first, and more than
``MAX_SOURCES`` are refused. The driver holds one row per source and at most ``MOST_QUOTAS``
quotas per source and shard. Shards have about ``SHARD_WORDS`` words and are at most
``MOST_SHARDS``, blocks at most ``MAX_BLOCKS`` per source; beyond that both get larger.

Defined cases: a null text has no words and is drawn with no words; a null source is a
source of its own and comes last; a null key is allowed; repeated rows are rows like any
other; sizes of 0 in all of a source give it the target 0; only the key, text and source
columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sftpipe.llm.common import WORD, count_at_most, filled, fresh_name
from sftpipe.session import write_stage

WEIGHTS = (5.0, 2.0, 1.0)
TOTAL_SHARE = 1.5
MAX_REPEATS = 2
BLOCK_WORDS = 100_000
MAX_BLOCKS = 65_536
MAX_SOURCES = 100_000
#: Words in a shard; beyond the bounds shards get larger, and the driver's table does not.
SHARD_WORDS = 1_000_000
LEAST_SHARDS, MOST_SHARDS, MOST_QUOTAS = 16, 65_536, 4_000_000
SEED = 7


def word_count(text: str | Column) -> Column:
    return F.regexp_count(filled(text), F.lit(WORD)).cast("long")


def capped_targets(
    sizes: Sequence[int], weights: Sequence[float], total: float, repeats: float = MAX_REPEATS
) -> list[float]:
    """Targets that share ``total`` by weight, none above ``repeats`` times its size.

    What a capped source cannot take is shared again by weight among the others, until no
    target is above its cap.
    """
    targets, capped = [0.0] * len(sizes), set()
    while len(capped) < len(sizes):
        rest = total - sum(repeats * sizes[i] for i in capped)
        weight = sum(w for i, w in enumerate(weights) if i not in capped)
        over = set()
        for i, w in enumerate(weights):
            if i not in capped:
                targets[i] = rest * w / weight
                if targets[i] > repeats * sizes[i]:
                    over.add(i)
        if not over:
            break
        for i in over:
            targets[i] = float(repeats * sizes[i])
        capped |= over
    return targets


def split_quotas(quotas: Sequence[int], shards: int, seed: int = SEED) -> np.ndarray:
    """How many blocks of each source every shard gets: an array (shards, sources).

    Columns sum to the quotas; rows sum to the same number, give or take one.
    """
    draw = np.random.default_rng(seed)
    out = np.zeros((shards, len(quotas)), np.int64)

    def hypergeometric(urn: np.ndarray, n: int) -> np.ndarray:
        taken, rest = np.zeros_like(urn), int(urn.sum())
        for i, balls in enumerate(urn.tolist()):
            rest -= balls
            if n and balls:
                taken[i] = _draws(draw, balls, rest, n)
                n -= int(taken[i])
        return taken

    def split(first: int, last: int, urn: np.ndarray) -> None:
        if last - first == 1:
            out[first] = urn
            return
        middle = (first + last) // 2
        left = hypergeometric(urn, int(urn.sum()) * (middle - first) // (last - first))
        split(first, middle, left)
        split(middle, last, urn - left)

    if len(quotas):
        split(0, shards, np.asarray(quotas, np.int64))
    return out


def _draws(draw: np.random.Generator, good: int, bad: int, n: int) -> int:
    # Block counts are bounded by MAX_BLOCKS a source, far below the generator's limit.
    return int(draw.hypergeometric(good, bad, n)) if bad else n


@dataclass
class Mix:
    """``plan``: key, source, size, source_size, target, taken, and ``draws``, an array of
    (shard, place, words), one per copy in the mix."""

    plan: DataFrame
    targets: dict


def mix(
    df: DataFrame,
    key: str,
    text: str,
    source: str,
    weights: Sequence[float] = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    shards: int | None = None,
    block_words: int = BLOCK_WORDS,
    seed: int = SEED,
) -> Mix:
    """The mix of all rows. ``weights`` repeat over the sources in code point order."""
    spark = df.sparkSession
    docs = write_stage(
        df.select(
            df[key].alias("key"),
            df[source].cast("string").alias("source"),
            word_count(df[text]).alias("size"),
            F.xxhash64(F.lit(seed), df[key], df[text]).alias("place"),
        ),
        "mix-sizes",
    )
    by_source = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    found = by_source.limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"a mix of more than {MAX_SOURCES} sources")
    # UTF-8 sorts as its code points do.
    found.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sizes = [r["source_size"] for r in found]
    targets = capped_targets(
        sizes, [weights[i % len(weights)] for i in range(len(found))], total_share * sum(sizes)
    )

    if shards is None:
        wanted = min(max(round(sum(targets)) // SHARD_WORDS, LEAST_SHARDS), MOST_SHARDS)
        shards = max(1, min(wanted, MOST_QUOTAS // max(len(found), 1)))
    rows = []
    for number, (r, target) in enumerate(zip(found, targets)):
        words, size = round(target), r["source_size"]
        full = min(words // size, MAX_REPEATS) if size else 0
        blocks = min(max(math.ceil(size / block_words), 1), MAX_BLOCKS)
        rows.append((number, r["source"], size, float(target), full, words - full * size, blocks))
    sources = spark.createDataFrame(
        rows, "number int, source string, source_size bigint, target double, full int, rest bigint, blocks int"
    )

    # The high 31 bits of the hash deal the documents to equal ranges of it.
    block = F.floor(F.shiftrightunsigned("place", 33) * F.col("blocks") / F.lit(float(1 << 31))).cast("int")
    placed = docs.join(F.broadcast(sources), docs["source"].eqNullSafe(sources["source"])).select(
        "key", docs["source"], "size", "place", "number", "source_size", "target", "full", "rest", "blocks",
        block.alias("block"),
    )
    in_order = Window.partitionBy("number").orderBy("block")
    sums = (
        placed.groupBy("number", "rest", "block")
        .agg(F.sum("size").alias("words"))
        .withColumn("before", F.sum("words").over(in_order) - F.col("words"))
    )
    # The block in which the rest of the target ends; a rest of 0 ends before all blocks.
    cut = {
        r["number"]: (r["block"], r["before"])
        for r in sums.filter("before < rest AND before + words >= rest").collect()
    }

    quotas = [full * blocks + (cut[n][0] + 1 if n in cut else 0) for n, _, _, _, full, _, blocks in rows]
    bounds = np.cumsum(split_quotas(quotas, shards, seed), axis=0)
    plan_rows = []
    for n, quota in enumerate(quotas):
        step = _coprime(quota, seed + n)
        plan_rows.append((n, *cut.get(n, (-1, 0)), max(quota, 1), step, bounds[:, n].tolist()))
    quota_table = spark.createDataFrame(
        plan_rows, "number int, cut int, before bigint, quota bigint, step bigint, bounds array<bigint>"
    )

    def shard(epoch: int) -> Column:
        """The shard whose range has the place of this block's copy among the source's permuted draws."""
        slot = F.pmod((F.lit(epoch) * F.col("blocks") + F.col("block")) * F.col("step"), F.col("quota"))
        return count_at_most(F.col("bounds"), shards, slot).alias(f"shard_{epoch}")

    joined = placed.join(F.broadcast(quota_table), "number").select(
        *placed.columns, "cut", "before", *[shard(e) for e in range(MAX_REPEATS)]
    )
    inside = joined.filter(F.col("block") == F.col("cut"))
    ordered = Window.partitionBy("number").orderBy("place", "key", "size").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.col("before") + F.coalesce(F.sum("size").over(ordered), F.lit(0))
    partial = F.greatest(F.least(F.col("rest") - earlier, F.col("size")), F.lit(0))
    outside = joined.filter(F.col("block") != F.col("cut"))
    whole = F.when(F.col("block") < F.col("cut"), F.col("size"))
    counted = outside.withColumn("last", whole).unionByName(inside.withColumn("last", partial))

    def drawn(epoch: int, words: Column) -> Column:
        return F.struct(
            F.col(f"shard_{epoch}").alias("shard"),
            F.xxhash64("place", F.lit(seed), F.lit(epoch)).alias("place"),
            words.alias("words"),
        )

    copies = F.array(
        *[F.when(F.col("full") > e, drawn(e, F.col("size"))) for e in range(MAX_REPEATS)],
        *[
            F.when((F.col("full") == e) & (F.col("last") > 0), drawn(e, F.col("last")))
            for e in range(MAX_REPEATS)
        ],
    )
    plan = counted.withColumn("draws", F.filter(copies, lambda c: c.isNotNull())).select(
        F.col("key").alias(key),
        F.col("source").alias(source),
        "size",
        "source_size",
        "target",
        F.aggregate("draws", F.lit(0).cast("long"), lambda total, d: total + d["words"]).alias("taken"),
        "draws",
    )
    return Mix(plan, {r["source"]: t for r, t in zip(found, targets)})


def _coprime(n: int, seed: int) -> int:
    """A number by which the places 0 to n - 1 are permuted."""
    draw = np.random.default_rng(seed)
    while n > 2:
        step = int(draw.integers(1, n))
        if math.gcd(step, n) == 1:
            return step
    return 1


def mixed_rows(df: DataFrame, key: str, text: str, source: str, **options) -> DataFrame:
    """The rows of the mix with the columns of ``df``, shard by shard in shuffled order.

    A row that is taken twice comes twice. Of the one row per source at which its target
    ends, only the words taken are left. Rows are found again by key and size; where several
    rows share both, they are numbered first.
    """
    own, draw, size, number = (fresh_name(df, c) for c in ("draw_key", "draw", "draw_size", "draw_number"))
    met_size, met_number = (fresh_name(df, c) for c in ("drawn_size", "drawn_number"))
    plan = write_stage(
        mix(df, key, text, source, **options).plan.select(
            F.col(f"`{key}`").alias(own), F.col("size").alias(met_size), F.col("draws").alias(draw)
        ),
        "mix-plan",
    )
    repeated = not plan.groupBy(own, met_size).count().filter("count > 1").isEmpty()
    plan = plan.withColumn(met_number, _number([own, met_size], draw) if repeated else F.lit(1))
    keyed = df.withColumn(size, word_count(df[text]))
    keyed = keyed.withColumn(number, _number([key, size], key) if repeated else F.lit(1))
    met = keyed.join(
        plan.filter(F.size(draw) > 0).hint("shuffle_hash"),
        F.col(f"`{key}`").eqNullSafe(F.col(own))
        & (F.col(size) == F.col(met_size))
        & (F.col(number) == F.col(met_number)),
    ).withColumn(draw, F.explode(draw))
    words = F.regexp_extract_all(filled(text), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    taken = F.array_join(F.slice(words, F.lit(1), F.col(f"{draw}.words").cast("int")), "")
    return (
        met.withColumn(text, F.when(F.col(f"{draw}.words") < F.col(size), taken).otherwise(F.col(text)))
        .repartition(F.col(f"{draw}.shard"))
        .sortWithinPartitions(f"{draw}.shard", f"{draw}.place")
        .select(*(f"`{c}`" for c in df.columns))
    )


def _number(keys: list[str], order: str) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(order))
