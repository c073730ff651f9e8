"""Exact deduplication by deterministic block naming.

A text is cut into fixed-size blocks of bytes. Sorting the distinct blocks gives each an
integer name. Neighbouring names are then paired, the distinct pairs are sorted and named
in turn, and so on until one name is left for each text. Two texts are equal if and only
if they end on the same level with the same name, because every step names different
things differently.

Blocks are sorted by a digest, so that a block's bytes move only where another block has
the same digest. There the bytes are compared, and if two different blocks share a digest
the naming is done again with the next digest: no decision rests on a digest alone.
Pairs are two integers and need none. Equal blocks and pairs are combined before each
shuffle, and all joins meet one row per name, so a text with a third of all copies costs no
task more than its share.

Everything is DataFrame functions. Defined cases: a null text equals an empty one; texts of
any length are read whole; a null key is smaller than any other; of rows with the same key
and text one is kept; only the key and text columns are read, so others cannot clash; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftpipe.llm.common import filled, fresh_name
from sftpipe.operators.joins import BROADCAST_ROWS, with_keys, without_keys
from sftpipe.session import write_counted, write_stage

BLOCK_BYTES = 4096
Digest = Callable[[Column], Column]
#: Tried in turn until no two different blocks of the input share a digest.
DIGESTS: tuple[Digest, ...] = (
    lambda block: F.unhex(F.md5(block)),
    lambda block: F.unhex(F.sha2(block, 256)),
)
#: Stands for the missing second name of a pair; names are not negative.
NOTHING = -1


def _blocks(of: Callable[[Column], Column], block_bytes: int) -> Column:
    """An array of ``of`` each block of the binary column ``bytes``; no bytes are one block."""
    last = F.greatest(F.octet_length("bytes") - 1, F.lit(0))
    starts = F.sequence(F.lit(0), F.floor(last / block_bytes).cast("int"))
    return F.transform(
        starts, lambda i: of(F.substring(F.col("bytes"), i * block_bytes + 1, F.lit(block_bytes)))
    )


def _digests_differ(texts: DataFrame, keyed: DataFrame, digest: Digest, block_bytes: int) -> bool:
    """Whether no two different blocks share a digest."""
    shared, rows = write_counted(
        keyed.select(F.explode("blocks").alias("digest"))
        .groupBy("digest")
        .count()
        .filter("count > 1")
        .select("digest"),
        "shared-digests",
    )
    if not rows:
        return True
    contents = texts.select(
        F.explode(_blocks(lambda b: F.struct(digest(b).alias("digest"), b.alias("block")), block_bytes)).alias("x")
    ).select("x.*")
    if rows <= BROADCAST_ROWS:
        distinct = with_keys(contents, shared, "digest", rows).distinct()
    else:
        distinct = with_keys(contents.distinct(), shared, "digest", rows)
    return distinct.groupBy("digest").count().filter("count > 1").isEmpty()


def _named(keys: DataFrame) -> DataFrame:
    """The distinct rows of ``keys`` in order, each with an integer name."""
    ordered = keys.distinct().orderBy(*keys.columns)
    return write_stage(ordered.withColumn("name", F.monotonically_increasing_id()), "names")


def block_names(
    df: DataFrame,
    key: str,
    text: str,
    block_bytes: int = BLOCK_BYTES,
    digests: Sequence[Digest] = DIGESTS,
) -> DataFrame:
    """``key``, ``row``, ``sha256`` and the identity (``level``, ``name``) of every text.

    ``row`` numbers the rows, as keys may repeat. Equal texts have equal identities,
    different texts different ones.
    """
    texts = df.select(df[key].alias("key"), filled(df[text]).alias("text")).select(
        "key", "text", F.col("text").cast("binary").alias("bytes")
    )
    for digest in digests:
        keyed, blocks = write_counted(
            texts.select(
                "key",
                F.monotonically_increasing_id().alias("row"),
                F.unhex(F.sha2("text", 256)).alias("sha256"),
                _blocks(digest, block_bytes).alias("blocks"),
            ),
            "blocks",
            F.max(F.size("blocks")),
        )
        if _digests_differ(texts, keyed, digest, block_bytes):
            break
    else:
        raise ValueError("different blocks share every digest")

    entries = keyed.select("row", F.size("blocks").alias("size"), F.posexplode("blocks").alias("pos", "digest"))
    names = _named(entries.select("digest"))
    state = entries.join(names, "digest").select("row", "size", "pos", "name")
    level, done = 0, []
    while True:
        done.append(state.filter(F.col("size") <= 1 << level).select("row", F.lit(level).alias("level"), "name"))
        if blocks <= 1 << level:
            break
        pairs = write_stage(
            state.filter(F.col("size") > 1 << level)
            .groupBy("row", "size", F.shiftright("pos", 1).alias("half"))
            .agg(
                F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("first"),
                F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(NOTHING)).alias("second"),
            ),
            "pairs",
        )
        names = _named(pairs.select("first", "second"))
        state = pairs.join(names, ["first", "second"]).select("row", "size", F.col("half").alias("pos"), "name")
        level += 1
    identity = done[0]
    for part in done[1:]:
        identity = identity.unionByName(part)
    return keyed.drop("blocks").join(identity, "row").withColumnRenamed("key", key)


def exact_groups(
    df: DataFrame,
    key: str,
    text: str,
    block_bytes: int = BLOCK_BYTES,
    digests: Sequence[Digest] = DIGESTS,
) -> DataFrame:
    """Per row: ``key``, ``keep_id`` (largest key of the equal texts), ``group_size``,
    ``kept`` (true for one row of each group) and ``text_sha256``."""
    named = write_stage(
        block_names(df.select(df[key].alias("key"), df[text].alias("text")), "key", "text", block_bytes, digests),
        "identities",
    )
    # Written, so that the join below reads both sides from a shuffle of its own and a large
    # group can be split between tasks.
    groups = write_stage(
        named.groupBy("level", "name").agg(
            F.max("key").alias("keep_id"),
            F.count(F.lit(1)).alias("group_size"),
            F.coalesce(F.max_by("row", "key"), F.max("row")).alias("keep_row"),
        ),
        "groups",
    )
    return named.join(groups, ["level", "name"]).select(
        F.col("key").alias(key),
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("sha256")).alias("text_sha256"),
    )


def exact_dedup(df: DataFrame, key: str, text: str) -> DataFrame:
    """The rows of ``df`` that stay: of equal texts the one with the largest key.

    Rows are found again by key and text digest, so a key may repeat.
    """
    row = fresh_name(df, "row_key")

    def row_key(key_column: Column, sha: Column) -> Column:
        return F.concat_ws(":", F.coalesce(key_column.cast("string"), F.lit("")), key_column.isNull(), sha)

    groups = exact_groups(df, key, text)
    marks = write_stage(
        groups.groupBy(row_key(groups[key], groups["text_sha256"]).alias(row)).agg(
            F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows")
        ),
        "kept-rows",
    )
    counted = marks.agg(
        F.count_if(~F.col("kept")).alias("gone"), F.count_if(F.col("kept") & (F.col("rows") > 1)).alias("twice")
    ).first()
    keyed = df.withColumn(row, row_key(df[key], F.sha2(filled(df[text]), 256)))
    left = without_keys(keyed, marks.filter(~F.col("kept")).select(row), row, counted["gone"])
    if counted["twice"]:
        twice = marks.filter(F.col("kept") & (F.col("rows") > 1)).select(row)
        once = without_keys(left, twice, row, counted["twice"])
        left = once.unionByName(with_keys(left, twice, row, counted["twice"]).dropDuplicates([row]))
    return left.select(*df.columns)
