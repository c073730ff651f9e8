"""De-identification: personal identifiers in text columns become keyed pseudonyms.

The same identifier has the same pseudonym in all rows, columns and spellings under one
secret, so mentions can still be joined and counted; without the secret a pseudonym cannot be
computed from a guess. A text is read once, in column expressions: nothing is shuffled, and a
row depends on itself alone. Null stays null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftpipe.functions.identifiers import KINDS, pieces, pseudonym


def _replaced(found: Column, secret: bytes) -> Column:
    """(kind, pseudonym, value): the value of a piece, or what stands in its place."""

    def one(piece: Column) -> Column:
        name = F.when(piece["kind"].isNotNull(), pseudonym(piece["value"], piece["kind"], secret))
        return F.struct(piece["kind"].alias("kind"), name.alias("pseudonym"), piece["value"].alias("value"))

    def written(piece: Column) -> Column:
        mark = F.concat(F.lit("["), piece["kind"], F.lit(":"), piece["pseudonym"], F.lit("]"))
        return F.struct(piece["kind"].alias("kind"), piece["pseudonym"].alias("pseudonym"), F.coalesce(mark, piece["value"]).alias("value"))

    return F.transform(F.transform(found, one), written)


def identifiers(df: DataFrame, key: str, columns: Sequence[str], secret: bytes, kinds: Sequence[str] = KINDS) -> DataFrame:
    """One row per mention: ``key``, ``column``, ``kind``, ``pseudonym`` and ``place``, its number
    in the text. No raw value is returned."""

    def named(column: str) -> Column:
        found = F.filter(_replaced(pieces(F.col(column), kinds), secret), lambda p: p["kind"].isNotNull())
        placed = F.transform(found, lambda p, i: F.struct(
            F.lit(column).alias("column"), p["kind"].alias("kind"), p["pseudonym"].alias("pseudonym"), i.alias("place")
        ))
        return F.coalesce(placed, F.array())

    return df.select(key, F.inline(F.concat(*map(named, columns))))


def mentions(found: DataFrame) -> DataFrame:
    """How often each pseudonym in ``identifiers`` is mentioned; counted before the shuffle, so a
    number on every page costs no more than others."""
    return found.groupBy("kind", "pseudonym").agg(F.count(F.lit(1)).alias("mentions"))


def deidentify(
    df: DataFrame,
    columns: Sequence[str],
    secret: bytes,
    kinds: Sequence[str] = KINDS,
    counts: str | None = None,
) -> DataFrame:
    """``df`` with the identifiers in ``columns`` replaced by ``[kind:pseudonym]``.

    ``counts`` names a column to add: a map from kind to how many were replaced in the row.
    """
    taken = {c.lower() for c in df.columns}
    held = {name: _fresh(taken, f"_pieces_{i}") for i, name in enumerate(columns)}
    split = df.select("*", *[_replaced(pieces(F.col(c), kinds), secret).alias(h) for c, h in held.items()])
    own = [
        F.array_join(F.col(held[c])["value"], "").alias(c) if c in held else F.col(f"`{c}`") for c in df.columns
    ]
    if counts is None:
        return split.select(*own)
    every = F.concat(*[F.coalesce(F.col(h)["kind"], F.array().cast("array<string>")) for h in held.values()])
    size = lambda kind: F.size(F.filter(every, lambda k: k == kind))
    tally = F.map_from_arrays(F.array(*map(F.lit, kinds)), F.array(*map(size, kinds)))
    return split.select(*own, tally.alias(counts))


def _fresh(taken: set[str], name: str) -> str:
    while name in taken:
        name = f"_{name}"
    return name
