"""Answers that do not belong to their question, by weighted overlap of character bigrams.

A bigram, or longer gram, weighs its inverse document frequency over the answers, and a pair's
score is the share of its question's weight that its answer holds. A long answer holds common
grams by chance, so a pair is judged by its excess: the score without what all answers of that
size, in powers of two, hold of the question on average. What an unrelated answer exceeds is
measured, not assumed: every question is also held against the answer of the row that follows
it in a seeded order of its group, and the ``quantile`` of these excesses is the bound, for each answer size
with enough pairs and for all others together. A pair below its bound is irrelevant; one whose
answer holds all of the question never is.

Weights and shares are whole millionths, so sums do not depend on their order. Texts, not their
grams, are kept and moved: the grams of an answer are several times its text, so they are taken
from its letters and digits wherever they are met or counted, and counted by task before they
move. Questions are spread over their grams once, for both answers; grams meet their weights by
broadcast, or by a shuffled join in which no gram is frequent. ``key`` is unique. A question
without letters or digits has no score and is not called irrelevant.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sftpipe.functions.text import once
from sftpipe.operators.joins import BROADCAST_ROWS, join_hot
from sftpipe.operators.split import SPLIT_SEED, numbered, shuffle_rank
from sftpipe.session import bound_batches, spread, write_counted, write_stage

UNIT = 1_000_000
#: Cells of a unit in the histogram of shuffled excesses: twice as many rows per size reach the
#: driver at most.
CELLS = 1000
#: Grams of answers that a task holds before it counts and sends them.
CHUNK_GRAMS = 8_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class RelevanceRule:
    """Characters of a gram (two for Han text, more for letters), ``quantile`` of the shuffled
    excesses, and pairs that an answer size needs for a bound of its own."""

    gram: int = 2
    quantile: float = 0.9
    min_pairs: int = 200
    seed: int = SPLIT_SEED


def plain(text: Column) -> Column:
    """The letters and digits of a text, in lower case."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", "")


def _distinct(codes: np.ndarray) -> np.ndarray:
    """The different values, ascending; several times faster than numpy's ``unique``."""
    codes = np.sort(codes)
    return codes[np.append(True, codes[1:] != codes[:-1])] if len(codes) else codes


@lru_cache(1024)
def _seed(of: str, size: int) -> np.uint64:
    return np.frombuffer(hashlib.blake2b(f"{size}:{of}".encode(), digest_size=8).digest(), np.uint64)[0]


def gram_codes(of: str, text: str, size: int = 2) -> np.ndarray:
    """The distinct hashed stretches of ``size`` characters, ascending; a shorter text is one."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    size = min(size, len(points))
    if not size:
        return np.zeros(0, np.int64)
    n = len(points) - size + 1
    codes = np.zeros(n, np.uint64)
    for at in range(size):
        codes *= _BASE
        codes += points[at : at + n]
    codes += _seed(of, size)
    return _distinct(codes.view(np.int64))


def _question_codes(size: int):
    @F.pandas_udf("array<bigint>")
    def codes(of: pd.Series, text: pd.Series) -> pd.Series:
        return pd.Series([gram_codes(o, t, size) for o, t in zip(of, text)], dtype=object)

    return once(codes)


def _met(size: int):
    """The size of an answer, as a power of two, and the question's grams that it holds."""

    @F.pandas_udf("band int, met array<bigint>")
    def met(q: pd.Series, of: pd.Series, answer: pd.Series) -> pd.DataFrame:
        bands, found = [], []
        for codes, o, a in zip(q, of, answer):
            if a is None:
                bands.append(None)
                found.append(None)
                continue
            held = gram_codes(o, a, size) if isinstance(a, str) else _distinct(np.asarray(a, np.int64))
            bands.append(_band(held))
            found.append(np.intersect1d(codes, held))
        return pd.DataFrame({"band": pd.array(bands, "Int32"), "met": pd.Series(found, dtype=object)})

    return once(met)


def pair_sets(df: DataFrame, key: str, question: str, answer: str, group: str | None = None, size: int = 2) -> DataFrame:
    """(key, of, q, a): the distinct hashed grams of the question, and the answer's letters and
    digits; ``of`` is the group that has its own weights, for example a language."""
    of = F.lit("") if group is None else F.coalesce(F.col(group).cast("string"), F.lit(""))
    read = df.select(
        F.col(key).alias("key"), of.alias("of"), plain(F.col(question)).alias("plain"), plain(F.col(answer)).alias("a")
    )
    return read.select("key", "of", _question_codes(size)("of", "plain").alias("q"), "a")


def _band(codes: np.ndarray) -> int:
    """The power of two of a set's size, -1 for none."""
    return len(codes).bit_length() - 1


def _count_grams(size: int, chunk: int = CHUNK_GRAMS):
    """(of, band, code, n) of batches of of and a, counted by ``chunk`` grams, with a null code for
    the answers themselves."""
    names, types = ("of", "band", "code", "n"), (pa.string(), pa.int32(), pa.int64(), pa.int64())

    def counted(held: dict[tuple[str, int], list[np.ndarray]]) -> pa.RecordBatch:
        groups, codes, counts = list(held), [], []
        for parts in held.values():
            every = np.sort(np.concatenate(parts))
            starts = np.flatnonzero(np.append(True, every[1:] != every[:-1])[: len(every)])
            found, n = every[starts], np.diff(np.append(starts, len(every)))
            codes.append(pa.array(np.append(0, found), mask=np.append(True, np.zeros(len(found), bool))))
            counts.append(np.append(len(parts), n))
        lengths = [len(c) for c in codes]
        at = pa.array(np.repeat(np.arange(len(groups)), lengths))
        of, band = (pa.array(x, t).take(at) for x, t in zip(zip(*groups), types))
        return pa.RecordBatch.from_arrays([of, band, pa.concat_arrays(codes), pa.array(np.concatenate(counts))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], list[np.ndarray]] = {}
        grams = 0
        for batch in batches:
            for of, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                codes = gram_codes(of, text.as_py(), size)
                held.setdefault((of, _band(codes)), []).append(codes)
                grams += len(codes) + 1
                if grams >= chunk:
                    yield counted(held)
                    held, grams = {}, 0
        if held:
            yield counted(held)

    return run


def _by_band(counted: DataFrame, *keys: str) -> DataFrame:
    """``keys``, ``n`` and ``bands``, a map from answer size to count, of (keys, band, n). There is
    one entry for each power of two."""
    entries = F.map_from_entries(F.collect_list(F.struct("band", "n")))
    return counted.groupBy(*keys).agg(F.sum("n").alias("n"), entries.alias("bands"))


def answer_weights(
    sets: DataFrame, size: int = 2, broadcast_rows: int = BROADCAST_ROWS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(code, weight, chance), the grams of answers that questions ask for with the share of the
    answers of each size that hold them, in ``UNIT`` parts; (of, none), the weight of a gram in no
    answer; and (code, count), the grams of all questions."""
    weight = lambda n, held: F.round(F.log((n + 1) / (held + 1)) * UNIT).cast("long")
    counts, known = write_counted(
        sets.select(F.explode("q").alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("count")), "grams-asked"
    )
    asked = counts.select("code")
    counted = sets.select("of", "a").mapInArrow(_count_grams(size), "of string, band int, code bigint, n bigint")
    if known <= broadcast_rows:  # questions are short: most grams of answers need no count
        answers = sets.sparkSession.range(1).select(F.lit(None).cast("long").alias("code"))
        side = F.broadcast(asked.unionByName(answers))
        counted = counted.join(side, counted["code"].eqNullSafe(side["code"]), "left_semi")
    held = counted.groupBy("of", "band", "code").agg(F.sum("n").alias("n"))
    held = write_stage(held, "grams-held")
    answers = _by_band(held.filter("code IS NULL"), "of")
    held = held.filter("code IS NOT NULL")
    if known > broadcast_rows:
        held = held.join(asked, "code", "left_semi")
    totals = answers.select("of", F.col("n").alias("total"), F.col("bands").alias("answers"))
    side = F.broadcast(totals) if totals.count() <= broadcast_rows else totals
    share = lambda band, n: F.round(n / F.try_element_at("answers", band) * UNIT).cast("long")
    weights = _by_band(held, "of", "code").join(side, "of").select(
        "code", weight(F.col("total"), F.col("n")).alias("weight"), F.transform_values("bands", share).alias("chance")
    )
    return weights, answers.select("of", weight(F.col("n"), F.lit(0)).alias("none")), counts


def with_other_answers(sets: DataFrame, seed: int = SPLIT_SEED, size: int = 2) -> DataFrame:
    """(key, of, q, band, other_band, own, met): the grams of a question that its answer holds, and
    those that the answer of the next row in seeded order within the group holds.

    ``a`` of ``sets`` is an answer's letters and digits, or the grams themselves. The last row of a
    group has no other; rows are ordered by group, so the next one is of another. Questions travel,
    as they are short: an answer moves once, to the question before.
    """
    order = sets.select("key", "of").orderBy("of", shuffle_rank("key", seed), "key")
    ranks = write_stage(numbered(order, "rank"), "ranks").select("key", "rank")
    after = ranks.select(F.col("key").alias("next"), (F.col("rank") - 1).alias("rank"))
    asked = sets.select("key", "of", "q", _met(size)("q", "of", "a").alias("own")).select(
        "key", "of", "q", "own.band", F.col("own.met").alias("own")
    )
    placed = asked.join(ranks.join(after, "rank", "left").select("key", "next"), "key")
    others = sets.select(F.col("key").alias("next"), F.col("of").alias("other_of"), F.col("a").alias("other"))
    joined = placed.join(others, "next", "left")
    other = F.when(F.col("of") == F.col("other_of"), F.col("other"))
    return joined.select("key", "of", "q", "band", "own", _met(size)("q", "of", other).alias("met")).select(
        "key", "of", "q", "band", F.col("met.band").alias("other_band"), "own", "met.met"
    )


def overlaps(
    pairs: DataFrame, weights: DataFrame, groups: DataFrame, counts: DataFrame, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """(key, band, score, excess, other_band, other_excess) of ``pairs`` (key, of, q, band,
    other_band, own, met), in whole ``UNIT`` parts, rounded down, or null. ``counts`` (code, count)
    are the grams of all questions."""
    weights, known = write_counted(weights, "gram-weights")
    own, met = F.array_contains("own", F.col("code")), F.array_contains("met", F.col("code"))
    side = F.broadcast(groups) if groups.count() <= broadcast_rows else groups
    pairs, rows = write_counted(pairs.join(side, "of"), "pairs", F.sum(F.size("q")))
    flat = pairs.select("key", "band", "other_band", "none", "own", "met", F.explode("q").alias("code")).select(
        "key", "band", "other_band", "none", "code", own.alias("in_own"), F.coalesce(met, F.lit(False)).alias("in_other")
    )
    if known <= broadcast_rows:
        weighed = flat.join(F.broadcast(weights), "code", "left")
    else:
        weighed = join_hot(flat, weights, "code", "left", rows, counts=counts)
    weight = F.coalesce("weight", "none")
    chance = lambda band: weight * F.coalesce(F.try_element_at("chance", F.col(band)), F.lit(0))
    none = F.lit(0).cast("long")
    # Each question without grams is a row as well.
    parts = weighed.select(
        "key", "band", "other_band", weight.alias("whole"), F.when(F.col("in_own"), weight).otherwise(none).alias("own"),
        chance("band").alias("own_chance"), F.when(F.col("in_other"), weight).otherwise(none).alias("met"),
        chance("other_band").alias("met_chance"),
    ).unionByName(
        pairs.filter(F.size("q") == 0).select(
            "key", "band", "other_band", *[none.alias(c) for c in ("whole", "own", "own_chance", "met", "met_chance")]
        )
    )
    sums = parts.groupBy("key").agg(
        F.any_value("band").alias("band"), F.any_value("other_band").alias("other_band"),
        *[F.sum(c).alias(c) for c in ("whole", "own", "own_chance", "met", "met_chance")],
    )
    # Whole numbers of any size, so that nothing is rounded on the way.
    exact = lambda c: F.col(c).cast("decimal(38,0)")
    parted = sums.select(
        "key", "band", "other_band", F.when(F.col("whole") > 0, exact("whole")).alias("whole"),
        (exact("own") * UNIT).cast("decimal(38,0)").alias("score"),
        (exact("own") * UNIT - exact("own_chance")).cast("decimal(38,0)").alias("excess"),
        F.when(F.col("other_band").isNotNull(), exact("met") * UNIT - exact("met_chance")).cast("decimal(38,0)").alias("other_excess"),
    )
    floor = lambda c: F.expr(f"({c} - pmod({c}, whole)) div whole").alias(c)
    return parted.select("key", "band", floor("score"), floor("excess"), "other_band", floor("other_excess"))


def _quantile(cells: list[tuple[int, int]], quantile: float) -> int:
    """The end of the first cell up to which this share of the values lies."""
    total, seen = sum(n for _, n in cells), 0
    for cell, n in sorted(cells):
        seen += n
        if seen >= quantile * total:
            return (cell + 1) * (UNIT // CELLS)
    return 0


def shuffled_bounds(scores: DataFrame, rule: RelevanceRule = RelevanceRule()) -> tuple[dict[int, int], int]:
    """The bound of each answer size with enough pairs, and that of all pairs."""
    cell = F.floor(F.col("other_excess") / (UNIT // CELLS)).cast("int")
    found = scores.filter("other_excess IS NOT NULL").groupBy("other_band", cell.alias("cell")).count().collect()
    bands: dict[int, list[tuple[int, int]]] = {}
    for band, at, n in found:
        bands.setdefault(band, []).append((at, n))
    bounds = {
        b: _quantile(cells, rule.quantile) for b, cells in bands.items() if sum(n for _, n in cells) >= rule.min_pairs
    }
    return bounds, _quantile([c for cells in bands.values() for c in cells], rule.quantile)


def relevance(
    df: DataFrame,
    key: str,
    question: str,
    answer: str,
    group: str | None = None,
    rule: RelevanceRule = RelevanceRule(),
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Per row ``key``, ``score`` (0 to 1), ``excess``, ``bound`` and ``irrelevant``."""
    bound_batches(df.sparkSession)
    sets = write_stage(pair_sets(spread(df, key), key, question, answer, group, rule.gram), "pair-sets")
    pairs = with_other_answers(sets, rule.seed, rule.gram)
    scores = write_stage(
        overlaps(pairs, *answer_weights(sets, rule.gram, broadcast_rows), broadcast_rows), "overlaps"
    )
    bounds, of_all = shuffled_bounds(scores, rule)
    schema = StructType([StructField("band", scores.schema["band"].dataType), StructField("own_bound", LongType())])
    table = F.broadcast(scores.sparkSession.createDataFrame(sorted(bounds.items()), schema))
    bound = F.coalesce("own_bound", F.lit(of_all))
    below = (F.col("excess") < bound) & (F.col("score") < UNIT)
    return scores.join(table, "band", "left").select(
        F.col("key").alias(key),
        *[(F.col(c) / UNIT).alias(c) for c in ("score", "excess")],
        (bound / UNIT).alias("bound"),
        F.coalesce(below, F.lit(False)).alias("irrelevant"),
    )
