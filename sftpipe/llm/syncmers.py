"""Document fingerprints from closed syncmers, in DataFrame functions only.

A text is a sequence of units: runs of at most ``UNIT_CHARS`` characters that are no ASCII white
space; of a longer run, as of a script without blanks, each character up to the last
``UNIT_CHARS``, which are one unit. So what a unit is depends on the characters after it alone,
and no further than that. Of ``K`` units in a row, all windows of ``S``
units are hashed; the K units are a closed syncmer if the smallest of these hashes is the
first or the last. Whether they are chosen depends on nothing around them, so an edit
changes only the anchors it touches, and at least one of any K - S + 1 neighbouring starts
is chosen. A fingerprint is the hashes of the chosen K-mers in text order without repeats, 31 bits each.
Few K-mers fit into a text of under ``SHORT_UNITS`` units, so its single units follow, marked by
a bit of their own. Two fingerprints are as alike as the share of their anchors that both have;
single units count only where both have them, so that like is compared with like.

Defined cases: a null or empty text, or one of white space, has no anchors; two such
fingerprints are alike to 1, one such and another to 0; a text of fewer than K units has its
units as its only anchors, and likeness 0 to one of ``SHORT_UNITS`` or more; texts of any length are read whole; equal keys are ordered by a hash of
their texts; a null key comes after all others; only the key and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sftpipe.llm.common import filled

K, S = 8, 2
SHORT_UNITS = 32
UNIT_CHARS = 16
_BLACK = r"[^\x20\x09-\x0D]"
UNIT = rf"{_BLACK}{{1,{UNIT_CHARS}}}+(?!{_BLACK})|{_BLACK}"
#: Marks the digest of a single unit.
SINGLE = 1 << 31
#: Rows in a run of neighbouring keys that is ordered by one task, and runs at most.
RUN_ROWS, MAX_RUNS = 500, 16_384
LEAST_KEY = -(1 << 63)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once; a lambda evaluates what it refers to again
    for each element, but not its own variables."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _digest(k_mer: Column) -> Column:
    """31 bits of a hash, as a long that is not negative."""
    return F.shiftrightunsigned(F.xxhash64(k_mer), 33)


def _single(unit: Column) -> Column:
    return F.lit(SINGLE) + _digest(F.array(unit))


def _sampled(text: Column, hashed, singles) -> Column:
    """``hashed(units, i)`` for each closed syncmer, which starts at unit i (from 1).

    A short text also has its ``singles(units)``.
    """
    inner = K - S + 1

    def with_windows(arrays: Column) -> Column:
        least = arrays["s"]
        chosen = F.filter(
            F.sequence(F.lit(1), F.size(least) - inner + 1),
            lambda i: F.array_min(F.slice(least, i, inner))
            == F.least(F.element_at(least, i), F.element_at(least, i + inner - 1)),
        )
        return F.transform(chosen, lambda i: hashed(arrays["h"], i))

    def of(h: Column) -> Column:
        length = F.size(h) - S + 1
        shifted = [F.slice(h, i + 1, length) for i in range(S)]
        windows = F.zip_with(*shifted, lambda a, b: F.xxhash64(a, b))
        both = F.struct(h.alias("h"), windows.alias("s"))
        sampled = _bound(both, with_windows)
        return (
            F.when(F.size(h) < K, singles(h))
            .when(F.size(h) < SHORT_UNITS, F.concat(sampled, singles(h)))
            .otherwise(sampled)
        )

    return _bound(F.transform(_units(text), lambda u: F.xxhash64(u)), of)


def _units(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(UNIT), F.lit(0))


def anchors(text: str | Column) -> Column:
    """The fingerprint of a text as an array of longs below 2^32."""
    return F.array_distinct(
        _sampled(
            filled(text),
            lambda h, i: _digest(F.slice(h, i, K)),
            lambda h: F.transform(h, _single),
        )
    )


def positioned_anchors(text: str | Column) -> Column:
    """(unit, hash) of every anchor, units counted from 1, for positional matching."""
    def at(position: Column, digest: Column) -> Column:
        return F.struct(position.cast("int").alias("unit"), digest.alias("hash"))

    return _sampled(
        filled(text),
        lambda h, i: at(i, _digest(F.slice(h, i, K))),
        lambda h: F.transform(h, lambda u, i: at(i + 1, _single(u))),
    )


def as_text(fingerprint: str) -> Column:
    """A fingerprint as hex digits, eight for each anchor."""
    return F.lower(F.array_join(F.transform(fingerprint, lambda a: F.lpad(F.hex(a), 8, "0")), ""))


def likeness(a: str, b: str) -> Column:
    """Shared anchors over all anchors of both, from 0 to 1; single units count where both have
    them, or where one has no anchors."""
    def singles(anchors: str) -> Column:
        # They come last.
        return F.coalesce(F.get(anchors, F.size(anchors) - 1) >= SINGLE, F.lit(True))

    def share(shared: Column) -> Column:
        union = shared["a"] + shared["b"] - shared["both"]
        return F.when(union == 0, 1.0).otherwise(shared["both"] / union)

    def count(anchors: str | Column, all_of_them: bool) -> Column:
        return F.size(anchors) if all_of_them else F.size(F.filter(anchors, lambda x: x < SINGLE))

    def shares(all_of_them: bool) -> Column:
        parts = {"a": F.col(a), "b": F.col(b), "both": F.array_intersect(a, b)}
        return F.struct(*[count(c, all_of_them).alias(n) for n, c in parts.items()])

    return _bound(F.when(singles(a) & singles(b), shares(True)).otherwise(shares(False)), share)


def fingerprints(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key`` and ``fingerprint`` (array of longs) of every text."""
    return df.select(df[key].alias(key), anchors(df[text]).alias("fingerprint"))


def _run_of(order: Column, bounds: list[int]) -> Column:
    """How many bounds are greater than or equal to ``order``; the bounds are in descending order.

    A binary search of a constant array.
    """
    if not bounds:
        return F.lit(0)
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    array = F.array(*map(F.lit, bounds)) if len(bounds) < 64 else F.from_json(
        F.lit(str(bounds)), "array<bigint>"
    )
    return F.aggregate(
        F.array(*map(F.lit, steps)),
        F.lit(0),
        lambda at, step: F.when(F.get(array, at + step - 1) >= order, at + step).otherwise(at),
    )


def with_next(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, ``text``, ``fingerprint`` and those of the row with the next smaller key.

    After the smallest key comes the largest. Keys are cut into runs by their quantiles, a
    window orders each run, and the first rows of the following run are added at its end,
    so no task orders all rows. Texts are shuffled once.
    """
    order = F.coalesce(df[key].cast("long"), F.lit(LEAST_KEY))
    read = df.select(df[key].alias("key"), filled(df[text]).alias("text"), order.alias("order"))
    rows = read.count()
    runs = min(max(rows // RUN_ROWS, 1), MAX_RUNS)
    bounds: list[int] = []
    if runs > 1:
        shares = [i / runs for i in range(1, runs)]
        found = read.agg(F.percentile_approx("order", shares, 20 * runs)).first()[0]
        bounds = sorted(set(found), reverse=True)
    placed = read.withColumn("run", _run_of(F.col("order"), bounds))
    # One row per run: its number and its largest key.
    firsts = sorted(placed.groupBy("run").agg(F.max("order").alias("order")).collect())
    ghosts = [(r["order"], firsts[i - 1]["run"]) for i, r in enumerate(firsts)]
    before = F.broadcast(df.sparkSession.createDataFrame(ghosts, "order bigint, run int"))
    copies = read.join(before, "order").select("key", "text", "order", "run", F.lit(True).alias("ghost"))
    in_order = Window.partitionBy("run").orderBy("ghost", F.desc("order"), "tie")
    return (
        placed.select("key", "text", "order", "run", F.lit(False).alias("ghost"))
        .unionByName(copies)
        .repartition("run")
        .withColumns({"fingerprint": anchors("text"), "tie": F.xxhash64("text")})
        .withColumns(
            {
                "next_text": F.lead("text").over(in_order),
                "next_fingerprint": F.lead("fingerprint").over(in_order),
            }
        )
        .filter("NOT ghost")
        .select("key", "text", "fingerprint", "next_text", "next_fingerprint")
    )


def edit_likeness(df: DataFrame, key: str, text: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has the first characters of the next text in place of its last third.
    """
    cut = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(
        F.left(F.col("text"), F.length("text") - cut), F.left(F.col("next_text"), cut)
    )
    return (
        with_next(df, key, text)
        .select(
            "key",
            F.length("text").cast("long").alias("chars"),
            F.col("fingerprint").alias("own"),
            F.col("next_fingerprint").alias("following"),
            edited.alias("edited"),
        )
        .withColumn("changed", anchors("edited"))
        .select(
            F.col("key").alias(key),
            F.col("chars").alias("n_chars"),
            F.sha2("edited", 256).alias("edited_sha256"),
            as_text("own").alias("fingerprint"),
            as_text("changed").alias("edited_fingerprint"),
            likeness("own", "changed").alias("near_edited"),
            likeness("own", "following").alias("near_next"),
        )
    )
