"""Language identification by cross-parsing.

For each language a suffix automaton holds a sample of its labelled text. A text is parsed
greedily into the longest phrases that occur in the sample; the fewer phrases it takes, at
log2(sample size) bits each, the closer the text is to the language. The language that needs
the fewest bits wins.

Texts are reduced to lower-case letters and single blanks, as UTF-8 bytes, and parsed from
their first byte to their last. To do so for many texts a step, a task first parses stretches
of ``STRETCH`` bytes as if a phrase began with each. It then enters each stretch with the state
that the one before ended in, and goes on until a phrase begins where one began before: from
there on both parses are the same. Where that does not happen within a stretch, the next one is
entered again. What ``ROUNDS`` rounds leave open is walked byte by byte, so no text costs more
than in proportion to its length.

The sample is bounded: of each language the ``SAMPLE_ROWS`` labelled texts with the smallest
hashes, together up to ``SAMPLE_BYTES`` bytes. Rows with one key, length and label count once.
A model holds ``MODEL_LANGUAGES`` languages; of more, each model in turn reads the texts and
hands on the best and second best so far. One row a language comes to the driver.

Defined cases: a null text, one without letters, or any text if no language was learned, is
``und`` with score 0; with one language its score is 1; of equally good languages the
smallest name wins; repeated rows give repeated rows; a null key is not held out, as the
checksum of an empty text is 0; only the key, text and label columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sftpipe.llm.common import filled, id_text

SAMPLE_ROWS, SAMPLE_BYTES, SPARE = 256, 20_000, 4
MODEL_LANGUAGES = 200
STRETCH, ROUNDS = 256, 8
#: Bytes parsed at once.
GROUP_BYTES = 8 << 20
UNKNOWN = "und"
_NO_LETTERS = re.compile(r"[\W\d_]+")


def reduced(text: str) -> bytes:
    """Lower-case words joined by blanks; empty if there is no letter."""
    words = _NO_LETTERS.sub(" ", text.lower()).strip()
    return words.encode() if any(map(str.isalpha, words)) else b""


def automaton(text: bytes, codes: np.ndarray, size: int) -> np.ndarray:
    """Transitions of the suffix automaton: rows are states, columns codes.

    State 0 stands for no match, state 1 for the empty one.
    """
    links, lengths, moves = [0, 0], [0, 0], [{}, {}]
    last = 1
    for code in codes[np.frombuffer(text, np.uint8)].tolist():
        links.append(1)
        lengths.append(lengths[last] + 1)
        moves.append({})
        new, at = len(links) - 1, last
        while at and code not in moves[at]:
            moves[at][code] = new
            at = links[at]
        if at:
            old = moves[at][code]
            if lengths[old] == lengths[at] + 1:
                links[new] = old
            else:
                links.append(links[old])
                lengths.append(lengths[at] + 1)
                moves.append(dict(moves[old]))
                copy = len(links) - 1
                while at and moves[at].get(code) == old:
                    moves[at][code] = copy
                    at = links[at]
                links[old] = links[new] = copy
        last = new
    table = np.zeros((len(moves), size), np.uint16 if len(moves) < 1 << 16 else np.uint32)
    for state, found in enumerate(moves):
        table[state, list(found)] = list(found.values())
    return table


def fit(samples: dict[str, bytes]) -> tuple:
    """Languages in order, the code of each byte, transition tables, and sample sizes."""
    names = sorted(n for n, text in samples.items() if text)
    seen = sorted(set(b"".join(samples[n] for n in names)))
    codes = np.zeros(256, np.uint8)
    codes[seen] = range(1, len(seen) + 1)
    # A byte that no sample has goes by code 0, which no state has a transition for.
    tables = [automaton(samples[n], codes, len(seen) + 1) for n in names]
    return names, codes, tables, [len(samples[n]) for n in names]


def learn(df: DataFrame, key: str, text: str, label: str, languages: int = MODEL_LANGUAGES) -> list[tuple]:
    """Models of the labelled rows of ``df``, each of at most so many ``languages``."""
    labelled = df.filter(df[label].isNotNull() & df[text].isNotNull()).select(
        F.col(label).cast("string").alias("label"),
        F.shiftrightunsigned(F.xxhash64(id_text(key), F.length(text)), 1).alias("place"),
        F.col(text).alias("text"),
    )
    counts = labelled.groupBy("label").agg(F.approx_count_distinct("place").alias("n")).collect()
    # Hashes are even, so those below this bound hold about SPARE times the sample; only they
    # are ordered.
    most = (1 << 63) - 1
    bounds = sorted((r["label"], min(most, most * SPARE * SAMPLE_ROWS // max(r["n"], 1))) for r in counts)
    blocks = [bounds[at : at + languages] for at in range(0, len(bounds), languages)]
    return [fit(_samples(labelled, block)) for block in blocks]


def _samples(labelled: DataFrame, bounds: list[tuple[str, int]]) -> dict[str, bytes]:
    """The sample of each language in ``bounds``, which has at most ``MODEL_LANGUAGES``."""
    below = F.broadcast(labelled.sparkSession.createDataFrame(bounds, "label string, bound bigint"))
    order = Window.partitionBy("label").orderBy("place")
    # Places are picked first, so that texts are not sorted.
    picked = (
        labelled.select("label", "place")
        .join(below, "label")
        .filter("place <= bound")
        .select("label", "place")
        .distinct()
        .withColumn("n", F.row_number().over(order))
        .filter(F.col("n") <= SAMPLE_ROWS)
        .select("label", "place")
    )
    # One text for each place, however many rows have it.
    rows = (
        labelled.select("label", "place", F.left("text", F.lit(SAMPLE_BYTES)).alias("text"))
        .join(F.broadcast(picked), ["label", "place"], "left_semi")
        .groupBy("label", "place")
        .agg(F.min("text").alias("text"))
    )
    samples: dict[str, bytes] = {}
    for row in sorted(rows.collect(), key=lambda r: (r["label"], r["place"])):
        known = samples.setdefault(row["label"], b"")
        if len(known) < SAMPLE_BYTES:
            samples[row["label"]] = (known + reduced(row["text"]) + b" ")[:SAMPLE_BYTES]
    return samples


class _Stretches:
    """Texts cut into stretches that stand side by side: a row for each place in a stretch, a
    column for each stretch, long ones first. Stretches are numbered in the order of the texts."""

    def __init__(self, texts: list[bytes], codes: np.ndarray):
        sizes = np.array([len(t) for t in texts], np.int64)
        rows = -(-sizes // STRETCH)
        self.owner = np.repeat(np.arange(len(texts)), rows)
        inside = np.arange(len(self.owner)) - np.repeat(np.cumsum(rows) - rows, rows)
        self.length = np.minimum(sizes[self.owner] - inside * STRETCH, STRETCH)
        self.first = inside == 0
        order = np.argsort(-self.length, kind="stable")
        self.column = np.empty(len(order), np.int64)
        self.column[order] = np.arange(len(order))
        padded = b"".join([t + b"\0" * (-len(t) % STRETCH) for t in texts])
        self.codes = codes[np.frombuffer(padded, np.uint8).reshape(-1, STRETCH)[order].T]
        self.active = np.searchsorted(-self.length[order], -np.arange(STRETCH))

    def followers(self, stretches: np.ndarray) -> np.ndarray:
        """The stretches after these in the same texts."""
        after = stretches[stretches + 1 < len(self.owner)] + 1
        return after[~self.first[after]]


def _cold_parse(cut: _Stretches, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where phrases begin if one begins with each stretch, and the states at their ends, both
    by column."""
    flat, width, starts = table.ravel(), table.shape[1], table[1]
    state = np.zeros(len(cut.owner), np.int64)
    begins = np.zeros(cut.codes.shape, bool)
    for j in range(STRETCH):
        n = cut.active[j]
        if not n:
            break
        code = cut.codes[j, :n]
        following = flat[state[:n] * width + code]
        begins[j, :n] = following == 0
        state[:n] = np.where(begins[j, :n], starts[code], following)
    return begins, state


def _enter(cut: _Stretches, table: np.ndarray, begins: np.ndarray, state: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Parse the stretches ``some`` anew, entered with the states of those before; return the
    ones that now end in another state. ``begins`` and ``state`` are put right."""
    flat, width, starts = table.ravel(), table.shape[1], table[1]
    now = state[cut.column[some - 1]]
    for j in range(STRETCH):
        inside = cut.length[some] > j
        if not inside.all():
            # Only the last stretch of a text is short, and nobody asks for its state.
            some, now = some[inside], now[inside]
        if not len(some):
            return some
        place = cut.column[some]
        code = cut.codes[j, place]
        following = flat[now * width + code]
        new = following == 0
        apart = ~(new & begins[j, place])
        begins[j, place] = new
        now = np.where(new, starts[code], following).astype(np.int64)
        some, now = some[apart], now[apart]
    other = state[cut.column[some]] != now
    state[cut.column[some]] = now
    return some[other]


def _walk(cut: _Stretches, table: np.ndarray, begins: np.ndarray, state: np.ndarray, stretch: int) -> None:
    """The same for one stretch and those after it, byte by byte."""
    now = int(state[cut.column[stretch - 1]])
    while stretch < len(cut.owner) and not cut.first[stretch]:
        place = cut.column[stretch]
        known = begins[:, place].tolist()
        for j, code in enumerate(cut.codes[: cut.length[stretch], place].tolist()):
            following = int(table[now, code])
            new = following == 0
            if new and known[j]:
                return
            begins[j, place] = new
            now = int(table[1, code]) if new else following
        if state[place] == now:
            return
        state[place] = now
        stretch += 1


def phrase_counts(texts: list[bytes], model: tuple) -> np.ndarray:
    """Phrases of each whole text in each language: an array (texts, languages)."""
    names, codes, tables, _ = model
    cut = _Stretches(texts, codes)
    counts = np.zeros((len(texts), len(names)), np.int64)
    for number, table in enumerate(tables):
        begins, state = _cold_parse(cut, table)
        left = np.flatnonzero(~cut.first)
        for _ in range(ROUNDS):
            left = cut.followers(_enter(cut, table, begins, state, left))
        for stretch in left.tolist():
            _walk(cut, table, begins, state, stretch)
        phrases = begins.sum(axis=0)[cut.column]
        counts[:, number] = np.bincount(cut.owner, weights=phrases, minlength=len(texts))
    return counts


def ranked(texts: list[bytes], model: tuple) -> list[tuple[str, float, float]]:
    """The best language of each reduced text, its bits, and those of the second best."""
    names, _, _, sizes = model
    if not names:
        return [(UNKNOWN, np.inf, np.inf)] * len(texts)
    bits = phrase_counts(texts, model) * np.log2(np.maximum(sizes, 2))
    best = bits.argmin(axis=1)
    ordered = np.sort(bits, axis=1)
    second = ordered[:, 1] if len(names) > 1 else np.full(len(texts), np.inf)
    return list(zip([names[b] for b in best], ordered[:, 0].tolist(), second.tolist()))


def better(a: tuple[str, float, float], b: tuple[str, float, float]) -> tuple[str, float, float]:
    """Two results for one text as one; of equal ones ``a``, whose names come first."""
    first, other = (b, a) if b[1] < a[1] else (a, b)
    return first[0], first[1], min(first[2], other[1])


def verdict(text: bytes, found: tuple[str, float, float]) -> tuple[str, float]:
    """Language and score of a reduced text; the score is how far the best is ahead of the
    second best, as a share of the latter's bits."""
    name, bits, second = found
    if not text or name == UNKNOWN and np.isinf(bits):
        return UNKNOWN, 0.0
    return name, 1.0 if np.isinf(second) else 1 - bits / second


def classify(texts: list[bytes], model: tuple) -> list[tuple[str, float]]:
    """Language and score of each reduced text."""
    return [verdict(t, f) for t, f in zip(texts, ranked(texts, model))]


def _groups(texts: list[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for text in texts:
        if size and size + len(text) > GROUP_BYTES:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def predict(df: DataFrame, key: str, text: str, models: list[tuple]) -> DataFrame:
    """``key``, ``held_out`` (a column of ``df``), ``lang_pred`` and ``score`` of every row.

    The models come in the order of their languages' names.
    """
    # Each is bounded by the number of languages of a model and the sample size.
    shared = [df.sparkSession.sparkContext.broadcast(m) for m in models]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            for group in _groups([reduced(t.as_py()) for t in batch.column(2)]):
                found = [(UNKNOWN, np.inf, np.inf)] * len(group)
                for model in shared:
                    found = [better(f, r) for f, r in zip(found, ranked(group, model.value))]
                for text, result in zip(group, found):
                    name, score = verdict(text, result)
                    names.append(name)
                    scores.append(score)
            if names:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(names), pa.array(scores)],
                    names=[key, "held_out", "lang_pred", "score"],
                )

    kind = df.schema[key].dataType.simpleString()
    read = df.select(df[key], "held_out", filled(df[text]).alias("text"))
    return read.mapInArrow(run, f"`{key}` {kind}, held_out boolean, lang_pred string, score double")


def held_out_languages(df: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """Learn from the rows whose key's checksum is not 2 modulo four; predict all rows."""
    held = F.crc32(id_text(key).cast("binary")) % 4 == 2
    read = df.select(df[key], df[text], df[label], held.alias("held_out"))
    models = learn(read.filter(~F.col("held_out")), key, text, label)
    return predict(read, key, text, models)
