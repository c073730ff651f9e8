"""Alignment of two tokenizers over the same bytes, by lockstep merging.

A text is encoded by a byte-level BPE (A), with a blank put before it, and by a sentencepiece
model (B), which puts that blank itself. Both token sequences cover the same bytes, so
aligning them is merging two ascending lists of byte ends. All documents of a batch are merged
at once: one state vector holds a pointer into A and one into B for each of them; a step
compares the ends under the pointers, emits a link for each document, a cut where both ends
are equal, advances the pointer that lies behind (both at a cut) and drops the documents that
are finished. A link is a pair of token occurrences whose byte ranges overlap; the cuts
divide both sequences into groups.

No token of A or B crosses a blank between two characters that are no white space, unless it
begins there. So a text is split at these blanks, the ids of a piece serve for all its
occurrences, and a task encodes a piece it remembers only once. For the merge, long documents
are cut into parts of whole pieces; the parts step side by side as documents do, so a batch
takes as many steps as its longest part has links.

How often an id pair is linked is counted over all documents: documents keep their distinct
pairs with counts, which Spark sums up. The most frequent ``PAIRS`` pairs are broadcast, a
bound on rows whatever the corpus; documents with other pairs get those by a shuffled join, in
which no pair is frequent.

Defined cases: a null or empty text has no tokens, nor has one whose tokens do not give back
its bytes in both tokenizers (a text with U+2581, which B reads as a blank); a text of any
length is aligned whole, in memory of about 300 bytes a token; control strings in texts are
ordinary text; repeated rows and keys give repeated rows; null keys stay null; an empty table
gives an empty result; only the named key and text columns are read, so others cannot clash.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from sftpipe.llm.common import filled
from sftpipe.operators.joins import join_hot
from sftpipe.session import write_counted, write_stage

#: Tokens of A in a part, which ends with a piece, and characters of the texts of one merge.
PART_TOKENS, BATCH_CHARS = 1024, 1 << 20
#: Characters of the pieces that a task remembers, and how many are encoded as one text.
KNOWN_CHARS, JOINED = 3 << 20, 64
#: Id pairs that are broadcast: 32 MB in a worker.
PAIRS = 2 << 20
#: Ids have at most 20 bits.
ID = (1 << 20) - 1
_BLANK, _SPACES = re.compile(r"(?<=\S) (?=\S)"), re.compile(r"\s\s")
_SPACE = "▁"


def byte_characters() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary.

    Printing characters of Latin-1 stand for themselves, the other bytes for the characters
    from 256 on, in order.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = sorted(set(range(256)) - set(own))
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, a: str, b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b)
        own = byte_characters()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(map(own.get, token)) if set(token) <= set(own) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)
        ]
        self.sizes_a = np.array([*map(len, self.bytes_a)])
        self.sizes_b = np.array([*map(len, self.bytes_b)])
        #: Whether a blank after another character always begins a token of B.
        self.cuts = not any(_SPACE in p.lstrip(_SPACE) for p in pieces)

    def pieces(self, text: str) -> list[str]:
        """The text without the blanks at which it is split."""
        if not self.cuts:
            return [text]
        if not _SPACES.search(text):
            found = text.split(" ")
            if found[0] and found[-1]:
                return found
        return _BLANK.split(text)

    def _encoded(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of each text, a blank before it, by A and by B."""
        a = self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return [e.ids for e in a], self.b.encode(texts, num_threads=1)

    def _spells(self, a: Sequence[int], b: Sequence[int], wanted: bytes) -> bool:
        return b"".join([self.bytes_a[i] for i in a]) == wanted == b"".join([self.bytes_b[i] for i in b])

    def encode(self, pieces: list[str]) -> Pieces:
        """Ids of each piece, a blank before it; none if they do not give back its bytes.

        Pieces between which a text may be split are encoded as one text.
        """
        apart = [not self.cuts or not p or p[0].isspace() or p[-1].isspace() or _SPACE in p for p in pieces]
        joined = [p for p, own in zip(pieces, apart) if not own]
        a, b = array("q"), array("q")
        for at in range(0, len(joined), JOINED * JOINED):
            some = joined[at : at + JOINED * JOINED]
            lines = [" ".join(some[i : i + JOINED]) for i in range(0, len(some), JOINED)]
            for ids, found in zip((a, b), self._encoded(lines)):
                for row in found:
                    ids.extend(row)
        if not self._spells(a, b, " ".join(["", *joined]).encode()):
            apart, joined, a, b = [True] * len(pieces), [], [], []
        own = [p for p, alone in zip(pieces, apart) if alone]
        own_a, own_b = self._encoded(own) if own else ([], [])
        for i, p in enumerate(own):
            if not p or not self._spells(own_a[i], own_b[i], b" " + p.encode()):
                own_a[i] = own_b[i] = []
        alone, ends = np.array(apart, bool), np.cumsum([len(p.encode()) + 1 for p in joined])
        return Pieces(
            *_merged(alone, own_a, *_cut(a, self.sizes_a, ends)),
            *_merged(alone, own_b, *_cut(b, self.sizes_b, ends)),
        )


@dataclass
class Pieces:
    """Ids by A and B of some pieces, one after another, and how many each has."""

    a: np.ndarray
    sizes_a: np.ndarray
    b: np.ndarray
    sizes_b: np.ndarray

    def __add__(self, other: Pieces) -> Pieces:
        return Pieces(*(np.concatenate([getattr(x, f) for x in (self, other)]) for f in ("a", "sizes_a", "b", "sizes_b")))


def _gathered(ids: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Ids of the pieces in ``order``."""
    taken = sizes[order]
    shift = (np.cumsum(sizes) - sizes)[order] - (np.cumsum(taken) - taken)
    return ids[np.arange(taken.sum()) + np.repeat(shift, taken)]


def _cut(ids: Sequence[int], sizes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the pieces that end at the bytes ``ends`` of a text, and how many each has."""
    ids = np.array(ids, np.int64)
    return ids, np.diff(np.searchsorted(np.cumsum(sizes[ids]), ends, side="right"), prepend=0)


def _merged(alone: np.ndarray, own: list[list[int]], ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and sizes of all pieces, those encoded alone in their places."""
    all_ids = np.concatenate([ids, np.array([i for row in own for i in row], np.int64)])
    all_sizes = np.concatenate([sizes, np.array([len(row) for row in own], np.int64)])
    order = np.argsort(np.argsort(alone, kind="stable"), kind="stable")
    return _gathered(all_ids, all_sizes, order), all_sizes[order]


class Encoder:
    """Encodes the texts of a task and remembers their pieces."""

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        none = np.zeros(0, np.int64)
        self.known = Pieces(none, none, none, none)
        self.chars = 0

    def encode(self, texts: list[list[str]]) -> tuple[Pieces, np.ndarray]:
        """The ids of the known pieces, and the places of the pieces of all texts among them."""
        if self.chars > KNOWN_CHARS:
            self._forget()
        if fresh := list(set().union(*texts).difference(self.places)):
            self.places.update(zip(fresh, range(len(self.places), len(self.places) + len(fresh))))
            self.known += self.tokenizers.encode(fresh)
            self.chars += sum(map(len, fresh))
        order = np.fromiter(map(self.places.__getitem__, chain.from_iterable(texts)), np.int64)
        return self.known, order


@lru_cache(maxsize=1)
def tokenizers(a: str, b: str) -> Tokenizers:
    return Tokenizers(a, b)


def lockstep(
    ends_a: np.ndarray, ends_b: np.ndarray, stops_a: np.ndarray, stops_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of all parts, in order: the place in A, the place in B and whether a cut follows.

    ``ends`` are the byte ends of all tokens, ``stops`` the places after the last token of each
    part; the parts lie one after another, with the same bytes in A and in B.
    """
    at_a, at_b = (np.r_[0, stops][: len(stops)] for stops in (stops_a, stops_b))
    # A part has fewer links than tokens in A and B.
    slot, stop = at_a + at_b, stops_a
    links_a = np.full(len(ends_a) + len(ends_b), -1)
    links_b = np.zeros_like(links_a)
    cuts = np.zeros(len(links_a), bool)
    while len(at_a):
        a, b = ends_a[at_a], ends_b[at_b]
        links_a[slot], links_b[slot], cuts[slot] = at_a, at_b, a == b
        at_a, at_b, slot = at_a + (a <= b), at_b + (b <= a), slot + 1
        live = at_a < stop
        if not live.all():
            at_a, at_b, slot, stop = at_a[live], at_b[live], slot[live], stop[live]
    used = links_a >= 0
    return links_a[used], links_b[used], cuts[used]


@dataclass
class Aligned:
    """Tokens, links and cuts of some texts; ``of_`` are the bounds of the texts in each."""

    a: np.ndarray
    b: np.ndarray
    links_a: np.ndarray
    links_b: np.ndarray
    #: The places of the links after which both sequences have an end.
    cuts: np.ndarray
    of_a: np.ndarray
    of_b: np.ndarray
    of_links: np.ndarray
    of_cuts: np.ndarray


def align_texts(encoder: Encoder, texts: list[str]) -> Aligned:
    found = [encoder.tokenizers.pieces(t) if t else [] for t in texts]
    known, order = encoder.encode(found)
    of_text = np.repeat(np.arange(len(texts)), [*map(len, found)])
    spelled = known.sizes_a > 0
    whole = np.bincount(of_text, ~spelled[order], len(texts)) == 0
    order, of_text = order[whole[of_text]], of_text[whole[of_text]]
    ids_a, ids_b = _gathered(known.a, known.sizes_a, order), _gathered(known.b, known.sizes_b, order)
    ends_a, ends_b = np.cumsum(known.sizes_a[order]), np.cumsum(known.sizes_b[order])
    at = np.searchsorted(of_text, np.arange(len(texts) + 1))
    of_a, of_b = (np.r_[0, ends][at] for ends in (ends_a, ends_b))
    # A part ends with the last piece of a text, or that begins within its tokens.
    part = (ends_a - known.sizes_a[order] - of_a[of_text]) // PART_TOKENS
    last = np.flatnonzero(np.diff(of_text, append=-1) | np.diff(part, append=-1))
    codec = encoder.tokenizers
    links_a, links_b, cut = lockstep(
        np.cumsum(codec.sizes_a[ids_a]), np.cumsum(codec.sizes_b[ids_b]), ends_a[last], ends_b[last]
    )
    cuts = np.flatnonzero(cut)
    of_links = np.searchsorted(links_a, of_a)
    return Aligned(ids_a, ids_b, links_a, links_b, cuts, of_a, of_b, of_links, np.searchsorted(cuts, of_links))


def group_texts(found: Aligned) -> list[str]:
    """Each text's groups: ids of A, a bar, ids of B; commas within, semicolons between."""
    ends_a, ends_b = found.links_a[found.cuts], found.links_b[found.cuts]
    group_a = np.searchsorted(ends_a, np.arange(len(found.a)))
    group_b = np.searchsorted(ends_b, np.arange(len(found.b)))
    # All of a group's ids of B follow its last id of A.
    place_a = np.arange(len(found.a)) + np.r_[0, ends_b + 1][group_a]
    place_b = np.arange(len(found.b)) + ends_a[group_b] + 1
    size = -(-(int(max(found.a.max(initial=0), found.b.max(initial=0))) + 1) // 65536) * 65536
    codes = np.zeros(len(found.a) + len(found.b), np.int64)
    codes[place_a], codes[place_b] = found.a, found.b
    codes[place_a[ends_a]] += size
    codes[place_b[ends_b]] += 2 * size
    spelled = _written(size)[codes]
    bounds = (found.of_a + found.of_b).tolist()
    return ["".join(spelled[x:y].tolist())[:-1] for x, y in zip(bounds, bounds[1:])]


@lru_cache(maxsize=1)
def _written(size: int) -> np.ndarray:
    """Ids below ``size`` as text before each of the three marks; of few sizes, so it is kept."""
    return np.array([f"{i}{mark}" for mark in ",|;" for i in range(size)], object)


def id_pairs(found: Aligned) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct linked id pairs of each text: bounds of the texts, ids of A and B, counts."""
    text = np.repeat(np.arange(len(found.of_links) - 1), np.diff(found.of_links))
    codes = text << 40 | found.a[found.links_a] << 20 | found.b[found.links_b]
    codes, counts = np.unique(codes, return_counts=True)
    bounds = np.searchsorted(codes, np.arange(len(found.of_links)) << 40)
    return bounds, codes >> 20 & ID, codes & ID, counts


def _lists(bounds: np.ndarray, *columns: np.ndarray, names: str) -> pa.Array:
    """Lists of structs of ints, cut at ``bounds``."""
    fields = [pa.array(c, pa.int32()) for c in columns]
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(fields, names.split()))


def _mapped(df: DataFrame, key: str, text: str, a: str, b: str, schema: str, columns: Callable[[Aligned], list]) -> DataFrame:
    """``key`` and the ``columns`` of the alignment of each text."""
    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, {schema}"
    fields = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizers(a, b))
        for batch in batches:
            start, chars, texts = 0, 0, batch.column(1).to_pylist()
            for at, value in enumerate(texts, 1):
                chars += len(value)
                if chars >= BATCH_CHARS or at == len(texts):
                    found = columns(align_texts(encoder, texts[start:at]))
                    arrays = [batch.column(0).slice(start, at - start), *found]
                    yield pa.RecordBatch.from_arrays([_cast(x, f.type) for x, f in zip(arrays, fields)], schema=fields)
                    start, chars = at, 0

    return df.select(df[key], filled(df[text])).mapInArrow(run, schema)


def _cast(values, kind: pa.DataType) -> pa.Array:
    values = values if isinstance(values, pa.Array) else pa.array(values)
    return values if values.type == kind else values.cast(kind)


def alignments(df: DataFrame, key: str, text: str, a: str, b: str) -> DataFrame:
    """Per row ``a`` and ``b`` (ids), ``links`` (places of linked tokens in both, in order) and
    ``cuts`` (numbers of tokens before each common end)."""

    def columns(found: Aligned) -> list:
        link = lambda of: np.repeat(of[:-1], np.diff(found.of_links))
        own_a, own_b = found.links_a - link(found.of_a), found.links_b - link(found.of_b)
        ids = lambda of, values: pa.ListArray.from_arrays(pa.array(of, pa.int32()), pa.array(values, pa.int32()))
        return [
            ids(found.of_a, found.a),
            ids(found.of_b, found.b),
            _lists(found.of_links, own_a, own_b, names="a b"),
            _lists(found.of_cuts, own_a[found.cuts] + 1, own_b[found.cuts] + 1, names="a b"),
        ]

    pair = "array<struct<a: int, b: int>>"
    return _mapped(df, key, text, a, b, f"a array<int>, b array<int>, links {pair}, cuts {pair}", columns)


def summaries(df: DataFrame, key: str, text: str, a: str, b: str) -> DataFrame:
    """Per row the numbers of tokens, groups and links, the digest of the groups, and the
    distinct id ``pairs`` (a, b, n) with the links that hold them."""

    def columns(found: Aligned) -> list:
        bounds, ids_a, ids_b, n = id_pairs(found)
        sizes = [np.diff(of) for of in (found.of_a, found.of_b, found.of_cuts, found.of_links)]
        digests = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in group_texts(found)]
        return [*sizes, digests, _lists(bounds, ids_a, ids_b, n, names="a b n")]

    schema = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
    return _mapped(df, key, text, a, b, f"{schema}, pairs array<struct<a: int, b: int, n: int>>", columns)


def pair_counts(found: DataFrame) -> DataFrame:
    """``a``, ``b``, ``n``: how many links hold each id pair."""
    return found.select(F.inline("pairs")).groupBy("a", "b").agg(F.sum("n").cast("long").alias("n"))


def _frequent(counts: DataFrame, most: int) -> tuple[int, bool]:
    """The least count of the pairs to broadcast, a power of two, and whether pairs are left."""
    sizes = counts.groupBy(F.floor(F.log2("n")).alias("power")).count().collect()
    taken, least = 0, 62
    for power, rows in sorted(((r["power"], r["count"]) for r in sizes), reverse=True):
        if taken + rows > most:
            return 1 << least, True
        taken, least = taken + rows, power
    return 1, False


def _looked_up(found: DataFrame, table, schema: str) -> DataFrame:
    """``found`` with the links of its pairs in ``table`` counted, and its other ``pairs``."""
    fields = to_arrow_schema(found.sparkSession.createDataFrame([], schema).schema)
    at = found.columns.index("pairs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, best = table.value
        for batch in batches:
            pairs = batch.column(at)
            ids_a, ids_b, n = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in pairs.flatten().flatten())
            row = np.repeat(np.arange(batch.num_rows), pairs.value_lengths().to_numpy(zero_copy_only=False))
            code = ids_a << 20 | ids_b
            place = np.minimum(np.searchsorted(known, code), max(len(known) - 1, 0))
            met = known[place] == code if len(known) else np.zeros(len(code), bool)
            links = np.where(met, counts[place], 0) if len(known) else np.zeros(len(code), np.int64)
            sums = lambda values: np.bincount(row, values, batch.num_rows) if len(row) else np.zeros(batch.num_rows)
            n_best = sums(n * (met & (links == best[ids_b]))).astype(np.int64)
            total = np.zeros(batch.num_rows, np.int64)
            np.add.at(total, row, n * links)
            rest = np.searchsorted(row[~met], np.arange(batch.num_rows + 1))
            left = _lists(rest, ids_a[~met], ids_b[~met], n[~met], names="a b n")
            own = [c for i, c in enumerate(batch.columns) if i != at]
            arrays = [*own, n_best, total, left]
            yield pa.RecordBatch.from_arrays([_cast(x, f.type) for x, f in zip(arrays, fields)], schema=fields)

    return found.mapInArrow(run, schema)


def with_pair_counts(found: DataFrame, counts: DataFrame, most: int = PAIRS) -> DataFrame:
    """``found`` with ``n_best``, its links whose id pair is counted as often as any of its id of
    B, and ``count_sum``, the counts of the pairs of all its links; without ``pairs``.

    The best counts have one row per id of B: the vocabulary bounds them.
    """
    spark = found.sparkSession
    best_of = counts.groupBy("b").agg(F.max("n").alias("best"))
    best = np.zeros(ID + 1, np.int64)
    for b, n in best_of.collect():
        best[b] = n
    least, more = _frequent(counts, most)
    frequent = counts.filter(F.col("n") >= least).select((F.col("a").cast("long") * (1 << 20) + F.col("b")).alias("code"), "n")
    table = frequent.toArrow()
    codes, links = (table.column(c).to_numpy().astype(np.int64) for c in ("code", "n"))
    order = np.argsort(codes)
    shared = spark.sparkContext.broadcast((codes[order], links[order], best))
    own = [f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema if f.name != "pairs"]
    schema = ", ".join([*own, "n_best bigint, count_sum bigint, pairs array<struct<a: int, b: int, n: int>>"])
    scored = _looked_up(found, shared, schema)
    if not more:
        return scored.drop("pairs")
    # Equal groups have equal pairs, so the rest is looked up once for each digest.
    scored, rows = write_counted(scored, "frequent-pairs")
    rare = counts.filter(F.col("n") < least).join(best_of, "b")
    rest = (
        scored.filter(F.size("pairs") > 0)
        .groupBy("groups_sha256")
        .agg(F.any_value("pairs").alias("pairs"))
        .select("groups_sha256", F.inline("pairs"))
        .withColumnRenamed("n", "links")
        .join(rare, ["a", "b"])
        .groupBy("groups_sha256")
        .agg(
            F.sum(F.when(F.col("n") == F.col("best"), F.col("links")).otherwise(0)).alias("more_best"),
            F.sum(F.col("n") * F.col("links")).alias("more_sum"),
        )
    )
    joined = join_hot(scored.drop("pairs"), write_stage(rest, "rare-pairs"), "groups_sha256", "left", rows)
    return joined.select(
        *[c for c in found.columns if c != "pairs"],
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
    )


def alignment_counts(df: DataFrame, key: str, text: str, a: str, b: str, most: int = PAIRS) -> DataFrame:
    """Per row ``key``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups_sha256`` (empty
    without tokens), ``n_best`` and ``count_sum``."""
    found = write_stage(summaries(df, key, text, a, b), "alignments")
    counts = write_stage(pair_counts(found), "pair-counts")
    return with_pair_counts(found, counts, most)
