"""Byte-level BPE encoding and decoding through a sentencepiece model.

The model is not trained. It is serialised here from a rank file: each byte string
becomes a piece whose characters stand for its bytes, scored by its negative rank, with
the identity as normalisation. A sentencepiece BPE model joins the neighbours with the
highest score first, that is, of the lowest rank, which is the merge rule of the rank
file; a piece's place in the model is its rank, so the ids need no translation. Texts are
split by the tokenizer's pattern first and each match is encoded by itself.

Defined cases: a null or empty text has no ids and decodes to no bytes; texts of any
length are encoded whole; repeated rows give repeated rows; control strings in a text are
ordinary text; only the named key and text columns are read, so others cannot clash.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from sftpipe.llm.common import filled, map_texts

#: A byte's character in the pieces: no white space, no control character.
_SHIFT = 0x100
_TO_PIECE = {byte: byte + _SHIFT for byte in range(256)}
#: Bytes of the encodings that a task keeps for its next texts, in each of two generations, what an
#: entry takes besides its characters, and characters of a piece that is kept.
CACHE_BYTES, ENTRY_BYTES, CACHE_CHARS = 16 << 20, 200, 64
_SPACES = re.compile(r"\s\s")
_BLANK = re.compile(r"(?<=\S) (?=\S)")


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def as_piece(data: bytes) -> str:
    return data.decode("latin-1").translate(_TO_PIECE)


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and ranks of a rank file: base64, a blank, the rank."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece BPE model whose ids are the ranks.

    Ranks must run from 0 without gaps. The unknown piece, which the format asks for,
    comes last and is never used, as every byte is a piece.
    """
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must run from 0 without gaps")
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"no token for the bytes {missing}")
    score = lambda value: _varint(2 << 3 | 5) + struct.pack("<f", value)
    pieces = [_bytes(1, as_piece(t).encode()) + score(-rank) for rank, t in enumerate(tokens)]
    pieces.append(_bytes(1, b"<unk>") + score(-len(tokens)) + _number(3, 2))
    trainer = _number(3, 2) + _number(4, len(pieces)) + _number(40, len(tokens))
    trainer += b"".join(_varint(field << 3) + _varint((1 << 64) - 1) for field in (41, 42, 43))
    normalizer = _bytes(1, b"identity") + b"".join(_number(field, 0) for field in (3, 4, 5))
    return b"".join(_bytes(1, p) for p in pieces) + _bytes(2, trainer) + _bytes(3, normalizer)


def unicode_pattern(pattern: str) -> str:
    """The pattern with white space as Unicode names it.

    The ``regex`` library counts four more control characters in its own class.
    """
    return pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


class Codec:
    """Encoder and decoder over a serialised model; keeps what it has encoded before.

    No match of a pattern crosses a blank between two characters that are no white space,
    unless it begins there. So a text is cut at such blanks, and the ids of a piece, as
    text, serve for all its occurrences.
    """

    def __init__(self, model: bytes, pattern: str):
        import regex
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.find = regex.compile(unicode_pattern(pattern)).findall
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size() - 1)]
        self.bytes_of = {str(i): bytes(ord(c) - _SHIFT for c in p) for i, p in enumerate(pieces)}
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.known_bytes = 0

    def _keep(self, piece: str, ids: str) -> None:
        self.known[piece] = ids
        self.known_bytes += ENTRY_BYTES + len(piece) + len(ids)

    def _encoded(self, pieces: list[str]) -> list[str]:
        """Ids of each piece, joined by blanks; its pre-tokens are encoded one by one."""
        tokens = [self.find(p) for p in pieces]
        flat = [as_piece(t.encode()) for found in tokens for t in found]
        ids = iter(self.model.encode(flat, num_threads=1))
        return [" ".join([str(i) for _ in found for i in next(ids)]) for found in tokens]

    def encode_joined(self, text: str) -> str:
        """The ids of a text in decimal, joined by blanks."""
        if not text:
            return ""
        first, *rest = _BLANK.split(text) if _SPACES.search(text) else text.split(" ")
        # A blank at an end has no neighbour on one side.
        if not first:
            return self._encoded([text])[0]
        if rest and not rest[-1]:
            rest.pop()
            rest[-1:] = [rest[-1] + " "] if rest else []
            first = first if rest else first + " "
        known, older, long = self.known, self.older, {}
        if fresh := set(rest).difference(known):
            met = [p for p in fresh if p in older]
            for piece in met:
                self._keep(piece, older[piece])
            fresh = list(fresh.difference(met))
            for piece, ids in zip(fresh, self._encoded([" " + p for p in fresh])):
                if len(piece) > CACHE_CHARS:
                    long[piece] = ids
                else:
                    self._keep(piece, ids)
        ids_of = known.__getitem__ if not long else lambda p: long[p] if p in long else known[p]
        ids = " ".join([self._encoded([first])[0], *map(ids_of, rest)])
        if self.known_bytes > CACHE_BYTES:
            # What is not met again before the next generation is full is forgotten.
            self.known, self.older, self.known_bytes = {}, known, 0
        return ids

    def decode_joined(self, ids: str) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.split()))

    def encode(self, text: str) -> list[int]:
        return list(map(int, self.encode_joined(text).split()))

    def decode(self, ids: list[int]) -> bytes:
        return self.decode_joined(" ".join(map(str, ids)))


@lru_cache(maxsize=1)
def _loaded(model: bytes, pattern: str) -> Codec:
    return Codec(model, pattern)


@contextmanager
def _codec(model: bytes, pattern: str) -> Iterator[Codec]:
    """The worker's codec; what a task has it keep goes when the task ends."""
    codec = _loaded(model, pattern)
    try:
        yield codec
    finally:
        codec.forget()


def _shared_model(spark: SparkSession, vocabulary: str):
    """The model for the workers, read once by the driver; bounded by the vocabulary."""
    return spark.sparkContext.broadcast(sentencepiece_model(read_ranks(vocabulary)))


def encode(df: DataFrame, key: str, text: str, vocabulary: str, pattern: str) -> DataFrame:
    """``key`` and ``ids`` of every text."""
    model = _shared_model(df.sparkSession, vocabulary)

    def rows(batches: Iterator[dict]) -> Iterator[list[tuple]]:
        with _codec(model.value, pattern) as codec:
            for batch in batches:
                yield [(k, codec.encode(t)) for k, t in zip(batch["key"], batch["text"])]

    kind = df.schema[key].dataType.simpleString()
    read = df.select(df[key].alias("key"), filled(df[text]).alias("text"))
    return map_texts(read, f"`{key}` {kind}, ids array<int>", rows)


def decode(df: DataFrame, key: str, ids: str, vocabulary: str, pattern: str) -> DataFrame:
    """``key`` and the ``bytes`` that the ids stand for."""
    model = _shared_model(df.sparkSession, vocabulary)

    def rows(batches: Iterator[dict]) -> Iterator[list[tuple]]:
        with _codec(model.value, pattern) as codec:
            for batch in batches:
                yield [(k, codec.decode(i or [])) for k, i in zip(batch["key"], batch["ids"])]

    kind = df.schema[key].dataType.simpleString()
    read = df.select(df[key].alias("key"), df[ids].alias("ids"))
    return map_texts(read, f"`{key}` {kind}, bytes binary", rows)


def round_trip_digests(
    df: DataFrame, key: str, text: str, vocabulary: str, pattern: str
) -> DataFrame:
    """Token count and digests of the ids and of the bytes decoded from them, in one pass."""
    model = _shared_model(df.sparkSession, vocabulary)

    def digests(codec: Codec, value: str) -> tuple[int, str, str]:
        ids = codec.encode_joined(value)
        n_tokens = ids.count(" ") + 1 if ids else 0
        decoded = codec.decode_joined(ids)
        digest = hashlib.sha256(ids.encode()).hexdigest()
        return n_tokens, digest, hashlib.sha256(decoded).hexdigest()

    def rows(batches: Iterator[dict]) -> Iterator[list[tuple]]:
        with _codec(model.value, pattern) as codec:
            for batch in batches:
                yield [(k, *digests(codec, t)) for k, t in zip(batch["key"], batch["text"])]

    kind = df.schema[key].dataType.simpleString()
    read = df.select(df[key].alias("key"), filled(df[text]).alias("text"))
    schema = f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_texts(read, schema, rows)
