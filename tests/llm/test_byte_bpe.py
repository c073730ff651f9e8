"""Against the tiktoken library and an exact round trip."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

from sftpipe.llm import byte_bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def codec(ranks):
    return byte_bpe.Codec(byte_bpe.sentencepiece_model(ranks), PATTERN)


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_every_token_is_its_own_encoding(ranks, codec):
    pieces = [byte_bpe.as_piece(token) for token in ranks]
    assert codec.model.encode(pieces) == [[rank] for rank in ranks.values()]


def test_white_space_and_marks_at_random(codec, reference):
    draw = random.Random(4)
    letters = " \n\t  \r\x1c\x85 ab1,'sté漢　٣\x00🙂"
    for _ in range(5000):
        text = "".join(draw.choice(letters) for _ in range(draw.randint(0, 12)))
        assert codec.encode(text) == reference.encode_ordinary(text), repr(text)
        assert codec.decode(codec.encode(text)).decode() == text


def test_known_pieces_do_not_change_results(codec, reference, monkeypatch):
    for most in (1, 1000, byte_bpe.CACHE_BYTES):
        monkeypatch.setattr(byte_bpe, "CACHE_BYTES", most)
        for text in ("a b c d e f a b", "x" * 500 + " y " + "x" * 500, "a b", " lead", "trail ", " ", "a  b"):
            assert codec.encode(text) == reference.encode_ordinary(text)
            assert codec.known_bytes <= most and not any(len(p) > byte_bpe.CACHE_CHARS for p in codec.known)
    assert codec.known
    monkeypatch.setattr(byte_bpe, "CACHE_BYTES", 1)
    assert codec.encode("a b c") == reference.encode_ordinary("a b c") and codec.older and not codec.known
    assert codec.encode("a b c") == reference.encode_ordinary("a b c")
    codec.forget()
    assert not codec.known and not codec.older and not codec.known_bytes


def test_a_task_leaves_nothing_behind(ranks):
    model = byte_bpe.sentencepiece_model(ranks)
    with byte_bpe._codec(model, PATTERN) as codec:
        codec.encode("one two three")
        assert codec.known
    assert not codec.known


def test_odd_rows(spark, odd_docs, odd_rows, reference):
    found = byte_bpe.round_trip_digests(odd_docs, "doc_id", "text", PATH, PATTERN).collect()

    def expected(row):
        text = row[1] or ""
        ids = reference.encode_ordinary(text)
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        return row[0], len(ids), digest, hashlib.sha256(text.encode()).hexdigest()

    assert Counter(map(tuple, found)) == Counter(map(expected, odd_rows))


def test_encode_then_decode(spark, odd_docs, odd_rows):
    ids = byte_bpe.encode(odd_docs, "doc_id", "text", PATH, PATTERN)
    back = byte_bpe.decode(ids, "doc_id", "ids", PATH, PATTERN).collect()
    assert Counter((r.doc_id, bytes(r.bytes)) for r in back) == Counter((r[0], (r[1] or "").encode()) for r in odd_rows)


def test_empty_table(no_docs):
    assert byte_bpe.round_trip_digests(no_docs, "doc_id", "text", PATH, PATTERN).collect() == []


def test_gaps_and_missing_bytes_are_refused():
    with pytest.raises(ValueError, match="gaps"):
        byte_bpe.sentencepiece_model({b"a": 0, b"b": 2})
    with pytest.raises(ValueError, match="no token"):
        byte_bpe.sentencepiece_model({b"a": 0})
