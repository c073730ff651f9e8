"""Against links of all token pairs in plain Python."""

import hashlib
import random
from collections import Counter
from functools import lru_cache

import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from sftpipe.llm import token_alignment
from sftpipe.llm.queries import BYTE_TOKENS, PIECE_TOKENS

TEXTS = [
    "One two  three\n\tfour, isn't it? ",
    " leading and trailing  ",
    "naïve café 漢字かな 🙂🙂 é",
    "a reader sees ▁ as itself",
    "<|endoftext|> </s> <s> <0x41> <unk>",
    "x" * 300 + " " + "ab " * 90,
    "\x00\x01 \x85  \xa0z",
    "",
    " ",
    None,
    "one two three",
    "one two three",
]


@lru_cache
def both():
    a = Tokenizer.from_file(BYTE_TOKENS)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=PIECE_TOKENS)


def spans(parts):
    at, found = 0, []
    for part in parts:
        found.append((at, at + len(part)))
        at += len(part)
    return found


def tokens(text):
    """Ids and byte spans by A and B; nothing for texts that do not come back."""
    if not text:
        return [], [], [], []
    a, b = both()
    character = token_alignment.byte_characters()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(character[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [
        bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b
    ]
    wanted = (" " + text).encode()
    if b"".join(bytes_a) != wanted or b"".join(bytes_b) != wanted:
        return [], [], [], []
    return ids_a, ids_b, spans(bytes_a), spans(bytes_b)


def aligned(text):
    """Ids, links of all overlapping pairs, and the groups between common ends."""
    ids_a, ids_b, spans_a, spans_b = tokens(text)
    links = [(i, j) for i, x in enumerate(spans_a) for j, y in enumerate(spans_b) if x[0] < y[1] and y[0] < x[1]]
    ends = sorted({x[1] for x in spans_a} & {y[1] for y in spans_b})
    groups = [
        ([i for i, x in zip(ids_a, spans_a) if s < x[1] <= e], [j for j, y in zip(ids_b, spans_b) if s < y[1] <= e])
        for s, e in zip([0, *ends], ends)
    ]
    return ids_a, ids_b, links, groups


def wanted_rows(rows):
    """(key, text) to the columns of ``alignment_counts``."""
    found = [(key, *aligned(text)) for key, text in rows]
    counts = Counter((a[i], b[j]) for _, a, b, links, _ in found for i, j in links)
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(n, best.get(j, 0))
    out = Counter()
    for key, a, b, links, groups in found:
        pairs = [(a[i], b[j]) for i, j in links]
        text = ";".join("|".join(",".join(map(str, side)) for side in group) for group in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if text else ""
        n_best = sum(counts[p] == best[p[1]] for p in pairs)
        out[(key, len(a), len(b), len(groups), len(pairs), digest, n_best, sum(counts[p] for p in pairs))] += 1
    return out


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(7)
    words = "".join(t or "" for t in TEXTS).split() + ["and", "the", "über", "12.5", "漢", "don't"]
    made = [" ".join(draw.choices(words, k=draw.randint(1, 40))) for _ in range(40)]
    return list(enumerate(TEXTS + made)) + [(None, made[0]), (3, made[1])]


@pytest.mark.parametrize("most", [token_alignment.PAIRS, 300, 0])
def test_counts_are_those_of_all_pairs(spark, rows, most):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = token_alignment.alignment_counts(docs, "doc_id", "text", BYTE_TOKENS, PIECE_TOKENS, most)
    assert found.columns == "doc_id n_a n_b n_groups n_links groups_sha256 n_best count_sum".split()
    assert Counter(map(tuple, found.collect())) == wanted_rows(rows)


@pytest.mark.parametrize("part", [token_alignment.PART_TOKENS, 1, 20])
@pytest.mark.parametrize("cuts", [True, False])
def test_parts_and_pieces_change_nothing(rows, part, cuts, monkeypatch):
    monkeypatch.setattr(token_alignment, "PART_TOKENS", part)
    monkeypatch.setattr(token_alignment, "KNOWN_CHARS", 100)
    codec = token_alignment.Tokenizers(BYTE_TOKENS, PIECE_TOKENS)
    codec.cuts = codec.cuts and cuts
    encoder = token_alignment.Encoder(codec)
    texts = [t or "" for _, t in rows]
    for some in ([], texts[:3], texts[20:30], texts):
        found = token_alignment.align_texts(encoder, some)
    texts = token_alignment.group_texts(found)
    for at, (_, text) in enumerate(rows):
        ids_a, ids_b, links, groups = aligned(text)
        assert found.a[found.of_a[at] : found.of_a[at + 1]].tolist() == ids_a
        assert found.b[found.of_b[at] : found.of_b[at + 1]].tolist() == ids_b
        own = slice(found.of_links[at], found.of_links[at + 1])
        pairs = zip((found.links_a[own] - found.of_a[at]).tolist(), (found.links_b[own] - found.of_b[at]).tolist())
        assert list(pairs) == links
        assert texts[at] == ";".join("|".join(",".join(map(str, side)) for side in group) for group in groups)


def test_links_and_cuts_as_columns(spark, rows):
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id bigint, text string").repartition(3)
    found = token_alignment.alignments(docs, "doc_id", "text", BYTE_TOKENS, PIECE_TOKENS).collect()
    assert len(found) == len(rows)
    for r in found:
        ids_a, ids_b, links, groups = aligned(rows[r.doc_id][1])
        assert (r.a, r.b, [tuple(x) for x in r.links]) == (ids_a, ids_b, links)
        ends, at = [], (0, 0)
        for a, b in groups:
            at = at[0] + len(a), at[1] + len(b)
            ends.append(at)
        assert [tuple(x) for x in r.cuts] == ends


def test_odd_rows(odd_docs, odd_rows):
    short = [(r[0], r[1]) for r in odd_rows if len(r[1] or "") < 2000]
    found = token_alignment.summaries(odd_docs, "doc_id", "text", BYTE_TOKENS, PIECE_TOKENS).collect()
    assert len(found) == len(odd_rows)
    wanted = Counter((k, *map(len, aligned(t)[:2])) for k, t in short)
    assert not wanted - Counter((r.doc_id, r.n_a, r.n_b) for r in found)
    long = {r.doc_id: r for r in found if r.doc_id in (150, 151, 160)}
    text = dict((r[0], r[1]) for r in odd_rows)
    for key, r in long.items():
        ids_a, ids_b, spans_a, spans_b = tokens(text[key])
        assert (r.n_a, r.n_b) == (len(ids_a), len(ids_b))
        assert r.n_groups == len({x[1] for x in spans_a} & {y[1] for y in spans_b})
    assert long[150].groups_sha256 == long[151].groups_sha256


def test_empty_table(no_docs):
    assert token_alignment.alignment_counts(no_docs, "doc_id", "text", BYTE_TOKENS, PIECE_TOKENS).collect() == []
