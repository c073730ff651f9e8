"""Against groups of equal texts in plain Python."""

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sftpipe.llm import exact_names


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        kept = [i == keep for i in ids]
        first = kept.index(True)
        kept = [k and n == first for n, k in enumerate(kept)]
        out.update((i, keep, len(ids), k, digest) for i, k in zip(ids, kept))
    return out


@pytest.mark.parametrize("block_bytes", [exact_names.BLOCK_BYTES, 7])
def test_odd_rows(odd_docs, odd_rows, block_bytes):
    rows = [r for r in odd_rows if len(r[1] or "") < 1000] if block_bytes == 7 else odd_rows
    docs = odd_docs.filter(F.length(F.coalesce("text", F.lit(""))) < 1000) if block_bytes == 7 else odd_docs
    found = exact_names.exact_groups(docs, "doc_id", "text", block_bytes)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(map(tuple, found.collect())) == expected(rows)


def test_shared_digests_are_found_and_named_anew(spark):
    rows = [(i, t) for i, t in enumerate(["aa", "ab", "ba", "ab", "c", "d", "aaaa", "aaab"])]
    weak = lambda block: F.octet_length(block)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = exact_names.exact_groups(docs, "doc_id", "text", 2, [weak, exact_names.DIGESTS[1]])
    assert Counter(map(tuple, found.collect())) == expected(rows)
    with pytest.raises(ValueError, match="share every digest"):
        exact_names.exact_groups(docs, "doc_id", "text", 2, [weak])


def test_blocks_in_another_order_are_another_text(spark):
    rows = [(1, "aabb"), (2, "bbaa"), (3, "aabbaa"), (4, "aabbaabb"), (5, "aabb"), (6, "aa"), (7, "aaaa")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = exact_names.exact_groups(docs, "doc_id", "text", 2)
    assert Counter(map(tuple, found.collect())) == expected(rows)


def test_dedup_keeps_one_row_of_each_text(odd_docs, odd_rows):
    kept = exact_names.exact_dedup(odd_docs, "doc_id", "text")
    assert kept.columns == odd_docs.columns
    found = Counter((r.doc_id, r.text or "") for r in kept.collect())
    wanted = {}
    for doc_id, text, *_ in odd_rows:
        old = wanted.get(text or "")
        wanted[text or ""] = doc_id if old is None else old if doc_id is None else max(old, doc_id)
    assert found == Counter((i, t) for t, i in wanted.items())


def test_empty_table(no_docs):
    assert exact_names.exact_groups(no_docs, "doc_id", "text").collect() == []
    assert exact_names.exact_dedup(no_docs, "doc_id", "text").collect() == []


def test_no_python_in_the_plan(odd_docs):
    plan = exact_names.exact_groups(odd_docs, "doc_id", "text")._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
