"""Against the similarity of all pairs of texts in plain Python."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sftpipe.llm import near_jaccard


def shingle_set(text):
    words = text.encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def classes(texts):
    """The first index reachable of each text, all pairs compared."""
    found = [shingle_set(t) for t in texts]
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if 5 * len(found[a] & found[b]) >= 4 * len(found[a] | found[b]) and root[a] != root[b]:
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = [new if r == old else r for r in root]
    return root


def planted(seed):
    """Texts, and copies of them with some words changed: similarities from 0.5 to 1."""
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    passage = draw.choices(words, k=30)
    texts = []
    for i in range(60):
        text = draw.choices(words, k=draw.choice((4, 6, 12, 40, 90, 300)))
        if i % 3 == 0:
            text[2:2] = passage
        texts.append(text)
        for _ in range(i % 4):
            text = list(text)
            for _ in range(draw.randint(1, max(1, len(text) // 25))):
                text[draw.randrange(len(text))] = draw.choice(words)
            texts.append(text)
    hub = draw.choices(words, k=200)
    for i in range(60):
        texts.append([*hub[: 199 - i % 7], f"own{i}", *hub[199 - i % 7 :]])
    draw.shuffle(texts)
    return [" ".join(t) for t in texts] + ["", " \n", "one", "One", "one two three four", "one two three five"]


@pytest.mark.parametrize("sizes", [{}, {"bucket_rows": 8, "group_hashes": 2000, "broadcast_rows": 0}])
def test_groups_are_those_of_all_pairs(spark, sizes):
    texts = planted(1)
    wanted = classes(texts)
    assert len(set(wanted)) < len(texts) - 60
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    found = dict(near_jaccard.near_groups(docs, "doc_id", "text", **sizes).collect())
    assert [found[i] for i in range(len(texts))] == wanted


def test_stage_drops_planted_near_copies(spark):
    texts = planted(2)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(set(classes(texts)))


def test_odd_rows(odd_docs, odd_rows):
    root = classes([r[1] or "" for r in odd_rows])
    least = {}
    for r, c in zip(odd_rows, root):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    wanted = Counter((r[0], least.get(c)) for r, c in zip(odd_rows, root))
    assert Counter(map(tuple, near_jaccard.near_groups(odd_docs, "doc_id", "text").collect())) == wanted
    stays = {r[0] for r, c in zip(odd_rows, root) if r[0] is not None and r[0] == least[c]}
    ids = Counter(r.doc_id for r in near_jaccard.near_dedup(odd_docs, "doc_id", "text").collect())
    assert ids[None] == 3 and {i for i in ids if i is not None} == stays


def test_prefixes_of_similar_sketches_meet():
    """Sets around the size of a sketch; common hashes are the most frequent ones, so they come last."""
    draw = np.random.default_rng(5)
    hashes = lambda n: draw.integers(0, 1 << 63, n, dtype=np.uint64)
    for n in (1, 4, 5, 30, 100, 102, 103, 120, 128, 130, 160, 600, 4000):
        for _ in range(40):
            common = hashes(n)
            sides = [np.unique(np.r_[common, hashes(n // 8)]), np.unique(np.r_[common, hashes(n // 4 - n // 8)])]
            low = [s[: near_jaccard.KEYS] for s in sides]
            both = np.intersect1d(*low)
            for s, sketch in zip(sides, low):
                k = len(sketch)
                taken = len(s) // 5 + 1 if 5 * len(s) < 4 * near_jaccard.KEYS else k - near_jaccard.COMMON + 1
                assert k - len(both) < taken


def test_prefix_size(spark):
    sizes = (0, 1, 4, 5, 102, 103, 127, 128, 129, 5000)
    found = spark.createDataFrame([(n,) for n in sizes], "n int").select(near_jaccard.prefix_size(F.col("n"))).collect()
    keys, common = near_jaccard.KEYS, near_jaccard.COMMON
    assert [r[0] for r in found] == [n // 5 + 1 if 5 * n < 4 * keys else min(n, keys) - common + 1 for n in sizes]


def test_a_shared_passage_makes_no_buckets(spark):
    """Unlike texts with 40 of their 65 words in common are never compared."""
    draw = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [f"{' '.join(f'w{draw.randrange(10**6)}' for _ in range(25))} {passage}" for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    points = near_jaccard.sketches(docs, "doc_id", "text")
    assert near_jaccard.bucket_entries(points, 400 * 61).count() == 0
    assert near_jaccard.bucket_entries(points, 400 * 61, 0).count() == 0


def test_bits_of_similar_sets_are_within_the_radius():
    draw = np.random.default_rng(3)
    for n in (4, 8, 12, 40, 400):
        for _ in range(200):
            own = np.unique(draw.integers(0, 1 << 63, n, dtype=np.uint64))
            other = np.unique(np.concatenate([own, draw.integers(0, 1 << 63, n // 4, dtype=np.uint64)]))
            differ = np.bitwise_count(near_jaccard.simhash(own) ^ near_jaccard.simhash(other)).sum()
            assert differ <= near_jaccard.RADIUS


def test_empty_table(no_docs):
    assert near_jaccard.near_groups(no_docs, "doc_id", "text").collect() == []
    assert near_jaccard.near_dedup(no_docs, "doc_id", "text").collect() == []
