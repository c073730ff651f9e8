"""Against all pairs of fingerprints in plain Python."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from sftpipe.llm import simhash_vp
from sftpipe.llm.components import components


def slow_fingerprint(text):
    words, current = [], ""
    for c in text:
        if c in " \t\n\v\f\r":
            words.append(current)
            current = ""
        else:
            current += chr(ord(c) + 32) if "A" <= c <= "Z" else c
    words = [w for w in [*words, current] if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(points, threshold):
    """Smallest point reachable of each point, all pairs compared."""
    label = {p: p for p in points}
    changed = True
    while changed:
        changed = False
        for a in points:
            for b in points:
                if (a ^ b).bit_count() <= threshold and label[a] < label[b]:
                    label[b] = label[a]
                    changed = True
    return label


def test_fingerprints():
    for text in ("", " \n", "one", "One two three", "a b c d e f g", "É a b c d", "x " * 300):
        assert simhash_vp.fingerprint(text) == slow_fingerprint(text)


def clustered(n, seed):
    """Distinct fingerprints: some at random, some in chains of near ones."""
    draw = random.Random(seed)
    points = {draw.getrandbits(64) for _ in range(n // 2)} | {0, (1 << 64) - 1}
    at = draw.getrandbits(64)
    while len(points) < n:
        for _ in range(draw.choice((1, 2, 4, 5))):
            at ^= 1 << draw.randrange(64)
        points.add(at)
    return sorted(points)


@pytest.mark.parametrize("trees,leaf_rows", [(None, 2048), (None, 8), (2, 64), (1, 2048), (3, 16)])
def test_links_connect_what_all_pairs_connect(spark, trees, leaf_rows):
    points = clustered(160, 3)
    signed = [simhash_vp._signed(p) for p in points]
    df = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    links = simhash_vp.links(df, 4, trees, leaf_rows)
    for a, b in links.collect():
        assert a in signed and b in signed
    label = dict(components(links).collect())
    groups = {}
    for p, s in zip(points, signed):
        groups.setdefault(label.get(s, s), set()).add(p)
    wanted = {}
    for p, root in classes(points, 4).items():
        wanted.setdefault(root, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_local_components_are_exact():
    points = np.array(clustered(300, 5), np.uint64)
    at, root = simhash_vp.local_components(points, 4)
    found = {int(p): int(p) for p in points} | {int(points[i]): int(points[r]) for i, r in zip(at, root)}
    assert found == classes([int(p) for p in points], 4)


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    rows = [*chain, *star, (100, 101), (7, 7), (500, 500), (-3, -9)]
    found = dict(components(spark.createDataFrame(rows, "a bigint, b bigint")).collect())
    assert found == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, -3: -9, -9: -9}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_odd_rows(odd_docs, odd_rows):
    rows = [(r[0], slow_fingerprint(r[1] or "")) for r in odd_rows if len(r[1] or "") < 10_000]
    docs = odd_docs.filter("coalesce(length(text), 0) < 10000")
    label = classes(sorted({fp for _, fp in rows}), 4)
    least = {}
    for doc_id, fp in rows:
        if doc_id is not None:
            least[label[fp]] = min(least.get(label[fp], doc_id), doc_id)
    wanted = Counter((i, f"{fp:016x}", least.get(label[fp])) for i, fp in rows)
    assert Counter(map(tuple, simhash_vp.near_groups(docs, "doc_id", "text").collect())) == wanted


def test_dedup_keeps_the_smallest_key(odd_docs):
    kept = simhash_vp.near_dedup(odd_docs, "doc_id", "text")
    assert kept.columns == odd_docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    groups = simhash_vp.near_groups(odd_docs, "doc_id", "text").collect()
    assert ids[None] == 3
    assert {i for i in ids if i is not None} == {g.component_id for g in groups if g.component_id is not None}


def test_empty_table(no_docs):
    assert simhash_vp.near_groups(no_docs, "doc_id", "text").collect() == []
    assert simhash_vp.near_dedup(no_docs, "doc_id", "text").collect() == []
