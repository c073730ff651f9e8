"""Targets, the splitting tree, and the words taken against a plain count."""

from collections import Counter, defaultdict

import numpy as np
import pytest

from sftpipe.llm import mixing


def words(text):
    return len((text or "").encode().split())


def test_capped_targets():
    assert mixing.capped_targets([100, 100, 100], [5, 2, 1], 450) == [200, 500 / 3, 250 / 3]
    assert mixing.capped_targets([10, 1000], [5, 1], 1500) == [20, 1480]
    assert mixing.capped_targets([0, 10], [5, 2], 15) == [0, 15]
    assert mixing.capped_targets([], [], 0) == []
    draw = np.random.default_rng(1)
    for _ in range(100):
        sizes = draw.integers(0, 1000, 12).tolist()
        weights = [mixing.WEIGHTS[i % 3] for i in range(12)]
        total = 1.5 * sum(sizes)
        targets = mixing.capped_targets(sizes, weights, total)
        assert sum(targets) == pytest.approx(total)
        free = [t / w for t, w, s in zip(targets, weights, sizes) if t < 2 * s]
        assert all(t <= 2 * s for t, s in zip(targets, sizes))
        assert max(free, default=0) == pytest.approx(min(free, default=0))
        # A capped source would get no more by weight than the others.
        assert all(t / w <= max(free, default=np.inf) + 1e-9 for t, w in zip(targets, weights))


@pytest.mark.parametrize("shards", [1, 2, 5, 16])
def test_splitting_tree_is_exact_and_even(shards):
    quotas = [7, 0, 120, 1, 33]
    found = mixing.split_quotas(quotas, shards, seed=3)
    assert found.sum(axis=0).tolist() == quotas and (found >= 0).all()
    assert found.sum(axis=1).max() - found.sum(axis=1).min() <= 1
    assert (found == mixing.split_quotas(quotas, shards, seed=3)).all()


def test_splitting_tree_is_hypergeometric():
    draws = np.array([mixing.split_quotas([40, 20, 40], 2, seed)[0] for seed in range(400)])
    assert np.allclose(draws.mean(axis=0), [20, 10, 20], atol=0.5)
    # n K/N (N-K)/N (N-n)/(N-1)
    assert np.allclose(draws.var(axis=0), [50 * 0.4 * 0.6 * 50 / 99, 50 * 0.2 * 0.8 * 50 / 99, 50 * 0.4 * 0.6 * 50 / 99], rtol=0.3)


@pytest.mark.parametrize("block_words", [mixing.BLOCK_WORDS, 50])
def test_odd_rows(odd_docs, odd_rows, block_words):
    def run():
        return mixing.mix(odd_docs, "doc_id", "text", "source", block_words=block_words, shards=4).plan.collect()

    found = run()
    assert Counter((r.doc_id, r["size"], r.source) for r in found) == Counter((i, words(t), s) for i, t, _, s in odd_rows)
    sizes = defaultdict(int)
    for _, text, _, source in odd_rows:
        sizes[source] += words(text)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = mixing.capped_targets([sizes[s] for s in order], [mixing.WEIGHTS[i % 3] for i in range(len(order))], 1.5 * sum(sizes.values()))
    taken = defaultdict(int)
    for r in found:
        assert 0 <= r.taken <= 2 * r["size"] and r.taken == sum(d.words for d in r.draws)
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[order.index(r.source)])
        taken[r.source] += r.taken
    assert {s: taken[s] for s in order} == {s: round(t) for s, t in zip(order, targets)}
    key = lambda r: repr((r.doc_id, r["size"], r.source, r.taken, sorted(r.draws)))
    assert sorted(map(key, found)) == sorted(map(key, run()))
    assert {d.shard for r in found for d in r.draws} <= set(range(4))


def test_mixed_rows_are_what_the_plan_draws(odd_docs, odd_rows):
    rows = mixing.mixed_rows(odd_docs, "doc_id", "text", "source")
    assert rows.columns == odd_docs.columns
    found = rows.collect()
    plan = mixing.mix(odd_docs, "doc_id", "text", "source").plan.collect()
    assert len(found) == sum(len(r.draws) for r in plan)
    assert sum(words(r.text) for r in found) == sum(r.taken for r in plan)
    whole = {(i, t) for i, t, *_ in odd_rows}
    cut = [r for r in found if (r.doc_id, r.text) not in whole]
    assert len(cut) <= 4
    for r in cut:
        assert any((t or "").startswith(r.text) for i, t in whole if i == r.doc_id)


def test_shards_grow_with_the_mix(odd_docs, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 1_000)
    found = mixing.mix(odd_docs, "doc_id", "text", "source", block_words=100).plan.collect()
    words_of = Counter()
    for r in found:
        for d in r.draws:
            words_of[d.shard] += d.words
    assert mixing.LEAST_SHARDS < max(words_of) < sum(words_of.values()) // 1_000


def test_empty_table(no_docs):
    assert mixing.mix(no_docs, "doc_id", "text", "source").plan.collect() == []
    assert mixing.mixed_rows(no_docs, "doc_id", "text", "source").collect() == []
