"""Posteriors against plain Python; held-out accuracy of the classifier."""

import math
import random

import numpy as np
import pytest

from sftpipe.llm import quality_eb as qe


def plain_posteriors(rows):
    """rows: (key, host, path, good, evidence). The same definitions, group by group."""
    value = [g if g is not None else 1 / (1 + math.exp(-e)) for *_, g, e in rows]
    known = [g for *_, g, _ in rows if g is not None]
    learned = min(max(np.mean(known), qe.EPSILON), 1 - qe.EPSILON) if known else 0.5
    rate = np.mean(value)

    def weight(groups, centers):
        n, k = sum(map(len, groups)), len(groups)
        if k < 2 or n <= k:
            return qe.MOST_WEIGHT
        between = sum(len(g) * (np.mean(g) - c) ** 2 for g, c in zip(groups, centers)) / (k - 1)
        inside = max(sum(((np.array(g) - np.mean(g)) ** 2).sum() for g in groups) / (n - k), 1e-12)
        size = (n - sum(len(g) ** 2 for g in groups) / n) / (k - 1)
        share = (between - inside) / (between + (size - 1) * inside)
        return min(max(1 / share - 1, qe.LEAST_WEIGHT), qe.MOST_WEIGHT) if share > 0 else qe.MOST_WEIGHT

    hosts, paths = {}, {}
    for (_, h, p, *_), y in zip(rows, value):
        hosts.setdefault(h, []).append(y)
        paths.setdefault((h, p), []).append(y)
    host_weight = weight(list(hosts.values()), [rate] * len(hosts))
    path_weight = weight(list(paths.values()), [np.mean(hosts[h]) for h, _ in paths])
    out = {}
    for (key, h, p, _, e), y in zip(rows, value):
        host = (sum(hosts[h]) - y + host_weight * rate) / (len(hosts[h]) - 1 + host_weight)
        path = (sum(paths[h, p]) - y + path_weight * host) / (len(paths[h, p]) - 1 + path_weight)
        safe = min(max(path, qe.EPSILON), 1 - qe.EPSILON)
        odds = e - math.log(learned / (1 - learned)) + math.log(safe / (1 - safe))
        out[key] = (host, path, 1 / (1 + math.exp(-odds)))
    return out


@pytest.mark.parametrize("labelled", [True, False])
def test_posteriors(spark, labelled):
    draw = random.Random(8)
    rows = []
    for i in range(300):
        host = draw.choice(["a", "a", "a", "b", "c", None])
        path = draw.choice(["x", "y", None])
        good = float(draw.random() < (0.9 if host == "a" else 0.3)) if labelled and draw.random() < 0.6 else None
        rows.append((i, host, path, good, draw.gauss(0.5, 2)))
    df = spark.createDataFrame(rows, "key bigint, host string, path string, good double, evidence double")
    found = {r.key: (r.host_rate, r.path_rate, r.posterior) for r in qe.posteriors(df).collect()}
    wanted = plain_posteriors(rows)
    assert found.keys() == wanted.keys()
    assert all(found[k] == pytest.approx(wanted[k], rel=1e-6) for k in found)


def test_sparse_sites_shrink_and_large_ones_do_not(spark):
    rows = [(i, "bad" if i < 200 else f"h{i % 40}", "p", float(i >= 200), 0.0) for i in range(1000)]
    rows.append((2000, "one", "p", 0.0, 0.0))
    df = spark.createDataFrame(rows, "key bigint, host string, path string, good double, evidence double")
    found = {r.key: r for r in qe.posteriors(df).collect()}
    assert found[0].path_rate < 0.1 < 0.5 < found[2000].path_rate < found[999].path_rate


def documents(n, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(draw.choice("abcdefghilmnoprstu") for _ in range(draw.randint(2, 9))) for _ in range(draw.randint(20, 80))]
        good = draw.random() < 0.8
        if not good:
            words = draw.choice([[w.upper() + "!!" for w in words], [w for w in words for _ in range(9)], [w + " |" for w in words], [w + "%%%" for w in words]])
        rows.append((i, " ".join(words), f"s{i % 5}", "en", int(good)))
    return rows


def test_held_out_accuracy_and_filter(spark):
    rows = documents(600)
    docs = spark.createDataFrame([r[:4] for r in rows], "doc_id bigint, text string, source string, lang string")
    labels = spark.createDataFrame([(r[0], r[4]) for r in rows[:300]], "doc_id bigint, quality int")
    found = {r.doc_id: r.kept for r in qe.classify(docs, "doc_id", "text", "source", "lang", labels).collect()}
    right = [found[i] == bool(good) for i, *_, good in rows[300:]]
    assert np.mean(right) > 0.97
    kept = qe.quality_filter(docs, "doc_id", "text", "source", "lang", labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, k in found.items() if k}


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (4, 1), (4, 0), (140, 1)], "doc_id bigint, quality int")
    found = qe.classify(odd_docs, "doc_id", "text", "source", "lang", labels).collect()
    assert sorted(repr(r.doc_id) for r in found) == sorted(repr(r[0]) for r in odd_rows)
    assert all(0 <= r.posterior <= 1 and r.kept == (r.posterior >= qe.KEEP) for r in found)
    kept = qe.quality_filter(odd_docs, "doc_id", "text", "source", "lang", labels)
    assert kept.columns == odd_docs.columns
    assert qe.classify(no_docs, "doc_id", "text", "source", "lang", labels).collect() == []


def test_without_labels_all_are_kept(spark, odd_docs, odd_rows):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    found = qe.classify(odd_docs, "doc_id", "text", "source", "lang", none).collect()
    assert len(found) == len(odd_rows) and all(r.kept and r.evidence == 0 for r in found)


def test_features_of_edge_texts():
    for text in ("", " ", "a", "é" * 10, "x" * 100_000, "\x00\n"):
        x = qe.features(text)
        assert len(x) == qe.FEATURES and np.isfinite(x).all()
