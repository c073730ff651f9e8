import hashlib
import random

from pyspark.sql import functions as F
from test_text import py_shingles

from sftpipe.functions.minhash import (
    BASE,
    PRIME,
    band_keys,
    band_shape,
    minhash_signature,
    permutation_coefficients,
)


def py_signature(text, n):
    hashes = set()
    for s in py_shingles(text):
        h = 0
        for c in s:
            h = (h * BASE + ord(c)) % PRIME
        hashes.add(h)
    return [
        min((a * h + b) % 2**64 for h in hashes) >> 32 for a, b in permutation_coefficients(n)
    ]


def py_bands(text, bands, rows):
    minima = py_signature(text, bands * rows)
    return [
        hashlib.md5(
            ",".join(map(str, [i, *minima[i * rows : (i + 1) * rows]])).encode()
        ).digest()
        for i in range(bands)
    ]


def test_band_shape():
    assert band_shape(0.8, 64) == (5, 11)
    assert all(b * r <= 64 for b, r in (band_shape(t / 10, 64) for t in range(1, 10)))


def test_signature_equals_plain_python_across_blocks(spark):
    rng = random.Random(3)
    texts = ["", "ab", "abcde", "律师 律师 律师", "😀" * 7] + [
        "".join(rng.choices("abcd法律😀 ", k=n)) for n in (40, 5, 6, 900, 65_536, 65_537, 140_000, 40)
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    rows = sorted(
        df.select(
            "i",
            minhash_signature(F.col("s"), 16).alias("m"),
            band_keys(F.col("s"), 2, 4).alias("b"),
        ).collect()
    )
    for text, row in zip(texts, rows):
        assert row.m == py_signature(text, 16)
        assert [bytes(b) for b in row.b] == py_bands(text, 2, 4)


def test_null_stays_null(spark):
    df = spark.createDataFrame([(None,)], "s string")
    assert df.select(minhash_signature(F.col("s"), 4).alias("m")).first().m is None


def test_share_of_equal_minima_estimates_jaccard(spark):
    rng = random.Random(5)
    alphabet = [chr(0x4E00 + i) for i in range(3000)]
    pairs, want = [], []
    for i in range(20):
        base = rng.choices(alphabet, k=400)
        other = base[: 20 * i] + rng.choices(alphabet, k=400 - 20 * i)
        a, b = "".join(base), "".join(other)
        x, y = py_shingles(a), py_shingles(b)
        pairs.append((i, a, b))
        want.append(len(x & y) / len(x | y))
    rows = sorted(
        spark.createDataFrame(pairs, "i int, a string, b string")
        .select(
            "i",
            minhash_signature(F.col("a"), 512).alias("a"),
            minhash_signature(F.col("b"), 512).alias("b"),
        )
        .collect()
    )
    got = [sum(p == q for p, q in zip(r.a, r.b)) / 512 for r in rows]
    assert max(abs(g - w) for g, w in zip(got, want)) < 0.1
    assert abs(sum(got) - sum(want)) / len(want) < 0.02
