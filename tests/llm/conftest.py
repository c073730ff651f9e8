import random

import pytest

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    # Names that the operators use themselves.
    "`key` string, `row` int, name string, fp string, label string, shard int, spans string, "
    "fingerprint string, draws int, good string, host string, path string, evidence string, "
    "held_out string, level string, bytes string, size int, place string, `order` int, run int"
)
WORDS = "the of and to in that was for with his they are this have from one had not but what".split()


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(["", "", ",", "er", "ing"]) for _ in range(words))


def texts() -> list[tuple]:
    """(doc_id, text, lang, source): ordinary rows, copies, nulls, ties, empty and long texts."""
    long_text = prose(99, 30_000)
    rows = [(i, prose(i, 20 + i), "en", f"s{i % 3}") for i in range(20)]
    rows += [(100 + i, rows[3][1], "en", "s0") for i in range(6)]
    rows += [(110, rows[5][1] + " end", "en", "s1"), (111, rows[5][1], None, None)]
    rows += [(120, None, "en", "s1"), (121, "", "en", "s2"), (122, " \t\n", None, "s2"), (123, None, None, None)]
    rows += [(None, "no id", "en", "s0"), (None, None, None, None), (None, rows[3][1], "en", None)]
    rows += [(130, "same row", "en", "s0")] * 2 + [(140, "one", "en", "s1"), (140, "two", "en", "s1")]
    rows += [(150, long_text, "en", "s0"), (151, long_text, "en", "s1"), (152, long_text + "!", "en", "s1")]
    rows += [(160, "x" * 100_000, None, "s2"), (161, "é漢字🙂 \x00\x85 ok", "zz", "ü"), (-5, "Ünder Zero", "de", "s1")]
    return rows


@pytest.fixture(scope="session")
def odd_rows():
    return texts()


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    rows = [(*r, len(r[1] or ""), "k", 1, *["c"] * 3, 2, "s", "f", 3, *["c"] * 6, "b", 4, "p", 5, 6) for r in odd_rows]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
