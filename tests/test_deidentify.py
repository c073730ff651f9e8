"""Identifiers against hand-made cases, checksums in plain Python and the standard HMAC."""

import hmac
import random

import pytest
from pyspark.sql import functions as F

from sftpipe.functions import identifiers as I
from sftpipe.operators import deidentify as D

SECRET = b"0123456789abcdef"


def name(kind, spelled):
    found = hmac.new(SECRET, f"{kind}:{spelled}".encode(), "sha256").hexdigest()[: I.PSEUDONYM_DIGITS]
    return f"[{kind}:{found.translate(str.maketrans('0123456789', 'ghijklmnop'))}]"


def check_character(born):
    weights = (7, 9, 10, 5, 8, 4, 2, 1, 6, 3, 7, 9, 10, 5, 8, 4, 2)
    return "10X98765432"[sum(int(d) * w for d, w in zip(born, weights)) % 11]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n // 10 + n % 10
    return total % 10 == 0


ID = "11010519900307001" + check_character("11010519900307001")
X = next(b for b in (f"11010519900307{n:03}" for n in range(100)) if check_character(b) == "X")
MOBILE, PHONE = name("mobile", "13912345678"), name("phone", "7435553824")
CARD, ADDRESS = name("card", "4111111111111111"), name("email", "a.b+c@mail5.example.com")
CASES = [
    (f"id {ID}.", f"id {name('resident_id', ID)}."),
    (f"身份证{X}x，", f"身份证{name('resident_id', X + 'X')}，"),
    (f"{X}X{X}X", f"{X}X{X}X"),
    ("id " + ID[:-1] + str((int(ID[-1].replace("X", "0")) + 1) % 10), None),
    ("no such day " + "11010519900230001" + check_character("11010519900230001"), None),
    ("no such place " + "10010519900307001" + check_character("10010519900307001"), None),
    ("no such century " + "11010518900307001" + check_character("11010518900307001"), None),
    ("4111 1111 1111 1111, 4111111111111111; 4111-1111-1111-1111 20", f"{CARD}, {CARD}; {CARD} 20"),
    ("4111 1111 1111 1112 x4111111111111111 4111111111111111x _4111111111111111", None),
    ("0000 0000 0000 0000", None),
    ("3782 822463 10005", name("card", "378282246310005")),
    ("+86 139 1234 5678;0086-13912345678;86 13912345678;13912345678", ";".join([MOBILE] * 4)),
    ("手机13912345678转", f"手机{MOBILE}转"),
    ("12345678901 139123456789 1391234567 213912345678", None),
    ("+1 (743) 555-3824, 743-555-3824, 743.555.3824, 1-743-555-3824, (743) 555-3824", ", ".join([PHONE] * 5)),
    ("911-555-3824 743-911-3824 143-555-3824 743-055-3824", None),
    ("010-62345678 0571 87654321", f"{name('phone', '01062345678')} {name('phone', '057187654321')}"),
    ("010-12345678 0123 87654321 0260-1234", None),
    ("A.b+c@Mail5.example.com, a.B+C@mail5.EXAMPLE.com.", f"{ADDRESS}, {ADDRESS}."),
    ("x@y, @a.bc a@.com a@b.c 5", None),
    ("from 10.0.0.255 or 10.0.0.256 or 300.1.1.1", f"from {name('ipv4', '10.0.0.255')} or 10.0.0.256 or 300.1.1.1"),
    ("\x01\x02\x03 13912345678\x01", f"\x01\x02\x03 {MOBILE}\x01"),
    ("", None),
    ("plain $1 \\1 text", None),
]


@pytest.fixture(scope="module")
def cases(spark):
    return spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)] + [(99, None)], "k int, text string")


def test_cases(cases):
    found = {r.k: r.text for r in D.deidentify(cases, ["text"], SECRET).collect()}
    assert found.pop(99) is None
    for i, (text, wanted) in enumerate(CASES):
        assert found[i] == (text if wanted is None else wanted)


def test_checksums_of_random_numbers(spark):
    draw = random.Random(1)
    cards = ["".join(draw.choices("0123456789", k=draw.randint(12, 20))) for _ in range(2000)]
    ids = [f"11010519{draw.randint(10, 99)}{draw.randint(1, 14):02}{draw.randint(1, 31):02}{draw.randint(0, 999):03}" for _ in range(2000)]
    ids = [b + draw.choice("0123456789Xx") for b in ids]
    found = spark.createDataFrame(list(zip(cards, ids)), "card string, id string").select(
        "*", I.is_card(F.col("card")).alias("is_card"), I.is_resident_id(F.col("id")).alias("is_id")
    )
    days = (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)
    for r in found.collect():
        assert r.is_card == (13 <= len(r.card) <= 19 and luhn(r.card) and len(set(r.card)) > 1)
        year, month, day = int(r.id[6:10]), int(r.id[10:12]), int(r.id[12:14])
        dated = month <= 12 and day <= days[month - 1] + (month == 2 and year % 4 == 0)
        assert r.is_id == (dated and check_character(r.id[:17]) == r.id[17].upper())


def test_pieces_joined_are_the_text(spark):
    draw = random.Random(2)
    parts = ["13912345678", "a@b.cd", "\x01", "\x02", "\x03", " ", "4111111111111111", "x", "1.2.3.4", "+1", "(743) 555-3824"]
    texts = ["".join(draw.choices(parts, k=12)) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select("text", I.pieces(F.col("text")).alias("found"))
    for r in df.collect():
        assert "".join(p.value for p in r.found) == r.text
        assert all(p.kind is None or i % 2 for i, p in enumerate(r.found))


def test_columns_counts_and_clashing_names(spark):
    df = spark.createDataFrame(
        [(1, "call 13912345678", "13912345678 or a@b.cd", "p"), (2, None, "none", "q"), (3, None, None, None)],
        "k int, question string, answer string, _pieces_0 string",
    )
    found = D.deidentify(df, ["question", "answer"], SECRET, counts="n").orderBy("k").collect()
    assert found[0].question == f"call {MOBILE}" and found[0].answer == f"{MOBILE} or {name('email', 'a@b.cd')}"
    assert {k: v for k, v in found[0].n.items() if v} == {"mobile": 2, "email": 1}
    assert set(found[1].n.values()) == set(found[2].n.values()) == {0} and found[2].answer is None
    assert [r._pieces_0 for r in found] == ["p", "q", None]
    rows = D.identifiers(df, "k", ["question", "answer"], SECRET)
    assert sorted((r.k, r.column, r.kind, r.place) for r in rows.collect()) == [
        (1, "answer", "email", 1), (1, "answer", "mobile", 0), (1, "question", "mobile", 0),
    ]
    assert {(r.kind, r.mentions) for r in D.mentions(rows).collect()} == {("mobile", 2), ("email", 1)}


def test_chosen_kinds(cases):
    found = {r.k: r.text for r in D.deidentify(cases, ["text"], SECRET, kinds=("email",)).collect()}
    for i, (text, wanted) in enumerate(CASES):
        assert found[i] == (wanted if wanted and "@" in text else text)


def test_other_secrets_give_other_names(cases):
    one, two = (D.identifiers(cases, "k", ["text"], s).select("pseudonym").distinct() for s in (SECRET, SECRET[::-1]))
    assert one.count() == two.count() > 5 and one.intersect(two).count() == 0


def test_nothing_is_found_in_the_result(cases):
    once = D.deidentify(cases, ["text"], SECRET)
    assert D.identifiers(once, "k", ["text"], SECRET).count() == 0
    assert D.deidentify(once, ["text"], SECRET).exceptAll(once).count() == 0


def test_refusals(cases):
    with pytest.raises(ValueError, match="unknown kinds"):
        D.deidentify(cases, ["text"], SECRET, kinds=("email", "name"))
    with pytest.raises(ValueError, match="16 to 64 bytes"):
        D.deidentify(cases, ["text"], b"short")


def test_no_shuffle_and_empty_table(spark, cases):
    done = D.deidentify(cases, ["text"], SECRET)
    assert "Exchange" not in done._jdf.queryExecution().executedPlan().toString()
    assert D.deidentify(cases.limit(0), ["text"], SECRET).collect() == []


def test_second_pass_reads_what_the_first_wrote(spark, tmp_path):
    from sftpipe.plans.checks import QUERIES
    from sftpipe.plans import cleaning_checks  # noqa: F401

    rows = [(1, "call 139 1234 5678", "en", "s", 18), (2, None, "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    found = QUERIES["identifiers_left"](spark, str(tmp_path))
    plan = found._jdf.queryExecution().analyzed().toString()
    assert "documents.parquet" not in plan and plan.count("sha2") == 2  # one pass of the HMAC's two hashes
    assert [r.left for r in found.collect()] == [0]


def test_replaced_texts_are_read_once_more(spark, tmp_path):
    from sftpipe.plans import cleaning_checks as C

    for name, texts in (("some", ["call 139 1234 5678", None, "", "x\x01y", ""]), ("none", [None, None])):
        path = f"{tmp_path}/{name}"
        rows = [(i // 2, t) for i, t in enumerate(texts)]  # ids repeat
        spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
        left = C.identifiers_left(spark, path)
        plan = left._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation") == 1 and "Join" not in plan
        assert left.dtypes == [("texts", "bigint"), ("chars", "bigint"), ("left", "bigint")]
        once = [r.text for r in D.deidentify(C._personal(spark, path), ["text"], C.SECRET).collect()]
        sizes = [len(t) for t in once if t is not None]
        assert [tuple(r) for r in left.collect()] == [(len(sizes), sum(sizes) if sizes else None, 0)]


def test_boundary_and_at_sign(spark):
    texts = ["x13912345678 13912345678x", "a.b@c@mail.example.com", "(743) 555-1234 +8613912345678", "a" * 70 + "@x.org"]
    cases = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k long, text string")
    found = D.identifiers(cases, "k", ["text"], b"0123456789abcdef")
    kinds = sorted((r.k, r.kind) for r in found.collect())
    assert kinds == [(1, "email"), (2, "mobile"), (2, "phone")]
