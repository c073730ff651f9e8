"""Personal identifiers in text: candidates by shape, validators by checksum and number plan.

All of it is column expressions. A candidate is a stretch of text with the shape of an
identifier; a validator decides what it is, so an order number of sixteen digits is no card
and an eighteen-digit number with a wrong check character is no resident id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Province codes of resident ids.
PROVINCES = (
    "11 12 13 14 15 21 22 23 31 32 33 34 35 36 37 41 42 43 44 45 46 50 51 52 53 54 61 62 63 64 65 71 81 82"
).split()
KINDS = ("resident_id", "mobile", "card", "email", "ipv4", "phone")
#: Hexadecimal digits of a pseudonym: 80 bits.
PSEUDONYM_DIGITS = 20
_HEX, _LETTERS = "0123456789abcdef", "ghijklmnopabcdef"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: No letter, digit or underscore of ASCII before or after, by the classes that are looked up.
_BEFORE, _AFTER = r"(?<!\w)", r"(?!\w)"
_MOBILE = r"1[3-9]\d(?:[ -]?\d{4}){2}"
#: The shapes that begin with a digit.
NUMBERS = (
    r"\d{1,3}(?:\.\d{1,3}){3}",
    r"[1-9]\d{16}[0-9Xx]",
    r"\d{4}(?:[ -]?\d{4}){2,3}(?:\d{1,3}|[ -]\d{3})?",
    r"\d{4}[ -]\d{6}[ -]\d{5}",
    r"(?:0086[ -]?|86[ -]?)?" + _MOBILE,
    r"(?:1[ .-])?\d{3}[.-]\d{3}[.-]\d{4}",
    r"0\d{2,3}[ -]\d{7,8}",
)
#: A name before an at sign, taken whole: it holds none, so no shorter one has it behind it.
EMAIL = r"\p{Alnum}[\w.%+-]{0,63}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}"
#: A leading plus or bracket needs no boundary before it.
SIGNED = (
    r"\+86[ -]?" + _MOBILE,
    r"\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}",
    r"\(\d{3}\) ?\d{3}[ .-]\d{4}",
)
#: First characters are told apart before any shape is tried: most of a text begins none.
CANDIDATE = (
    rf"(?:(?=\p{{Alnum}}){_BEFORE}(?:{EMAIL}|(?=\d)(?:{'|'.join(NUMBERS)}))|(?=[+(])(?:{'|'.join(SIGNED)})){_AFTER}"
)
# A mark around candidates. Its first character is doubled up in texts that have it.
_ESCAPE, _MARK, _ESCAPED = "\x01", "\x01\x02", "\x01\x03"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _numbers(digits: Column) -> Column:
    return F.transform(F.split(digits, ""), lambda d: d.cast("int"))


def luhn(digits: Column) -> Column:
    """Whether the digits end in the check digit of payment cards."""
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    last_first = F.reverse(_numbers(digits))
    weighed = F.transform(last_first, lambda d, i: F.when(i % 2 == 1, doubled(d)).otherwise(d))
    return F.aggregate(weighed, F.lit(0), lambda total, d: total + d) % 10 == 0


def is_card(value: Column) -> Column:
    """13 to 19 digits, not all equal, with a valid check digit."""
    digits = _digits(value)
    shaped = F.length(digits).between(13, 19) & ~digits.rlike(r"^(\d)\1*$")
    return F.when(shaped, luhn(digits)).otherwise(False)


def is_resident_id(value: Column) -> Column:
    """A province, a date of birth of this or the last century, and a valid check character."""
    born = F.substring(value, 7, 8)
    # Weights are powers of two modulo 11; an X stands for ten.
    values = F.transform(F.split(value, ""), lambda d: F.when(d.isin("X", "x"), 10).otherwise(d.cast("int")))
    rest = F.aggregate(values, F.lit(0), lambda total, d: (2 * total + d) % 11)
    shaped = value.rlike(r"^\d{17}[0-9Xx]$") & born.rlike("^(19|20)")
    dated = F.try_to_timestamp(born, F.lit("yyyyMMdd")).isNotNull()
    # The date last: a wrong one costs an exception.
    valid = F.when(F.substring(value, 1, 2).isin(*PROVINCES) & (rest == 1), dated).otherwise(False)
    return F.when(shaped, valid).otherwise(False)


def is_mobile(value: Column) -> Column:
    """Eleven digits of the mobile plan, a country code before them or not."""
    return value.rlike(rf"^(?:(?:\+|00)?86[ -]?)?{_MOBILE}$")


def is_phone(value: Column) -> Column:
    """A number of the North American plan, or an area code and a number of the Chinese plan."""
    digits = _digits(value)
    north_american = digits.rlike(r"^1?[2-9](?!11)\d{2}[2-9](?!11)\d{6}$")
    fixed_line = digits.rlike(r"^0(?:10|2[0-57-9]|[3-9]\d{2})[2-9]\d{6,7}$") & value.rlike("^0")
    return (north_american & ~value.rlike("^0")) | fixed_line


def is_ipv4(value: Column) -> Column:
    part = "(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    return value.rlike(rf"^{part}(?:\.{part}){{3}}$")


def kind_of(value: Column, kinds: Sequence[str] = KINDS) -> Column:
    """The kind of identifier that a candidate is, or null."""
    tests = {
        "email": value.contains("@"),
        "ipv4": is_ipv4(value),
        "resident_id": is_resident_id(value),
        "mobile": is_mobile(value),
        "card": is_card(value),
        "phone": is_phone(value),
    }
    if unknown := set(kinds) - set(tests):
        raise ValueError(f"unknown kinds {sorted(unknown)}; known kinds: {sorted(tests)}")
    found = F.lit(None).cast("string")
    for kind, test in reversed(tests.items()):
        found = F.when(test, kind).otherwise(found) if kind in kinds else F.when(test, F.lit(None)).otherwise(found)
    return found


def normal_form(value: Column, kind: Column) -> Column:
    """What all spellings of an identifier have in common."""
    digits = _digits(value)
    return (
        F.when(kind == "email", F.translate(value, _UPPER, _UPPER.lower()))
        .when(kind == "ipv4", value)
        .when(kind == "resident_id", F.translate(value, "x", "X"))
        .when(kind == "mobile", F.right(digits, F.lit(11)))
        .when((kind == "phone") & (F.length(digits) == 11) & digits.startswith("1"), F.right(digits, F.lit(10)))
        .otherwise(digits)
    )


def keyed_hash(value: Column, secret: bytes) -> Column:
    """HMAC-SHA256 of a text, in hexadecimal.

    Only the padded key is a literal of the plan; keep plans and event logs as you keep the key.
    """
    if not 16 <= len(secret) <= 64:
        raise ValueError("a secret has 16 to 64 bytes")
    padded = secret.ljust(64, b"\0")
    inner, outer = (F.lit(bytes(b ^ pad for b in padded)) for pad in (0x36, 0x5C))
    first = F.unhex(F.sha2(F.concat(inner, F.encode(value, "UTF-8")), 256))
    return F.sha2(F.concat(outer, first), 256)


def pseudonym(value: Column, kind: Column, secret: bytes, digits: int = PSEUDONYM_DIGITS) -> Column:
    """The same letters for all spellings of an identifier; without digits, so that no pseudonym
    looks like an identifier."""
    hashed = keyed_hash(F.concat(kind, F.lit(":"), normal_form(value, kind)), secret)
    return F.translate(F.substring(hashed, 1, digits), _HEX, _LETTERS)


def pieces(text: Column, kinds: Sequence[str] = KINDS) -> Column:
    """The text as an array of (kind, value) whose values joined are the text; the kind is null
    for what is no identifier."""
    escaped = F.replace(text, F.lit(_ESCAPE), F.lit(_ESCAPED))
    parts = F.split(F.regexp_replace(escaped, f"({CANDIDATE})", f"{_MARK}$1{_MARK}"), _MARK)
    plain = lambda part: F.replace(part, F.lit(_ESCAPED), F.lit(_ESCAPE))
    none = F.lit(None).cast("string")
    return F.transform(
        parts,
        lambda part, i: F.struct(
            F.when(i % 2 == 1, kind_of(part, kinds)).otherwise(none).alias("kind"), plain(part).alias("value")
        ),
    )
