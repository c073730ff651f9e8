"""Secret scans: patterns, and the guess cost of values in credential contexts.

Three kinds of spans come from patterns alone. The method adds a fourth, ``guess``: a value
that stands where a credential stands, by a wider set of names and ways of giving a value,
and that takes at least ``10 ** LEAST_COST`` guesses. The cost of a value is the least sum
over all ways to cut it into words, dates, repeats, runs along a keyboard row or an
alphabet, and single characters tried by brute force, found by dynamic programming over its
positions; each cut costs a factor of two for the guesser. A value that is inside a span of
the patterns is not reported again.

Spans are (kind, start, end) in code points, the end exclusive.

Defined cases: a null text is an empty one, without spans; texts and values of any length
are read whole; repeated rows give repeated rows; only the key and text columns are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame

from sftpipe.llm.common import filled, map_texts

ASSIGN = re.compile(
    r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_CHARS, ACCESS_CHARS = 6, 20
KINDS = ("assign", "access", "hex", "guess")

CONTEXT = re.compile(
    r"""(?ai)(?:pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|credentials?|bearer|"""
    r"""(?:api|access|private|secret|auth|client)[_-]?(?:key|secret|token))"""
    r"""["']?(?:\x20*(?:=>|:=|[:=])\x20*|\x20+(?:is|was|ist|est|es)\x20+|(?<=bearer)\x20+)"""
    r"""(?:"([^"\s]{6,})"|'([^'\s]{6,})'|([^\s"'<>]{6,}))"""
)
#: Any of these is in every match of a context.
_HINTS = ("pass", "pwd", "pin", "secret", "token", "credential", "bearer", "key")
_TRAILING = ".,;:!?)]}"
LEAST_COST = 10.0

#: Common choices, most common first; the guesses a word takes are its place.
WORDS = (
    "password 123456 qwerty admin welcome letmein monkey dragon iloveyou football baseball "
    "master sunshine princess shadow superman michael login abc123 starwars hello freedom "
    "whatever trustno1 secret summer winter spring autumn test user root guest default "
    "changeme pass love god money office computer internet service system server database "
    "demo example sample token access private public key house family flower orange purple "
    "silver golden happy lucky angel buster tiger ranger hunter killer soccer hockey george "
    "charlie robert thomas daniel andrew jordan jennifer jessica ashley amanda nicole "
    "batman pokemon london berlin madrid paris america germany france spain monday friday "
    "sunday january march april june july august october december passwort geheim hallo "
    "schatz soleil bonjour amour motdepasse hola amor contrasena secreto"
).split()
_PLACE = {word: place for place, word in enumerate(WORDS, 1)}
_LONGEST = max(map(len, WORDS))
ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "qwertzuiop", "yxcvbnm", "azertyuiop")
ALPHABET = "abcdefghijklmnopqrstuvwxyz"
#: Characters usually written in the place of a letter.
_LOOKS = str.maketrans("@43105$7", "aaelosst")
_VOWELS = set("aeiouyäöüáéíóúàèìòùâêîôû")
#: Letters that can be spoken, but are no listed word, count as one of this many words.
SPOKEN_WORDS = 100_000
_DATE = re.compile(
    r"(?:19|20)\d\d[-./]?(?:0[1-9]|1[0-2])[-./]?(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0?[1-9]|[12]\d|3[01])[-./]?(?:0?[1-9]|1[0-2])[-./]?(?:19|20)\d\d"
    r"|(?:19|20)\d\d"
)
#: Guesses for a year, and for a day of one.
YEARS, DAYS = 130, 365
#: A span shorter than a whole run may end anywhere up to here.
_PART = 24
_STEP = math.log10(2)


def _neighbours() -> dict[str, set[str]]:
    out: dict[str, set[str]] = {}
    for row in (*ROWS, ALPHABET):
        for a, b in zip(row, row[1:]):
            out.setdefault(a, set()).add(b)
            out.setdefault(b, set()).add(a)
    return out


_NEXT = _neighbours()


def _charset(c: str) -> int:
    if c.isdigit():
        return 10
    if "a" <= c <= "z" or "A" <= c <= "Z":
        return 26
    return 33 if c < "\x80" else 100


def _spoken_end(text: str, start: int, stop: int) -> int:
    """How far letters can be spoken: no four consonants and no four vowels in a row."""
    run, kind = 0, None
    for i in range(start, stop):
        vowel = text[i] in _VOWELS
        run, kind = (run + 1 if vowel is kind else 1), vowel
        if run > 3:
            return i
    return stop


def _case_cost(word: str) -> float:
    if word.islower() or not any(map(str.isalpha, word)):
        return 0.0
    if word.isupper() or word[0].isupper() and word[1:].islower():
        return _STEP
    return len(word) * _STEP


def _run_ends(value: str, follows) -> list[int]:
    """For each position, where the run that covers it and the next ones ends."""
    ends = [len(value)] * len(value)
    for i in range(len(value) - 2, -1, -1):
        ends[i] = ends[i + 1] if follows(value[i], value[i + 1]) else i + 1
    return ends


@lru_cache(maxsize=100_000)
def guess_cost(value: str) -> float:
    """log10 of the guesses for ``value`` by the cheapest way to cut it.

    A run's span ends with the run or within ``_PART`` characters, so the work grows with
    the length.
    """
    n = len(value)
    low = value.lower()
    if len(low) != n:
        low = value
    plain = low.translate(_LOOKS)
    same = _run_ends(low, lambda a, b: a == b)
    walks = _run_ends(low, lambda a, b: b in _NEXT.get(a, ()))
    letters = _run_ends(low, lambda a, b: a.isalpha() and b.isalpha())
    best = [0.0] + [math.inf] * n

    def offer(i: int, j: int, cost: float) -> None:
        total = best[i] + cost + (_STEP if i else 0.0)
        if total < best[j]:
            best[j] = total

    for i in range(n):
        # By brute force a character costs its class, and no cut.
        best[i + 1] = min(best[i + 1], best[i] + math.log10(_charset(value[i])))
        for j in range(i + 3, min(n, i + _LONGEST) + 1):
            for text, extra in ((low, 0.0), (plain, _STEP)):
                if place := _PLACE.get(text[i:j]):
                    offer(i, j, math.log10(place + 1) + extra + _case_cost(value[i:j]))
        if date := _DATE.match(value, i):
            length = date.end() - i
            offer(i, date.end(), math.log10(YEARS * (DAYS if length > 4 else 1)))
        for ends, least in ((same, 3), (walks, 3)):
            if ends[i] - i > _PART:
                offer(i, ends[i], math.log10(_charset(value[i]) * (ends[i] - i)))
            for j in range(i + least, min(ends[i], i + _PART) + 1):
                offer(i, j, math.log10(_charset(value[i]) * (j - i)) + _case_cost(value[i:j]))
        for j in range(i + 4, _spoken_end(low, i, min(letters[i], i + _PART)) + 1):
            offer(i, j, math.log10(SPOKEN_WORDS) + max(0, j - i - 8) * 0.5 + _case_cost(value[i:j]))
    return best[n]


def _found(text: str) -> list[tuple[int, int, int]]:
    """Spans of the patterns as (start, kind, end), in order."""
    spans = []
    low = text.lower()
    if any(hint in low for hint in ("passw", "secret", "token", "key")):
        spans += [
            (m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_CHARS
        ]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def _guessed(text: str, spans: list[tuple[int, int, int]], least_cost: float) -> list[tuple[int, int, int]]:
    low = text.lower()
    if not any(hint in low for hint in _HINTS):
        return []
    out = []
    for m in CONTEXT.finditer(text):
        start, end = m.span(m.lastindex)
        if m.lastindex == 3:
            end = start + len(m.group(3).rstrip(_TRAILING))
        if any(a <= start and end <= b for a, _, b in spans):
            continue
        if end - start >= ASSIGN_CHARS and guess_cost(text[start:end]) >= least_cost:
            out.append((start, 3, end))
    return out


def secret_spans(text: str, least_cost: float = LEAST_COST) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) by start, then in the order of kinds."""
    spans = _found(text)
    spans += _guessed(text, spans, least_cost)
    return [(KINDS[kind], start, end) for start, kind, end in sorted(spans)]


def scan(df: DataFrame, key: str, text: str, least_cost: float = LEAST_COST) -> DataFrame:
    """``key`` and ``spans``, an array of (kind, start, end, cost), of every row.

    The cost is that of an assigned or guessed value, and of the whole span otherwise.
    """

    def costed(value: str) -> list[tuple]:
        out = []
        for kind, start, end in secret_spans(value, least_cost):
            span = value[start:end]
            match = ASSIGN.fullmatch(span) if kind == "assign" else None
            out.append({"kind": kind, "start": start, "end": end, "cost": guess_cost(match.group(2) if match else span)})
        return out

    def rows(batches: Iterator[dict]) -> Iterator[list[tuple]]:
        for batch in batches:
            yield [(k, costed(t)) for k, t in zip(batch["key"], batch["text"])]

    kind = df.schema[key].dataType.simpleString()
    read = df.select(df[key].alias("key"), filled(df[text]).alias("text"))
    fields = "kind string, start bigint, end bigint, cost double"
    return map_texts(read, f"`{key}` {kind}, spans array<struct<{fields.replace(' ', ':').replace(',:', ',')}>>", rows)
