"""Quality rules: zstandard ratios within bands, and counts of words, symbols and repeats.

The ratio of a text is its compressed size over its size in bytes. Repetitive text compresses
far better than prose of its length, and encoded or random text far worse, so for each length
there is a band in which prose lies. A text is judged twice: as a whole, which sees repeats at
any distance, and in chunks of ``CHUNK_BYTES``, which see a passage that the rest of a long
text would hide. It is rejected if its whole ratio is out of its band, or if chunks with at
least ``CHUNK_SHARE`` of its bytes are out of theirs on one side. Each chunk, the last and
shorter one too, is judged by the band of its own length. Compression has a fixed cost a text,
so bands rise towards short texts; below ``BANDS[0]`` there is none.

Defined cases: a null or empty text has no words, a ratio of 1 and the verdict ``in_band``;
texts of any length are read whole; repeated rows and keys give repeated rows; an empty table
gives an empty result; a text's verdict depends on that text alone; only the named key and
text columns are read, so others cannot clash.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame

from sftpipe.llm.common import filled, map_texts

#: From so many bytes on, the least and the greatest ratio of prose. Prose of a few KB in
#: languages of one byte a letter lies near 0.45, of three bytes a letter near 0.55; base64
#: text near 0.77 and hexadecimal text near 0.58 at any length.
BANDS = (
    (64, 0.55, 1.25),
    (128, 0.48, 1.00),
    (256, 0.42, 0.85),
    (512, 0.38, 0.76),
    (1024, 0.34, 0.70),
    (2048, 0.32, 0.66),
    (4096, 0.30, 0.63),
    (8192, 0.27, 0.62),
    (16384, 0.25, 0.61),
    (65536, 0.22, 0.60),
)
CHUNK_BYTES, CHUNK_SHARE = 4096, 0.34
LEVEL = 3
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"
#: Base rules: fewer words, or more words in repeated windows, in hundredths, reject.
LEAST_WORDS, MOST_REPEATED = 50, 50
WINDOW = 3


def band(size: int, bands: Sequence[tuple[int, float, float]] = BANDS) -> tuple[float, float]:
    """The least and the greatest ratio of prose of so many bytes."""
    at = bisect_right(bands, size, key=lambda b: b[0])
    return bands[at - 1][1:] if at else (0.0, float("inf"))


class Ratios:
    """Compression ratios; keeps its compressor."""

    def __init__(self, level: int = LEVEL, bands: Sequence[tuple[int, float, float]] = BANDS):
        from zstandard import ZstdCompressor

        self.compress = ZstdCompressor(level=level, write_content_size=False).compress
        self.bands = bands

    def ratio(self, data: bytes) -> float:
        return len(self.compress(data)) / len(data) if data else 1.0

    def side(self, size: int, ratio: float) -> int:
        """-1 below the band of this size, 1 above it, 0 within."""
        least, most = band(size, self.bands)
        return (ratio > most) - (ratio < least)

    def judge(self, data: bytes) -> tuple[float, float, float, str]:
        """Whole ratio, the shares of bytes in chunks below and above their bands, verdict."""
        whole = self.ratio(data)
        sides = {-1: 0, 0: 0, 1: 0}
        if len(data) <= CHUNK_BYTES:
            sides[self.side(len(data), whole)] += len(data)
        else:
            for at in range(0, len(data), CHUNK_BYTES):
                chunk = data[at : at + CHUNK_BYTES]
                sides[self.side(len(chunk), self.ratio(chunk))] += len(chunk)
        size = max(1, len(data))
        low, high = sides[-1] / size, sides[1] / size
        side = self.side(len(data), whole)
        if side < 0 or low >= CHUNK_SHARE:
            return whole, low, high, "repetitive"
        if side > 0 or high >= CHUNK_SHARE:
            return whole, low, high, "incompressible"
        return whole, low, high, "in_band"


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of ``WINDOW`` words that the text has twice or more."""
    n = len(words)
    if n <= WINDOW:
        return 0
    last = dict(zip(words, range(n)))
    ids = np.fromiter(map(last.__getitem__, words), np.int64, n)
    if n < 1 << 21:
        codes = ids[:-2] << 42 | ids[1:-1] << 21 | ids[2:]
    else:
        pairs = np.unique(ids[:-1] << 31 | ids[1:], return_inverse=True)[1]
        codes = pairs[:-1] << 31 | ids[2:]
    ordered = np.sort(codes)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    starts = twice[np.minimum(np.searchsorted(twice, codes), len(twice) - 1)] == codes
    covered = np.zeros(n, bool)
    for shift in range(WINDOW):
        covered[shift : shift + len(starts)] |= starts
    return int(covered.sum())


def counts(text: str) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, words in repeated windows."""
    data = text.encode()
    words = data.split()
    spaces = sum(data.count(c) for c in SPACES)
    lines = [line for line in data.split(b"\n") if line.strip()]
    symbols = sum(data.count(c) for c in SYMBOLS)
    return len(words), len(text) - spaces, symbols, len(lines) - len(set(lines)), repeated_words(words)


def fails_base(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat_words > MOST_REPEATED * n_words


def quality_rules(
    df: DataFrame,
    key: str,
    text: str,
    level: int = LEVEL,
    bands: Sequence[tuple[int, float, float]] = BANDS,
) -> DataFrame:
    """Per row ``key``, the counts, ``base_failed``, ``kept`` (neither the base rules nor the
    bands reject) and, for the bands, ``ratio``, ``low_share``, ``high_share`` and ``verdict``."""
    bands = tuple(sorted(bands))

    def rows(batches: Iterator[dict]) -> Iterator[list[tuple]]:
        ratios = Ratios(level, bands)
        for batch in batches:
            found = []
            for k, t in zip(batch["key"], batch["text"]):
                own = counts(t)
                failed = fails_base(own[0], own[-1])
                judged = ratios.judge(t.encode())
                found.append((k, *own, failed, not failed and judged[-1] == "in_band", *judged))
            yield found

    kind = df.schema[key].dataType.simpleString()
    read = df.select(df[key].alias("key"), filled(df[text]).alias("text"))
    numbers = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
    judged = "ratio double, low_share double, high_share double, verdict string"
    return map_texts(read, f"`{key}` {kind}, {numbers}, base_failed boolean, kept boolean, {judged}", rows)
