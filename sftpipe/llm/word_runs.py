"""Runs of periodic words, by a suffix automaton and the access of link-cut trees.

A run is a longest stretch of words in which words one period apart are equal. The suffix
links of a text's automaton form a tree; the path from the state of a prefix to the root holds
all suffixes of that prefix. Words are appended one by one: the path of the new prefix is
recoloured with its end. Before that, the path falls into segments of one colour, the end of
their last occurrence. If the new end lies ``d`` behind that end and a segment reaches suffixes
of length ``l >= d``, a square of period ``d`` ends here, and ``l`` says where its repetition
starts. Squares of one period and start over successive ends are one run. No suffix of that
length occurs later, so ``d`` is the smallest period. The preferred paths of a link-cut tree
are these segments: its access recolours a path in a logarithmic number of steps on average.

Only stretches that may hold a run are given to an automaton. In a run of at least
``LEAST_WORDS`` and ``LEAST_PERIODS`` periods every window of ``WINDOW`` words occurs again one
period before or after it, and these windows overlap without a gap. So a run lies within one
stretch of windows whose nearest equal is at most a third of that stretch away. Windows are
compared by hashes here: equal hashes of unlike windows cost time and change nothing.

Defined cases: a null or empty text has no words and no runs; texts of any length are read
whole, in memory of about 500 bytes a word of a stretch; repeated rows and keys give repeated
rows; an empty table gives an empty result; words are compared by their bytes, in the case in
which they are written; only the named key and text columns are read, so others cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftpipe.llm.common import WORD, filled, id_text, map_texts

#: A run has at least so many words and so many periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Words of a window: a period less than a third of LEAST_WORDS leaves room for two of them.
WINDOW = 8
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)

Run = tuple[int, int, int]


def nearest_equal(words: list[bytes]) -> np.ndarray:
    """For each window of words, how far the nearest window with its hash lies."""
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    for level, factor in enumerate(_FACTORS):
        width = 1 << level
        hashes = hashes[:-width] * np.uint64(factor) + hashes[width:]
    order = np.argsort(hashes, kind="stable")
    sorted_hashes = hashes[order]
    same = sorted_hashes[1:] == sorted_hashes[:-1]
    found = np.full(len(hashes), len(words), np.int64)
    if same.any():
        left, right = order[:-1][same], order[1:][same]
        found[left] = right - left
        found[right] = np.minimum(found[right], right - left)
    return found


def stretches(words: list[bytes]) -> list[tuple[int, int]]:
    """Start and stop of the stretches of words outside which no run has a word."""
    if len(words) < LEAST_WORDS:
        return []
    nearest = nearest_equal(words)
    found, todo = [], [(0, len(words))]
    while todo:
        start, stop = todo.pop()
        if stop - start < LEAST_WORDS:
            continue
        windows = stop - start - WINDOW + 1
        fit = nearest[start : start + windows] * LEAST_PERIODS <= stop - start
        if fit.all():
            found.append((start, stop))
            continue
        edges = np.flatnonzero(np.diff(fit, prepend=False, append=False)).reshape(-1, 2) + start
        todo += [(a, b + WINDOW - 1) for a, b in edges.tolist()]
    return found


def automaton(word_ids: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Length and suffix link of all states, and the state of each prefix.

    Most states have one transition, which is kept in a list; the others have a dict too.
    """
    length, link, word, target, more = [0], [-1], [-1], [-1], {}
    prefixes, last = [], 0
    for w in word_ids:
        new = len(length)
        length.append(length[last] + 1)
        link.append(0)
        word.append(-1)
        target.append(-1)
        at, to = last, -1
        while at >= 0:
            if word[at] == w:
                to = target[at]
                break
            if word[at] < 0:
                word[at], target[at] = w, new
            else:
                others = more.setdefault(at, {})
                if w in others:
                    to = others[w]
                    break
                others[w] = new
            at = link[at]
        if to >= 0:
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                clone = len(length)
                length.append(length[at] + 1)
                link.append(link[to])
                word.append(word[to])
                target.append(target[to])
                if to in more:
                    more[clone] = dict(more[to])
                while at >= 0:
                    if word[at] == w:
                        if target[at] != to:
                            break
                        target[at] = clone
                    else:
                        others = more.get(at, {})
                        if others.get(w) != to:
                            break
                        others[w] = clone
                    at = link[at]
                link[to] = link[new] = clone
        prefixes.append(new)
        last = new
    return length, link, prefixes


class Paths:
    """The tree of suffix links, cut into paths of one colour each.

    A path is a splay tree ordered by depth, whose root holds the colour. ``up`` leads to the
    parent in the splay tree, or from its root to the state above the path.
    """

    def __init__(self, link: list[int]):
        self.up = link[:]
        self.left, self.right = [-1] * len(link), [-1] * len(link)
        self.colour = [-1] * len(link)

    def _rise(self, x: int) -> None:
        """Make ``x`` the root of its path's splay tree."""
        up, left, right, colour = self.up, self.left, self.right, self.colour
        while (p := up[x]) >= 0 and (left[p] == x or right[p] == x):
            g = up[p]
            if g < 0 or (left[g] != p and right[g] != p):
                colour[x] = colour[p]
            else:
                colour[x] = colour[g]
                self._rotate(p if (left[g] == p) == (left[p] == x) else x)
            self._rotate(x)

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g = up[p]
        if left[p] == x:
            inner = left[p] = right[x]
            right[x] = p
        else:
            inner = right[p] = left[x]
            left[x] = p
        if inner >= 0:
            up[inner] = p
        up[p], up[x] = x, g
        if g >= 0:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def recolour(self, state: int, new: int) -> Iterator[tuple[int, int]]:
        """Give the path from ``state`` to the root a new colour; yields the deepest state and
        the old colour of the segments that it consisted of."""
        up, right, colour = self.up, self.right, self.colour
        below = -1
        while state >= 0:
            self._rise(state)
            old, rest = colour[state], right[state]
            if rest >= 0:
                colour[rest] = old
            right[state] = below
            if old >= 0:
                yield state, old
            below, state = state, up[state]
        colour[below] = new


def long_enough(start: int, stop: int, period: int) -> bool:
    return stop - start >= max(LEAST_WORDS, LEAST_PERIODS * period)


def runs_of_ids(word_ids: list[int]) -> list[Run]:
    """All runs of a sequence as (start, length, period), by start, then period."""
    length, link, prefixes = automaton(word_ids)
    paths, found, open_runs = Paths(link), [], {}
    for end, state in enumerate(prefixes):
        for deepest, before in paths.recolour(state, end):
            period = end - before
            if period <= length[deepest]:
                start = before - length[deepest] + 1
                if (run := open_runs.get(period)) and run[0] == start and run[1] == end:
                    run[1] = end + 1
                    continue
                if run and long_enough(*run, period):
                    found.append((run[0], run[1] - run[0], period))
                open_runs[period] = [start, end + 1]
    found += [(a, b - a, period) for period, (a, b) in open_runs.items() if long_enough(a, b, period)]
    return sorted(found, key=lambda run: (run[0], run[2]))


def word_runs(words: list[bytes]) -> list[Run]:
    """All runs of a text's words as (start, length, period), by start, then period."""
    found = []
    for start, stop in stretches(words):
        names: dict[bytes, int] = {}
        ids = [names.setdefault(w, len(names)) for w in words[start:stop]]
        found += [(start + a, n, period) for a, n, period in runs_of_ids(ids)]
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those of a run that come after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, n, period in runs:
        kept[start + period : start + n] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def find_runs(df: DataFrame, key: str, text: str) -> DataFrame:
    """Per row ``key``, ``n_words``, ``runs`` (start, length, period; by start, then period)
    and ``collapsed``, the text with one period of each run, its words joined by blanks."""

    def rows(batches: Iterator[dict]) -> Iterator[list[tuple]]:
        for batch in batches:
            found = []
            for k, t in zip(batch["key"], batch["text"]):
                words = t.encode().split()
                runs = word_runs(words)
                found.append((k, len(words), runs, b" ".join(collapsed(words, runs)).decode()))
            yield found

    kind = df.schema[key].dataType.simpleString()
    read = df.select(df[key].alias("key"), filled(df[text]).alias("text"))
    run = "struct<start: bigint, length: bigint, period: bigint>"
    return map_texts(read, f"`{key}` {kind}, n_words bigint, runs array<{run}>, collapsed string", rows)


def most_repeated(runs: Column) -> Column:
    """The run with the greatest exact length per period; of equals the one that starts first,
    then that of the smaller period. Null without runs."""
    ahead = lambda x, y: x["length"] * y["period"] > y["length"] * x["period"]
    none = F.get(F.slice(runs, 1, 0), 0)
    return F.aggregate(runs, none, lambda x, y: F.when(x.isNull() | ahead(y, x), y).otherwise(x))


def with_periodic_tails(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key`` and ``text``, every tenth text by the hash of its key with a periodic end.

    With the words numbered from 0 and g a tenth of the hash, words from a = g mod n on repeat
    the first 1 + (n - a) / (3 + g mod 8) of them.
    """
    hashed = df.select(df[key].alias("key"), filled(df[text]).alias("text"), F.crc32(id_text(df[key])).alias("hash"))
    found = F.when(F.col("hash") % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"), 1))
    split = hashed.select("*", found.alias("words"), F.expr("hash div 10").alias("g"))
    counted = split.select("*", F.size("words").cast("long").alias("n"))
    placed = counted.select("*", F.when(F.col("n") > 0, F.col("g") % F.col("n")).alias("a"))
    sized = placed.select("*", (1 + F.expr("(n - a) div (3 + g % 8)")).alias("p"))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    made = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get("words", place(i).cast("int")))
    edited = F.when(F.col("n") > 0, F.array_join(made, " ")).otherwise(F.col("text"))
    return sized.select(F.col("key").alias(key), edited.alias(text))
