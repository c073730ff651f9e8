"""Column expressions over text. Lengths and windows count code points."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sftpipe.session import bound_active_batches

# Fixed values.
CONTROL_CHARS = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
HAN_CLASS = r"[\u4e00-\u9fff]"
PAIR_SEPARATOR = "\x01"
SHINGLE_SIZE = 5
# What Python's str.strip removes.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


@F.pandas_udf(StringType())
def _nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def once(udf):
    """Keep a filter on a Python result from being pushed below it, and its batches small.

    Catalyst copies a deterministic Python function into every filter on its result
    and so evaluates it again, often before a repartition. A batch of whole texts is held
    several times over by the worker, so its rows are bounded whatever the session says.
    """
    bound_active_batches()
    return udf.asNondeterministic()


def nfkc(c: Column | str) -> Column:
    """Unicode compatibility composition; null stays null."""
    return once(_nfkc)(_col(c))


def remove_control(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), CONTROL_CHARS, "")


def collapse_whitespace(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(_col(c), r"(?U)\s+", " "))


_control_re = re.compile(CONTROL_CHARS)


@F.pandas_udf(StringType())
def _clean(texts: pd.Series) -> pd.Series:
    def one(t: str | None) -> str:
        if t is None:
            return ""
        return " ".join(_control_re.sub("", unicodedata.normalize("NFKC", t)).split())

    return texts.map(one)


def clean_text(c: Column | str) -> Column:
    """Null to "", then NFKC, control removal, whitespace collapse.

    Equals ``collapse_whitespace(remove_control(nfkc(c)))``. NFKC needs Python
    anyway, and finishing the job in the same Arrow batch is measurably faster
    than two JVM regular expressions after it.
    """
    return once(_clean)(_col(c))


def strip_unicode(c: Column | str) -> Column:
    """Trim what Python's ``str.strip`` trims."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


def script_ratio(c: Column | str, char_class: str = HAN_CLASS) -> Column:
    """Share of characters in ``char_class``; 0.0 for empty text.

    Removing whole runs and comparing lengths is faster than ``regexp_count``,
    which builds an array of all matches.
    """
    c = _col(c)
    inside = F.length(c) - F.length(F.regexp_replace(c, f"{char_class}+", ""))
    return F.coalesce(F.try_divide(inside, F.length(c)), F.lit(0.0))


def prefix(c: Column | str, n: int) -> Column:
    return F.substring(_col(c), 1, n)


def pair_fingerprint(question: Column | str, answer: Column | str) -> Column:
    """Hex md5 of the cleaned pair with a separator between the sides."""
    return F.md5(F.concat(_col(question), F.lit(PAIR_SEPARATOR), _col(answer)))


def ingest_fingerprint(question: Column | str, answer: Column | str) -> Column:
    """Hex sha1 of the uncleaned pair, no separator, outer whitespace trimmed."""
    return F.sha1(strip_unicode(F.concat(_col(question), _col(answer))))


def shingles(c: Column | str, k: int = SHINGLE_SIZE) -> Column:
    """Distinct ``k``-character windows with spaces removed.

    The lookahead finds overlapping windows in one linear pass; the trailing dot
    advances by a whole code point. Text shorter than ``k`` is its own shingle.
    """
    t = F.replace(_col(c), F.lit(" "), F.lit(""))
    windows = F.regexp_extract_all(t, F.lit(f"(?s)(?=(.{{{k}}}))."), F.lit(1))
    return F.array_distinct(F.when(F.length(t) < k, F.array(t)).otherwise(windows))
