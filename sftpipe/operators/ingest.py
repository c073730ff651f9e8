"""Resume, content-unique insert and page outcomes, as plain DataFrame steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftpipe.functions.text import ingest_fingerprint, prefix
from sftpipe.operators.joins import BROADCAST_ROWS, met_in, not_seen, with_keys
from sftpipe.operators.pages import ERROR_CHARS
from sftpipe.session import write_counted


def unseen_pages(pages: DataFrame, visited: DataFrame) -> DataFrame:
    """Pages whose url was never processed, with success or without."""
    return not_seen(pages, "page_key", "url", visited)


def new_records(found: DataFrame, stored: DataFrame) -> DataFrame:
    """First occurrence of each content hash that is not stored yet.

    ``found`` has page_key, position, question, answer and is in (page_key,
    position) order. Hash and place alone decide, both of fixed width, so the firsts are
    found by hashing; a small batch is broadcast to the store, which is only scanned, and
    its text does not move.
    """
    fingerprint = ingest_fingerprint("question", "answer")
    # One number in (page_key, position) order, with room for both whole ranges.
    place = F.col("page_key").cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(11,0)")
    whole = found.filter("question != '' AND answer != ''")
    placed = whole.withColumn("place", (place + F.col("position")).cast("decimal(38,0)"))
    narrow = placed.select(F.unhex(fingerprint).alias("digest"), "place")
    firsts, rows = write_counted(narrow.groupBy("digest").agg(F.min("place").alias("place")), "firsts")
    known = stored.select(F.unhex("content_hash").alias("digest"))
    if rows <= BROADCAST_ROWS:
        known = F.broadcast(met_in(known, firsts.select("digest"), "digest"))
    fresh = firsts.join(known, "digest", "left_anti").select("place")
    if rows > BROADCAST_ROWS:  # fewer are broadcast in any case, so they need no count of their own
        fresh, rows = write_counted(fresh, "fresh")
    # Only what is kept is hashed again.
    return with_keys(placed, fresh, "place", rows).drop("place").withColumn("content_hash", fingerprint)


def page_outcomes(parsed: DataFrame) -> DataFrame:
    """(url, ok, error): the last outcome where a batch holds a url more than once."""
    return (
        parsed.groupBy("url")
        .agg(F.max_by(F.struct("ok", "error"), "page_key").alias("last"))
        .select("url", "last.ok", "last.error")
    )


def dead_letter_rows(parsed: DataFrame, error_chars: int = ERROR_CHARS) -> DataFrame:
    """(url, error) of failed pages, the last failure per url, error text cut."""
    return (
        parsed.filter("NOT ok")
        .groupBy("url")
        .agg(F.max_by("error", "page_key").alias("error"))
        .select("url", prefix("error", error_chars).alias("error"))
    )


def run_summary(parsed: DataFrame, inserted: DataFrame, counts: tuple[int, int, int] | None = None) -> DataFrame:
    """Ok pages, dead pages and new records of one run, as one row.

    ``counts`` are these numbers where the caller's writes have counted them; nothing is read then.
    """
    if counts is not None:
        names = ("ok_pages", "dead_pages", "new_records")
        return parsed.sparkSession.range(1).select(
            *[F.lit(n).cast("bigint").alias(name) for n, name in zip(counts, names, strict=True)]
        )
    fresh = inserted.agg(F.count("*").alias("new_records")).scalar()
    return parsed.agg(
        F.count_if("ok").alias("ok_pages"),
        F.count_if(~F.col("ok")).alias("dead_pages"),
    ).select("*", fresh.alias("new_records"))
