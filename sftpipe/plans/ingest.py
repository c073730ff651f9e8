"""Incremental page ingest: resume, parse, insert, mark visited."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftpipe.operators.ingest import (
    dead_letter_rows,
    new_records,
    page_outcomes,
    run_summary,
    unseen_pages,
)
from sftpipe.operators.pages import check_site, page_records, parse_pages
from sftpipe.operators.split import head
from sftpipe.session import spread, write_counted
from sftpipe.sources.tables import append_table, earliest, read_table, records


def ingest_pages(
    pages: DataFrame,
    root: str,
    site: str | None = None,
    limit: int | None = None,
    now: datetime | None = None,
    run: str | None = None,
) -> DataFrame:
    """Process the pages (page_key, url, html[, site]) not seen before; return the run summary.

    ``visited`` is written last: a run that dies earlier is simply done again, and
    the content hash keeps its records from entering twice. Both results are
    written to scratch before any table changes, so what is appended cannot depend
    on the appends. A batch without a ``run`` name gets one from its pages, so that a batch
    done again has the same.
    """
    if site is not None:
        check_site(site)
    spark = pages.sparkSession
    at = F.lit(now or datetime.now())
    todo = unseen_pages(head(pages, "page_key", limit), read_table(spark, root, "visited"))
    counted = F.struct(
        F.sum(F.xxhash64("page_key", "url").cast("decimal(38,0)")).alias("digest"),
        F.count_if("ok").alias("ok"),
        F.count_if(~F.col("ok")).alias("dead"),
    )
    parsed, batch = write_counted(parse_pages(spread(todo, "page_key"), site), "parsed-pages", counted)
    if run is None:
        run = f"batch-{int(batch.digest) % (1 << 64):x}" if batch.digest else f"empty-{uuid.uuid4().hex}"
    fresh, rows = write_counted(new_records(page_records(parsed), records(spark, root)), "new-records")
    summary = run_summary(parsed, fresh, (batch.ok, batch.dead, rows))

    columns = ("content_hash", "question", "answer", "source", "url")
    append_table(fresh.select(*columns, at.alias("created_at")), root, "records")
    dead = dead_letter_rows(parsed)
    append_table(dead.select("url", "error", at.alias("failed_at")), root, "dead_letters")
    append_table(summary.select(F.lit(run).alias("run"), "*", at.alias("at")), root, "runs")
    seen = page_outcomes(parsed).select("url", F.col("ok").cast("int").alias("ok"), at.alias("at"))
    append_table(seen, root, "visited")
    return summary


def runs(spark: SparkSession, root: str) -> DataFrame:
    """Counts per batch, in place of a progress line: the first row of each run's name, as a
    batch that is done again finds its records stored already."""
    return earliest(read_table(spark, root, "runs"), "run", "at")
