"""Streaming twin of the batch ingest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sftpipe.operators.pages import check_site
from sftpipe.plans.ingest import ingest_pages

PAGE_SCHEMA = "page_key bigint, url string, html string"


def batch_ingest(root: str, site: str) -> Callable[[DataFrame, int], None]:
    """What a stream does with a batch. A batch that is delivered again finds its pages visited
    and its run recorded, so it changes nothing."""
    check_site(site)

    def take(batch: DataFrame, batch_id: int) -> None:
        ingest_pages(batch, root, site, run=f"stream-{batch_id}")

    return take


def stream_pages(
    spark: SparkSession,
    source: str,
    root: str,
    checkpoint: str,
    site: str,
    max_files: int = 1000,
) -> StreamingQuery:
    """Ingest page files as they land in ``source`` (Parquet, PAGE_SCHEMA), then stop.

    The checkpoint remembers the files taken. A batch may be delivered again after
    a failure; the ingest is idempotent, so that changes nothing.
    """
    return (
        spark.readStream.schema(PAGE_SCHEMA)
        .option("maxFilesPerTrigger", max_files)
        .parquet(source)
        .writeStream.foreachBatch(batch_ingest(root, site))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
