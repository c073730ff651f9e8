"""Queries of the stores: streaming ingest, rounds applied once, files read in blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from sftpipe.plans import views
from sftpipe.plans.checks import query, store_contents
from sftpipe.session import append_stage, scratch_path, write_stage
from sftpipe.sources.large_csv import read_large_csv
from sftpipe.sources.readers import SCORED_SCHEMA
from sftpipe.sources.rounds import append_round, read_rounds
from sftpipe.sources.writers import write_csv
from sftpipe.streaming.ingest import batch_ingest, stream_pages


@query
def ingest_stream(spark, sf_dir):
    """The store after three batches of a stream that is restarted from its checkpoint before
    each, with the second batch delivered twice. Two pages share a url."""
    pages = write_stage(views.quote_pages(spark, sf_dir).withColumn("url", views.shared_url()), "stream-pages")
    landing, root, checkpoint = (scratch_path(spark, name) for name in ("landing", "stream-store", "stream-checkpoint"))
    for batch_id, rest in enumerate((1, 2, 0)):
        batch = pages.filter(F.col("page_key") % 3 == rest)
        append_stage(batch, landing)
        stream_pages(spark, landing, root, checkpoint, "quotes").awaitTermination()
        if batch_id == 1:
            batch_ingest(root, "quotes")(batch, batch_id)
    return store_contents(spark, root)


@query
def scored_rounds(spark, sf_dir):
    """Scored rows of two rounds, the first applied twice, beside an attempt that never
    committed."""
    scored = write_stage(views.scored_documents(spark, sf_dir), "scored")
    path = scratch_path(spark, "rounds")
    applied = []
    for part in (0, 1, 0):
        applied.append(append_round(scored.filter(F.col("doc_id") % 2 == part), path))
    scored.write.json(f"{path}/data/crashed")
    back = read_rounds(spark, path, f"doc_id bigint, {SCORED_SCHEMA}")
    return back.select(
        "doc_id", "instruction", "complexity", "clarity", "informativeness", "_error",
        F.lit(sum(applied)).cast("bigint").alias("rounds"),
    )


SPLIT = "spark.sql.files.maxPartitionBytes"
#: Characters of text in one file that ``large_csv_round_trip`` writes, about.
FILE_CHARS = 256 << 20


@query
def large_csv_round_trip(spark, sf_dir):
    """Documents as two CSV files, or two runs of large ones, with quotes and line breaks in cells,
    read in small blocks."""
    docs = views.table(spark, sf_dir, "documents").select("doc_id", views.csv_text().alias("text"), "lang")
    root = scratch_path(spark, "large-csv")
    even = F.col("doc_id") % 2 == 0
    for name, part in (("a", docs.filter(even)), ("b", docs.filter(~even))):
        # A file is one task's, so its size is bounded; files follow one another by path and by id.
        chars = part.agg(F.sum(F.length("text"))).first()[0] or 0
        files = -(-chars // FILE_CHARS)
        ordered = part.repartitionByRange(files, "doc_id") if files > 1 else part.repartition(1)
        write_csv(ordered.sortWithinPartitions("doc_id"), f"{root}/{name}")
    before = spark.conf.get(SPLIT)
    spark.conf.set(SPLIT, str(256 << 10))
    try:
        found = read_large_csv(spark, f"{root}/*", "position")
    finally:
        spark.conf.set(SPLIT, before)
    return found
