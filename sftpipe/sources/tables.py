"""Append-only tables of the ingest store, and the views that make them keyed.

Each table is a Parquet folder under one root. Keys are enforced where the data is
written (records) or read (the latest row per url), so every write is one append
that may be repeated without harm.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "visited": "url string, ok int, at timestamp",
    "records": (
        "content_hash string, question string, answer string, source string, url string, "
        "created_at timestamp"
    ),
    "dead_letters": "url string, error string, failed_at timestamp",
    "runs": "run string, ok_pages bigint, dead_pages bigint, new_records bigint, at timestamp",
}


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The appended rows; a table not written yet is empty."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table_path(root, name))
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not files.exists(path):
        return spark.createDataFrame([], SCHEMAS[name])
    return spark.read.schema(SCHEMAS[name]).parquet(table_path(root, name))


def append_table(df: DataFrame, root: str, name: str) -> None:
    df.write.mode("append").parquet(table_path(root, name))


def latest(rows: DataFrame, key: str, at: str) -> DataFrame:
    """The newest row per key: what an upsert would have left."""
    values = [c for c in rows.columns if c != key]
    newest = rows.groupBy(key).agg(F.max_by(F.struct(*values), at).alias("row"))
    return newest.select(key, "row.*").select(*rows.columns)


def earliest(rows: DataFrame, key: str, at: str) -> DataFrame:
    """The oldest row per key."""
    values = [c for c in rows.columns if c != key]
    oldest = rows.groupBy(key).agg(F.min_by(F.struct(*values), at).alias("row"))
    return oldest.select(key, "row.*").select(*rows.columns)


def compact(spark: SparkSession, root: str, name: str, files: int = 1) -> None:
    """Put a table that is keyed when read (not ``records``) into ``files`` files.

    The new files are moved in before the old ones go, so a reader or a crash in between
    meets rows twice, which the keyed views ignore. No writer may run meanwhile.
    """
    keyed = {"visited": (latest, "url", "at"), "dead_letters": (latest, "url", "failed_at"), "runs": (earliest, "run", "at")}
    view, key, at = keyed[name]
    place = spark._jvm.org.apache.hadoop.fs.Path(table_path(root, name))
    system = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not system.exists(place):
        return
    old = [s.getPath() for s in system.listStatus(place)]
    fresh = f"{table_path(root, name)}-compacting-{uuid.uuid4().hex}"
    view(read_table(spark, root, name), key, at).coalesce(files).write.parquet(fresh)
    folder = spark._jvm.org.apache.hadoop.fs.Path(fresh)
    for status in system.listStatus(folder):
        if status.getPath().getName().startswith("part-"):
            system.rename(status.getPath(), place)
    for path in old:
        system.delete(path, False)
    system.delete(folder, True)


def visited(spark: SparkSession, root: str) -> DataFrame:
    return latest(read_table(spark, root, "visited"), "url", "at")


def dead_letters(spark: SparkSession, root: str) -> DataFrame:
    return latest(read_table(spark, root, "dead_letters"), "url", "failed_at")


def records(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, "records")


def store_totals(stored: DataFrame, dead: DataFrame) -> DataFrame:
    """Record count and dead-letter count as one row."""
    names = {"records": stored, "dead_letters": dead}
    counts = [df.agg(F.count("*").alias(n)).scalar().alias(n) for n, df in names.items()]
    return stored.sparkSession.range(1).select(*counts)
