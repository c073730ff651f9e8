"""Rounds of rows appended exactly once, with a commit log.

A round is written to a folder of its own attempt, ``data/<round>-<attempt>``, and becomes part
of the table when ``_log/<round>`` is created, which names that folder. Creation fails where the
file exists, so of two attempts at a round, after a crash or side by side, the first one counts
and the other is deleted. Readers take the folders that the log names and nothing else: a
crashed attempt is never seen. The log has one small file per round; ``compact`` folds the
rounds of a long history into one.
"""

from __future__ import annotations

import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sftpipe.session import write_stage

_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def round_name(rows: DataFrame) -> str:
    """A name that depends on the rows alone, in any order and partitioning."""
    struct = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    digest = F.sum(F.xxhash64(struct).cast("decimal(38,0)"))
    total, n = rows.agg(F.coalesce(digest, F.lit(0)), F.count(F.lit(1))).first()
    return f"rows-{n}-{int(total) % (1 << 64):x}"


def _entries(spark: SparkSession, path: str) -> dict[str, dict]:
    """Round to its log entry. A file without a whole entry was not committed."""
    place, files = _place(spark, f"{path}/_log")
    if not files.exists(place):
        return {}
    found = {}
    for status in files.listStatus(place):
        stream = files.open(status.getPath())
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        try:
            found[status.getPath().getName()] = json.loads(text)
        except json.JSONDecodeError:
            continue
    return found


def rounds(spark: SparkSession, path: str) -> list[str]:
    """The committed rounds, among them those that ``compact`` has folded into another."""
    found = _entries(spark, path)
    return sorted({*found, *(name for entry in found.values() for name in entry.get("holds", ()))})


def _commit(spark: SparkSession, path: str, name: str, entry: dict) -> bool:
    place, files = _place(spark, f"{path}/_log/{name}")
    try:
        stream = files.create(place, False)
    except Py4JJavaError:
        if files.exists(place):
            return False
        raise
    stream.write(bytearray(json.dumps(entry).encode()))
    stream.close()
    return True


def append_round(rows: DataFrame, path: str, name: str | None = None) -> bool:
    """Append the rows as JSON lines under the round's name; False if the round is there already.

    Without a name it is made from the rows, so rows applied again change nothing.
    """
    spark, path = rows.sparkSession, path.rstrip("/")
    if name is None:
        rows = write_stage(rows, "round")
        name = round_name(rows)
    if not _NAME.fullmatch(name):
        raise ValueError(f"{name!r} cannot name a round")
    if name in rounds(spark, path):
        return False
    folder = f"data/{name}-{uuid.uuid4().hex}"
    rows.write.json(f"{path}/{folder}")
    if _commit(spark, path, name, {"folder": folder}):
        return True
    place, files = _place(spark, f"{path}/{folder}")
    files.delete(place, True)
    return False


def read_rounds(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The rows of all committed rounds."""
    path = path.rstrip("/")
    folders = sorted(f"{path}/{entry['folder']}" for entry in _entries(spark, path).values() if "folder" in entry)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(folders)


def compact(spark: SparkSession, path: str, schema: str | StructType) -> int:
    """Fold all rounds into one; returns how many there were. No writer or reader may run
    meanwhile.

    A crash before the new entry leaves the old rounds; one after it leaves entries that the
    new one holds, which the next run removes first.
    """
    path = path.rstrip("/")
    entries = _entries(spark, path)
    held = {name for entry in entries.values() for name in entry.get("holds", ())}
    _drop(spark, path, {name: entries.pop(name) for name in held & entries.keys()})
    if len(entries) < 2:
        return len(entries)
    name = f"compacted-{uuid.uuid4().hex}"
    folder = f"data/{name}"
    read_rounds(spark, path, schema).write.json(f"{path}/{folder}")
    every = sorted({*entries, *(n for e in entries.values() for n in e.get("holds", ()))})
    _commit(spark, path, name, {"folder": folder, "holds": every})
    _drop(spark, path, entries)
    return len(entries)


def _drop(spark: SparkSession, path: str, entries: dict[str, dict]) -> None:
    for name, entry in entries.items():
        for part in (f"{path}/_log/{name}", f"{path}/{entry['folder']}"):
            place, files = _place(spark, part)
            files.delete(place, True)
