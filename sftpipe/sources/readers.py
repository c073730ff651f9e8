"""CSV and JSON-lines sources."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sftpipe.operators.joins import BROADCAST_ROWS
from sftpipe.operators.stats import profile
from sftpipe.session import write_stage

# Texts that count as missing in a CSV cell.
NA_STRINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
BOM = "\ufeff"
SCORED_SCHEMA = (
    "instruction string, input string, output string, source string, complexity double, "
    "clarity double, informativeness double, reason string, _error string"
)
HEADER_BYTES = 1 << 16
_READERS = 32
_ROW_BITS = 33
_EXTRA = "_more_cells_than_the_header"
# Listing and row metadata write the slashes after a scheme differently.
_SCHEME = r"^([a-zA-Z][\w+.-]*:)/+"


def strip_bom(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lstrip(BOM) for c in df.columns])


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def expand_globs(spark: SparkSession, patterns: Iterable[str]) -> list[str]:
    """Files matching each pattern; a pattern without a match stands for itself.

    A folder stands for the files in it that Spark would read.
    """
    paths: list[str] = []
    for pattern in patterns:
        glob, files = _file_system(spark, pattern)
        found = list(files.globStatus(glob) or [])
        for status in found:
            inside = files.listStatus(status.getPath()) if status.isDirectory() else [status]
            names = (s.getPath().toString() for s in inside if s.isFile())
            paths += [n for n in names if not re.match(r"[._]", n.rpartition("/")[2])]
        paths += [] if found else [pattern]
    return paths


def read_header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of one CSV file, from a read of its first bytes."""
    place, files = _file_system(spark, path)
    if not files.exists(place):
        raise FileNotFoundError(path)
    stream = files.open(place)
    try:
        codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(files.getConf()).getCodec(place)
        source = codec.createInputStream(stream) if codec else stream
        head = bytes(source.readNBytes(HEADER_BYTES)).decode("utf-8", "replace")
    finally:
        stream.close()
    if not head.strip():
        raise ValueError("no columns to read from the file")
    return tuple(c.lstrip(BOM) for c in next(csv.reader(head.splitlines(keepends=True))))


def _by_header(spark: SparkSession, files: list[str]) -> dict[tuple[str, ...], list[tuple[int, str]]]:
    """(place in the list, file) of the files with each header; headers are read side by side."""
    with ThreadPoolExecutor(_READERS) as pool:
        headers = list(pool.map(lambda f: read_header(spark, f), files))
    groups: dict[tuple[str, ...], list[tuple[int, str]]] = {}
    for place, (file, header) in enumerate(zip(files, headers)):
        groups.setdefault(header, []).append((place, file))
    return groups


def _read_group(
    spark: SparkSession, header: tuple[str, ...], files: list[tuple[int, str]], order_key: str | None, multi_line: bool
) -> DataFrame:
    """Files with one header. A row with more cells than it is an error, one with fewer is filled with nulls."""
    schema = StructType([StructField(f"c{i}", StringType()) for i in range(len(header))])
    raw = spark.read.schema(schema.add(_EXTRA, "string")).options(
        header=True, multiLine=multi_line, quote='"', escape='"', encoding="UTF-8",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, nullValue="",
    ).csv([f for _, f in files])
    cells = [
        F.when(~F.col(f"c{i}").isin(*NA_STRINGS), F.col(f"c{i}")).alias(name) for i, name in enumerate(header)
    ]
    file = F.col("_metadata.file_path")
    complaint = F.concat(F.lit("more cells than the header has: "), file, F.lit(": "), *[
        F.concat(F.coalesce(f"c{i}", F.lit("")), F.lit(",")) for i in range(len(header))
    ], F.col(_EXTRA))
    whole = F.col(_EXTRA).isNull() | F.raise_error(complaint).cast("boolean")
    if order_key is None:
        return raw.filter(whole).select(*cells)
    ranks = F.broadcast(
        spark.createDataFrame([(n, re.sub(_SCHEME, r"\1", f)) for n, f in files], "_rank bigint, _file string")
    )
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    named = F.regexp_replace(file, _SCHEME, "$1").alias("_file")
    ranked = raw.select("*", "_metadata", named, row.alias("_row")).join(ranks, "_file", "left")
    rank = F.coalesce("_rank", F.raise_error(F.concat(F.lit("unlisted file "), "_file")))
    return ranked.filter(whole).select((F.shiftleft(rank, _ROW_BITS) + F.col("_row")).alias(order_key), *cells)


def read_csv(
    spark: SparkSession,
    paths: str | list[str],
    order_key: str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Headered RFC-4180 CSV, all columns text, missing-value texts as null.

    Files may order their columns differently or lack some: those with the same header are
    read together, and groups are joined by name. Quoted line breaks need ``multi_line``,
    where one file is one task; land large files with ``write_stage`` before using them
    twice. ``order_key`` adds a BIGINT that follows file order, by path, then row order.
    The text stays where it is read: a file's place comes from a broadcast list of at most
    ``BROADCAST_ROWS`` names.
    """
    if order_key is not None and not multi_line:
        raise ValueError("row order over split files is not defined; bring a key column")
    patterns = [paths] if isinstance(paths, str) else list(paths)
    files = sorted(expand_globs(spark, patterns))
    result: DataFrame | None = None
    for header, members in _by_header(spark, files).items():
        for at in range(0, len(members), BROADCAST_ROWS):
            part = _read_group(spark, header, members[at : at + BROADCAST_ROWS], order_key, multi_line)
            result = part if result is None else result.unionByName(part, allowMissingColumns=True)
    if result is None:
        raise ValueError("no files to read")
    return result


def read_jsonl(
    spark: SparkSession, path: str, schema: str | StructType, order_key: str | None = None
) -> DataFrame:
    """JSON lines. ``order_key`` adds a unique BIGINT in the order of files, blocks and lines.

    Files are numbered by path and blocks by their start, on the driver; a task counts its
    lines from there. The numbers stay the same while the files and the split size do.
    """
    lines = spark.read.schema(schema).json(path)
    if order_key is None:
        return lines
    # Rows of a task come in order, but tasks are not in the order of files.
    place = F.struct(
        F.regexp_replace(F.col("_metadata.file_path"), _SCHEME, "$1").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
    )
    numbered = lines.select("*", place.alias("_place"), F.monotonically_increasing_id().alias("_row"))
    blocks = numbered.groupBy("_place").agg(F.count(F.lit(1)).alias("n"), F.min("_row").alias("first"))
    found = sorted(blocks.collect(), key=lambda r: (r["_place"]["file"], r["_place"]["start"]))
    offsets, total = [], 0
    for r in found:
        offsets.append((r["_place"], total - r["first"]))
        total += r["n"]
    known = StructType([blocks.schema["_place"], StructField("_offset", LongType())])
    table = F.broadcast(spark.createDataFrame(offsets, known))
    return numbered.join(table, "_place").select(
        (F.col("_row") + F.col("_offset")).alias(order_key), *[f"`{c}`" for c in lines.columns]
    )


def _chunks(files: list[str], profiled) -> Iterator[tuple[DataFrame | None, list[tuple[str, str]]]]:
    """The profile of all files at once, or, if a read fails, of each file by itself."""
    try:
        yield write_stage(profiled(files), "file-profile"), []
    except (PySparkException, Py4JJavaError) as error:
        if len(files) == 1:
            yield None, [(files[0], f"{type(error).__name__}: {str(error).splitlines()[0]}")]
            return
        middle = len(files) // 2
        yield from _chunks(files[:middle], profiled)
        yield from _chunks(files[middle:], profiled)


def profile_files(
    spark: SparkSession, patterns: Iterable[str], folders: bool = False
) -> tuple[DataFrame | None, list[tuple[str, str]]]:
    """Profile of each CSV on its own, and (path, error) of the ones skipped.

    Files with the same header are one plan, grouped by file. Where a read fails, at the
    start or halfway, the files are halved until the bad ones are alone. With ``folders`` the
    files of a folder are one table, and its path is that of the folder; files of one folder
    with other headers, or beside a bad one, are tables of their own.
    """
    headers: dict[tuple[str, ...], list[str]] = {}
    skipped: list[tuple[str, str]] = []
    for path in expand_globs(spark, patterns):
        try:
            headers.setdefault(read_header(spark, path), []).append(path)
        except Exception as error:  # a file that cannot be opened is reported, whatever the reason
            skipped.append((path, f"{type(error).__name__}: {str(error).splitlines()[0]}"))
    result: DataFrame | None = None
    for header, files in headers.items():

        def profiled(some: list[str], header=header) -> DataFrame:
            members = list(enumerate(some))
            table = _read_group(spark, header, members, "_order", True)
            place = F.shiftright("_order", _ROW_BITS)
            named = [(n, f.rpartition("/")[0] if folders else f) for n, f in members]
            first = {name: n for n, name in reversed(named)}
            paths = F.broadcast(spark.createDataFrame([(n, first[name], name) for n, name in named], "_file bigint, _place bigint, path string"))
            placed = table.select(place.alias("_file"), *[f"`{c}`" for c in header]).join(paths.drop("path"), "_file")
            found = profile(placed.select("_place", *[f"`{c}`" for c in header]), by="_place")
            names = paths.filter("_file = _place").select("_place", "path")
            return found.join(names, "_place").select("path", *[c for c in found.columns if c != "_place"])

        for part, bad in _chunks(files, profiled):
            skipped += bad
            if part is not None:
                result = part if result is None else result.unionByName(part)
    return result, skipped
