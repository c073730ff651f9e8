"""One large quoted CSV file read by many tasks.

A quoted cell may hold line breaks, so whether a line begins a row depends on all quotes before
it. The file is read as lines, block by block. A first pass counts each block's quotes; the
running parity of these counts, one small row per block, says whether a block begins inside a
quoted cell. In a second pass every task follows the parity from there and joins lines to rows.
A row that goes on in the next block leaves a fragment in both; fragments, one or two a block,
are put together by their order. The joined rows are parsed by Spark's own CSV functions.

Text is read twice and moved only where a row crosses blocks. A block's lines are one task's;
``spark.sql.files.maxPartitionBytes`` sets its size. A quote that opens a cell and is never
closed makes one row of all that follows, as it does for any reader of such files.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sftpipe.operators.joins import BROADCAST_ROWS
from sftpipe.session import write_counted, write_stage
from sftpipe.sources.readers import NA_STRINGS, _SCHEME, expand_globs, read_header

_LINES = "file string, start bigint, place bigint, odd boolean, line string"
_ROWS = "file string, start bigint, part int, place bigint, row string"
#: Parts of a block: the end of a row of an earlier block, whole rows, a row that goes on.
HEAD, WHOLE, TAIL = 0, 1, 2


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """Lines in the order of their block; ``odd`` says if a line has an odd number of quotes."""
    raw = spark.read.option("lineSep", "\n").text(files)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return raw.select(
        F.regexp_replace(F.col("_metadata.file_path"), _SCHEME, "$1").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
        (quotes % 2 == 1).alias("odd"),
        F.col("value").alias("line"),
    )


def block_parities(lines: DataFrame) -> tuple[DataFrame, int]:
    """(file, start, inside) of each block: whether it begins within a quoted cell; and how many
    blocks there are."""
    odd = (F.count_if("odd") % 2).alias("odd")
    blocks, rows = write_counted(lines.groupBy("file", "start").agg(odd), "csv-blocks")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1
    return blocks.select("file", "start", inside.alias("inside")), rows


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (file, start, place, odd, line, inside) in order to rows (file, start, part, place, row)."""
    block, inside, held, at, part = None, False, [], 0, WHOLE

    def ended(rows: list[tuple], part: int) -> None:
        if held:
            rows.append((*block, part, at, "\n".join(held)))
            held.clear()

    for batch in batches:
        rows: list[tuple] = []
        for file, start, place, odd, line, began in zip(*(c.to_pylist() for c in batch.columns)):
            if (file, start) != block:
                ended(rows, TAIL)
                block, inside = (file, start), began
                part = HEAD if began else WHOLE
            if not held:
                at = place
            held.append(line)
            inside ^= odd
            if not inside:
                ended(rows, part)
                part = WHOLE
        yield _batch(rows)
    rows = []
    ended(rows, TAIL)
    yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string())
    columns = list(zip(*rows)) or [[] for _ in kinds]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "start", "part", "place", "row"]
    )


def _across_blocks(parts: DataFrame) -> DataFrame:
    """Rows made of fragments: a tail and the heads that follow it, up to the next tail.

    A block within one cell is a tail that begins inside, so it is no row of its own: ``part``
    says so by the block's parity. There are at most two fragments a block.
    """
    order = Window.partitionBy("file").orderBy("start", "part")
    fragments = parts.withColumn("row_number", F.sum(F.col("opens").cast("int")).over(order))
    pieces = F.sort_array(F.collect_list(F.struct("start", "part", "row")))
    put = F.aggregate(
        pieces, F.lit(None).cast("string"),
        lambda text, p: F.when(text.isNull(), p["row"]).otherwise(F.concat(text, F.lit("\n"), p["row"])),
    )
    firsts = F.min(F.struct("start", "part", "place")).alias("first")
    rows = fragments.groupBy("file", "row_number").agg(firsts, put.alias("row"))
    return rows.select("file", F.col("first.start").alias("start"), F.col("first.place").alias("place"), "row")


def csv_rows(spark: SparkSession, files: list[str], broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(file, start, place, row): the rows as text; (file, start, place) is their order."""
    lines = _lines(spark, files)
    parities, blocks = block_parities(lines)
    side = F.broadcast(parities) if blocks <= broadcast_rows else parities.hint("shuffle_hash")
    known = lines.join(side, ["file", "start"]).select("file", "start", "place", "odd", "line", "inside")
    if blocks > broadcast_rows:
        known = known.repartition("file", "start").sortWithinPartitions("file", "start", "place")
    parts = write_stage(known.mapInArrow(_joined, _ROWS), "csv-parts")
    whole = parts.filter(F.col("part") == WHOLE).select("file", "start", "place", "row")
    # A tail opens a row unless its block begins and ends inside the same cell.
    fragments = parts.filter(F.col("part") != WHOLE).join(F.broadcast(parities) if blocks <= broadcast_rows else parities, ["file", "start"])
    first = Window.partitionBy("file", "start").orderBy("part", "place")
    opens = (F.col("part") == TAIL) & ~(F.col("inside") & (F.row_number().over(first) == 1))
    return whole.unionByName(_across_blocks(fragments.withColumn("opens", opens).drop("inside")))


def _ordered(rows: DataFrame, name: str) -> DataFrame:
    """Rows with a BIGINT in their order: those of a block are counted from the sum of the blocks
    before, which is found on one row per block."""
    staged = write_stage(rows, "csv-rows")
    blocks = staged.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n"))
    files = blocks.groupBy("file").agg(F.sum("n").alias("n"))
    before_file = F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    in_file = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("file", "start", F.coalesce(F.sum("n").over(in_file), F.lit(0)).alias("own")).join(
        files.select("file", before_file.alias("base")), "file"
    )
    inside = F.row_number().over(Window.partitionBy("file", "start").orderBy("place")) - 1
    numbered = staged.select("file", "start", "row", inside.alias("inside"))
    return numbered.join(offsets, ["file", "start"]).select((F.col("base") + F.col("own") + F.col("inside")).alias(name), F.col("row").alias("_row"))


def _parsed(rows: DataFrame, header: tuple[str, ...], *keep: str) -> DataFrame:
    """The cells of rows by name, missing-value texts as null; a cell too many is an error."""
    names = [f"c{i}" for i in range(len(header))]
    schema = ", ".join(f"{n} string" for n in [*names, "more"])
    options = {"quote": '"', "escape": '"', "nullValue": "", "multiLine": "true", "maxCharsPerColumn": "-1"}
    options |= {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    read = rows.select(*keep, "_row", F.from_csv("_row", schema, options).alias("_cells"))
    complaint = F.concat(F.lit("more cells than the header has: "), F.col("_row"))
    whole = F.col("_cells.more").isNull() | F.raise_error(complaint).cast("boolean")
    cells = [F.when(~F.col(f"_cells.{n}").isin(*NA_STRINGS), F.col(f"_cells.{n}")).alias(h) for n, h in zip(names, header)]
    return read.filter(whole).select(*keep, *cells)


def read_large_csv(
    spark: SparkSession, paths: str | list[str], order_key: str | None = None, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``read_csv`` for large files: the same cells, read block by block.

    Files have one header, each begins with it. Blank lines between rows are left out.
    ``order_key`` adds a BIGINT that follows the files by path, then the rows.
    """
    files = sorted(expand_globs(spark, [paths] if isinstance(paths, str) else paths))
    header = read_header(spark, files[0])
    if odd := [f for f in files[1:] if read_header(spark, f) != header]:
        raise ValueError(f"another header than {files[0]}: {odd[0]}")
    found = csv_rows(spark, files, broadcast_rows)
    # The header is the first row of a file's first block.
    heads = found.filter("start = 0").groupBy("file").agg(F.min("place").alias("head"))
    rows = found.join(F.broadcast(heads) if len(files) <= broadcast_rows else heads, "file")
    rows = rows.filter((F.col("start") > 0) | (F.col("place") != F.col("head"))).drop("head")
    rows = rows.withColumn("row", F.regexp_replace("row", r"\r\z", "")).filter("row != ''")
    if order_key is None:
        return _parsed(rows.withColumnRenamed("row", "_row"), header)
    return _parsed(_ordered(rows, order_key), header, order_key)
