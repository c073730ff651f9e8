"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

#: Words are runs of anything but the six ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def filled(text: str | Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: str | Column) -> Column:
    """A-Z in lower case; all other characters stay."""
    return F.translate(text, UPPER, LOWER)


def id_text(key: str | Column) -> Column:
    """The id as text, null as empty."""
    return F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(""))


def count_at_most(bounds: Column, size: int, value: Column) -> Column:
    """How many of the ``size`` ascending numbers in the array ``bounds`` are at most ``value``.

    A binary search: the array is read once per halving.
    """
    steps = [1 << i for i in reversed(range(size.bit_length()))]
    return F.aggregate(
        F.array(*map(F.lit, steps)),
        F.lit(0),
        lambda at, step: F.when(F.get(bounds, at + step - 1) <= value, at + step).otherwise(at),
    )


def map_texts(
    df: DataFrame,
    schema: str,
    rows: Callable[[Iterator[dict]], Iterator[list[tuple]]],
) -> DataFrame:
    """Run ``rows`` over the Arrow batches of ``df``, one list of columns in, tuples out.

    ``rows`` gets dicts from column name to a list of values and yields the rows that
    belong to each. Memory is that of one batch.
    """
    fields = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in rows(batch.to_pydict() for batch in batches):
            columns = list(zip(*found)) or [[] for _ in fields]
            arrays = [pa.array(c, f.type) for c, f in zip(columns, fields)]
            yield pa.RecordBatch.from_arrays(arrays, schema=fields)

    return df.mapInArrow(run, schema)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
