"""Connected components of a link table, as Spark jobs.

Large and small stars alternate: every node points its larger neighbours, then its smaller
ones, at the smallest node it knows. Each round keeps the components, writes at most one
row per node and neighbour, and the number of rounds grows with the logarithm of the
longest chain squared. Rounds end when a round changes nothing, which is when every node
points at the smallest one of its component.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftpipe.session import write_counted


def _state() -> Column:
    digest = F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))
    return F.concat_ws(":", F.count(F.lit(1)).cast("string"), digest.cast("string"))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node reachable, of all nodes in ``links``.

    ``links`` has two long columns; loops and repeated links are allowed, nulls are not.
    A node that only has a loop is left out.
    """
    a, b = (F.col(f"`{c}`") for c in links.columns)
    stars, state = write_counted(
        links.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"))
        .filter("high <> low")
        .distinct(),
        "links",
        _state(),
    )
    before = None
    while state != before:
        before = state
        both = stars.unionByName(stars.select(F.col("low").alias("high"), F.col("high").alias("low")))
        least = both.groupBy("high").agg(F.least(F.col("high"), F.min("low")).alias("least"))
        large = (
            both.filter("low > high")
            .join(least, "high")
            .select(F.col("low").alias("high"), F.col("least").alias("low"))
            .distinct()
        )
        firsts = large.groupBy("high").agg(F.min("low").alias("least"))
        small = (
            large.join(firsts, "high")
            .select(F.explode(F.array(
                F.struct(F.col("high"), F.col("least").alias("low")),
                F.struct(F.col("low").alias("high"), F.col("least").alias("low")),
            )).alias("x"))
            .select("x.*")
            .filter("high <> low")
            .distinct()
        )
        stars, state = write_counted(small, "stars", _state())
    roots = stars.select("low").distinct().select(F.col("low").alias("node"), F.col("low").alias("label"))
    return stars.select(F.col("high").alias("node"), F.col("low").alias("label")).unionByName(roots)
