"""Profiles, score and length distributions, fetch-log summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftpipe.functions.judge_json import DIMENSIONS
from sftpipe.operators.dedup import row_groups

SCORES = (1, 2, 3, 4, 5)
OVERALL_BINS = 20
LENGTH_BINS = 50
HIGH_QUALITY = 4


def _missing(df: DataFrame, name: str) -> Column:
    column = F.col(f"`{name}`")
    if df.schema[name].dataType.typeName() in ("double", "float"):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def profile(df: DataFrame, by: str | None = None) -> DataFrame:
    """Per column: missing count, with the table's row, column and duplicate counts.

    NaN counts as missing. One scan: missing flags are equal within a group of equal rows,
    so they ride on the digest grouping that counts duplicates. ``by`` names a column, the
    first, whose values are profiled apart.
    """
    keys = [by] if by else []
    names = [c for c in df.columns if c != by]
    flags = [F.count_if(_missing(df, n)).alias(f"n{i}") for i, n in enumerate(names)]
    groups = row_groups(df, *[F.first(F.col(f"`{k}`")).alias(k) for k in keys], *flags)
    totals = groups.groupBy(*keys).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.count("*").alias("distinct_rows"),
        F.array(
            *[
                F.struct(F.lit(n).alias("column"), F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias("nulls"))
                for i, n in enumerate(names)
            ]
        ).alias("per_column"),
    )
    return totals.select(
        *keys,
        F.inline("per_column"),
        "rows",
        F.lit(len(names)).alias("columns"),
        "distinct_rows",
        (F.col("rows") - F.col("distinct_rows")).alias("duplicates"),
    )


def scored_ok(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("_error").isNull())


def score_summary(scored: DataFrame) -> DataFrame:
    """Ok and failed rows of the whole table; means over ok rows with a missing score as 0."""
    ok = F.col("_error").isNull()
    return scored.agg(
        F.count_if(ok).alias("ok_rows"),
        F.count_if(~ok).alias("failed_rows"),
        *[
            F.avg(F.when(ok, F.coalesce(F.col(d), F.lit(0.0)))).alias(f"mean_{d}")
            for d in DIMENSIONS
        ],
    )


def score_histogram(scored: DataFrame) -> DataFrame:
    """Rows at exactly 1..5 per dimension, and the mean of those rows.

    All fifteen counts come from one aggregate row; other values are ignored.
    """
    counts = scored_ok(scored).agg(
        F.array(
            *[
                F.struct(
                    F.lit(d).alias("dimension"),
                    *[F.count_if(F.col(d) == s).alias(f"c{s}") for s in SCORES],
                )
                for d in DIMENSIONS
            ]
        ).alias("dims")
    )
    total = sum((F.col(f"c{s}") for s in SCORES), F.lit(0))
    weighted = sum((F.col(f"c{s}") * s for s in SCORES), F.lit(0))
    cells = F.array(
        *[F.struct(F.lit(s).alias("score"), F.col(f"c{s}").alias("rows")) for s in SCORES]
    )
    return (
        counts.select(F.inline("dims"))
        .select("dimension", F.try_divide(weighted, total).alias("mean"), F.inline(cells))
        .select("dimension", "score", "rows", "mean")
    )


def overall_score() -> Column:
    """Mean of the three scores; null unless all three are numbers."""
    return sum((F.col(d) for d in DIMENSIONS[1:]), F.col(DIMENSIONS[0])) / len(DIMENSIONS)


def high_quality(scored: DataFrame, threshold: float = HIGH_QUALITY) -> DataFrame:
    return scored_ok(scored).filter(overall_score() >= threshold)


def high_quality_share(scored: DataFrame, threshold: float = HIGH_QUALITY) -> DataFrame:
    high = F.count_if(F.col("overall") >= threshold)
    total = F.count("overall")
    return (
        scored_ok(scored)
        .select(overall_score().alias("overall"))
        .agg(
            total.alias("rated_rows"),
            high.alias("high_rows"),
            (F.try_divide(high, total) * 100).alias("high_pct"),
        )
    )


def histogram(df: DataFrame, value: Column, bins: int) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed; empty bins included.

    Edges follow numpy: ``lo + i * step``, a range of width 0 is widened by one
    half on both sides, and a value is moved by one bin where rounding put it on the
    wrong side of an edge.
    """
    values = df.select(value.cast("double").alias("v")).filter("v IS NOT NULL")
    spread = values.agg(F.min("v").alias("a"), F.max("v").alias("b"))
    flat = F.when(F.col("a") == F.col("b"), 0.5).otherwise(0.0)
    bounds = spread.select(
        (F.col("a") - flat).alias("lo"), (F.col("b") + flat).alias("hi")
    ).select(F.struct("lo", "hi", ((F.col("hi") - F.col("lo")) / bins).alias("step")).alias("r"))

    def edge(i: Column) -> Column:
        return F.col("r.lo") + i * F.col("r.step")

    last = F.lit(bins - 1)
    guess = F.least(
        F.floor((F.col("v") - F.col("r.lo")) / (F.col("r.hi") - F.col("r.lo")) * bins), last
    )
    counted = (
        values.withColumn("r", bounds.scalar())
        .withColumn("guess", guess)
        .select(
            F.when(F.col("v") < edge(F.col("guess")), F.col("guess") - 1)
            .when(
                (F.col("v") >= edge(F.col("guess") + 1)) & (F.col("guess") != last),
                F.col("guess") + 1,
            )
            .otherwise(F.col("guess"))
            .alias("bin"),
            "v",
        )
        .groupBy("bin")
        .agg(F.count("*").alias("rows"))
    )
    return (
        df.sparkSession.range(bins)
        .withColumnRenamed("id", "bin")
        .withColumn("r", bounds.scalar())
        .join(counted, "bin", "left")
        .select(
            "bin",
            edge(F.col("bin")).alias("lo"),
            F.when(F.col("bin") == last, F.col("r.hi"))
            .otherwise(edge(F.col("bin") + 1))
            .alias("hi"),
            F.coalesce("rows", F.lit(0)).alias("rows"),
        )
    )


def _chars(scored: DataFrame, field: str) -> Column:
    """The length of a text, or the column that ``narrow_scores`` has in its place."""
    name = f"{field}_chars"
    return F.col(name) if name in scored.columns else F.length(field)


def narrow_scores(scored: DataFrame) -> DataFrame:
    """Error-free rows without their texts: scores and lengths."""
    lengths = [F.length(f).alias(f"{f}_chars") for f in ("instruction", "output")]
    return scored_ok(scored).select(*DIMENSIONS, *lengths, F.lit(None).cast("string").alias("_error"))


def overall_histogram(scored: DataFrame, bins: int = OVERALL_BINS) -> DataFrame:
    return histogram(scored_ok(scored), overall_score(), bins)


def length_histogram(scored: DataFrame, field: str, bins: int = LENGTH_BINS) -> DataFrame:
    return histogram(scored_ok(scored), _chars(scored, field), bins)


def mean_lengths(scored: DataFrame) -> DataFrame:
    return scored_ok(scored).agg(
        F.avg(_chars(scored, "instruction")).alias("mean_question_chars"),
        F.avg(_chars(scored, "output")).alias("mean_answer_chars"),
    )


def fetch_summary(log: DataFrame) -> DataFrame:
    """Counts and times of a fetch log (url, status, elapsed_s); only status 200 is a success."""
    return log.agg(
        F.count_if(F.col("status") == 200).alias("ok"),
        F.count_if(~F.col("status").eqNullSafe(200)).alias("failed"),
        F.count("*").alias("total"),
        F.avg("elapsed_s").alias("mean_elapsed_s"),
        (F.avg("elapsed_s") * F.count("*")).alias("serial_estimate_s"),
    )
