"""Sinks: training records, scored rows, splits and the report."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines in column order: UTF-8 unescaped, empty text kept, nulls left out."""
    df.write.mode(mode).json(path)


def append_scored(scored: DataFrame, path: str, overwrite: bool = False) -> None:
    """One atomic commit per job; a rerun scores what is still missing."""
    write_jsonl(scored, path, "overwrite" if overwrite else "append")


def write_csv(df: DataFrame, path: str, by: str | None = None) -> None:
    """Headered UTF-8 CSV without a byte-order mark; a folder for each value of ``by``."""
    writer = df.write.mode("overwrite").options(
        header=True, quote='"', escape='"', emptyValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    (writer.partitionBy(by) if by else writer).csv(path)


def write_splits(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def report_lines(funnel: dict) -> list[str]:
    """Markdown lines of the one-row funnel."""

    def pct(value: float | None) -> str:
        return "skipped" if value is None else f"{value:.1f}%"

    def mean(value: float | None) -> str:
        return "none" if value is None else f"{value:.0f}"

    return [
        "# Data quality report",
        "",
        f"- raw rows: {funnel['raw_rows']}",
        f"- after empty filter: {funnel['after_clean']}",
        f"- after exact dedup: {funnel['after_exact']} ({pct(funnel['exact_dup_pct'])} removed)",
        f"- after near dedup: {funnel['after_near']} ({pct(funnel['near_dup_pct'])} removed)",
        f"- after quality filter: {funnel['final_rows']}",
        f"- overall yield: {pct(funnel['yield_pct'])}",
        f"- mean question length: {mean(funnel['mean_question_chars'])}",
        f"- mean answer length: {mean(funnel['mean_answer_chars'])}",
    ]


def write_report(funnel: DataFrame, path: str) -> None:
    """The funnel is one row, so its text is built on the driver."""
    lines = report_lines(funnel.first().asDict())
    spark = funnel.sparkSession
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(path)
