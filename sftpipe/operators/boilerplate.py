"""Ad noise: lines that a site repeats on its pages.

A line in its normal form (lower case, blanks collapsed, numbers alike) that stands on many
pages of its site is a template: advertisement, navigation, call to action. Lines are counted
over the whole corpus as 16-byte digests of site and line, each once a page, so a count is a
number of distinct pages; counting combines before it shuffles, so neither a large site nor a
line on all pages is one task's work. Removal is by line numbers within the page's own row.

``key`` is unique; a null site is a site of its own, a null text stays null and has no lines.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftpipe.operators.joins import BROADCAST_ROWS, join_hot
from sftpipe.session import write_counted, write_stage


@dataclass(frozen=True)
class TemplateRule:
    """On at least ``min_pages`` pages and this share of a site's pages."""

    min_pages: int = 5
    min_share: float = 0.2


def normal_line(line: Column) -> Column:
    """A line with blanks collapsed, in lower case, and runs of digits as one zero."""
    plain = F.trim(F.regexp_replace(line, r"[\s\x{a0}\x{3000}]+", " "))
    return F.regexp_replace(F.lower(plain), "[0-9]+", "0")


def line_digests(site: str, text: str) -> Column:
    """One digest for each line of the text, null for blank lines."""
    name = F.coalesce(F.col(site).cast("string"), F.lit(""))
    known = F.concat(F.col(site).isNotNull().cast("string"), F.lit(":"), name, F.lit("\n"))

    def digest(line: Column) -> Column:
        normal = normal_line(line)
        return F.when(normal != "", F.unhex(F.md5(F.concat(known, normal))))

    return F.transform(F.split(F.col(text), "\n"), digest)


def page_lines(pages: DataFrame, key: str, site: str, text: str) -> DataFrame:
    """(key, site, digests) of each page: the narrow table that the steps share."""
    return pages.select(F.col(key).alias("key"), F.col(site).alias("site"), line_digests(site, text).alias("digests"))


def template_lines(lines: DataFrame, rule: TemplateRule = TemplateRule()) -> DataFrame:
    """(site, digest, pages, site_pages) of the templates in ``page_lines``."""
    sites = lines.groupBy("site").agg(F.count(F.lit(1)).alias("site_pages"))
    distinct = F.filter(F.array_distinct("digests"), lambda d: d.isNotNull())
    counted = (
        lines.select("site", F.explode(distinct).alias("digest"))
        .groupBy("digest")
        .agg(F.any_value("site").alias("site"), F.count(F.lit(1)).alias("pages"))
        .filter(F.col("pages") >= rule.min_pages)
        .withColumnRenamed("site", "of")
    )
    # One row per site on the right; the left holds at most a few lines of each.
    joined = counted.join(sites, F.col("of").eqNullSafe(F.col("site")))
    share = F.col("pages") >= F.lit(rule.min_share) * F.col("site_pages")
    return joined.filter(share).select("site", "digest", "pages", "site_pages")


def _numbers_in_place(lines: DataFrame, templates: DataFrame) -> DataFrame:
    """Few templates: each site's digests go to its pages, which are not moved."""
    of_site = templates.groupBy(F.col("site").alias("of")).agg(F.collect_set("digest").alias("templates"))
    met = lines.join(F.broadcast(of_site), F.col("of").eqNullSafe(F.col("site")))
    # Hashed: a page's lines are not compared with each template of its site.
    own = met.select("key", "digests", F.array_intersect("digests", "templates").alias("own"))
    numbered = F.transform("digests", lambda d, i: F.when(F.array_contains("own", d), i))
    return own.filter(F.size("own") > 0).select("key", F.array_compact(numbered).alias("numbers"))


def _numbers_by_shuffle(lines: DataFrame, templates: DataFrame) -> DataFrame:
    """Many templates: line digests meet them by hash, those of frequent lines by broadcast."""
    held = lines.select("key", F.posexplode("digests").alias("number", "digest")).filter("digest IS NOT NULL")
    held, rows = write_counted(held, "line-digests")
    counts = templates.select("digest", F.col("pages").alias("count"))
    met = join_hot(held, templates.select("digest"), "digest", "inner", rows, counts=counts)
    return met.groupBy("key").agg(F.sort_array(F.collect_list("number")).alias("numbers"))


def template_numbers(
    lines: DataFrame, rule: TemplateRule = TemplateRule(), broadcast_rows: int = BROADCAST_ROWS
) -> tuple[DataFrame, int]:
    """(key, numbers) of the pages with template lines, their line numbers from 0, and how many
    numbers these are."""
    templates, rows = write_counted(template_lines(lines, rule), "templates")
    found = (_numbers_in_place if rows <= broadcast_rows else _numbers_by_shuffle)(lines, templates)
    return write_counted(found, "template-numbers", F.sum(F.size("numbers")))


def kept_lines(text: Column, numbers: Column) -> Column:
    """The text without the lines of these numbers."""
    placed = F.transform(F.split(text, "\n"), lambda line, i: F.when(~F.array_contains(numbers, i), line))
    return F.when(F.size(numbers) > 0, F.array_join(F.array_compact(placed), "\n")).otherwise(text)


def remove_templates(
    pages: DataFrame,
    key: str,
    site: str,
    text: str,
    rule: TemplateRule = TemplateRule(),
    removed: str | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``pages`` with ``text`` without template lines; ``removed`` names a column for their
    numbers.

    Texts stay where they are read while the numbers are few enough to broadcast; beyond that
    they are shuffled once, by key.
    """
    lines = write_stage(page_lines(pages, key, site, text), "page-lines")
    numbers, rows = template_numbers(lines, rule, broadcast_rows)
    name = "_numbers"
    while name in pages.columns:
        name = f"_{name}"
    side = numbers.select(F.col("key").alias(key), F.col("numbers").alias(name))
    joined = pages.join(F.broadcast(side) if rows <= broadcast_rows else side.hint("shuffle_hash"), key, "left")
    found = F.coalesce(F.col(name), F.array().cast("array<int>"))
    columns = [kept_lines(F.col(c), found).alias(c) if c == text else F.col(f"`{c}`") for c in pages.columns]
    return joined.select(*columns, *([found.alias(removed)] if removed else []))
