"""Queries of the cleaning steps beyond the core build."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sftpipe.functions.identifiers import KINDS
from sftpipe.functions.residue import has_residue, strip_residue
from sftpipe.operators import boilerplate, relevance
from sftpipe.operators import deidentify as D
from sftpipe.plans import views
from sftpipe.plans.checks import query
from sftpipe.session import spread, write_stage

#: The secret of these queries alone; real ones are brought by the caller.
SECRET = b"secret of the registered queries"


def _personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spread(views.table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return documents.select("doc_id", views.personal_text().alias("text"))


@query
def deidentified_documents(spark, sf_dir):
    """Texts with true and false identifiers, replaced where they are true."""
    found = D.deidentify(_personal(spark, sf_dir), ["text"], SECRET, counts="found")
    return found.select("doc_id", "text", *[F.col("found")[k].cast("long").alias(f"n_{k}") for k in KINDS])


@query
def identifier_mentions(spark, sf_dir):
    """How often each identifier is mentioned in all texts, under its pseudonym."""
    return D.mentions(D.identifiers(_personal(spark, sf_dir), "doc_id", ["text"], SECRET))


@query
def identifiers_left(spark, sf_dir):
    """What a second pass over replaced texts still finds, which is nothing."""
    sizes = Observation()
    replaced = D.deidentify(_personal(spark, sf_dir), ["text"], SECRET).observe(
        sizes, F.count("text").alias("texts"), F.sum(F.length("text")).alias("chars")
    )
    once = write_stage(replaced, "replaced")
    left = D.identifiers(once, "doc_id", ["text"], SECRET).agg(F.count(F.lit(1)).alias("left"))
    # Counted by the job that wrote the texts, so they are read again only to be searched.
    return left.select(*[F.lit(sizes.get[n]).cast("bigint").alias(n) for n in ("texts", "chars")], "left")


TEMPLATES = boilerplate.TemplateRule(min_pages=3, min_share=0.3)


@query
def ad_lines(spark, sf_dir):
    """Lines that sites repeat, as digests, with the pages that have them."""
    lines = boilerplate.page_lines(views.site_pages(spark, sf_dir), "page_key", "site", "text")
    found = boilerplate.template_lines(write_stage(lines, "page-lines"), TEMPLATES)
    return found.select("site", F.lower(F.hex("digest")).alias("digest"), "pages", "site_pages")


@query
def pages_without_ads(spark, sf_dir):
    """The pages without these lines, and the numbers of the removed ones."""
    pages = views.site_pages(spark, sf_dir)
    found = boilerplate.remove_templates(pages, "page_key", "site", "text", TEMPLATES, removed="removed")
    return found.select("page_key", "site", "text", F.array_join("removed", ",").alias("removed"))


@query
def documents_without_residue(spark, sf_dir):
    """Texts with HTML residue, cleaned of it."""
    documents = spread(views.table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    marked = documents.select("doc_id", views.residue_text().alias("text"))
    return marked.select("doc_id", strip_residue("text").alias("text"))


@query
def residue_counts(spark, sf_dir):
    """How many texts of documents, as they are and with residue, are changed."""
    documents = spread(views.table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), "doc_id")
    both = documents.select("lang", "text", views.residue_text().alias("marked"))
    return both.groupBy("lang").agg(
        F.count_if(has_residue("text")).alias("plain_changed"), F.count_if(has_residue("marked")).alias("marked_changed")
    )


# The tables hold words of letters, where two neighbours say little.
RELEVANCE = relevance.RelevanceRule(gram=5, quantile=0.8)


@query
def irrelevant_answers(spark, sf_dir):
    """Score, bound and verdict of pairs of which every fifth has another's answer."""
    pairs = write_stage(views.relevance_pairs(spark, sf_dir), "relevance-pairs")
    return relevance.relevance(pairs, "doc_id", "question", "answer", "lang", RELEVANCE)


@query
def relevance_of_swaps(spark, sf_dir):
    """Pairs by whether their answer was swapped and whether it was called irrelevant."""
    pairs = write_stage(views.relevance_pairs(spark, sf_dir), "relevance-pairs")
    found = relevance.relevance(pairs, "doc_id", "question", "answer", "lang", RELEVANCE)
    return found.join(pairs.select("doc_id", "swapped"), "doc_id").groupBy("swapped", "irrelevant").count()
