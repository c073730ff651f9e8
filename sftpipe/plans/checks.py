"""Every operator as a named query over the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftpipe.functions import text as T
from sftpipe.functions.minhash import band_keys, band_shape, minhash_signature
from sftpipe.operators import columns, dedup, ingest, judge, pages, quality, split, stats
from sftpipe.plans import views
from sftpipe.plans.build import Build, BuildConfig, build, clean_pairs, with_bands
from sftpipe.plans.ingest import ingest_pages, runs
from sftpipe.plans.scoring import apply_responses, publish
from sftpipe.plans.scoring import distributions as scored_distributions
from sftpipe.session import scratch_path, spread, write_stage
from sftpipe.sources import tables
from sftpipe.sources.readers import SCORED_SCHEMA, profile_files, read_csv, read_jsonl
from sftpipe.sources.tables import store_totals
from sftpipe.sources.writers import append_scored, write_csv, write_jsonl, write_report, write_splits

# The benchmark tables hold no Han text, so their script class is any letter.
RULE = quality.QualityRule(script_class=r"[\p{L}]", min_script_ratio=0.6)
CONFIG = BuildConfig(quality=RULE, source="documents")
RECORD_SCHEMA = "instruction string, input string, output string, source string"
BANDS, ROWS = band_shape(CONFIG.threshold, CONFIG.num_perm)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_pairs(spread(views.documents_qa(spark, sf_dir), "doc_id"), "doc_id")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(views.table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


def _scored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows as a stored table, for statistics that read it more than once."""
    return write_stage(views.scored_documents(spark, sf_dir), "scored")


def _built(spark: SparkSession, sf_dir: str) -> Build:
    return build(views.documents_qa(spark, sf_dir), "doc_id", CONFIG)


@query
def clean_documents(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", T.clean_text("text").alias("text"))


@query
def normalize_columns(spark, sf_dir):
    raw = views.table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("lang").alias("input"),
        F.col("source").alias("Instruction"),
        F.col("text").alias("Model Output"),
    )
    return columns.normalize_columns(raw, "doc_id")


@query
def drop_empty_pairs(spark, sf_dir):
    return quality.drop_empty_pairs(_cleaned(spark, sf_dir))


@query
def exact_dedup(spark, sf_dir):
    pairs = quality.drop_empty_pairs(_cleaned(spark, sf_dir))
    hashed = pairs.withColumn("fingerprint", T.pair_fingerprint("question", "answer"))
    return dedup.exact_dedup(write_stage(hashed, "hashed"), "fingerprint", "doc_id")


@query
def ingest_fingerprint(spark, sf_dir):
    return views.documents_qa(spark, sf_dir).select(
        "doc_id", T.ingest_fingerprint("question", "answer").alias("content_hash")
    )


@query
def script_ratio(spark, sf_dir):
    return _documents(spark, sf_dir).select(
        "doc_id",
        T.script_ratio("text", RULE.script_class).alias("letter_ratio"),
        T.script_ratio("text").alias("han_ratio"),
        F.length("text").alias("chars"),
    )


@query
def shingle_counts(spark, sf_dir):
    return _documents(spark, sf_dir).select(
        "doc_id", F.size(T.shingles("text")).cast("long").alias("shingles")
    )


@query
def minhash_signatures(spark, sf_dir):
    minima = minhash_signature(F.col("text"), CONFIG.num_perm)
    return (
        _documents(spark, sf_dir)
        .select("doc_id", minima.alias("minima"))
        .select("doc_id", F.array_join(F.col("minima").cast("array<string>"), ",").alias("minima"))
    )


@query
def minhash_bands(spark, sf_dir):
    keyed = _documents(spark, sf_dir).select(
        "doc_id", band_keys(F.col("text"), BANDS, ROWS).alias("bands")
    )
    return keyed.select("doc_id", F.posexplode("bands").alias("band", "key")).select(
        "doc_id", F.col("band").cast("long").alias("band"), F.lower(F.hex("key")).alias("bucket")
    )


@query
def lsh_buckets(spark, sf_dir):
    keyed = with_bands(_cleaned(spark, sf_dir), CONFIG.threshold, CONFIG.num_perm)
    shared = dedup.shared_buckets(dedup.bucket_rows(keyed, "doc_id", "bands"), "doc_id")
    return shared.select(F.lower(F.hex("bucket")).alias("bucket"), "first_key", "size")


@query
def near_dedup(spark, sf_dir):
    pairs = quality.drop_empty_pairs(_cleaned(spark, sf_dir))
    keyed = with_bands(pairs, CONFIG.threshold, CONFIG.num_perm)
    return dedup.near_dedup(keyed.select("doc_id", "bands"), "doc_id").select("doc_id")


@query
def quality_filter(spark, sf_dir):
    return quality.quality_filter(_cleaned(spark, sf_dir), RULE)


@query
def drop_stage(spark, sf_dir):
    return _built(spark, sf_dir).stages


@query
def funnel_report(spark, sf_dir):
    return _built(spark, sf_dir).funnel


@query
def document_records(spark, sf_dir):
    return _built(spark, sf_dir).records


@query
def conversation_records(spark, sf_dir):
    config = BuildConfig(quality=RULE, source="conversations")
    return build(views.conversations_qa(spark, sf_dir), "turn_key", config).records


@query
def publish_fields(spark, sf_dir):
    return columns.publish_fields(stats.scored_ok(views.scored_documents(spark, sf_dir)), "doc_id")


@query
def judge_prompts(spark, sf_dir):
    return judge.judge_requests(views.document_records(spark, sf_dir), "doc_id")


@query
def judge_picks(spark, sf_dir):
    return judge.pick_responses(views.judge_responses(spark, sf_dir), "doc_id")


@query
def judge_scores(spark, sf_dir):
    return views.scored_documents(spark, sf_dir)


@query
def score_resume(spark, sf_dir):
    pending = judge.pending_records(
        views.document_records(spark, sf_dir), _scored_table(spark, sf_dir), "doc_id"
    )
    return pending.select("doc_id", "instruction")


@query
def score_summary(spark, sf_dir):
    return stats.score_summary(views.scored_documents(spark, sf_dir))


@query
def score_histogram(spark, sf_dir):
    return stats.score_histogram(views.scored_documents(spark, sf_dir))


@query
def overall_histogram(spark, sf_dir):
    return stats.overall_histogram(_scored_table(spark, sf_dir))


@query
def high_quality(spark, sf_dir):
    return stats.high_quality(views.scored_documents(spark, sf_dir)).select(
        "doc_id", "instruction", "output"
    )


@query
def high_quality_share(spark, sf_dir):
    return stats.high_quality_share(views.scored_documents(spark, sf_dir))


@query
def question_length_histogram(spark, sf_dir):
    return stats.length_histogram(_scored_table(spark, sf_dir), "instruction")


@query
def answer_length_histogram(spark, sf_dir):
    return stats.length_histogram(_scored_table(spark, sf_dir), "output")


@query
def mean_lengths(spark, sf_dir):
    return stats.mean_lengths(views.scored_documents(spark, sf_dir))


@query
def train_test_split(spark, sf_dir):
    rows = columns.publish_fields(stats.scored_ok(_scored_table(spark, sf_dir)), "doc_id")
    return split.train_test_split(rows, "doc_id", 50).select("doc_id", "instruction", "split")


@query
def head_sample(spark, sf_dir):
    return split.head(views.table(spark, sf_dir, "documents"), "doc_id", 100)


@query
def seed_sample(spark, sf_dir):
    return split.seed_rows(views.documents_qa(spark, sf_dir), "doc_id")


@query
def table_profile(spark, sf_dir):
    rated = views.table(spark, sf_dir, "documents").join(
        views.table(spark, sf_dir, "labels"), "doc_id", "left"
    )
    return stats.profile(rated.drop("doc_id"))


@query
def duplicate_rows(spark, sf_dir):
    return dedup.duplicate_rows(views.table(spark, sf_dir, "documents").drop("doc_id"))


@query
def quote_page_records(spark, sf_dir):
    parsed = pages.parse_pages(views.quote_pages(spark, sf_dir), "quotes")
    return pages.page_records(parsed)


@query
def book_rows(spark, sf_dir):
    return pages.book_rows(pages.parse_books(spread(views.book_pages(spark, sf_dir), "page_key")))


@query
def book_outcomes(spark, sf_dir):
    parsed = pages.parse_books(spread(views.book_pages(spark, sf_dir), "page_key"))
    return parsed.select("page_key", "url", "ok", "error", F.size("records").alias("books"))


@query
def pages_by_site(spark, sf_dir):
    """Quote pages and web pages in one table; the column says which parser reads a page."""
    quotes = views.quote_pages(spark, sf_dir).withColumn("site", F.lit("quotes"))
    web = views.web_pages(spark, sf_dir).withColumn("site", F.lit("article"))
    both = quotes.unionByName(web.withColumn("page_key", -1 - F.col("page_key")))
    return pages.page_records(pages.parse_pages(both))


@query
def article_page_records(spark, sf_dir):
    parsed = pages.parse_pages(spread(views.web_pages(spark, sf_dir), "page_key"), "article")
    return pages.page_records(parsed)


@query
def pages_todo(spark, sf_dir):
    todo = ingest.unseen_pages(views.web_pages(spark, sf_dir), views.visited_pages(spark, sf_dir))
    return todo.select("page_key", "url")


def _parsed_quotes(spark, sf_dir):
    parsed = pages.parse_pages(views.quote_pages(spark, sf_dir), "quotes")
    return write_stage(parsed, "parsed-pages")


def _stored_quotes(spark, sf_dir, parsed):
    """What an earlier run stored: the records of the German pages."""
    german = views.table(spark, sf_dir, "documents").filter("lang = 'de'").select(
        F.col("doc_id").alias("page_key")
    )
    old = pages.page_records(parsed).join(german, "page_key", "left_semi")
    return old.select(T.ingest_fingerprint("question", "answer").alias("content_hash")).distinct()


def _inserted_quotes(spark, sf_dir, parsed):
    return ingest.new_records(
        pages.page_records(parsed), _stored_quotes(spark, sf_dir, parsed)
    )


@query
def content_unique_insert(spark, sf_dir):
    fresh = _inserted_quotes(spark, sf_dir, _parsed_quotes(spark, sf_dir))
    return fresh.select("page_key", "position", "content_hash", "question", "answer")


@query
def page_outcomes(spark, sf_dir):
    return ingest.page_outcomes(_parsed_quotes(spark, sf_dir))


@query
def dead_letters(spark, sf_dir):
    return ingest.dead_letter_rows(_parsed_quotes(spark, sf_dir))


@query
def ingest_summary(spark, sf_dir):
    parsed = _parsed_quotes(spark, sf_dir)
    return ingest.run_summary(parsed, _inserted_quotes(spark, sf_dir, parsed))


@query
def ingest_totals(spark, sf_dir):
    parsed = _parsed_quotes(spark, sf_dir)
    return store_totals(_stored_quotes(spark, sf_dir, parsed), ingest.dead_letter_rows(parsed))


@query
def ingest_twice(spark, sf_dir):
    """The store after three runs: two thirds of the pages, the same again, and all of them.

    Two pages share a url, so runs skip pages by url and outcomes are upserted.
    """
    all_pages = views.quote_pages(spark, sf_dir).withColumn("url", views.shared_url())
    early = all_pages.filter("page_key % 3 != 0")
    root = scratch_path(spark, "store")
    for n, batch in enumerate((early, early, all_pages)):
        ingest_pages(batch, root, "quotes", now=datetime(2024, 1, 1 + n), run=f"run {n}")
    return store_contents(spark, root)


def store_contents(spark: SparkSession, root: str) -> DataFrame:
    """(kind, key, value) of all rows of an ingest store."""
    kept = tables.records(spark, root).select(
        F.lit("record").alias("kind"), F.col("content_hash").alias("key"), F.col("url").alias("value")
    )
    seen = tables.visited(spark, root).select(F.lit("visited"), "url", F.col("ok").cast("string"))
    dead = tables.dead_letters(spark, root).select(F.lit("dead"), "url", "error")
    counts = F.concat_ws(" ", "ok_pages", "dead_pages", "new_records")
    done = runs(spark, root).select(F.lit("run"), "run", counts)
    return kept.union(seen).union(dead).union(done)


@query
def csv_round_trip(spark, sf_dir):
    """Documents as CSV files with columns in two orders, read back as one table in order."""
    docs = views.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), views.csv_text().alias("text"), "lang"
    )
    root = scratch_path(spark, "csv")
    even = F.col("doc_id").cast("long") % 2 == 0
    write_csv(docs.filter(even).orderBy(F.col("doc_id").cast("long")), f"{root}/a")
    write_csv(docs.filter(~even).select("lang", "text", "doc_id").orderBy(F.col("doc_id").cast("long")), f"{root}/b")
    back = read_csv(spark, f"{root}/*", order_key="place")
    return split.numbered(back.orderBy("place"), "position").drop("place")


@query
def file_profile(spark, sf_dir):
    """Profile of CSV files, a folder per language, null among them."""
    root = scratch_path(spark, "profiles")
    docs = views.table(spark, sf_dir, "documents")
    write_csv(docs.select("lang", "source", views.csv_text().alias("text")), root, by="lang")
    profiles, _ = profile_files(spark, [f"{root}/*"], folders=True)
    folder = F.regexp_extract("path", r"/lang=([^/]+)$", 1)
    lang = F.when(folder != "__HIVE_DEFAULT_PARTITION__", folder).alias("lang")
    return profiles.select(lang, "column", "nulls", "rows", "columns", "distinct_rows", "duplicates")


@query
def jsonl_round_trip(spark, sf_dir):
    """Scored rows appended in two rounds as JSON lines and read back."""
    scored = _scored_table(spark, sf_dir)
    path = scratch_path(spark, "scored-lines")
    for part in (0, 1):
        append_scored(scored.filter(F.col("doc_id") % 2 == part).drop("doc_id"), path)
    back = read_jsonl(spark, path, SCORED_SCHEMA, order_key="place")
    return back.groupBy(*[c for c in back.columns if c != "place"]).agg(
        F.count("*").alias("copies"), F.countDistinct("place").alias("places")
    )


@query
def publish_from_disk(spark, sf_dir):
    """Build, score and publish through files: the published rows and their split sizes."""
    root = scratch_path(spark, "published")
    write_jsonl(_built(spark, sf_dir).records.drop("doc_id"), f"{root}/built")
    records = read_jsonl(spark, f"{root}/built", RECORD_SCHEMA, order_key="row")
    responses = records.select(
        "row", F.lit(1).alias("attempt"), F.lit(None).cast("string").alias("error"),
        F.when(F.length("output") % 7 != 0, views.length_scores()).otherwise("no").alias("content"),
    )
    apply_responses(records, responses, "row", f"{root}/scored")
    publish(read_jsonl(spark, f"{root}/scored", SCORED_SCHEMA, order_key="row"), "row", f"{root}/hub", 20)
    out = spark.read.parquet(f"{root}/hub")
    test_rows = F.lit(out.filter("split = 'test'").count())
    return out.select("instruction", "output", "complexity", test_rows.alias("test_rows"))


@query
def report_lines(spark, sf_dir):
    path = scratch_path(spark, "report")
    write_report(_built(spark, sf_dir).funnel, path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query
def split_sizes(spark, sf_dir):
    """Splits written and read back."""
    rows = columns.publish_fields(stats.scored_ok(_scored_table(spark, sf_dir)), "doc_id")
    path = scratch_path(spark, "splits")
    write_splits(split.train_test_split(rows, "doc_id", 50), path)
    return spark.read.parquet(path).select("doc_id", F.col("split").cast("string").alias("split"))


@query
def seeded_shuffle(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents").select("doc_id")
    return split.numbered(split.seeded_shuffle(docs, "doc_id"), "position")


@query
def seed_sample_of_lines(spark, sf_dir):
    """The default sample, of a table with more rows than it takes."""
    lines = views.table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line"), "l_quantity"
    )
    return split.seed_rows(lines, "line")


@query
def distributions(spark, sf_dir):
    """All statistics from one read of the scored rows."""
    found = scored_distributions(views.scored_documents(spark, sf_dir))
    flat = lambda df, kind, key, value: df.select(
        F.lit(kind).alias("kind"), F.col(key).cast("bigint").alias("at"), F.col(value).cast("double").alias("value")
    )
    parts = [
        flat(found.overall, "overall", "bin", "rows"),
        flat(found.question_chars, "question_chars", "bin", "rows"),
        flat(found.answer_chars, "answer_chars", "bin", "rows"),
        flat(found.high_quality, "high", "high_rows", "high_pct"),
        flat(found.mean_chars.withColumn("zero", F.lit(0)), "mean", "zero", "mean_answer_chars"),
        flat(found.scores.filter("dimension = 'clarity'"), "clarity", "score", "rows"),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query
def clean_odd_documents(spark, sf_dir):
    """Cleaning of texts with full-width letters, controls and wide blanks."""
    odd = views.table(spark, sf_dir, "documents").select("doc_id", views.odd_text().alias("text"))
    return odd.select("doc_id", T.clean_text("text").alias("text"))


@query
def han_ratio(spark, sf_dir):
    """Script ratio of texts with letters mapped to Han, and the prefix of 500."""
    han = views.table(spark, sf_dir, "documents").select("doc_id", views.han_text().alias("text"))
    return han.select("doc_id", T.script_ratio("text").alias("ratio"), T.prefix("text", 500).alias("head"))


@query
def fetch_summary(spark, sf_dir):
    return stats.fetch_summary(views.fetch_log(spark, sf_dir))
