"""Question/answer, page and judge views over the benchmark tables.

They adapt the given tables to the inputs of the operators; every view reads its
tables whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sftpipe.operators.columns import to_alpaca
from sftpipe.operators.judge import attach_scores, pick_responses
from sftpipe.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _halves() -> tuple[Column, Column]:
    """``text`` before and after its first full stop."""
    text = F.col("text")
    stop = F.locate(".", text)
    question = F.when(stop > 0, F.substring(text, F.lit(1), stop - 1)).otherwise(text)
    answer = F.when(stop > 0, F.substring(text, stop + 1, F.length(text))).otherwise("")
    return question.alias("question"), answer.alias("answer")


def documents_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, question, answer): the text before and after its first full stop."""
    return table(spark, sf_dir, "documents").select("doc_id", *_halves())


def conversations_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(turn_key, question, answer): a user turn and the assistant turn after it.

    Turns of a conversation are numbered without gaps, so the next turn is an
    equi-join on (conv_id, turn), which a very long conversation cannot skew.
    """
    turns = table(spark, sf_dir, "conversations")
    asked = turns.filter("role = 'user'").select(
        "conv_id", "turn", F.col("text").alias("question")
    )
    replied = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    return asked.join(replied, ["conv_id", "turn"]).select(
        (F.shiftleft("conv_id", 32) + F.col("turn")).alias("turn_key"), "question", "answer"
    )


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_alpaca(documents_qa(spark, sf_dir), "documents", "doc_id")


def judge_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, attempt, content, error): judge answers derived from documents and labels.

    They cover good and bad JSON, floats, texts and booleans as scores, missing
    scores, overridden record fields, null fields, failed calls and retries, among them
    records whose first good or only response is the fourth.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    rated = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    complexity = (F.col("n_chars") % 5 + 1).cast("string")
    clarity = ((F.col("doc_id") * 7) % 5 + 1).cast("string")
    information = (F.coalesce("quality", F.lit(0)) * 2 + F.col("doc_id") % 3 + 1).cast("string")

    def answer(c: Column, l: Column, i: Column | None, rest: str) -> Column:
        parts = [F.lit('{"complexity": '), c, F.lit(', "clarity": '), l]
        if i is not None:
            parts += [F.lit(', "informativeness": '), i]
        return F.concat(*parts, F.lit(rest + "}"))

    kind = F.col("doc_id") % 13
    reason = ', "reason": "ok"'
    good = (
        F.when(kind == 0, answer(F.concat(complexity, F.lit(".5")), clarity, information, reason))
        .when(kind == 1, answer(F.lit('"4"'), clarity, information, reason))
        .when(kind == 2, answer(F.lit("true"), F.lit("null"), information, reason))
        .when(kind == 3, answer(complexity, clarity, None, reason))
        .when(kind == 4, answer(F.lit("5"), F.lit("4"), F.lit("4"), ', "output": "rewritten"'))
        .when(kind == 5, answer(F.lit("9"), clarity, F.lit("0"), ""))
        .when(kind == 6, answer(complexity, clarity, information, ', "reason": null, "output": null'))
        .when(kind == 7, answer(complexity, clarity, information, ', "_error": null'))
        .otherwise(answer(complexity, clarity, information, reason))
    )
    trouble = F.col("doc_id") % 11
    first = (
        F.when(trouble == 1, F.lit("no scores today"))
        .when(trouble == 2, F.lit("[1, 2, 3]"))
        .when(trouble == 4, F.lit('{"complexity": 3'))
        .when(trouble != 0, good)
    )
    second = (
        F.when(F.col("doc_id") % 2 == 0, good)
        .when(F.col("doc_id") % 3 == 0, F.lit('"fine"'))
        .otherwise(F.lit('{"complexity": 3'))
    )
    attempts = F.array(
        F.struct(
            F.lit(1).alias("attempt"),
            first.alias("content"),
            F.when(trouble == 0, F.lit("HTTPError: 503 Server Error")).alias("error"),
        ),
        F.struct(
            F.lit(2).alias("attempt"),
            second.alias("content"),
            F.lit(None).cast("string").alias("error"),
        ),
        F.struct(
            F.lit(4).alias("attempt"),
            good.alias("content"),
            F.lit(None).cast("string").alias("error"),
        ),
    )
    only_fourth = F.col("doc_id") % 17 == 5
    held = lambda a: (
        F.when(a.attempt == 4, only_fourth | (trouble == 4))
        .when(a.attempt == 2, ~only_fourth & (trouble < 3))
        .otherwise(~only_fourth)
    )
    return rated.select("doc_id", F.inline(F.filter(attempts, held)))


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = pick_responses(judge_responses(spark, sf_dir), "doc_id")
    return attach_scores(document_records(spark, sf_dir), picked, "doc_id")


def _escaped(c: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(char), F.lit(entity))
    return c


def quote_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_key, url, html): a quote page per document; Spanish ones lack a quote text."""
    docs = spread(table(spark, sf_dir, "documents").drop("n_chars"), "doc_id").select(
        "doc_id", "lang", "source", *_halves()
    )
    html = F.concat(
        F.lit('<html><body><div class="quote big"><span class="text">'),
        _escaped(F.col("question")),
        F.lit(' <!-- <b>no</b> --> end</span><br>by <small class="author"> '),
        _escaped(F.col("source")),
        F.lit(' </small><div class="tags"><a class="tag">'),
        F.col("lang"),
        F.lit('</a> <a class="tag" href="/t">text</a></div></div><div class=quote>'),
        F.when(
            F.col("lang") != "es",
            F.concat(F.lit("<span class='text'>"), _escaped(F.col("answer")), F.lit("</span>")),
        ).otherwise(""),
        F.lit('<small class="author">anonymous</small></div></body></html>'),
    )
    return docs.select(
        F.col("doc_id").alias("page_key"),
        F.concat(F.lit("https://quotes.example/"), F.col("doc_id").cast("string")).alias("url"),
        html.alias("html"),
    )


def shared_url() -> Column:
    """A url that two neighbouring pages share."""
    return F.concat(F.lit("https://quotes.example/"), F.floor(F.col("page_key") / 2).cast("string"))


def csv_text() -> Column:
    """Document texts with quotes, line breaks and texts that count as missing."""
    return (
        F.when(F.col("doc_id") % 10 == 3, F.lit("NA"))
        .when(F.col("doc_id") % 10 == 4, F.lit(""))
        .otherwise(F.replace(F.col("text"), F.lit(". "), F.lit('",\n"')))
    )


def odd_text() -> Column:
    """Document texts with full-width letters, control characters and wide blanks."""
    wide = F.translate("text", "abcdeh.", "ａｂｃｄｅｈ．")
    return F.concat(F.lit("\x07\u3000"), F.replace(wide, F.lit("o"), F.lit("o\x0c\x1f\u00a0")))


def han_text() -> Column:
    return F.translate("text", "aeiou", "法律问答题")


def length_scores() -> Column:
    """A judge's answer that only depends on the answer's length."""
    score = (F.length("output") % 5 + 1).cast("string")
    return F.concat(F.lit('{"complexity": '), score, F.lit(', "clarity": 4, "informativeness": 3}'))


def book_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_key, url, html): a book list page per document; French ones lack the price."""
    docs = table(spark, sf_dir, "documents")
    html = F.concat(
        F.lit('<ol><li><article class="product_pod"><h3><a href="#" title="'),
        F.replace(_escaped(F.col("text")), F.lit('"'), F.lit("&quot;")),
        F.lit('">short</a></h3>'),
        F.when(
            F.col("lang") != "fr",
            F.concat(F.lit('<p class="price_color">£'), F.col("n_chars").cast("string"), F.lit(".00</p>")),
        ).otherwise(""),
        F.lit('<p class="instock availability">\n    <i class="icon-ok"></i>\n   In '),
        F.col("lang"),
        F.lit(" stock \n</p></article></ol>"),
    )
    url = F.concat(F.lit("https://books.example/"), F.col("doc_id").cast("string"))
    return docs.select(F.col("doc_id").alias("page_key"), url.alias("url"), html.alias("html"))


def web_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").withColumnRenamed("page_id", "page_key")


def visited_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(url): the web pages with a French path count as visited already."""
    return table(spark, sf_dir, "pages").filter(F.contains("url", F.lit("/fr/"))).select("url")


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(url, status, elapsed_s): events read as fetches."""
    status = F.when(F.col("event_type") == "error", -1).when(
        F.col("event_type") == "signup", 404
    ).otherwise(200)
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("url"), status.alias("status"), F.col("value").alias("elapsed_s")
    )


def personal_text() -> Column:
    """Document texts after true and false identifiers: numbers with every check character, of
    which one is right, dates that do not exist, numbers of other lengths and plans, and
    several spellings of one identifier."""
    number = F.col("doc_id")
    padded = lambda value, size: F.lpad(value.cast("string"), size, "0")
    born = F.concat(
        F.lit("110105"), (number % 50 + 1950).cast("string"), padded(number % 12 + 1, 2), padded(number % 28 + 1, 2),
        padded(number % 1000, 3),
    )
    never = F.concat(F.substring(born, 1, 10), F.lit("0230123"))
    card = F.concat(F.lit("4"), padded(number % 10**14, 14))
    four = padded(number % 10000, 4)
    ends = F.split(F.lit("0123456789X"), "")
    all_ends = lambda start: F.array_join(F.transform(ends, lambda e: F.concat(start, e)), " ")
    spaced = F.concat_ws(" ", *[F.substring(card, at, 4) for at in (1, 5, 9, 13)])
    digits = F.slice(ends, 1, 10)
    cards = F.transform(digits, lambda e: F.concat(F.when(number % 2 == 0, card).otherwise(spaced), e))
    person = (number % 100).cast("string")
    return F.concat(
        F.lit("id "), all_ends(born), F.lit(" "), all_ends(never), F.lit(" card "), F.array_join(cards, "; "),
        F.lit(" call +86 139 "), four, F.lit(" 5678, 139"), four, F.lit("5678, 0086-139"), four, F.lit("5678 or 1"), four,
        F.lit("5678 +1 (743) 555-"), four, F.lit(", 1-743-555-"), four, F.lit(", 911-555-"), four, F.lit(", 010-6"), four,
        F.lit("678 mail User."), person, F.lit("@Mail.Example.COM, user."), person,
        F.lit("@mail.example.com, user@host from 10."), (number % 300).cast("string"), F.lit(".1.2 \x01\x02 "), F.col("text"),
    )


def site_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_key, site, text): the lines of web pages, with lines that pages of a site share in
    several spellings, and lines of one page alone."""
    pages = table(spark, sf_dir, "pages")
    site = F.regexp_extract("url", "//([^/]+)", 1)
    scripts = F.regexp_replace("html", "(?s)<(?:script|style)[^>]*>.*?</(?:script|style)>", "")
    number = F.col("page_id").cast("string")
    title = F.regexp_extract("html", "(?s)<h1>(.*?)</h1>", 1)
    lines = F.concat_ws(
        "\n",
        F.when(F.col("page_id") % 3 != 0, F.concat(F.lit("Call "), site, F.lit(" now: 400-"), number, F.lit("!"))),
        F.regexp_replace(scripts, "<[^>]*>", "\n"),
        F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("Only here: "), title)),
        F.when(F.col("page_id") % 5 == 0, "  SUBSCRIBE to \t our newsletter").otherwise("Subscribe to our newsletter "),
        F.concat(F.lit("subscribe to our newsletter or to "), title),
    )
    return pages.select(F.col("page_id").alias("page_key"), site.alias("site"), lines.alias("text"))


def residue_text() -> Column:
    """Document texts with tags, comments and references, escaped up to three times, and with
    comparisons that only look like tags."""
    number = F.col("doc_id")
    text = F.replace("text", F.lit(". "), F.lit(".<br/>"))
    for plain, marked in (
        (", ", ",&nbsp;"),
        (" the ", " <b class='x'>the</b> "),
        (" de ", " &lt;i&gt;de&lt;/i&gt; "),
        (" of ", " a < b of c > d "),
        (" in ", " x<y>z in "),
    ):
        text = F.replace(text, F.lit(plain), F.lit(marked))
    opened = (
        F.when(number % 4 == 0, '<div id="a>b">')
        .when(number % 4 == 1, "&lt;p align=&quot;left&quot;&gt;")
        .when(number % 4 == 2, "&amp;lt;!-- &amp;amp; --&amp;gt;&amp;#60;hr&#38;#62;")
        .otherwise("<SCRIPT type='t'>if (a < b) {}</script >&amp;amp;amp;copy; &unknown; AT&T ")
    )
    return F.concat(opened, text, F.lit("<!-- end --></div><font color=red size=2 noshade>"))


def relevance_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, lang, question, answer, swapped): a question has words of its own text and of
    another; every fifth answer is that of a third document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    words = F.filter(F.split("text", r"[ \n\r\t]+"), lambda w: F.length(w) > 0)
    own = docs.select("doc_id", "lang", "text", words.alias("words"))
    every = lambda step, first: F.filter("words", lambda w, i: i % step == first)
    size = F.greatest(F.lit(1), F.floor(F.size("words") / 8)).cast("int")
    asked = own.select("doc_id", "lang", "text", F.slice(every(size, 0), 1, 8).alias("picked"))
    taken = F.col("doc_id") % 5 == 0
    # Only texts that replace an answer are moved.
    other = docs.select((F.col("doc_id") - 5).alias("doc_id"), F.when(taken, F.col("text")).alias("next_text"))
    mixed = asked.select((F.col("doc_id") - 7).alias("doc_id"), F.slice("picked", 1, 3).alias("noise"))
    joined = asked.join(other, "doc_id", "left").join(mixed, "doc_id", "left")
    swapped = taken & F.col("next_text").isNotNull()
    question = F.array_join(F.concat("picked", F.coalesce("noise", F.array().cast("array<string>"))), " ")
    return joined.select(
        "doc_id", "lang", question.alias("question"),
        F.when(swapped, F.col("next_text")).otherwise(F.col("text")).alias("answer"), swapped.alias("swapped"),
    )
