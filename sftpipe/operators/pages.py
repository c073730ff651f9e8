"""Page to record parsing inside Spark tasks, with per-page fault isolation."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftpipe.session import bound_batches

ERROR_CHARS = 500
PARSED_SCHEMA = (
    "page_key bigint, url string, source string, ok boolean, error string, "
    "records array<struct<question:string,answer:string>>"
)
# Fixed values.
QUOTE_ANSWER = "—— {author}(标签:{tags})"
NO_TAGS = "无"
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_UNREAD_TEXT = frozenset(("script", "style", "template"))


class Node:
    """An element with its children; text is kept as plain strings."""

    def __init__(self, tag: str, attrs: dict[str, str | None]):
        self.tag, self.attrs, self.children = tag, attrs, []

    def walk(self) -> Iterator[Node]:
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def all(self, tag: str, *classes: str) -> Iterator[Node]:
        for node in self.walk():
            if node.tag == tag and set(classes) <= set((node.attrs.get("class") or "").split()):
                yield node

    def first(self, tag: str, *classes: str) -> Node | None:
        return next(self.all(tag, *classes), None)

    def strings(self, skip: Node | None = None) -> Iterator[str]:
        """Text pieces in document order, without those of ``skip``."""
        stack = list(reversed(self.children))
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                yield item
            elif item is not skip and item.tag not in _UNREAD_TEXT:
                stack.extend(reversed(item.children))

    def get_text(self, strip: bool = False, skip: Node | None = None) -> str:
        return "".join(s.strip() if strip else s for s in self.strings(skip))


class _TreeBuilder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]
        self.in_text = False

    def handle_starttag(self, tag, attrs):
        node = Node(tag, dict(attrs))
        self.open[-1].children.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(Node(tag, dict(attrs)))

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == tag:
                del self.open[depth:]
                return

    def handle_data(self, data):
        siblings = self.open[-1].children
        if self.in_text and siblings and isinstance(siblings[-1], str):
            siblings[-1] += data
        else:
            siblings.append(data)
        self.in_text = True

    def _end_text(self, _):
        """A comment, declaration or instruction leaves no node, but the text after it is another piece."""
        self.in_text = False

    handle_comment = handle_decl = handle_pi = unknown_decl = _end_text


def parse_html(html: str) -> Node:
    builder = _TreeBuilder()
    builder.feed(html)
    builder.close()
    return builder.root


@dataclass(frozen=True)
class Pick:
    """A text or attribute below an element: of the first match of the last step, or of all.

    ``steps`` are (tag, class, ...) selectors; all but the last take the first match.
    """

    steps: tuple[tuple[str, ...], ...]
    attribute: str | None = None
    strip_pieces: bool = True
    strip: bool = False
    joined: str | None = None
    default: str = ""
    without: tuple[str, ...] | None = None

    def read(self, node: Node) -> str:
        for step in self.steps[:-1]:
            node = node.first(*step)
        if self.joined is not None:
            found = node.all(*self.steps[-1])
            return self.joined.join(map(self._value, found)) or self.default
        return self._value(node.first(*self.steps[-1]))

    def _value(self, node: Node) -> str:
        if self.attribute is not None:
            return node.attrs[self.attribute]
        skip = node.first(*self.without) if self.without else None
        text = node.get_text(strip=self.strip_pieces, skip=skip)
        return text.strip() if self.strip else text


@dataclass(frozen=True)
class Site:
    """What is read from a page: per ``container``, the whole page without one, the
    ``fields``, from which ``record`` makes the columns of a row.

    A ``lenient`` site has no row where an element is missing or a column is empty;
    otherwise a missing element is an error of the page.
    """

    source: str
    fields: dict[str, Pick]
    record: dict[str, str]
    container: tuple[str, ...] | None = None
    lenient: bool = False

    def rows(self, root: Node) -> list[dict[str, str]]:
        parts = root.all(*self.container) if self.container else [root]
        return [row for part in parts if (row := self._row(part)) is not None]

    def _row(self, part: Node) -> dict[str, str] | None:
        if self.lenient and any(part.first(*p.steps[-1]) is None for p in self.fields.values()):
            return None
        values = {name: pick.read(part) for name, pick in self.fields.items()}
        row = {name: form.format(**values) for name, form in self.record.items()}
        return row if all(row.values()) or not self.lenient else None


# Add a site here. Records of pages have a question and an answer; books have columns of
# their own.
SITES: dict[str, Site] = {
    "quotes": Site(
        "quotes_demo",
        {
            "tags": Pick((("a", "tag"),), joined=", ", default=NO_TAGS),
            "author": Pick((("small", "author"),)),
            "text": Pick((("span", "text"),)),
        },
        {"question": "{text}", "answer": QUOTE_ANSWER},
        container=("div", "quote"),
    ),
    "article": Site(
        "article_page",
        {"title": Pick((("h1",),)), "body": Pick((("article",),), without=("h1",))},
        {"question": "{title}", "answer": "{body}"},
        lenient=True,
    ),
    "books": Site(
        "books_demo",
        {
            "title": Pick((("h3",), ("a",)), attribute="title"),
            "price": Pick((("p", "price_color"),), strip_pieces=False),
            "stock": Pick((("p", "instock", "availability"),), strip_pieces=False, strip=True),
        },
        {"title": "{title}", "price": "{price}", "stock": "{stock}"},
        container=("article", "product_pod"),
    ),
}
PAIR_COLUMNS = ("question", "answer")
BOOK_COLUMNS = ("title", "price", "stock")


def check_site(site: str, columns: tuple[str, ...] = PAIR_COLUMNS) -> None:
    known = sorted(name for name, s in SITES.items() if tuple(s.record) == columns)
    if site not in known:
        raise ValueError(f"unknown site {site!r}; known sites: {known}")


def _attempt(site: Site, html: str | None, error_chars: int) -> tuple[list | None, str | None]:
    try:
        return site.rows(parse_html(html)), None
    except Exception as error:  # one bad page must not end the run
        return None, f"{type(error).__name__}: {error}"[:error_chars]


def _parse(
    pages: DataFrame, columns: tuple[str, ...], schema: str, error_chars: int = ERROR_CHARS
) -> DataFrame:
    """One row per page (page_key, url, html, site): its rows with ``columns``, or the error."""
    bound_batches(pages.sparkSession)
    sites = {name: s for name, s in SITES.items() if tuple(s.record) == columns}

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                site = sites[row.site]
                records, error = _attempt(site, row.html, error_chars)
                rows.append((row.page_key, row.url, site.source, error is None, error, records))
            yield pd.DataFrame(rows, columns=["page_key", "url", "source", "ok", "error", "records"])

    return pages.select("page_key", "url", "html", "site").mapInPandas(parse, schema)


def parse_pages(
    pages: DataFrame, site: str | None = None, error_chars: int = ERROR_CHARS
) -> DataFrame:
    """One row per page (page_key, url, html): its records, or the error.

    ``site`` names the parser of all pages; without it the column ``site`` does,
    row by row. An unknown site is an error of the run, not of the page.
    """
    if site is not None:
        check_site(site)
        pages = pages.withColumn("site", F.lit(site))
    return _parse(pages, PAIR_COLUMNS, PARSED_SCHEMA, error_chars)


def page_records(parsed: DataFrame) -> DataFrame:
    """Records with a question and an answer, with their place on the page."""
    return (
        parsed.filter("ok")
        .select("page_key", "url", "source", F.posexplode("records").alias("position", "record"))
        .select("page_key", "position", "url", "source", "record.question", "record.answer")
        .filter("question != '' AND answer != ''")
    )


def parse_books(pages: DataFrame, error_chars: int = ERROR_CHARS) -> DataFrame:
    """One row per list page (page_key, url, html): its books, or the error."""
    named = pages.withColumn("site", F.lit("books"))
    schema = PARSED_SCHEMA.replace("question:string,answer:string", "title:string,price:string,stock:string")
    return _parse(named, BOOK_COLUMNS, schema, error_chars)


def book_rows(parsed: DataFrame) -> DataFrame:
    """The books of the pages that could be read, with their place on the page."""
    return (
        parsed.filter("ok")
        .select("page_key", F.posexplode("records").alias("position", "book"))
        .select("page_key", "position", "book.*")
    )
