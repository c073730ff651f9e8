"""HTML residue in text that is not a page: tags, comments and character references.

Text is no HTML document, so a ``<`` is markup only where a known element with well-formed
attributes follows: ``a < b``, ``x<y>z`` and ``if (a<b && c>d)`` stay. Escaped markup is markup
once it is unescaped, at any depth (``&amp;lt;br&amp;gt;``): rounds of removal and unescaping go
on until a round changes nothing. Each changing round takes a ``<`` or an ``&`` out of the text
or turns an ``&`` into a ``<``, which bounds their number. All of it is column expressions.
"""

from __future__ import annotations

from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements that end a line of text, other elements, attributes without a value.
BLOCKS = (
    "address article aside blockquote body br caption center col colgroup dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup "
    "option p pre section select summary table tbody td textarea tfoot th thead title tr ul"
).split()
INLINE = (
    "a abbr acronym applet area audio b base basefont bdi bdo big blink button canvas cite code data datalist del dfn "
    "em embed font frame frameset i iframe img input ins kbd label link map mark marquee meta meter nobr noembed "
    "noframes noscript object output param picture progress q rp rt ruby s samp slot small source span strike strong "
    "sub sup svg time track tt u var video wbr"
).split()
FLAGS = (
    "allowfullscreen async autofocus autoplay checked compact controls default defer disabled hidden ismap loop "
    "multiple muted nohref noresize noshade novalidate nowrap open readonly required reversed selected"
).split()
#: Elements whose content is no text either.
UNREAD = ("script", "style", "template")
_VALUE = r"""(?:"[^"]*"|'[^']*'|[^\s"'<>=`]+)"""
_ATTRIBUTES = rf"(?:\s+(?:[a-z_:][a-z0-9_.:-]*\s*=\s*{_VALUE}|(?:{'|'.join(FLAGS)})(?=[\s/>])))*+\s*/?"
COMMENT = r"<!--[^<-]*+(?:(?:-(?!->)|<(?!!--))[^<-]*+)*+-->"
DECLARATION = r"(?i)<!doctype\s+html[^<>]*>|<\?xml\s[^<>]*\?>|<!\[CDATA\[|\]\]>"
REFERENCE = r"&(?:[A-Za-z][A-Za-z0-9]{1,31}|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});"
#: Marks around references. The first character stands for itself after a doubling.
_ESCAPE, _MARK, _ESCAPED = "\x01", "\x01\x02", "\x01\x03"


def named_references() -> dict[str, str]:
    """The names of HTML 4 and the apostrophe's."""
    return {name: html5[f"{name};"] for name in [*name2codepoint, "apos"]}


def low_references() -> dict[int, str]:
    """Numbers 128 to 159 mean characters of the Windows code page that most pages were written in."""
    points = {n: bytes([n]).decode("cp1252", "ignore") for n in range(0x80, 0xA0)}
    return {n: text for n, text in points.items() if text}


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once; an expression in a lambda is evaluated again
    wherever it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _tag(names: list[str], closing: str = "/?") -> str:
    return rf"(?i)<{closing}(?:{'|'.join(names)}){_ATTRIBUTES}>"


def _unread(name: str) -> str:
    """An element whose content has no other of its kind, which a round takes before it."""
    return rf"(?i)<{name}{_ATTRIBUTES}>[^<]*+(?:<(?!/?{name}[\s/>])[^<]*+)*+</{name}\s*>"


def _table(entries: dict) -> Column:
    keys, values = F.array(*map(F.lit, entries)), F.array(*map(F.lit, entries.values()))
    return F.map_from_arrays(keys, values)


def _character(reference: Column) -> Column:
    """What a reference stands for; an unknown name or number stands for itself."""
    body = F.substring(reference, F.lit(2), F.length(reference) - 2)
    number = F.when(body.rlike("^#[xX]"), F.conv(F.substring(body, F.lit(3), F.lit(6)), 16, 10)).when(
        body.startswith("#"), F.substring(body, F.lit(2), F.lit(7))
    )
    point = number.cast("int")
    valid = (point.isin(9, 10, 13) | point.between(0x20, 0x10FFFF)) & ~point.between(0xD800, 0xDFFF) & ~point.isin(127)
    unicode = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
    meant = F.coalesce(F.try_element_at(_table(low_references()), point), F.when(valid, unicode))
    named = F.try_element_at(_table(named_references()), body)
    return F.coalesce(F.when(number.isNotNull(), meant).otherwise(named), reference)


def unescape_once(text: Column) -> Column:
    """All references of the text as characters, each read once."""
    escaped = F.replace(text, F.lit(_ESCAPE), F.lit(_ESCAPED))
    parts = F.split(F.regexp_replace(escaped, f"({REFERENCE})", f"{_MARK}$1{_MARK}"), _MARK)
    read = F.transform(parts, lambda part, i: F.when(i % 2 == 1, _character(part)).otherwise(part))
    return F.when(text.contains("&"), F.replace(F.array_join(read, ""), F.lit(_ESCAPED), F.lit(_ESCAPE))).otherwise(text)


def without_markup(text: Column) -> Column:
    """The text without comments, declarations and tags; a block element ends a line."""

    def removed(found: Column) -> Column:
        for name in UNREAD:
            found = F.regexp_replace(found, _unread(name), "")
        return found

    # Most texts and rounds have none of the first three, which a plain search tells.
    found = F.when(text.contains("<!--"), F.regexp_replace(text, COMMENT, "")).otherwise(text)
    found = _let(found, lambda t: F.when(
        t.contains("<!") | t.contains("<?") | t.contains("]]>"), F.regexp_replace(t, DECLARATION, "")
    ).otherwise(t))
    found = _let(found, lambda t: F.when(t.rlike(f"(?i)</(?:{'|'.join(UNREAD)})"), removed(t)).otherwise(t))
    found = F.regexp_replace(found, _tag(BLOCKS), "\n")
    found = F.regexp_replace(found, _tag([*INLINE, *UNREAD]), "")
    return F.when(text.contains("<") | text.contains("]]>"), found).otherwise(text)


def strip_residue(text: str | Column) -> Column:
    """The text without HTML residue, null for null. White space is left to ``clean_text``."""
    text = F.col(text) if isinstance(text, str) else text
    # A changing round lowers twice the number of & plus that of <, or that of ]]>.
    most = 2 * F.regexp_count(text, F.lit("&")) + F.regexp_count(text, F.lit("<|\\]\\]>")) + 1
    # The text and whether its last round changed it; nothing more is done once one has not.
    state = lambda now, more: F.struct(now.alias("now"), more.alias("more"))
    step = lambda now: _let(without_markup(now), unescape_once)
    rounds = F.aggregate(
        F.sequence(F.lit(0), most),
        state(text, F.lit(True)),
        lambda s, _: F.when(s["more"], _let(step(s["now"]), lambda now: state(now, now != s["now"]))).otherwise(s),
        lambda s: s["now"],
    )
    return F.when(text.rlike(r"[<&]|\]\]>"), rounds).otherwise(text)


def has_residue(text: str | Column) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return strip_residue(text) != text
