"""Fields of a raw HTML page as Spark columns: text, title, links, in-page date.

Everything here is a column expression over one page, so it runs inside the
scan stage and never shuffles. Text nodes come out separated by line feeds,
because words must not run together across a tag.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trawl.functions.expr import let

# Comments and scripts are cut in one left-to-right pass: a comment mark inside
# a script, or a script tag inside a comment, then belongs to what opened first.
HIDDEN = r"(?is)<(?:!--.*?(?:-->|\z)|script\b.*?(?:</script\s*>|\z))"
BODY_OPEN = r"(?i)<body\b[^>]*>"
HEAD_CLOSE = r"(?i)</head\s*>"
TITLE = r"(?is)<title\b[^>]*>(.*?)</title\s*>"
# A tag; quoted attribute values may hold ">". The second form takes tags whose
# quotes do not pair up.
TAG = (
    r"<[a-zA-Z/!?](?:[^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+>|[^>]*>)"
)
NAMED_ENTITY = r"&[a-zA-Z][a-zA-Z0-9]*;"
HREF = (
    r"(?i)<a(?:\s+[^\s=>\"'/]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?)*?"
    r"\s+href\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
)
DATED_PARAGRAPH = (
    r"(?is)<p\s(?:[^>]*?\s)?class\s*=\s*"
    r"(?:\"[^\"]*right[^\"]*\"|'[^']*right[^']*'|[^\s\"'>]*right[^\s\"'>]*)"
    r"[^>]*>(.*?)(?:</p\s*>|<p\b|\z)"
)
INLINE_ELEMENT = r"(?is)<([a-z][a-z0-9]*)\b[^>]*>.*?</\1\s*>"
# Fixed value: the sentence that dates a page.
UPDATED_ON = r"Last updated on (\d{4}-\d{2}-\d{2})"


def regions(html: Column) -> Column:
    """``(page, head, body)`` of a page whose comments and scripts are cut.

    The body runs from its opening tag to the end, as a browser adds what follows
    the closing tag to it; without a body tag it is what follows the head, or the
    whole fragment less its title.
    """

    def around_body(page):
        def parts(at_body):
            body = F.coalesce(
                F.get(at_body, F.lit(1)),
                F.get(F.split(page, HEAD_CLOSE, 2), F.lit(1)),
                F.regexp_replace(page, TITLE, "\n"),
            )
            return F.struct(
                page.alias("page"),
                F.get(at_body, F.lit(0)).alias("head"),
                body.alias("body"),
            )

        return let(F.split(page, BODY_OPEN, 2), parts)

    return let(F.regexp_replace(html, HIDDEN, "\n"), around_body)


def text_of(markup: Column) -> Column:
    """Text of a piece of markup: tags end a node, entities become characters."""
    return let(F.regexp_replace(markup, TAG, "\n"), decode_entities)


def title_markup(head: Column) -> Column:
    return F.array_join(F.regexp_extract_all(head, F.lit(TITLE), 1), "\n")


def _decode_numeric(text: Column) -> Column:
    """Decode ``&#65;`` and ``&#x41;``; code points outside ASCII become a space.

    Only ASCII characters can be part of a word here, so nothing is lost.
    """
    code = r"^(?:[xX]0*([0-9a-fA-F]{1,6})|0*([0-9]{1,7}));?"

    def piece(part, i):
        hexadecimal = F.regexp_extract(part, code, 1)
        decimal = F.regexp_extract(part, code, 2)
        point = F.when(
            hexadecimal != "", F.conv(hexadecimal, 16, 10).cast("int")
        ).when(decimal != "", decimal.cast("int"))
        char = F.when(point.between(32, 126), F.chr(point)).otherwise(" ")
        decoded = F.concat(char, F.regexp_replace(part, code, ""))
        return (
            F.when(i == 0, part)
            .when(point.isNull(), F.concat(F.lit("&#"), part))
            .otherwise(decoded)
        )

    return F.when(
        F.contains(text, F.lit("&#")),
        F.array_join(F.transform(F.split(text, "&#"), piece), ""),
    ).otherwise(text)


def decode_entities(text: Column) -> Column:
    """Entities to characters; a named one, never a word character, to a space."""
    named = F.when(
        F.contains(text, F.lit("&")), F.regexp_replace(text, NAMED_ENTITY, " ")
    ).otherwise(text)
    return let(named, _decode_numeric)


def hrefs(page: Column) -> Column:
    """Targets of all ``<a href>`` in document order, entities decoded."""

    def value(raw):
        bare = F.when(
            raw.startswith('"') | raw.startswith("'"),
            F.substring(raw, F.lit(2), F.length(raw) - 2),
        ).otherwise(raw)
        decoded = _decode_numeric(bare)
        # The named entities that can stand in a link target.
        for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("amp", "&")):
            decoded = F.replace(decoded, F.lit(f"&{name};"), F.lit(char))
        return F.when(F.contains(bare, F.lit("&")), decoded).otherwise(bare)

    return F.transform(F.regexp_extract_all(page, F.lit(HREF), 1), value)


def updated_on(page: Column) -> Column:
    """First ``Last updated on yyyy-mm-dd`` in the own text of a "right" paragraph."""
    own_text = F.transform(
        F.regexp_extract_all(page, F.lit(DATED_PARAGRAPH), 1),
        lambda p: F.regexp_replace(p, INLINE_ELEMENT, "\n"),
    )
    first = F.regexp_extract(F.array_join(own_text, "\n"), UPDATED_ON, 1)
    return F.when(
        F.contains(page, F.lit("Last updated on ")),
        F.try_to_date(F.nullif(first, F.lit("")), "yyyy-MM-dd"),
    ).cast("timestamp_ntz")
