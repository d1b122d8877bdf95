"""Scalar functions over text: HTML, entities, blanks, titles, dates and hashes."""

from __future__ import annotations

import html
import re
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: An entity that ends as it should; HTML also knows some that don't.
ENTITY = re.compile(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[0-9A-Za-z]+);")
WHITE_EDGES = r"(?U)^\s+|\s+$"


def strip(c: Column) -> Column:
    """Without white space, of any kind, at either end."""
    return F.regexp_replace(c, WHITE_EDGES, "")


def clean_text(c: Column) -> Column:
    """Null as empty; runs of white space as one space; stripped."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def is_blank(c: Column) -> Column:
    return c.isNull() | c.rlike(r"(?U)^\s*$")


def _ended(m: re.Match) -> str:
    return html.unescape(m[0]) if m[0][1] == "#" or m[0][1:] in html5 else m[0]


def html_unescape(c: Column, unended: bool = True) -> Column:
    """One pass of entity decoding; ``unended``: also of those that HTML knows without a semicolon, as in ``&amp<``.  Spark has no such function: an Arrow UDF, skipped where there is no ampersand."""

    @F.udf("string", useArrow=True)
    def decode(s):
        return None if s is None else html.unescape(s) if unended else ENTITY.sub(_ended, s)

    return F.when(F.contains(c, F.lit("&")), decode(c)).otherwise(c)


def clean_html(c: Column) -> Column:
    """Readable text of markup: scripts and styles dropped, block ends as line ends, other tags dropped, white space tidied; null as empty."""
    c = F.coalesce(c, F.lit(""))
    for pattern, put in (
        (r"(?is)<script[^>]*>.*?</script>", ""),
        (r"(?is)<style[^>]*>.*?</style>", ""),
        (r"</(?:p|h[1-4])>", "\n\n"),
        (r"</(?:div|li)>|<br(?: ?/)?>", "\n"),
        (r"<[^>]+>", ""),
        (r"\n\s*\n\s*\n+", "\n\n"),
        (r"[ \t]+", " "),
    ):
        c = F.regexp_replace(c, pattern, put)
    return strip(c)


def html_to_text(c: Column, unended: bool = True) -> Column:
    """Entities first: content arrives escaped twice, so tags show only after decoding."""
    return clean_html(html_unescape(c, unended))


def title_case(c: Column) -> Column:
    """Every letter after a non-letter in upper case, the others in lower case."""

    @F.udf("string", useArrow=True)
    def title(s):
        return s.title() if s is not None else None

    return title(c)


def iso_date(c: Column) -> Column:
    """Calendar date in the string's own offset; anything but an extended ISO date or date-time gives null."""
    good = c.rlike(r"^\d{4}-\d{2}-\d{2}(?:.\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?)?(?:Z|[+-]\d{2}:?\d{2}(?::?\d{2})?)?)?$")
    return F.when(good, F.substring(c, 1, 10).try_cast("date"))


def content_hash(title: Column, company: Column, location: Column, date_posted: Column) -> Column:
    """SHA-256 of the four fields joined by bars; a null is written None, as in the stored hashes."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("None")) for c in (title, company, location, date_posted)]), 256)


def words_like(pattern_words: tuple[str, ...]) -> str:
    """A pattern that finds any of the literal words."""
    return "|".join(re.escape(w) for w in pattern_words)
