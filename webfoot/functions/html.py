"""HTML column expressions by plain patterns (O16-O20, O30a, O30b); the library reads whole tags with ``markup``.

The page is scanned by regular expressions, not parsed into a DOM (a DOM or
``xpath()`` fails on broken markup).  To keep the cost of the largest column
low the HTML is rewritten once (comments, script bodies and style bodies
removed) and then scanned once for all four link kinds.

Known gap: a '>' inside an earlier quoted attribute of the same tag ends the
tag for the pattern.
"""

from __future__ import annotations

import html.entities

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: link kinds, in the order the record lists them ---
LINK_KINDS = ["a", "link", "script", "img"]
# tag -> attribute: a/@href, link/@href, script/@src, img/@src
# --- end of fixed values ---

# Named character references of HTML 4, from the standard library's table (built by rule, not listed here).
NAMED = {**{name: chr(point) for name, point in html.entities.name2codepoint.items()}, "apos": "'"}
REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"

WS = r"[ \t\n\r\f]"
# Comments, and the bodies of script/style elements (their opening tag is kept
# because script/@src is a link).  One pass, leftmost match wins.
CLEAN_PATTERN = (r"(?is)<!--.*?-->|(<script(?:" + WS + r"[^>]*)?>).*?</script" + WS + r"*>"
                 r"|(<style(?:" + WS + r"[^>]*)?>).*?</style" + WS + r"*>")
# One pattern for the four kinds: a|link with href, script|img with src.
LINK_PATTERN = (r"(?is)<(?:(?:a|link)(?:" + WS + r"[^>]*?)?" + WS + r"href|(?:script|img)(?:"
                + WS + r"[^>]*?)?" + WS + r"src)" + WS + r"*=" + WS
                + r"""*("[^"]*"|'[^']*'|[^ \t\n\r\f>"']+)""")
TAG_OF_MATCH = r"^<([A-Za-z]+)"
VALUE_OF_MATCH = r"""(?s)=[ \t\n\r\f]*("[^"]*"|'[^']*'|[^ \t\n\r\f>"']+)$"""
TITLE_PATTERN = r"(?is)<title(?:" + WS + r"[^>]*)?>(.*?)</title"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _reference(ref: Column) -> Column:
    """The text of one reference; an unknown name or number stays as it is."""
    number = F.when(ref.rlike("^&#[xX]"), F.conv(F.regexp_extract(ref, "([0-9a-fA-F]+);$", 1), 16, 10)) \
        .otherwise(F.regexp_extract(ref, "([0-9]+);$", 1)).cast("bigint")
    valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    point = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    named = F.element_at(F.create_map(*[F.lit(x) for pair in NAMED.items() for x in pair]),
                         F.regexp_extract(ref, "^&([A-Za-z0-9]+);$", 1))
    return F.when(ref.startswith("&#"), F.when(valid, point).otherwise(ref)).otherwise(F.coalesce(named, ref))


def decode_entities(c) -> Column:
    """Numeric and named character references decoded once; other texts are left alone."""
    def decode(x: Column) -> Column:
        between, found = F.split(x, REFERENCE, -1), F.regexp_extract_all(x, F.lit(REFERENCE), F.lit(0))
        decoded = F.concat(F.array_join(F.zip_with(F.slice(between, 1, F.size(found)), F.transform(found, _reference),
                                                   lambda a, b: F.concat(a, b)), ""), F.element_at(between, -1))
        return F.when(x.contains("&"), F.when(x.rlike(REFERENCE), decoded).otherwise(x)).otherwise(x)
    return F.element_at(F.transform(F.array(_c(c)), decode), 1)  # the argument stands in the plan once


def clean_html(c) -> Column:
    """Drop what a DOM query would not see (comments, script/style text)."""
    return F.regexp_replace(_c(c), CLEAN_PATTERN, "$1$2")


def link_matches(cleaned) -> Column:
    """All link-bearing tag matches of a cleaned page, in document order."""
    return F.regexp_extract_all(_c(cleaned), F.lit(LINK_PATTERN), 0)


def match_kind(m) -> Column:
    return F.lower(F.regexp_extract(_c(m), TAG_OF_MATCH, 1))


def match_value(m) -> Column:
    """Attribute value of a match: quotes stripped, entities decoded."""
    v = F.regexp_extract(_c(m), VALUE_OF_MATCH, 1)
    unq = F.when(v.startswith('"') | v.startswith("'"),
                 v.substr(F.lit(2), F.length(v) - 2)).otherwise(v)
    return decode_entities(unq)


def page_title(c) -> Column:
    """Title text, entities decoded, whitespace collapsed and trimmed; '' if none."""
    raw = F.regexp_extract(_c(c), TITLE_PATTERN, 1)
    collapsed = F.regexp_replace(raw, WS + "+", " ")
    return F.trim(decode_entities(collapsed))
