"""Tags read token by token.

One pass over the HTML steps over comments, over the bodies of raw-text
elements and over whole tags, whose quoted attribute values may hold a ``>``
or another tag's text; only the four link tags stay.  The value of a tag's
first ``href`` or ``src`` is then read by the same attribute rule.  All
repetitions are possessive, so a long tag costs no stack and no backtracking.

Defined cases: a quote that is never closed is an ordinary character and gives
its attribute no value, so that the tag is no link; a comment or raw-text body that is never closed runs to the end of the page; an
attribute without a value is the empty text; of equal attributes the first
counts; null HTML has no tags and a null title.
"""

from __future__ import annotations

import html.entities

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---
HREF_TAGS = "a|link"
SRC_TAGS = "script|img"
# Elements whose body is text, scripts apart (their tag is a link).
TEXT_ELEMENTS = "style|title|textarea|xmp|iframe|noembed|noframes"
# --- end of fixed values ---

WS = r"[ \t\n\r\f]"
NAME_ENDS = r"(?=[ \t\n\r\f/>])"
ASSIGNED = WS + "*+=" + WS + r"""*+("[^"]*+"|'[^']*+'|[^ \t\n\r\f>"'][^ \t\n\r\f>]*+)"""
ATTRIBUTE_NAME = r"""[^ \t\n\r\f/>="'][^ \t\n\r\f/>=]*+"""
STRAY = r"""[ \t\n\r\f/]++|["'=]"""


def _plain(pattern: str) -> str:
    """The pattern with its group left out of the numbering."""
    return pattern.replace('("[^"]', '(?:"[^"]')


def _attributes(but: str = "") -> str:
    """Any run of attributes; ``but`` names one that ends the run."""
    guard = f"(?!{but}(?=[ \\t\\n\\r\\f/>=]))" if but else ""
    return f"(?:{STRAY}|{guard}{ATTRIBUTE_NAME}(?:{_plain(ASSIGNED)})?+)*+"


def _tag(names: str) -> str:
    return f"<(?:{names}){NAME_ENDS}{_attributes()}>"


def _body(name: str) -> str:
    return f"(?:.*?</{name}{NAME_ENDS}|.*)"


COMMENT = r"<!--(?:-?>|.*?(?:--!?>|\z))"
ANY_TAG = _tag(r"/?[a-z][^ \t\n\r\f/>]*+")
BOGUS = "<[!?/][^>]*+>"
TOKENS = (f"(?is){COMMENT}|({_tag('script')}){_body('script')}"
          f"|<({TEXT_ELEMENTS}){NAME_ENDS}{_attributes()}>{_body(chr(92) + '2')}"
          f"|({_tag('a|link|img')})|{ANY_TAG}|{BOGUS}")
LINK_TAG = f"(?is){_tag(HREF_TAGS + '|' + SRC_TAGS)}"
NO_VALUE = f"(?!{WS}*+=)"
HREF_VALUE = f"(?is)^<(?:{HREF_TAGS}){NAME_ENDS}{_attributes('href')}href(?:{ASSIGNED}|{NO_VALUE})"
SRC_VALUE = f"(?is)^<(?:{SRC_TAGS}){NAME_ENDS}{_attributes('src')}src(?:{ASSIGNED}|{NO_VALUE})"
NOT_TITLE = f"(?!<title{NAME_ENDS})"
TITLE = (f"(?is)\\A(?:[^<]++|{COMMENT}|{_tag('script')}{_body('script')}"
         f"|{NOT_TITLE}<({TEXT_ELEMENTS}){NAME_ENDS}{_attributes()}>{_body(chr(92) + '1')}"
         f"|{NOT_TITLE}{ANY_TAG}|{BOGUS}|{NOT_TITLE}<)*+<title{NAME_ENDS}{_attributes()}>(.*?)(?:</title{NAME_ENDS}|\\z)")

# The standard library's table of named references, as one text so that a plan holds one literal.
# Names without a semicolon are those that may stand without one.
PAIR, PART = "\x01", "\x02"
NAMES = PAIR.join(f"{name}{PART}{text}" for name, text in html.entities.html5.items())
BARE_NAMES = "|".join(sorted((n for n in html.entities.html5 if not n.endswith(";")), key=len, reverse=True))
REFERENCE = f"&(?:#[0-9]{{1,7}};?|#[xX][0-9a-fA-F]{{1,6}};?|[A-Za-z][A-Za-z0-9]{{1,31}};|(?:{BARE_NAMES}))"
# In an attribute a name without a semicolon is none if a letter, a digit or '=' follows.
REFERENCE_IN_VALUE = f"&(?:#[0-9]{{1,7}};?|#[xX][0-9a-fA-F]{{1,6}};?|[A-Za-z][A-Za-z0-9]{{1,31}};|(?:{BARE_NAMES})(?![A-Za-z0-9=]))"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _reference(in_value: bool):
    def read(ref: Column) -> Column:
        number = F.when(ref.rlike("^&#[xX]"), F.conv(F.regexp_extract(ref, "([0-9a-fA-F]+);?$", 1), 16, 10)) \
            .otherwise(F.regexp_extract(ref, "([0-9]+);?$", 1)).cast("bigint")
        valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        point = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        names = F.str_to_map(F.lit(NAMES), F.lit(PAIR), F.lit(PART))
        named = F.element_at(names, F.substring(ref, 2, 64))
        if not in_value:  # an unknown name may begin with one that needs no semicolon
            head = F.regexp_extract(ref, f"^&({BARE_NAMES})", 1)
            named = F.coalesce(named, F.when(head != "", F.concat(
                F.element_at(names, head), ref.substr(F.length(head) + 2, F.length(ref)))))
        return F.when(ref.startswith("&#"), F.when(valid, point).otherwise(ref)).otherwise(F.coalesce(named, ref))
    return read


def decode_references(c, in_value: bool) -> Column:
    """Character references decoded once, the longest name first; unknown ones stay."""
    pattern = REFERENCE_IN_VALUE if in_value else REFERENCE

    def decode(x: Column) -> Column:
        between, found = F.split(x, pattern, -1), F.regexp_extract_all(x, F.lit(pattern), F.lit(0))
        joined = F.zip_with(F.slice(between, 1, F.size(found)), F.transform(found, _reference(in_value)),
                            lambda a, b: F.concat(a, b))
        return F.when(x.contains("&"), F.concat(F.array_join(joined, ""), F.element_at(between, -1))).otherwise(x)
    return F.element_at(F.transform(F.array(_c(c)), decode), 1)


def link_tags(c) -> Column:
    """The link tags of a page in document order."""
    return F.regexp_extract_all(F.regexp_replace(_c(c), TOKENS, "$1$3"), F.lit(LINK_TAG), F.lit(0))


def tag_refs(c) -> Column:
    """``struct(kind, raw)`` of each link tag that has its attribute, in document order."""
    def refs(m: Column) -> Column:
        kind = F.lower(F.regexp_extract(m, "^<([A-Za-z]+)", 1))
        pattern = F.when(kind.isin(*HREF_TAGS.split("|")), F.lit(HREF_VALUE)).otherwise(F.lit(SRC_VALUE))

        def ref(value: Column) -> Column:
            bare = F.when(value.startswith('"') | value.startswith("'"), value.substr(F.lit(2), F.length(value) - 2)).otherwise(value)
            return F.struct(kind.alias("kind"), decode_references(bare, True).alias("raw"))
        return F.transform(F.regexp_extract_all(m, pattern, F.lit(1)), ref)  # one value or none: the pattern stands in the plan once
    return F.flatten(F.transform(link_tags(c), refs))


def title(c) -> Column:
    """The first title element's text, references decoded, white space collapsed and trimmed; '' if none."""
    text = F.regexp_replace(F.regexp_extract(_c(c), TITLE, 2), WS + "+", " ")
    return F.trim(decode_references(text, False))
