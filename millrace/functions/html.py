"""Links of web pages, read as a browser reads them, and references resolved against a base: native column expressions.

A page is cut into tokens by one expression: comments, declarations, elements whose content is no markup (with that
content), anchors, other tags. So what stands in a comment, a script or an attribute is no anchor. Script data that
hides its own end in a comment (`<!--<script>`) is not treated apart. Null in, null out.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Attributes of a tag: quotes matter after an equals sign only. The elements without markup inside.
ATTRIBUTES = r"(?:[\s/]|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\x22[^\x22]*+\x22|\x27[^\x27]*+\x27|[^\s>\x22\x27][^\s>]*+|(?=>)))?+)*+"
RAW = "script|style|textarea|title|xmp|iframe|noembed|noframes|noscript"
TOKEN = (
    r"(?is)<!--(?:-?>|.*?(?:--!?>|\z))|<[!?][^>]*+>?|</[^a-z>][^>]*+>?"
    rf"|<({RAW})(?=[\s/>]){ATTRIBUTES}>.*?(?:</\1(?=[\s/>])|\z)"
    rf"|<a(?=[\s/>])({ATTRIBUTES})>|</?[a-z][^\s/>]*+{ATTRIBUTES}>"
)
ATTRIBUTE = r"(?s)[^\s/>][^\s/>=]*(?:\s*=\s*(?:\x22[^\x22]*\x22|\x27[^\x27]*\x27|[^\s>\x22\x27][^\s>]*)?)?"
HREF = r"(?is)\Ahref\s*="
HREF_VALUE = r"(?is)\Ahref\s*=\s*(?:\x22([^\x22]*)\x22|\x27([^\x27]*)\x27|(.*))\z"
#: References in attributes: a name without a semicolon is none before an equals sign; what is no reference stays.
REFERENCE = r"&(?:#[xX][0-9a-fA-F]++;?|#[0-9]++;?|[a-zA-Z][a-zA-Z0-9]*+(?:;|(?!=)))|[^&]++|&"
COMMON = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": "\xa0"}
#: All names that HTML has, one after the other with their texts.
NAMES = "\x02".join(f"&{name}\x01{text}" for name, text in html5.items())
#: What numbers 128 to 159 mean.
C1 = "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ"


def references_decoded(value: Column) -> Column:
    """An attribute's value with its character references as characters; unknown ones stay as they are."""
    names = F.str_to_map(F.lit(NAMES), F.lit("\x02"), F.lit("\x01"))  # folded into one literal

    def numbered(number: Column) -> Column:
        code = F.coalesce(number, F.lit(0x110000))
        wrong = (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
        # UTF-32 is how a number becomes a character beyond Latin 1
        some = F.decode(F.to_binary(F.lpad(F.hex(code), 8, "0"), F.lit("hex")), "UTF-32")
        return F.when(wrong, "�").when(code.between(0x80, 0x9F), F.substring(F.lit(C1), (code - 0x7F).cast("int"), F.lit(1))).otherwise(some)

    def character(x: Column) -> Column:
        digits = lambda at: F.regexp_replace(F.substring(x, F.lit(at), F.length(x)), ";", "")
        hexadecimal, decimal = digits(4), digits(3)
        significant = lambda d: F.regexp_replace(d, "^0+", "")
        # numbers that are too long for a character are wrong ones
        of_hex = F.when(F.length(significant(hexadecimal)) <= 8, F.conv(hexadecimal, 16, 10).cast("long"))
        of_decimal = F.when(F.length(significant(decimal)) <= 9, decimal.cast("long"))
        out = F.when((x == "&") | ~x.startswith("&"), x)
        for name, text in COMMON.items():
            out = out.when(x == name, text)
        return out.when(F.lower(F.substring(x, 1, 3)) == "&#x", numbered(of_hex)).when(F.substring(x, 1, 2) == "&#", numbered(of_decimal)).otherwise(F.coalesce(F.try_element_at(names, x), x))

    parts = F.regexp_extract_all(value, F.lit(REFERENCE), F.lit(0))
    return F.when(value.contains("&"), F.array_join(F.transform(parts, character), "")).otherwise(value)


def links(html: Column, last: bool = False) -> Column:
    """The hrefs of the anchors in order, references decoded; last: one of each anchor, its last."""

    def of(attributes: Column) -> Column:
        found = F.filter(F.regexp_extract_all(attributes, F.lit(ATTRIBUTE), F.lit(0)), lambda x: x.rlike(HREF))
        some = F.when(F.size(found) > 0, F.slice(found, F.lit(-1), F.lit(1))).otherwise(found) if last else found
        return F.transform(some, lambda x: references_decoded(F.regexp_replace(x, HREF_VALUE, "$1$2$3")))

    return F.flatten(F.transform(F.filter(F.regexp_extract_all(html, F.lit(TOKEN), F.lit(2)), lambda x: x != ""), of))


# --- references to other pages ---

#: Scheme, authority, path and query of a reference, by the expression that the standard on URIs gives.
URI = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"


def without_dots(path: Column) -> Column:
    """An absolute path without its segments `.` and `..`."""
    dot = lambda s: s.isin(".", "..")
    segments = F.slice(F.split(path, "/", -1), F.lit(2), F.greatest(F.size(F.split(path, "/", -1)) - 1, F.lit(0)))
    none = F.array().cast("array<string>")

    def onward(kept: Column, s: Column) -> Column:
        shorter = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))
        return F.when(s == ".", kept).when(s == "..", shorter).otherwise(F.array_append(kept, s))

    kept = F.aggregate(segments, none, onward)
    kept = F.when(dot(F.element_at(segments, -1)), F.array_append(kept, F.lit(""))).otherwise(kept)
    return F.when(path.startswith("/") & path.contains("/."), F.concat(F.lit("/"), F.array_join(kept, "/"))).otherwise(path)


def resolved(base: Column, reference: Column) -> Column:
    """The absolute address of a reference on a page at base, without its fragment.

    White space around a reference and line ends or tabs within it go, as in browsers.
    """
    reference = F.regexp_replace(F.regexp_replace(reference, r"^[\x00-\x20]+|[\x00-\x20]+$", ""), r"[\t\n\r]", "")
    part = lambda c, n: F.regexp_extract(c, URI, n)
    scheme, authority, path = part(reference, 1), part(reference, 2), part(reference, 3)
    has_scheme, has_authority = scheme != "", reference.rlike("^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//")
    query = lambda c: F.when(c.rlike(r"^[^#]*\?"), F.concat(F.lit("?"), part(c, 4))).otherwise("")
    root = lambda s, a, p: F.concat(s, F.lit(":"), F.when(a[0], F.concat(F.lit("//"), a[1])).otherwise(""), without_dots(p))
    own = (has_authority, authority)
    of_base = (base.rlike("^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//"), part(base, 2))
    beside = F.when(of_base[0] & (part(base, 3) == ""), F.concat(F.lit("/"), path)).otherwise(F.concat(F.regexp_replace(part(base, 3), "[^/]*$", ""), path))
    return (
        F.when(has_scheme, F.concat(root(scheme, own, path), query(reference)))
        .when(has_authority, F.concat(root(part(base, 1), own, path), query(reference)))
        .when(path == "", F.concat(root(part(base, 1), of_base, part(base, 3)), F.when(reference.rlike(r"^[^#]*\?"), query(reference)).otherwise(query(base))))
        .when(path.startswith("/"), F.concat(root(part(base, 1), of_base, path), query(reference)))
        .otherwise(F.concat(root(part(base, 1), of_base, beside), query(reference)))
    )
