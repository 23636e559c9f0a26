"""Text functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.binding import let
from feedloom.functions.terms import SHORT_MONTHS, term_map

_JUNK = r"(?is)<(nav|header|footer|script|style|aside)\b[^>]*>.*?</\1\s*>"
_JUNK_CLASS = r"""(?is)<(\w+)\b[^>]*\bclass\s*=\s*["'][^"']*(?<![\w-])(?:share|related)(?![\w-])[^"']*["'][^>]*>.*?</\1\s*>"""
#: Named character references that occur in feeds.
_ENTITIES = [("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("nbsp", "\u00a0"), ("ndash", "–"), ("mdash", "—"), ("lsquo", "‘"), ("rsquo", "’"), ("ldquo", "“"), ("rdquo", "”"), ("hellip", "…"), ("bull", "•"), ("middot", "·"), ("copy", "©"), ("reg", "®"), ("trade", "™"), ("pound", "£"), ("euro", "€"), ("laquo", "«"), ("raquo", "»"), ("shy", "\u00ad"), ("zwj", "\u200d"), ("zwnj", "\u200c")]


def unescape(t: Column) -> Column:
    """Numeric references up to U+FFFF-and-beyond by chr(), common named ones by name, &amp; last so that nothing is read twice."""
    return let(t, _unescape)


def _unescape(t: Column) -> Column:
    parts = F.split(t, "&#", -1)
    number = lambda p: F.when(p.rlike("^[xX]"), F.conv(F.regexp_extract(p, r"^[xX]([0-9A-Fa-f]{1,6});", 1), 16, 10)).otherwise(F.regexp_extract(p, r"^(\d{1,7});", 1)).try_cast("int")
    good = lambda p: p.rlike(r"^(?:[xX][0-9A-Fa-f]{1,6}|\d{1,7});")
    rest = lambda p: F.regexp_replace(p, r"^[^;]*;", "")
    code = lambda n: F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    head = F.get(parts, F.lit(0))
    decoded = F.transform(F.slice(parts, 2, 1 << 30), lambda p: F.when(good(p), F.concat(code(number(p)), rest(p))).otherwise(F.concat(F.lit("&#"), p)))
    out = F.when(t.contains("&#"), F.concat(head, F.array_join(decoded, ""))).otherwise(t)
    for name, sign in _ENTITIES:
        out = F.replace(out, F.lit(f"&{name};"), F.lit(sign))
    return F.replace(out, F.lit("&amp;"), F.lit("&"))


def collapse(t: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(t, r"(?U)[\s\x1c-\x1f]+", " "), "^ | $", "")


def strip_markup(t: Column) -> Column:
    """Text of well-formed markup: menus, scripts, asides, share and related blocks go, tags become spaces, references are decoded."""
    return let(t, _strip_markup)


def _strip_markup(t: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"(?s)<!--.*?-->", " "), _JUNK, " "), _JUNK_CLASS, " ")
    return F.when(t.rlike("[<&]"), unescape(F.regexp_replace(bare, r"(?s)<[A-Za-z/!][^>]*>", " "))).otherwise(t)


def cut_words(t: Column, limit: int) -> Column:
    """A text of at most limit characters, cut at the last space before and marked by an ellipsis."""
    def cut(x):
        head = F.regexp_replace(F.substring(x, 1, limit), " [^ ]*$", "")
        return F.when(F.length(x) <= limit, x).otherwise(F.concat(F.regexp_replace(head, "[.,;:]+$", ""), F.lit("\u2026")))

    return let(t, cut)


def clean(t: Column, limit: int = 220) -> Column:
    """Markup off, white space collapsed, cut to limit; null for nothing."""
    return cut_words(F.nullif(collapse(strip_markup(t)), F.lit("")), limit)


def normalise_term(t: Column) -> Column:
    """A section name as a key: references decoded, invisible signs but the joiner off, white space collapsed, lower case."""
    return F.nullif(F.lower(collapse(F.translate(unescape(t), "\u200b\ufeff\u00ad", ""))), F.lit(""))


def category_of(terms: Column) -> Column:
    """The category of the first term in order that has one."""
    found = F.transform(terms, lambda t: F.try_element_at(term_map(), F.coalesce(normalise_term(t), F.lit(""))))
    return F.get(F.filter(found, lambda c: c.isNotNull()), F.lit(0))


def title_key(t: Column) -> Column:
    """Letters, digits and underscores of a title in lower case, 60 characters at most."""
    return F.substring(F.regexp_replace(F.lower(t), r"[^\p{L}\p{N}_]+", ""), 1, 60)


def without_publisher(t: Column) -> Column:
    """A search headline without ' - Publisher' at its end."""
    return F.trim(F.regexp_replace(t, r"\s+-\s+[^-]{2,40}$", ""))


def looks_like_date(t: Column) -> Column:
    s = F.trim(t)
    month = s.rlike("(?iu)" + "|".join(SHORT_MONTHS))
    sign = s.rlike(r"\d{4}[-/]\d{1,2}[-/]\d{1,2}") | s.rlike(r"\d{1,2}[:.]\d{2}") | (month & s.rlike(r"\d"))
    return F.coalesce(F.length(s).between(6, 60) & sign, F.lit(False))
