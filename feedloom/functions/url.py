"""URL functions as column expressions. No parser of Spark's own is used: they differ on odd hosts and raise on bad URLs."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.binding import let
from feedloom.functions.terms import JUNK_PARAMS

_URL = r"^([A-Za-z][A-Za-z0-9+.\-]*):(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def scheme(u: Column) -> Column:
    return F.lower(F.regexp_extract(u, _URL, 1))


def netloc(u: Column) -> Column:
    return F.regexp_extract(u, _URL, 2)


def path(u: Column) -> Column:
    return F.regexp_extract(u, _URL, 3)


def query(u: Column) -> Column:
    return F.regexp_extract(u, _URL, 4)


def host(u: Column) -> Column:
    """Lower case, without userinfo, port and final dots."""
    return F.regexp_replace(F.lower(F.regexp_replace(netloc(u), r"^.*@|:[^:\]]*$|[\[\]]", "")), r"\.+$", "")


def without_www(h: Column) -> Column:
    return F.regexp_replace(h, r"^www\.", "")


def _is_ipv4(h: Column) -> Column:
    return h.rlike(r"^(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]\d|\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]\d|\d)$")


def _public_ipv4(h: Column) -> Column:
    """Not in a private, shared, loopback, link-local, documentation, benchmark or reserved network; multicast counts as public."""
    closed = [r"0\.", r"10\.", r"127\.", r"169\.254\.", r"172\.(?:1[6-9]|2\d|3[01])\.", r"192\.168\.", r"192\.0\.0\.(?!(?:9|10)$)", r"192\.0\.2\.", r"198\.1[89]\.", r"198\.51\.100\.", r"203\.0\.113\.", r"100\.(?:6[4-9]|[7-9]\d|1[01]\d|12[0-7])\.", r"2(?:4\d|5[0-5])\."]
    return ~reduce(or_, [h.rlike("^" + c) for c in closed])


def _public_ipv6(h: Column) -> Column:
    """Global unicast outside of documentation and protocol networks."""
    return h.rlike(r"^[23][0-9a-f]{0,3}:") & ~h.rlike(r"^2001:0?db8:") & ~h.rlike(r"^2001:(?:0{0,4}|0?1[0-9a-f]{0,2}):") & ~h.rlike("^2002:") & ~h.rlike("^3fff:")


def valid(u: Column, allowed: Column | None = None) -> Column:
    """Whether a URL is http(s) without credentials, odd ports, spaces or non-public hosts; allowed: an array of hosts, exact but for www."""
    return let(u, lambda x: let(host(x), lambda h: _valid(x, h, allowed)))


def _valid(u: Column, h: Column, allowed: Column | None) -> Column:
    loc = netloc(u)
    port = F.regexp_extract(loc, r":([^:\]@]*)$", 1)
    named = h.contains(".") & ~h.rlike(r"\.(?:localhost|local|internal)$")
    public = F.when(loc.rlike(r"^\["), _public_ipv6(h)).when(_is_ipv4(h), _public_ipv4(h)).otherwise(named)
    good = (
        ~u.rlike(r"(?U)[\s\\\x00-\x1f\x7f]") & scheme(u).isin("http", "https") & (h != "") & ~loc.contains("@") & port.isin("", "80", "443") & public
    )
    if allowed is not None:
        bare = F.transform(allowed, lambda a: without_www(F.regexp_replace(F.lower(a), r"\.+$", "")))
        good = good & F.array_contains(bare, without_www(h))
    return F.coalesce(good, F.lit(False))


def is_search_link(u: Column) -> Column:
    """Whether a link goes by way of the news search engine."""
    return valid(u, F.array(F.lit("news.google.com")))


def _decode(v: Column) -> Column:
    return F.coalesce(F.try_url_decode(v), v)


def _encode(v: Column) -> Column:
    return F.replace(F.replace(F.url_encode(v), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def kept_query(q: Column) -> Column:
    """The query without junk parameters and blank values, encoded anew, in order."""
    pairs = F.transform(F.filter(F.split(q, "&"), lambda p: p.contains("=")), lambda p: F.struct(_decode(F.substring_index(p, "=", 1)).alias("k"), _decode(F.regexp_replace(p, r"^[^=]*=", "")).alias("v")))
    good = F.filter(pairs, lambda p: (p.v != "") & ~F.lower(p.k).isin(*JUNK_PARAMS))
    return F.array_join(F.transform(good, lambda p: F.concat(_encode(p.k), F.lit("="), _encode(p.v))), "&")


def canonical(u: Column) -> Column:
    """The stored form of a URL, null if it is not valid: https, host in lower case, no final slashes, junk parameters or fragment."""
    return let(u, _canonical)


def _canonical(u: Column) -> Column:
    p = F.regexp_replace(F.regexp_replace(path(u), r";[^/]*$", ""), "/+$", "")
    return F.when(valid(u), let(kept_query(query(u)), lambda q: _with_query(u, p, q)))


def _with_query(u: Column, p: Column, q: Column) -> Column:
    return F.concat(F.lit("https://"), F.lower(netloc(u)), F.when(p == "", "/").otherwise(p), F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""))


def dedupe_key(u: Column) -> Column:
    """The identity of a page: its canonical URL without www."""
    return F.regexp_replace(canonical(u), r"^https://www\.", "https://")


def article_id(u: Column) -> Column:
    return F.substring(F.sha1(dedupe_key(u).cast("binary")), 1, 16)


def join(base: Column, ref: Column) -> Column:
    """RFC 3986 reference resolution for absolute, //host, /path, ?query, #fragment and relative references, with dot segments."""
    return let(base, lambda b: let(ref, lambda r: _join(b, r)))


def _join(base: Column, ref: Column) -> Column:
    root = F.concat(scheme(base), F.lit("://"), netloc(base))
    folder = F.regexp_replace(path(base), r"[^/]*$", "")
    ref_path = F.regexp_extract(ref, r"^([^?#]*)", 1)
    tail = F.regexp_extract(ref, r"^[^?#]*(.*)$", 1)
    whole = F.when(ref_path.startswith("/"), ref_path).otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), ref_path))
    clean = let(whole, _without_dots)
    own_path = F.when(tail.startswith("?"), F.concat(root, path(base), tail)).otherwise(F.concat(root, path(base), F.when(query(base) != "", F.concat(F.lit("?"), query(base))).otherwise(""), tail))
    return (
        F.when(ref.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), ref).when(ref.startswith("//"), F.concat(scheme(base), F.lit(":"), ref))
        .when(ref_path == "", own_path).otherwise(F.concat(root, clean, tail))
    )


def _without_dots(merged: Column) -> Column:
    steps = F.aggregate(
        F.split(merged, "/"), F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc)).when(s == ".", acc).otherwise(F.array_append(acc, s)),
    )
    return F.concat(F.array_join(steps, "/"), F.when(merged.rlike(r"(^|/)\.\.?$"), "/").otherwise(""))


def _quote(part: Column, safe: str) -> Column:
    """Percent-encoding that leaves letters, digits, _.-~ and the safe signs."""
    sign = lambda c: F.when(c.rlike(rf"^[A-Za-z0-9_.\-~{safe}]$"), c).otherwise(F.regexp_replace(F.hex(F.encode(c, "UTF-8")), "(..)", "%$1"))
    signs = F.filter(F.split(part, ""), lambda c: c != "")
    return F.when(part.rlike(rf"^[A-Za-z0-9_.\-~{safe}]*$"), part).otherwise(F.array_join(F.transform(signs, sign), ""))


def encode_path(u: Column) -> Column:
    """Raw spaces and brackets of path and query in percent form; triplets stay, the fragment goes."""
    def encoded(x):
        q = query(x)
        return F.concat(scheme(x), F.lit("://"), netloc(x), let(path(x), lambda p: _quote(p, "/%")), F.when(q != "", F.concat(F.lit("?"), let(q, lambda y: _quote(y, "=&%")))).otherwise(""))

    return let(u, encoded)


def domain(u: Column) -> Column:
    return without_www(F.lower(netloc(u)))


def parent_domain(u: Column) -> Column:
    parts = F.split(domain(u), r"\.")
    return F.when(F.size(parts) <= 2, domain(u)).otherwise(F.array_join(F.slice(parts, -2, 2), "."))
